"""Audits (V1-V8): each returns a report DataFrame
``(check_name STRING, ok BOOLEAN, value DOUBLE, severity STRING)``; severity is ``error`` or ``warning``.

Metrics are computed in one distributed aggregation per input; the rules are
expressions over that single metrics row, unpivoted with ``stack``. Nothing is
printed or decided on the driver; ``assert_ok`` turns the failed errors of a
report into an exception when a pipeline must stop; warnings don't stop it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe import constants as C
from floe.operators import select, stats
from floe.session import materialize


def one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row metric frames with distinct columns into a single row (no cross join)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def checks(metrics: DataFrame, rules: list[tuple[str, ...]], nd: int = 6) -> DataFrame:
    """Rules ``(name, ok_sql, value_sql[, severity])`` evaluated on a one-row metrics frame."""
    parts = ", ".join(f"'{r[0]}', CAST({r[1]} AS BOOLEAN), CAST(round({r[2]}, {nd}) AS DOUBLE), '{r[3] if len(r) > 3 else 'error'}'" for r in rules)
    return metrics.selectExpr(f"stack({len(rules)}, {parts}) AS (check_name, ok, value, severity)")


def assert_ok(report: DataFrame) -> None:
    """Raises with every failed error (a report has a row per rule)."""
    bad = report.where(~F.coalesce(F.col("ok"), F.lit(False)) & (F.col("severity") == "error")).select("check_name").collect()
    if bad:
        raise ValueError(f"audit failed: {[r.check_name for r in bad]}")


def physics(df: DataFrame, values: list[str], area: str | None = "ice_area") -> DataFrame:
    """V1: |v| <= 500 for height-change variables (a warning); ice area non-negative and of a sane magnitude."""
    aggs = [F.max(F.abs(v)).alias(f"{v}_maxabs") for v in values]
    rules = [(f"{v}_within_500", f"coalesce({v}_maxabs <= {C.HEIGHT_CHANGE_ABS_MAX}, true)", f"{v}_maxabs", "warning")
             for v in values]
    if area:
        aggs += [F.min(area).alias("area_min"), F.max(area).alias("area_max")]
        rules += [("ice_area_non_negative", "coalesce(area_min >= 0, true)", "area_min"),
                  ("ice_area_magnitude",
                   f"coalesce(CASE WHEN area_max > {C.ICE_AREA_UNIT_SWITCH} THEN area_max <= {C.ICE_AREA_M2_MAX} "
                   f"ELSE area_max <= {C.ICE_AREA_FRACTION_MAX} END, true)", "area_max")]
    return checks(df.agg(*aggs), rules)


def grid_compat(src: DataFrame, dst: DataFrame, src_res: float, dst_res: float,
                src_tol: float = 1.0, dst_tol: float = 0.5, coord: str = "x") -> DataFrame:
    """V2: measured spacings of source and target match their nominal values and ratio."""
    def res(df, p):
        return df.agg(((F.max(coord) - F.min(coord)) / (F.count_distinct(coord) - 1).cast("double")).alias(f"{p}_res"))
    m = one_row(res(src, "src"), res(dst, "dst"))
    rules = [("source_spacing", f"abs(src_res - {src_res}) <= {src_tol} + 1e-5 * {src_res}", "src_res"),
             ("target_spacing", f"abs(dst_res - {dst_res}) <= {dst_tol} + 1e-5 * {dst_res}", "dst_res"),
             ("spacing_ratio", f"abs(src_res / dst_res - {src_res / dst_res}) <= 1e-6", "src_res / dst_res")]
    return checks(m, rules)


def mosaic_integrity(df: DataFrame, value: str, canvas_cells: int) -> DataFrame:
    """V3: steps present, coverage at the middle step, value range within +/-500."""
    df = materialize(df, "audit")
    a = df.agg(F.count_distinct("time").alias("n_steps"), F.max(F.abs(value)).alias("maxabs"))
    b = select.pick_steps(df, "middle").agg(F.count(value).alias("n_mid"))
    m = one_row(a, b)
    rules = [("n_steps", "n_steps > 0", "n_steps"),
             ("coverage_middle_pct", f"n_mid * 100.0 / {canvas_cells} >= {C.COVERAGE_WARN_PCT}", f"n_mid * 100.0 / {canvas_cells}", "warning"),
             ("range_within_500", f"coalesce(maxabs <= {C.HEIGHT_CHANGE_ABS_MAX}, true)", "maxabs", "warning")]
    return checks(m, rules)


def product_audit(df: DataFrame, value: str, res: float, canvas_cells: int, tol: float = 0.1) -> DataFrame:
    """V4: spacing, coverage >= 1% and value range at the last step."""
    df = materialize(df, "audit")
    a = df.agg(((F.max("x") - F.min("x")) / (F.count_distinct("x") - 1).cast("double")).alias("res"))
    last = select.pick_steps(df, "last")
    b = last.agg(F.count(value).alias("n_last"), F.max(F.abs(value)).alias("maxabs_last"))
    m = one_row(a, b)
    rules = [("spacing", f"abs(res - {res}) <= {tol} + 1e-5 * {res}", "res"),
             ("coverage_last_pct", f"n_last * 100.0 / {canvas_cells} >= {C.COVERAGE_WARN_PCT}",
              f"n_last * 100.0 / {canvas_cells}", "warning"),
             ("range_last_within_500", f"coalesce(maxabs_last <= {C.HEIGHT_CHANGE_ABS_MAX}, true)", "maxabs_last", "warning")]
    return checks(m, rules)


def anomaly_audit(df: DataFrame, keys: list[str], value: str, time: str = "time") -> DataFrame:
    """V5: unique keys; typical range, coverage, time gaps and temporal spread (warnings)."""
    df = materialize(df, "audit")
    dup = stats.duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n_dup"))
    a = df.agg(F.max(F.abs(value)).alias("maxabs"), F.count(value).alias("n_valid"),
               F.count_distinct(keys[0]).alias("n_regions"), F.count_distinct(time).alias("n_steps"))
    gaps = stats.consecutive_gaps(df, time).agg(
        F.count_if(F.col("gap") > C.GAP_WARN_DAYS).alias("n_large_gaps"), F.max("gap").alias("max_gap"))
    spread = stats.temporal_moments(df, value, keys=[k for k in keys if k != time], nd=None).agg(
        F.max("std").alias("max_std"), F.count_if(F.col("std") == 0).alias("n_flat"))
    m = one_row(dup, a, gaps, spread)
    pct = "n_valid * 100.0 / (n_regions * n_steps)"
    rules = [("keys_unique", "n_dup = 0", "n_dup"),
             ("within_typical", f"coalesce(maxabs <= {C.LWE_TYPICAL_ABS}, true)", "maxabs", "warning"),
             ("coverage_pct", f"{pct} >= {C.COVERAGE_WARN_PCT}", pct, "warning"),
             ("large_time_gaps", "n_large_gaps = 0", "n_large_gaps", "warning"),
             ("max_gap_days", f"coalesce(max_gap <= {C.GAP_WARN_DAYS}, true)", "max_gap", "warning"),
             ("regions_vary", "n_flat = 0", "n_flat", "warning"),
             ("max_temporal_std", f"coalesce(max_std <= {C.LWE_TYPICAL_ABS}, true)", "max_std", "warning")]
    return checks(m, rules)


def gridded_anomaly_audit(df: DataFrame, grid: DataFrame, value: str, ny: int, nx: int, every: int = 10, every_cell: int = 10, time: str = "time") -> DataFrame:
    """V5 on the grid, all parts: dimensions and coordinates against ``grid`` (iy, ix, x, y), unique keys, data at the first, middle
    and last step, statistics of a strided sample (P9, A6), continuity of time, and the quadrants of the temporal mean (A5).

    ``ny`` and ``nx`` are the grid's shape; halves are those of the whole grid. One aggregate by pixel serves coordinates,
    keys and quadrants, one by step the completeness; the sample's median is a radix selection.
    """
    df = materialize(df, "audit")
    mean = F.avg(value)
    pixels = materialize(df.groupBy("iy", "ix").agg(
        *[f(c).alias(f"{c}{n}") for c in ("x", "y") for n, f in ((0, F.min), (1, F.max))], F.count(F.lit(1)).alias("rows"),
        F.size(F.collect_set(time)).alias("steps"), mean.alias("mean")), "audit")

    def close(c):
        tolerance = F.lit(1e-8) + F.lit(1e-5) * F.abs(F.col(f"g{c}"))
        return (F.abs(F.col(f"{c}0") - F.col(f"g{c}")) <= tolerance) & (F.abs(F.col(f"{c}1") - F.col(f"g{c}")) <= tolerance)
    cells = grid.select("iy", "ix", F.col("x").alias("gx"), F.col("y").alias("gy"))
    placed = pixels.join(cells, ["iy", "ix"], "left").agg(
        F.count_if(~F.coalesce(close("x"), F.lit(False))).alias("n_x_off"), F.count_if(~F.coalesce(close("y"), F.lit(False))).alias("n_y_off"),
        F.sum(F.col("rows") - F.col("steps")).alias("n_dup"), F.count_distinct("iy").alias("n_y"), F.count_distinct("ix").alias("n_x"))
    shape = grid.agg(F.count_distinct("iy").alias("grid_y"), F.count_distinct("ix").alias("grid_x"), F.count(F.lit(1)).alias("n_cells"))
    per_step = df.groupBy(time).agg(F.count(value).alias("n")).join(select.step_positions(df, time), time)
    steps = per_step.agg(F.max("n_steps").alias("n_steps"), F.max(F.when(F.col("pos") == 0, F.col("n"))).alias("n_first"),
                         F.max(F.when(F.col("pos") == F.floor(F.col("n_steps") / 2), F.col("n"))).alias("n_middle"),
                         F.max(F.when(F.col("pos") == F.col("n_steps") - 1, F.col("n"))).alias("n_last"))
    sample = materialize(select.strided_sample(df, every, every_cell, time).select(value), "audit")
    seen = stats.robust_stats(sample, value, C.LWE_TYPICAL_ABS, nd=None).select(
        "vmin", "vmax", "vmean", "vmedian", "vstd", F.col("n").alias("n_sample"))
    gaps = stats.consecutive_gaps(df, time).agg(F.count_if(F.col("gap") > C.GAP_WARN_DAYS).alias("n_large_gaps"), F.max("gap").alias("max_gap"),
                                                F.min("gap").alias("min_gap"))
    quarters = stats.quadrant_stats(pixels, "mean", ny, nx, nd=None)
    names = ("NW", "NE", "SW", "SE")
    spread = quarters.agg(*[F.max(F.when(F.col("quadrant") == q, F.col(c))).alias(f"{q}_{c}") for q in names for c in ("mean", "std", "n")])
    m = one_row(placed, shape, steps, seen, gaps, spread)

    def typical(c):
        return f"coalesce(abs({c}) <= {C.LWE_TYPICAL_ABS}, false)"
    rules = [("rows_match", "n_y = grid_y", "n_y"), ("columns_match", "n_x = grid_x", "n_x"),
             ("x_matches", "n_x_off = 0", "n_x_off"), ("y_matches", "n_y_off = 0", "n_y_off"), ("keys_unique", "n_dup = 0", "n_dup"),
             *[(f"{s}_step_pct", f"n_{s} * 100.0 / n_cells >= {C.COVERAGE_WARN_PCT}", f"n_{s} * 100.0 / n_cells", "warning") for s in ("first", "middle", "last")],
             ("sample_size", "n_sample > 0", "n_sample", "warning"),
             *[(f"sample_{c}", typical(f"v{c}"), f"v{c}", "warning") for c in ("min", "max", "mean", "median", "std")],
             ("large_time_gaps", "n_large_gaps = 0", "n_large_gaps", "warning"),
             ("max_gap_days", f"coalesce(max_gap <= {C.GAP_WARN_DAYS}, true)", "max_gap", "warning"),
             ("min_gap_days", "coalesce(min_gap >= 1, true)", "min_gap"),
             *[(f"quadrant_{q}_pixels", f"coalesce({q}_n > 0, false)", f"coalesce({q}_n, 0)", "warning") for q in names],
             *[(f"quadrant_{q}_{c}", typical(f"{q}_{c}"), f"{q}_{c}", "warning") for q in names for c in ("mean", "std")]]
    return checks(m, rules)


def ocean_audit(df: DataFrame, types: dict[str, str], shelf: DataFrame, grid: DataFrame, times: DataFrame,
                max_depth: float, units: tuple[str, ...] = (), value_2d: tuple[str, ...] = ("ice_draft", "clamped_depth", "mascon_id"),
                reference: str = "dist_to_ocean", salinity: str = "so", temperature: str = "thetao") -> DataFrame:
    """V6, all groups: schema and types, coordinates and times against their sources, NaN fill, coverage of the
    shelf, one null pattern, bounds, whole-number regions, temporal coverage, metadata.

    ``types``: required columns and their Spark type names; ``shelf``: expected pixels; ``grid`` and
    ``times``: pixels and steps of the source stores; ``max_depth``: deepest level of the ocean
    product; ``units``: columns that must carry a unit. Bounds and coverage look at shelf
    pixels. The table is written once; three aggregates (rows, pixels, steps) read it.
    """
    have = {f.name: f for f in df.schema.fields}
    missing = [c for c in types if c not in have]
    if missing:
        one = df.sparkSession.range(1)
        return checks(one, [("required_columns", "false", f"{len(missing)}")])
    pix = ["iy", "ix"]
    on_shelf = shelf.select(*pix).distinct().withColumn("_shelf", F.lit(True))
    rows = materialize(df.join(on_shelf, pix, "left").withColumn("_shelf", F.coalesce("_shelf", F.lit(False))), "audit")
    inside = lambda cond: F.count_if(F.col("_shelf") & cond)
    two = [reference, *value_2d]
    nans = [F.isnan(c) for c, t in types.items() if t in ("float", "double")]
    a = rows.agg(
        F.count_if(reduce(lambda x, y: x | y, nans)).alias("n_nan"),
        *[F.count_if(F.col(c).isNull() != F.col(reference).isNull()).alias(f"n_null_{c}") for c in value_2d],
        F.count_if(F.col(temperature).isNull() != F.col(salinity).isNull()).alias("n_null_pair"),
        inside(~((F.col(reference) >= 0) & (F.col(reference) < C.DIST_MAX_M))).alias("n_dist_out"),
        inside(~F.col("clamped_depth").between(0, max_depth + 1.0)).alias("n_depth_out"),
        inside(~F.col("ice_draft").between(C.DRAFT_MIN, C.DRAFT_MAX)).alias("n_draft_out"),
        inside(~F.col(temperature).between(C.THETAO_MIN, C.THETAO_MAX)).alias("n_thetao_out"),
        inside(~F.col(salinity).between(C.SO_MIN, C.SO_MAX)).alias("n_so_out"),
        inside(F.col("mascon_id") != F.rint("mascon_id")).alias("n_mascon_part"))
    per_step = rows.groupBy("time").agg(F.count_if(F.col("_shelf") & F.col(temperature).isNotNull()).alias("n")).agg(
        F.min("n").alias("min_per_step"), F.count(F.lit(1)).alias("n_steps"))
    # pixels: the table's, the shelf's and the source grid's in one aggregate
    flags = lambda d, **k: d.select(*pix, *[(F.lit(v) if not isinstance(v, Column) else v).alias(n) for n, v in k.items()])
    sides = (flags(rows, own=1, data=F.col(reference).isNotNull().cast("int"), t=F.when(F.col(temperature).isNotNull(), F.col("time")), sh=0, src=0)
             .unionByName(flags(on_shelf, own=0, data=0, t=F.lit(None).cast(rows.schema["time"].dataType), sh=1, src=0))
             .unionByName(flags(grid, own=0, data=0, t=F.lit(None).cast(rows.schema["time"].dataType), sh=0, src=1)))
    px = sides.groupBy(*pix).agg(*[F.max(c).alias(c) for c in ("own", "data", "sh", "src")], F.count("t").alias("n_t"))
    n_steps = rows.select("time").distinct().count()
    per_px = px.agg(F.count_if((F.col("own") == 1) & (F.col("src") == 0)).alias("n_px_extra"),
                    F.count_if((F.col("own") == 0) & (F.col("src") == 1)).alias("n_px_lacking"),
                    F.count_if((F.col("sh") == 1) & (F.col("data") == 0)).alias("n_shelf_lacking"),
                    F.count_if((F.col("sh") == 0) & (F.col("data") == 1)).alias("n_outside"),
                    F.count_if((F.col("sh") == 1) & (F.col("n_t") < n_steps)).alias("n_px_gaps"))
    tt = (rows.select("time").distinct().withColumn("o", F.lit(1)).withColumn("s", F.lit(0))
          .unionByName(times.select("time").distinct().withColumn("o", F.lit(0)).withColumn("s", F.lit(1)))
          .groupBy("time").agg(F.max("o").alias("o"), F.max("s").alias("s"))
          .agg(F.count_if(F.col("o") != F.col("s")).alias("n_time_diff")))
    m = one_row(a, per_step, per_px, tt)
    zero = lambda name, count: (name, f"{count} = 0", count)
    wrong = [c for c, t in types.items() if have[c].dataType.typeName() != t]
    bare = [c for c in units if not (have[c].metadata or {}).get("units")]
    rules = [("required_columns", "true", "0"), ("column_types", f"{len(wrong)} = 0", f"{len(wrong)}"),
             zero("pixels_not_in_grid", "n_px_extra"), zero("grid_pixels_lacking", "n_px_lacking"), zero("time_differs", "n_time_diff"),
             zero("nan_values", "n_nan"), zero("shelf_without_data", "n_shelf_lacking"), zero("data_outside_shelf", "n_outside"),
             *[zero(f"null_pattern_{c}", f"n_null_{c}") for c in value_2d], zero("null_pattern_pair", "n_null_pair"),
             zero("dist_bounds", "n_dist_out"), zero("depth_bounds", "n_depth_out"), zero("draft_bounds", "n_draft_out"),
             zero("thetao_bounds", "n_thetao_out"), zero("so_bounds", "n_so_out"), zero("mascon_whole", "n_mascon_part"),
             ("min_valid_per_step", "min_per_step > 0", "min_per_step"), zero("shelf_pixels_with_time_gaps", "n_px_gaps"),
             ("units_missing", f"{len(bare)} = 0", f"{len(bare)}")]
    return checks(m, rules)


def merge_validation(df: DataFrame, value: str, canvas_cells: int) -> DataFrame:
    """V7: unique keys, x ascending along ix, y descending along iy, one coordinate per index; coverage of the
    first step >= 1% (a warning)."""
    df = materialize(df, "audit")
    dup = stats.duplicate_keys(df, ["iy", "ix", "time"]).agg(F.count(F.lit(1)).alias("n_dup"))
    x = stats.successor_violations(df, "ix", "x", True).select(F.col("n_violations").alias("n_x_violations"))
    y = stats.successor_violations(df, "iy", "y", False).select(F.col("n_violations").alias("n_y_violations"))
    several = [df.select(i, c).distinct().groupBy(i).count().agg(F.count_if(F.col("count") > 1).alias(f"n_{c}_several")) for i, c in (("ix", "x"), ("iy", "y"))]
    cov = select.pick_steps(df, "first").agg(F.count(value).alias("n_valid"))
    m = one_row(dup, x, y, *several, cov)
    pct = f"n_valid * 100.0 / {canvas_cells}"
    rules = [("unique_keys", "n_dup = 0", "n_dup"),
             ("x_monotonic", "n_x_violations = 0", "n_x_violations"), ("y_monotonic", "n_y_violations = 0", "n_y_violations"),
             ("x_single", "n_x_several = 0", "n_x_several"), ("y_single", "n_y_several = 0", "n_y_several"),
             ("coverage_first_pct", f"{pct} >= {C.COVERAGE_WARN_PCT}", pct, "warning")]
    return checks(m, rules)


def post_write(df: DataFrame, cols: list[str]) -> DataFrame:
    """V8: min / max / count of newly written columns (present and non-empty)."""
    aggs = []
    rules = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max"),
                 F.count(c).alias(f"{c}_n")]
        rules += [(f"{c}_count", f"{c}_n > 0", f"{c}_n"), (f"{c}_min", f"{c}_min IS NOT NULL", f"{c}_min"),
                  (f"{c}_max", f"{c}_max IS NOT NULL", f"{c}_max")]
    return checks(df.agg(*aggs), rules)

"""Registered queries: audits (V1-V8) and the whole compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from floe.functions import thermo
from floe.functions.grid import FIXTURE_GRID as G
from floe.functions.timefn import days_to_timestamp, quarter_start
from floe.operators import audit, joins, mosaic, regrid, select, stencil
from floe.operators.joins import broadcast_checked
from floe.plans import q_grid, q_io
from floe.plans.registry import query
from floe.session import materialize, scratch_path
from floe.sinks import writers
from floe.sources import fixtures as fx
from floe.sources import readers

W = fx.ctes
XY = "CAST(-3071750 + 500*ix AS DOUBLE) AS x, CAST(3071750 - 500*iy AS DOUBLE) AS y"
_ROWS = "(SELECT max(p_partkey // 50) + 1 FROM part)"
_CELLS = f"(50 * {_ROWS})"


def _xy(df):
    return df.withColumns({"x": G.x("ix"), "y": G.y("iy")})


def _cells(spark, d) -> int:
    return fx.NX * fx.grid_rows(spark, d)


def _rep(rows: list[tuple[str, ...]], src: str) -> str:
    """DuckDB text of an audit report: rows of (check_name, ok, value, severity)."""
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS check_name, CAST({ok} AS BOOLEAN) AS ok, CAST(round({v}, 6) AS DOUBLE) AS value, "
        f"'{sev[0] if sev else 'error'}' AS severity FROM {src}"
        for n, ok, v, *sev in rows)


_M1 = """
, m1 AS (SELECT iy, ix, time, delta_h, delta_h_sigma, tile_order FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY iy, ix, time ORDER BY delta_h_sigma NULLS LAST, tile_order) AS rn
  FROM fx_tiles WHERE delta_h_sigma IS NOT NULL OR tile_order = 0) WHERE rn = 1)
"""


def _m1(spark, d):
    return mosaic.mosaic(fx.fx_tiles(spark, d), "delta_h_sigma")


# ----------------------------------------------------------------- audits ---

@query("v1_physics_audit", W("fx_icesat") + """
, m AS (SELECT MAX(abs(delta_h)) AS delta_h_maxabs, MIN(ice_area) AS area_min, MAX(ice_area) AS area_max FROM fx_icesat)
""" + _rep([("delta_h_within_500", "coalesce(delta_h_maxabs <= 500.0, true)", "delta_h_maxabs", "warning"),
            ("ice_area_non_negative", "coalesce(area_min >= 0, true)", "area_min"),
            ("ice_area_magnitude", "coalesce(CASE WHEN area_max > 2.0 THEN area_max <= 2000000.0 ELSE area_max <= 1.01 END, true)",
             "area_max")], "m"))
def v1_physics_audit(spark, d):
    return audit.physics(fx.fx_icesat(spark, d), ["delta_h"], "ice_area")


_TGT = """
, t AS (SELECT CAST(250 + 500 * (2*cx + b) AS DOUBLE) AS x FROM fx_coarse, (VALUES (0), (1)) B(b)),
s AS (SELECT CAST(1000 * cx AS DOUBLE) AS x FROM fx_coarse),
m AS (SELECT (SELECT (MAX(x) - MIN(x)) / CAST(COUNT(DISTINCT x) - 1 AS DOUBLE) FROM s) AS src_res,
             (SELECT (MAX(x) - MIN(x)) / CAST(COUNT(DISTINCT x) - 1 AS DOUBLE) FROM t) AS dst_res)
"""


def _v2(spark, d):
    c = fx.fx_coarse(spark, d)
    src = c.select((F.col("cx") * 1000).cast("double").alias("x"))
    dst = q_grid._targets_2x(c).select((F.lit(250) + F.col("ix") * 500).cast("double").alias("x"))
    return audit.grid_compat(src, dst, 1000.0, 500.0)


@query("v2_grid_compat", W("fx_coarse") + _TGT + _rep([
    ("source_spacing", "abs(src_res - 1000.0) <= 1.0 + 1e-5 * 1000.0", "src_res"),
    ("target_spacing", "abs(dst_res - 500.0) <= 0.5 + 1e-5 * 500.0", "dst_res"),
    ("spacing_ratio", "abs(src_res / dst_res - 2.0) <= 1e-6", "src_res / dst_res")], "m"))
def v2_grid_compat(spark, d):
    return _v2(spark, d)


_STEPS = """
, st AS (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS pos, COUNT(*) OVER () AS n FROM (SELECT DISTINCT time FROM {src}))
"""


@query("v3_mosaic_integrity", W("fx_tiles") + _M1 + _STEPS.format(src="m1") + f"""
, m AS (SELECT (SELECT COUNT(DISTINCT time) FROM m1) AS n_steps, (SELECT MAX(abs(delta_h)) FROM m1) AS maxabs,
              (SELECT COUNT(delta_h) FROM m1 JOIN st ON m1.time = st.time WHERE st.pos = st.n // 2) AS n_mid)
""" + _rep([("n_steps", "n_steps > 0", "n_steps"),
            ("coverage_middle_pct", f"n_mid * 100.0 / {_CELLS} >= 1.0", f"n_mid * 100.0 / {_CELLS}", "warning"),
            ("range_within_500", "coalesce(maxabs <= 500.0, true)", "maxabs", "warning")], "m"))
def v3_mosaic_integrity(spark, d):
    return audit.mosaic_integrity(_m1(spark, d), "delta_h", _cells(spark, d))


@query("v4_product_audit", W("fx_icesat") + f", p AS (SELECT *, {XY} FROM fx_icesat)" + _STEPS.format(src="p") + f"""
, m AS (SELECT (SELECT (MAX(x) - MIN(x)) / CAST(COUNT(DISTINCT x) - 1 AS DOUBLE) FROM p) AS res,
              (SELECT COUNT(delta_h) FROM p JOIN st ON p.time = st.time WHERE st.pos = st.n - 1) AS n_last,
              (SELECT MAX(abs(delta_h)) FROM p JOIN st ON p.time = st.time WHERE st.pos = st.n - 1) AS maxabs_last)
""" + _rep([("spacing", "abs(res - 500.0) <= 0.1 + 1e-5 * 500.0", "res"),
            ("coverage_last_pct", f"n_last * 100.0 / {_CELLS} >= 1.0", f"n_last * 100.0 / {_CELLS}", "warning"),
            ("range_last_within_500", "coalesce(maxabs_last <= 500.0, true)", "maxabs_last", "warning")], "m"))
def v4_product_audit(spark, d):
    return audit.product_audit(_xy(fx.fx_icesat(spark, d)), "delta_h", 500.0, _cells(spark, d))


_QUADS = ("NW", "NE", "SW", "SE")
_V5_RULES = [
    ("rows_match", "n_y = grid_y", "n_y"), ("columns_match", "n_x = grid_x", "n_x"), ("x_matches", "n_x_off = 0", "n_x_off"),
    ("y_matches", "n_y_off = 0", "n_y_off"), ("keys_unique", "n_dup = 0", "n_dup"),
    *[(f"{s}_step_pct", f"n_{s} * 100.0 / n_cells >= 1.0", f"n_{s} * 100.0 / n_cells", "warning") for s in ("first", "middle", "last")],
    ("sample_size", "n_sample > 0", "n_sample", "warning"),
    *[(f"sample_{c}", f"coalesce(abs(v{c}) <= 200.0, false)", f"v{c}", "warning") for c in ("min", "max", "mean", "median", "std")],
    ("large_time_gaps", "n_large_gaps = 0", "n_large_gaps", "warning"), ("max_gap_days", "coalesce(max_gap <= 60, true)", "max_gap", "warning"),
    ("min_gap_days", "coalesce(min_gap >= 1, true)", "min_gap"),
    *[(f"quadrant_{q}_pixels", f"coalesce({q}_n > 0, false)", f"coalesce({q}_n, 0)", "warning") for q in _QUADS],
    *[(f"quadrant_{q}_{c}", f"coalesce(abs({q}_{c}) <= 200.0, false)", f"{q}_{c}", "warning") for q in _QUADS for c in ("mean", "std")]]


@query("v5_gridded_anomaly", W("fx_static", "fx_grace") + """
, p AS (SELECT s.iy, s.ix, s.x, s.y, g.time, g.lwe_length FROM fx_static s JOIN fx_grace g ON s.mascon_id = g.mascon_id),
grid AS (SELECT iy, ix, -3071750.0 + 500 * ix AS x, 3071750.0 - 500 * iy AS y FROM fx_static WHERE mascon_id IN (SELECT mascon_id FROM fx_grace)),
""" + _STEPS.format(src="p").strip().removeprefix(",").strip() + """,
ps AS (SELECT pos, n, COUNT(lwe_length) AS valid FROM p JOIN st ON p.time = st.time GROUP BY pos, n),
px AS (SELECT iy, ix, MIN(x) AS x0, MAX(x) AS x1, MIN(y) AS y0, MAX(y) AS y1, COUNT(*) AS c, COUNT(DISTINCT time) AS s, AVG(lwe_length) AS mean FROM p GROUP BY iy, ix),
q AS (SELECT (CASE WHEN iy < """ + _ROWS + """ // 2 THEN 'N' ELSE 'S' END) || (CASE WHEN ix < 25 THEN 'W' ELSE 'E' END) AS quadrant, mean FROM px),
sample AS (SELECT lwe_length AS v FROM p JOIN st ON p.time = st.time WHERE pos % 10 = 0 AND iy % 10 = 0 AND ix % 10 = 0),
g AS (SELECT datediff('day', LAG(time) OVER (ORDER BY time), time) AS gap FROM st),
m AS (SELECT (SELECT COUNT(DISTINCT iy) FROM p) AS n_y, (SELECT COUNT(DISTINCT ix) FROM p) AS n_x, (SELECT COUNT(DISTINCT iy) FROM grid) AS grid_y,
  (SELECT COUNT(DISTINCT ix) FROM grid) AS grid_x, (SELECT COUNT(*) FROM grid) AS n_cells,
  (SELECT COUNT(*) FILTER (WHERE g.x IS NULL OR greatest(abs(x0 - g.x), abs(x1 - g.x)) > 1e-8 + 1e-5 * abs(g.x)) FROM px LEFT JOIN grid g USING (iy, ix)) AS n_x_off,
  (SELECT COUNT(*) FILTER (WHERE g.y IS NULL OR greatest(abs(y0 - g.y), abs(y1 - g.y)) > 1e-8 + 1e-5 * abs(g.y)) FROM px LEFT JOIN grid g USING (iy, ix)) AS n_y_off,
  (SELECT SUM(c - s) FROM px) AS n_dup,
  (SELECT MAX(valid) FROM ps WHERE pos = 0) AS n_first, (SELECT MAX(valid) FROM ps WHERE pos = n // 2) AS n_middle, (SELECT MAX(valid) FROM ps WHERE pos = n - 1) AS n_last,
  (SELECT COUNT(v) FROM sample) AS n_sample, (SELECT MIN(v) FROM sample) AS vmin, (SELECT MAX(v) FROM sample) AS vmax, (SELECT AVG(v) FROM sample) AS vmean,
  (SELECT quantile_cont(v, 0.5) FROM sample) AS vmedian, (SELECT STDDEV_POP(v) FROM sample) AS vstd,
  (SELECT COUNT(*) FILTER (WHERE gap > 60) FROM g) AS n_large_gaps, (SELECT MAX(gap) FROM g) AS max_gap, (SELECT MIN(gap) FROM g) AS min_gap,
  """ + ", ".join(f"(SELECT {f}(mean) FROM q WHERE quadrant = '{x}') AS {x}_{n}" for x in _QUADS for n, f in (("mean", "AVG"), ("std", "STDDEV_POP"), ("n", "COUNT"))) + """)
""" + _rep(_V5_RULES, "m"))
def v5_gridded_anomaly(spark, d):
    """V5 over the gridded anomalies: the regional series on every cell of its region, against the grid's own coordinates."""
    static = fx.fx_static(spark, d)
    series = fx.fx_grace(spark, d)
    gridded = static.select("iy", "ix", "x", "y", "mascon_id").join(broadcast_checked(series), "mascon_id").drop("mascon_id")
    grid = _xy(static.join(broadcast_checked(series.select("mascon_id")), "mascon_id", "left_semi").select("iy", "ix"))
    return audit.gridded_anomaly_audit(gridded, grid, "lwe_length", fx.grid_rows(spark, d), fx.NX)


@query("v5_anomaly_audit", W("fx_grace") + """
, tt AS (SELECT DISTINCT time FROM fx_grace),
g AS (SELECT datediff('day', LAG(time) OVER (ORDER BY time), time) AS gap FROM tt),
sd AS (SELECT mascon_id, STDDEV_POP(lwe_length) AS s FROM fx_grace GROUP BY mascon_id),
m AS (SELECT (SELECT COUNT(*) FROM (SELECT mascon_id, time FROM fx_grace GROUP BY 1, 2 HAVING COUNT(*) > 1)) AS n_dup,
             (SELECT MAX(abs(lwe_length)) FROM fx_grace) AS maxabs, (SELECT COUNT(lwe_length) FROM fx_grace) AS n_valid,
             (SELECT COUNT(DISTINCT mascon_id) FROM fx_grace) AS n_regions, (SELECT COUNT(*) FROM tt) AS n_steps,
             (SELECT COUNT(*) FILTER (WHERE gap > 60) FROM g) AS n_large_gaps, (SELECT MAX(gap) FROM g) AS max_gap,
             (SELECT MAX(s) FROM sd) AS max_std, (SELECT COUNT(*) FILTER (WHERE s = 0) FROM sd) AS n_flat)
""" + _rep([("keys_unique", "n_dup = 0", "n_dup"), ("within_typical", "coalesce(maxabs <= 200.0, true)", "maxabs", "warning"),
            ("coverage_pct", "n_valid * 100.0 / (n_regions * n_steps) >= 1.0", "n_valid * 100.0 / (n_regions * n_steps)", "warning"),
            ("large_time_gaps", "n_large_gaps = 0", "n_large_gaps", "warning"),
            ("max_gap_days", "coalesce(max_gap <= 60, true)", "max_gap", "warning"), ("regions_vary", "n_flat = 0", "n_flat", "warning"),
            ("max_temporal_std", "coalesce(max_std <= 200.0, true)", "max_std", "warning")], "m"))
def v5_anomaly_audit(spark, d):
    return audit.anomaly_audit(fx.fx_grace(spark, d), ["mascon_id", "time"], "lwe_length")


# The audited table breaks some rules: distances over the limit, negative and too large depths, regions that
# are no whole numbers, nulls that don't match, cells without a shelf, steps that the source lacks.
_V6_TYPES = {"thetao": "double", "so": "double", "ice_draft": "double", "T_f": "float", "T_star": "float", "dist_to_ocean": "double",
             "clamped_depth": "double", "mascon_id": "float", "time": "date"}
_V6_DEPTH = 1500.0
_V6_CHECKS = ["n_px_extra", "n_px_lacking", "n_time_diff", "n_nan", "n_shelf_lacking", "n_outside", "n_null_ice_draft", "n_null_clamped_depth",
              "n_null_mascon_id", "n_null_pair", "n_dist_out", "n_depth_out", "n_draft_out", "n_thetao_out", "n_so_out", "n_mascon_part"]
_V6_NAMES = ["pixels_not_in_grid", "grid_pixels_lacking", "time_differs", "nan_values", "shelf_without_data", "data_outside_shelf", "null_pattern_ice_draft",
             "null_pattern_clamped_depth", "null_pattern_mascon_id", "null_pattern_pair", "dist_bounds", "depth_bounds", "draft_bounds", "thetao_bounds",
             "so_bounds", "mascon_whole"]


@query("v6_ocean_audit", W("fx_static", "fx_ocean", "fx_icesat") + q_io._THERMO_SQL + f"""
, t AS (SELECT th.*, CASE WHEN s.mask <> 1 THEN s.surface * 1000 END AS dist_to_ocean, s.thickness - 100 AS clamped_depth,
          CAST(s.mascon_id AS DOUBLE) + CASE WHEN th.ix % 10 = 0 THEN 0.5 ELSE 0 END AS mascon_id,
          s.mask IN (2, 3) AS shelf FROM th JOIN fx_static s ON th.iy = s.iy AND th.ix = s.ix),
px AS (SELECT iy, ix, bool_or(dist_to_ocean IS NOT NULL) AS data, COUNT(thetao) AS n FROM t GROUP BY iy, ix),
g AS (SELECT iy, ix FROM fx_static WHERE thickness > 100),
sh AS (SELECT iy, ix FROM fx_static WHERE mask IN (2, 3)),
ps AS (SELECT time, COUNT(thetao) FILTER (shelf) AS n FROM t GROUP BY time),
m AS (SELECT (SELECT COUNT(*) FROM (SELECT iy, ix FROM px EXCEPT SELECT * FROM g)) AS n_px_extra,
  (SELECT COUNT(*) FROM (SELECT * FROM g EXCEPT SELECT iy, ix FROM px)) AS n_px_lacking,
  (SELECT COUNT(*) FROM (SELECT time FROM ps EXCEPT SELECT time FROM fx_icesat WHERE time < DATE '1998-01-01'))
    + (SELECT COUNT(*) FROM (SELECT time FROM fx_icesat WHERE time < DATE '1998-01-01' EXCEPT SELECT time FROM ps)) AS n_time_diff,
  (SELECT COUNT(*) FROM (SELECT * FROM sh EXCEPT SELECT iy, ix FROM px WHERE data)) AS n_shelf_lacking,
  (SELECT COUNT(*) FROM (SELECT iy, ix FROM px WHERE data EXCEPT SELECT * FROM sh)) AS n_outside,
  (SELECT COUNT(*) FROM sh LEFT JOIN px ON sh.iy = px.iy AND sh.ix = px.ix WHERE coalesce(px.n, 0) < (SELECT COUNT(*) FROM ps)) AS n_px_gaps,
  (SELECT MIN(n) FROM ps) AS min_per_step, 0 AS n_nan,
  COUNT(*) FILTER ((ice_draft IS NULL) <> (dist_to_ocean IS NULL)) AS n_null_ice_draft,
  COUNT(*) FILTER ((clamped_depth IS NULL) <> (dist_to_ocean IS NULL)) AS n_null_clamped_depth,
  COUNT(*) FILTER ((mascon_id IS NULL) <> (dist_to_ocean IS NULL)) AS n_null_mascon_id,
  COUNT(*) FILTER ((thetao IS NULL) <> (so IS NULL)) AS n_null_pair,
  COUNT(*) FILTER (shelf AND NOT (dist_to_ocean >= 0 AND dist_to_ocean < 1500000)) AS n_dist_out,
  COUNT(*) FILTER (shelf AND NOT (clamped_depth BETWEEN 0 AND {_V6_DEPTH} + 1)) AS n_depth_out,
  COUNT(*) FILTER (shelf AND NOT (ice_draft BETWEEN -3000 AND 500)) AS n_draft_out,
  COUNT(*) FILTER (shelf AND NOT (thetao BETWEEN -3.5 AND 6)) AS n_thetao_out,
  COUNT(*) FILTER (shelf AND NOT (so BETWEEN 25 AND 38)) AS n_so_out,
  COUNT(*) FILTER (shelf AND mascon_id <> round(mascon_id)) AS n_mascon_part FROM t)
""" + _rep([("required_columns", "true", "0"), ("column_types", "1 = 0", "1"),
            *[(n, f"{c} = 0", c) for n, c in zip(_V6_NAMES, _V6_CHECKS)],
            ("min_valid_per_step", "min_per_step > 0", "min_per_step"), ("shelf_pixels_with_time_gaps", "n_px_gaps = 0", "n_px_gaps"),
            ("units_missing", "2 = 0", "2")], "m"))
def v6_ocean_audit(spark, d):
    """V6 with the shelf mask of the checker (mask codes 2, 3; finding D5), on a table with seeded faults."""
    from floe import constants as C
    s = fx.fx_static(spark, d)
    extra = s.select("iy", "ix", F.when(F.col("mask") != 1, F.col("surface") * 1000).alias("dist_to_ocean"),
                     (F.col("thickness") - 100).alias("clamped_depth"),
                     (F.col("mascon_id").cast("double") + F.when(F.col("ix") % 10 == 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("mascon_id"))
    shelf = select.keep_codes(s, codes=C.SHELF_CODES).select("iy", "ix")
    grid = s.where(F.col("thickness") > 100).select("iy", "ix")
    times = fx.fx_icesat(spark, d).where(F.col("time") < F.lit("1998-01-01").cast("date"))
    table = writers.with_metadata(q_grid._thermo(spark, d).join(extra, ["iy", "ix"]), {"T_f": {"units": "degC"}, "T_star": {"units": "degC"}})
    return audit.ocean_audit(table, _V6_TYPES, shelf, grid, times, _V6_DEPTH, units=("T_f", "T_star", "thetao", "so"))


# y breaks its order at one cell: the row after a multiple of five steps back by more than a cell
@query("v7_merge_validation", W("fx_tiles") + _M1 + f"""
, mx AS (SELECT * REPLACE (y + CASE WHEN iy % 5 = 1 THEN 600 ELSE 0 END AS y) FROM (SELECT *, {XY} FROM m1)),
xs AS (SELECT DISTINCT ix AS p, x AS v FROM mx), ys AS (SELECT DISTINCT iy AS p, y AS v FROM mx),
m AS (SELECT (SELECT COUNT(*) FROM (SELECT iy, ix, time FROM mx GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)) AS n_dup,
             (SELECT COUNT(*) FILTER (WHERE b.v <= a.v) FROM xs a JOIN xs b ON b.p - 1 = a.p) AS n_x_violations,
             (SELECT COUNT(*) FILTER (WHERE b.v >= a.v) FROM ys a JOIN ys b ON b.p - 1 = a.p) AS n_y_violations,
             (SELECT COUNT(*) FROM (SELECT p FROM xs GROUP BY p HAVING COUNT(*) > 1)) AS n_x_several,
             (SELECT COUNT(*) FROM (SELECT p FROM ys GROUP BY p HAVING COUNT(*) > 1)) AS n_y_several,
             (SELECT COUNT(delta_h) FROM mx WHERE time = (SELECT MIN(time) FROM mx)) AS n_valid)
""" + _rep([("unique_keys", "n_dup = 0", "n_dup"), ("x_monotonic", "n_x_violations = 0", "n_x_violations"),
            ("y_monotonic", "n_y_violations = 0", "n_y_violations"), ("x_single", "n_x_several = 0", "n_x_several"),
            ("y_single", "n_y_several = 0", "n_y_several"),
            ("coverage_first_pct", f"n_valid * 100.0 / {_CELLS} >= 1.0", f"n_valid * 100.0 / {_CELLS}", "warning")], "m"))
def v7_merge_validation(spark, d):
    m = _xy(_m1(spark, d)).withColumn("y", F.col("y") + F.when(F.col("iy") % 5 == 1, F.lit(600.0)).otherwise(F.lit(0.0)))
    return audit.merge_validation(m, "delta_h", _cells(spark, d))


def _thermo_written(spark, d):
    """Thermodynamics added to a copy of the ocean table (K6), FLOAT outputs with units (K8)."""
    src, dst = scratch_path(spark, "b10-in"), scratch_path(spark, "b10-out")
    writers.write_layout(q_io.ocean_match(spark, d), src, keys=("time",))
    base = spark.read.parquet(src).withColumn("pressure", thermo.base_pressure())
    out = base.withColumn("T_f", thermo.freezing_point()).withColumn("T_star", thermo.thermal_driving())
    meta = {"T_f": {"long_name": "Freezing point", "units": "degC"},
            "T_star": {"long_name": "Thermal driving", "units": "degC"}}
    writers.write_layout(writers.with_metadata(out, meta), dst, keys=("time",))
    return spark.read.parquet(dst)


@query("v8_post_write", W("fx_static", "fx_ocean") + q_io._THERMO_SQL + """
, m AS (SELECT CAST(MIN(T_f) AS DOUBLE) AS T_f_min, CAST(MAX(T_f) AS DOUBLE) AS T_f_max, COUNT(T_f) AS T_f_n,
               CAST(MIN(T_star) AS DOUBLE) AS T_star_min, CAST(MAX(T_star) AS DOUBLE) AS T_star_max, COUNT(T_star) AS T_star_n FROM th)
""" + _rep([("T_f_count", "T_f_n > 0", "T_f_n"), ("T_f_min", "T_f_min IS NOT NULL", "T_f_min"),
            ("T_f_max", "T_f_max IS NOT NULL", "T_f_max"), ("T_star_count", "T_star_n > 0", "T_star_n"),
            ("T_star_min", "T_star_min IS NOT NULL", "T_star_min"), ("T_star_max", "T_star_max IS NOT NULL", "T_star_max")], "m"))
def v8_post_write(spark, d):
    return audit.post_write(_thermo_written(spark, d), ["T_f", "T_star"])


@query("b10_thermodynamics", W("fx_static", "fx_ocean") + q_io._THERMO_SQL + "SELECT * FROM th")
def b10_thermodynamics(spark, d):
    return _thermo_written(spark, d)


# ------------------------------------------------------------ compositions ---

_FEAT = q_grid._EDT + """
, bs AS (""" + q_grid._slope_sql("fx_static", "bed", _ROWS, "50") + """)
"""


def _static_features(spark, d):
    """B9 (static part): bed slope (W6) and distance to the grounding line (W7), null outside ice."""
    s = fx.fx_static(spark, d)
    ny = fx.grid_rows(spark, d)
    bs = stencil.slope(s.select("iy", "ix", "bed"), "bed", ny, fx.NX, out="bed_slope").select("iy", "ix", "bed_slope")
    gl = stencil.distance_to_sources(s.select("iy", "ix", "mask"), F.col("mask") == 1, ny, out="dist_to_grounding_line")
    f = gl.join(bs, ["iy", "ix"], "left")
    return select.null_outside(f, ["bed_slope", "dist_to_grounding_line"], F.col("mask").isin(1, 3)).drop("mask")


@query("b9_features_static", W("fx_static") + _FEAT + """
SELECT e.iy, e.ix, CASE WHEN s.mask IN (1, 3) THEN e.dist END AS dist_to_grounding_line,
       CASE WHEN s.mask IN (1, 3) THEN bs.slope END AS bed_slope
FROM edt e JOIN fx_static s ON e.iy = s.iy AND e.ix = s.ix LEFT JOIN bs ON bs.iy = e.iy AND bs.ix = e.ix""")
def b9_features_static(spark, d):
    return _static_features(spark, d)


def _dynamic_features(spark, d):
    """B9 (dynamic part): h_surface_dynamic = surface + delta_h (F5, J6) and its slope."""
    a = fx.fx_icesat(spark, d)
    s = fx.fx_static(spark, d).select("iy", "ix", "surface", "mask")
    h = a.join(s, ["iy", "ix"]).select("iy", "ix", "time", "mask", thermo.dynamic_surface().alias("h_surface_dynamic"))
    h = stencil.slope(h, "h_surface_dynamic", fx.grid_rows(spark, d), fx.NX, by=("time",), out="surface_slope")
    return select.null_outside(h, ["h_surface_dynamic", "surface_slope"], F.col("mask").isin(1, 3)).drop("mask")


_DYN = q_grid._HSD + """
, ss AS (""" + q_grid._slope_sql("hsd", "h", _ROWS, "50", ("time",)) + """)
"""


@query("b9_features_dynamic", W("fx_static", "fx_icesat") + _DYN + """
SELECT h.iy, h.ix, h.time, CAST(CASE WHEN s.mask IN (1, 3) THEN h.h END AS FLOAT) AS h_surface_dynamic,
       CASE WHEN s.mask IN (1, 3) THEN ss.slope END AS surface_slope
FROM hsd h JOIN fx_static s ON h.iy = s.iy AND h.ix = s.ix JOIN ss ON ss.iy = h.iy AND ss.ix = h.ix AND ss.time = h.time""")
def b9_features_dynamic(spark, d):
    return writers.narrow_floats(_dynamic_features(spark, d))


@query("b1_static_table", W("fx_static") + _FEAT + """
SELECT s.iy, s.ix, s.x, s.y, s.surface, s.bed, s.thickness, s.mask, s.mascon_id, bs.slope AS bed_slope,
       e.dist AS dist_to_grounding_line
FROM fx_static s JOIN edt e ON e.iy = s.iy AND e.ix = s.ix LEFT JOIN bs ON bs.iy = s.iy AND bs.ix = s.ix
WHERE s.mask IN (1, 3)""")
def b1_static_table(spark, d):
    """B1: align topography, mascon map and features by pixel (J4), keep ice (P5)."""
    s = fx.fx_static(spark, d)
    topo = s.select("iy", "ix", "x", "y", "surface", "bed", "thickness", "mask")
    masc = s.where(F.col("mascon_id").isNotNull()).select("iy", "ix", "mascon_id")
    flat = joins.outer_align([topo, masc, _static_features(spark, d)], ["iy", "ix"])
    return select.keep_codes(flat)


@query("b2_altimetry_table", W("fx_static", "fx_icesat") + _DYN + """
SELECT a.iy, a.ix, a.time, a.delta_h, a.ice_area, h.h AS h_surface_dynamic, ss.slope AS surface_slope
FROM fx_icesat a JOIN fx_static s ON a.iy = s.iy AND a.ix = s.ix AND s.mask IN (1, 3)
LEFT JOIN hsd h ON h.iy = a.iy AND h.ix = a.ix AND h.time = a.time
LEFT JOIN ss ON ss.iy = a.iy AND ss.ix = a.ix AND ss.time = a.time
WHERE a.delta_h IS NOT NULL""")
def b2_altimetry_table(spark, d):
    """B2: altimetry with its dynamic features, ice pixels only (J7), rows with delta_h.

    The features derive from the same rows (surface + delta_h, J6), so the two
    stores are aligned by construction: one join with the static columns, the
    two slope windows over all pixels (ice cells need their non-ice
    neighbours), then the ice and non-null filters - no alignment shuffle.
    """
    a = fx.fx_icesat(spark, d).select("iy", "ix", "time", "delta_h", "ice_area")
    s = fx.fx_static(spark, d).select("iy", "ix", "surface", "mask")
    h = a.join(s, ["iy", "ix"]).withColumn("h_surface_dynamic", thermo.dynamic_surface())
    h = stencil.slope(h, "h_surface_dynamic", fx.grid_rows(spark, d), fx.NX, by=("time",), out="surface_slope")
    rows = select.drop_null(select.keep_codes(h), "delta_h")
    return rows.select("iy", "ix", "time", "delta_h", "ice_area", "h_surface_dynamic", "surface_slope")


@query("b3_ocean_table", W("fx_static", "fx_ocean") + q_io._THERMO_SQL + """
SELECT th.iy, th.ix, th.time, thetao, so, T_f, T_star FROM th JOIN fx_static s ON s.iy = th.iy AND s.ix = th.ix
WHERE s.mask IN (1, 3) AND thetao IS NOT NULL""")
def b3_ocean_table(spark, d):
    """Decoded ocean chunks per step (S3) -> long rows with freezing point and thermal driving (F7-F9), on ice (J7), dropped
    where thetao is missing (P7), stored by step (K2) and read back."""
    o = fx.fx_ocean(spark, d)
    cubes = [readers.cube_to_long(readers.long_to_cube(o, v, 10, extra=("time",)), v) for v in ("thetao", "so")]
    long = joins.outer_align(cubes, ["iy", "ix", "time"], partition_by=["iy", "ix"])
    s = fx.fx_static(spark, d)
    rows = long.join(s.select("iy", "ix", thermo.ice_draft().alias("ice_draft")), ["iy", "ix"])
    rows = rows.withColumn("pressure", thermo.base_pressure()).withColumn("T_f", thermo.freezing_point()).withColumn("T_star", thermo.thermal_driving())
    rows = select.drop_null(joins.mask_semi(rows, select.keep_codes(s).select("iy", "ix"), ["iy", "ix"]), "thetao")
    out = rows.select("iy", "ix", "time", "thetao", "so", "T_f", "T_star")
    path = scratch_path(spark, "b3")
    writers.write_steps(out, path, "time")
    return readers.read_steps(spark, path, out.schema)


@query("b4_anomaly_table", W("fx_grace") + "SELECT mascon_id, time, lwe_length FROM fx_grace WHERE lwe_length IS NOT NULL")
def b4_anomaly_table(spark, d):
    return select.drop_null(fx.fx_grace(spark, d).select("mascon_id", "time", "lwe_length"), "lwe_length")


#: Product groups of B7: value and sigma from the line items of each tile; a sigma of 0 is missing.
_GROUPS = {"delta_h": ("SUM(CAST(l_discount AS DECIMAL(10,2)) - CAST(l_tax AS DECIMAL(10,2)))", "MIN(l_tax)"),
           "dhdt_lag1": ("SUM(CAST(l_discount AS DECIMAL(10,2)))", "MIN(l_discount)"),
           "dhdt_lag4": ("SUM(CAST(l_tax AS DECIMAL(10,2)))", "MAX(l_tax)")}


def _group_sql(name: str) -> str:
    value, sigma = _GROUPS[name]
    return f"""
SELECT '{name}' AS product, c.iy, c.ix, c.time, m.value, m.sigma, m.tile_order, CAST(-3071750 + 500*c.ix AS DOUBLE) AS x, CAST(3071750 - 500*c.iy AS DOUBLE) AS y
FROM cells c LEFT JOIN (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iy, ix, time ORDER BY sigma NULLS LAST, tile_order) AS rn FROM (
    SELECT CAST(l_partkey%50 AS INT) AS ix, CAST(floor(l_partkey/50.0) AS INT) AS iy, make_date(year(l_shipdate), 3*quarter(l_shipdate)-2, 1) AS time,
      CAST(l_linenumber%4 AS INT) AS tile_order, CAST({value} AS DOUBLE) AS value, NULLIF({sigma}, 0) AS sigma
    FROM lineitem GROUP BY l_partkey, make_date(year(l_shipdate), 3*quarter(l_shipdate)-2, 1), l_linenumber%4)
    WHERE sigma IS NOT NULL OR tile_order = 0) WHERE rn = 1) m ON c.iy = m.iy AND c.ix = m.ix AND c.time = m.time"""


@query("b7_mosaic_products", """
WITH e AS (SELECT MIN(CAST(floor(l_partkey/50.0) AS INT)) AS iy0, MAX(CAST(floor(l_partkey/50.0) AS INT)) AS iy1,
    MIN(CAST(l_partkey%50 AS INT)) AS ix0, MAX(CAST(l_partkey%50 AS INT)) AS ix1 FROM lineitem),
times AS (SELECT DISTINCT make_date(year(l_shipdate), 3*quarter(l_shipdate)-2, 1) AS time FROM lineitem),
cells AS (SELECT CAST(iy AS INT) AS iy, CAST(ix AS INT) AS ix, time FROM
  (SELECT unnest(generate_series(iy0, iy1)) AS iy FROM e) CROSS JOIN (SELECT unnest(generate_series(ix0, ix1)) AS ix FROM e) CROSS JOIN times)
""" + "\nUNION ALL".join(_group_sql(g) for g in _GROUPS))
def b7_mosaic_products(spark, d):
    """B7, whole: three product groups with their own sigma from raw tile coordinates: snap (F1), canvas of all tiles' extent (S6),
    mosaic (M1), physics gate (V1), uncovered cells as rows with nulls (J8), written unless complete (K5)."""
    li = fx.table(spark, d, "lineitem")
    tiles = li.groupBy("l_partkey", quarter_start("l_shipdate").alias("time"), (F.col("l_linenumber") % 4).cast("int").alias("tile_order")).agg(
        *[F.expr(v).cast("double").alias(f"{g}_value") for g, (v, _) in _GROUPS.items()], *[F.nullif(F.expr(s), F.lit(0.0)).alias(f"{g}_sigma") for g, (_, s) in _GROUPS.items()])
    ix, iy = (F.col("l_partkey") % fx.NX).cast("int"), F.floor(F.col("l_partkey") / fx.NX).cast("int")
    jitter = (F.col("tile_order") - F.lit(1.5)) * F.lit(7.0)
    raw = tiles.withColumns({"ix": ix, "iy": iy}).withColumns({"x": G.x("ix") + jitter, "y": G.y("iy") - jitter}).drop("ix", "iy", "l_partkey")
    snapped = materialize(raw.withColumns({"iy": G.iy("y"), "ix": G.ix("x")}).drop("x", "y"), "b7-tiles")
    canvas = readers.canvas_from_extent(snapped)
    out = None
    for g in _GROUPS:
        def build(g=g):
            tiles_of = snapped.select("iy", "ix", "time", "tile_order", F.col(f"{g}_value").alias("value"), F.col(f"{g}_sigma").alias("sigma"))
            m = materialize(mosaic.mosaic(tiles_of, "sigma"), "b7")
            audit.assert_ok(audit.physics(m, ["value"], area=None))
            return _xy(mosaic.on_canvas(m, canvas))
        path = scratch_path(spark, f"b7-{g}")
        writers.write_if_absent(build, path, spark=spark)
        rows = spark.read.parquet(path).select(F.lit(g).alias("product"), "iy", "ix", "time", "value", "sigma", "tile_order", "x", "y")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("b7_mosaic", W("fx_tiles") + _M1 + f"SELECT iy, ix, time, delta_h, delta_h_sigma, tile_order, {XY} FROM m1")
def b7_mosaic(spark, d):
    """Raw tile coordinates snapped to the grid (F1), lowest-sigma mosaic (M1), physics gate (V1)."""
    t = fx.fx_tiles(spark, d)
    jitter = (F.col("tile_order") - F.lit(1.5)) * F.lit(7.0)
    raw = t.select("time", "tile_order", "delta_h", "delta_h_sigma",
                   (G.x("ix") + jitter).alias("x_raw"), (G.y("iy") - jitter).alias("y_raw"))
    snapped = raw.select(G.iy("y_raw").alias("iy"), G.ix("x_raw").alias("ix"), "time", "tile_order",
                         "delta_h", "delta_h_sigma")
    m = mosaic.mosaic(snapped, "delta_h_sigma")
    audit.assert_ok(audit.physics(m, ["delta_h"], area=None))
    return _xy(m)


@query("b8_upsample", W("fx_coarse") + q_grid._BIL + "SELECT iy, ix, CAST(v AS FLOAT) AS v FROM bil")
def b8_upsample(spark, d):
    """Spacing check (V2), bilinear 1 km -> 500 m (J12), FLOAT + units (K9, K8), write-if-absent (K5)."""
    audit.assert_ok(_v2(spark, d))
    up = regrid.upsample2x(fx.fx_coarse(spark, d))
    out = writers.with_metadata(writers.narrow_floats(up), {"v": {"units": "m", "long_name": "upsampled value"}})
    p = scratch_path(spark, "b8")
    writers.write_if_absent(out, p)
    return spark.read.parquet(p)


_B11 = _M1 + """
, t AS (SELECT 2*iy + a AS ty, 2*ix + b AS tx, time FROM m1, (VALUES (0), (1)) A(a), (VALUES (0), (1)) B(b)),
tw AS (SELECT CAST(ty AS INT) AS iy, CAST(tx AS INT) AS ix, time,
              CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(tx AS DOUBLE) AS fx,
              CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(ty AS DOUBLE) AS fy,
              CAST(floor(CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(tx AS DOUBLE)) AS INT) AS sx,
              CAST(floor(CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(ty AS DOUBLE)) AS INT) AS sy FROM t)
SELECT tw.iy, tw.ix, tw.time,
  CASE WHEN c00.delta_h IS NOT NULL AND c01.delta_h IS NOT NULL AND c10.delta_h IS NOT NULL AND c11.delta_h IS NOT NULL THEN
    ((CAST(1 AS DOUBLE) - (fy - sy)) * (CAST(1 AS DOUBLE) - (fx - sx))) * c00.delta_h
    + ((CAST(1 AS DOUBLE) - (fy - sy)) * (fx - sx)) * c01.delta_h
    + ((fy - sy) * (CAST(1 AS DOUBLE) - (fx - sx))) * c10.delta_h
    + ((fy - sy) * (fx - sx)) * c11.delta_h END AS delta_h
FROM tw LEFT JOIN m1 c00 ON c00.iy = sy AND c00.ix = sx AND c00.time = tw.time
LEFT JOIN m1 c01 ON c01.iy = sy AND c01.ix = sx + 1 AND c01.time = tw.time
LEFT JOIN m1 c10 ON c10.iy = sy + 1 AND c10.ix = sx AND c10.time = tw.time
LEFT JOIN m1 c11 ON c11.iy = sy + 1 AND c11.ix = sx + 1 AND c11.time = tw.time"""


@query("b11_merge_regrid", W("fx_tiles") + _B11)
def b11_merge_regrid(spark, d):
    """One-step tile merge (M1) then 1 km -> 500 m regrid per time step."""
    m = _m1(spark, d).select(F.col("iy").alias("cy"), F.col("ix").alias("cx"), "time", "delta_h")
    return regrid.upsample2x(m, value="delta_h", by=("time",))


_B11_WHOLE = W("fx_tiles", "fx_static", "fx_coarse") + f"""
, ext AS (SELECT MIN(ix) AS x0, MAX(ix) AS x1, MIN(iy) AS y0, MAX(iy) AS y1 FROM fx_static WHERE ix BETWEEN 5 AND 44),
inside AS (SELECT t.* FROM fx_tiles t, ext WHERE t.ix BETWEEN x0 - 1 AND x1 + 1 AND t.iy BETWEEN y0 - 1 AND y1 + 1),
m1 AS (SELECT iy, ix, time, delta_h FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY iy, ix, time ORDER BY delta_h_sigma NULLS LAST, tile_order) AS rn
  FROM inside WHERE delta_h_sigma IS NOT NULL OR tile_order = 0) WHERE rn = 1),
tg AS (SELECT 2*cy + a AS iy, 2*cx + b AS ix, cy, cx, 0.25 + 0.5*a AS wy, 0.25 + 0.5*b AS wx FROM fx_coarse, (VALUES (0), (1)) A(a), (VALUES (0), (1)) B(b)),
wt AS (SELECT iy, ix, cy + dy AS sy, cx + dx AS sx, (CASE dy WHEN 1 THEN wy ELSE 1 - wy END) * (CASE dx WHEN 1 THEN wx ELSE 1 - wx END) AS w
       FROM tg, (VALUES (0), (1)) C(dy), (VALUES (0), (1)) D(dx)),
ts AS (SELECT DISTINCT time FROM m1),
rg AS (SELECT wt.iy, wt.ix, ts.time, CASE WHEN COUNT(m1.delta_h) = 4 THEN SUM(w * m1.delta_h) END AS v
       FROM wt CROSS JOIN ts LEFT JOIN m1 ON m1.iy = wt.sy AND m1.ix = wt.sx AND m1.time = ts.time GROUP BY wt.iy, wt.ix, ts.time)
SELECT CAST(iy AS INT) AS iy, CAST(ix AS INT) AS ix, time, ROUND(v, 6) AS delta_h, n_valid FROM rg JOIN (SELECT time AS tt, COUNT(v) AS n_valid FROM rg GROUP BY time) ON time = tt
WHERE v IS NOT NULL"""


@query("b11_merge_regrid_stored", _B11_WHOLE)
def b11_merge_regrid_stored(spark, d):
    """B11 with its whole chain: coordinates in km and days decoded (F2, F3), tiles cut to an extent (P10), merged (M1), weights of
    the fine grid made once (J13) and applied to every step, coverage counted (A9), the first step created and the others
    appended (K3), read back."""
    epoch = "1990-01-01"
    raw = fx.fx_tiles(spark, d).select(
        (F.col("ix") * 0.5).alias("x_km"), (F.col("iy") * -0.5).alias("y_km"), F.date_diff("time", F.lit(epoch).cast("date")).cast("double").alias("days"),
        "tile_order", "delta_h", "delta_h_sigma")
    tiles = raw.select((F.col("x_km") * 1000).alias("x"), (F.col("y_km") * 1000).alias("y"), days_to_timestamp("days", epoch).cast("date").alias("time"),
                       "tile_order", "delta_h", "delta_h_sigma")
    ref = fx.fx_static(spark, d).where(F.col("ix").between(5, 44)).select((F.col("ix") * 500.0).alias("x"), (F.col("iy") * -500.0).alias("y"))
    inside = select.bbox_subset(tiles, ref, 500.0).select(
        F.rint(F.col("y") / -500).cast("int").alias("iy"), F.rint(F.col("x") / 500).cast("int").alias("ix"), "time", "tile_order", "delta_h", "delta_h_sigma")
    merged = materialize(mosaic.mosaic(inside, "delta_h_sigma"), "b11-merged")  # read for the steps and for the values
    node = lambda cy, cx: cy.cast("long") * (1 << 20) + cx
    t = q_grid._targets_2x(fx.fx_coarse(spark, d)).withColumn("dst_id", node(F.col("iy"), F.col("ix")))
    weights = regrid.weights_table(spark, scratch_path(spark, "b11-weights"), lambda: regrid.bilinear_weights(t, "dst_id", "fy", "fx", node),
                                   regrid.grid_fingerprint("bilinear", "2x"))
    src = merged.select(node(F.col("iy"), F.col("ix")).alias("src_id"), "time", "delta_h")
    fine = regrid.apply_weights(src, weights, value="delta_h", by=("time",))
    fine = materialize(fine.select(F.floor(F.col("dst_id") / (1 << 20)).cast("int").alias("iy"), (F.col("dst_id") % (1 << 20)).cast("int").alias("ix"), "time",
                                   F.round("delta_h", 6).alias("delta_h")), "b11")
    path = scratch_path(spark, "b11-out")
    first = fine.agg(F.min("time")).scalar()
    writers.write_steps(fine.where(F.col("time") == first), path, "time")
    writers.append_steps(fine.where(F.col("time") > first), path, "time")
    back = readers.read_steps(spark, path, fine.schema)
    coverage = back.groupBy("time").agg(F.count("delta_h").alias("n_valid"))
    return select.drop_null(back, "delta_h").join(coverage, "time").select("iy", "ix", "time", "delta_h", "n_valid")


# ------------------------------------------------- flatten -> long sparse ---

_CHAIN = W("fx_static", "fx_icesat", "fx_ocean", "fx_grace") + _FEAT + _DYN + q_io._THERMO_SQL + """
, st1 AS (SELECT s.iy, s.ix, s.surface, s.bed, s.thickness, s.mask, s.mascon_id, bs.slope AS bed_slope,
                 e.dist AS dist_to_grounding_line
          FROM fx_static s JOIN edt e ON e.iy = s.iy AND e.ix = s.ix LEFT JOIN bs ON bs.iy = s.iy AND bs.ix = s.ix
          WHERE s.mask IN (1, 3)),
alt AS (SELECT a.iy, a.ix, a.time, a.delta_h, a.ice_area, h.h AS h_surface_dynamic, ss.slope AS surface_slope
        FROM fx_icesat a JOIN fx_static s ON a.iy = s.iy AND a.ix = s.ix AND s.mask IN (1, 3)
        LEFT JOIN hsd h ON h.iy = a.iy AND h.ix = a.ix AND h.time = a.time
        LEFT JOIN ss ON ss.iy = a.iy AND ss.ix = a.ix AND ss.time = a.time WHERE a.delta_h IS NOT NULL),
oc AS (SELECT iy, ix, time, thetao, so, T_f, T_star FROM th WHERE thetao IS NOT NULL),
an AS (SELECT mascon_id, time, lwe_length FROM fx_grace WHERE lwe_length IS NOT NULL),
bb AS (SELECT COALESCE(a.iy, o.iy) AS iy, COALESCE(a.ix, o.ix) AS ix, COALESCE(a.time, o.time) AS time,
              a.delta_h, a.ice_area, a.h_surface_dynamic, a.surface_slope, o.thetao, o.so, o.T_f, o.T_star
       FROM alt a FULL OUTER JOIN oc o ON a.iy = o.iy AND a.ix = o.ix AND a.time = o.time),
en AS (SELECT bb.*, s.surface, s.bed, s.thickness, s.mask, s.mascon_id, s.bed_slope, s.dist_to_grounding_line, g.lwe_length
       FROM bb LEFT JOIN st1 s ON bb.iy = s.iy AND bb.ix = s.ix
       LEFT JOIN an g ON s.mascon_id = g.mascon_id AND bb.time = g.time),
ff AS (SELECT iy, ix, time, surface, bed, thickness, mask, mascon_id, bed_slope, dist_to_grounding_line,
              LAST_VALUE(delta_h IGNORE NULLS) OVER w AS delta_h, LAST_VALUE(ice_area IGNORE NULLS) OVER w AS ice_area,
              LAST_VALUE(h_surface_dynamic IGNORE NULLS) OVER w AS h_surface_dynamic,
              LAST_VALUE(surface_slope IGNORE NULLS) OVER w AS surface_slope,
              LAST_VALUE(thetao IGNORE NULLS) OVER w AS thetao, LAST_VALUE(so IGNORE NULLS) OVER w AS so,
              LAST_VALUE(T_f IGNORE NULLS) OVER w AS T_f, LAST_VALUE(T_star IGNORE NULLS) OVER w AS T_star,
              LAST_VALUE(lwe_length IGNORE NULLS) OVER w AS lwe_length
       FROM en WINDOW w AS (PARTITION BY iy, ix ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tot AS (SELECT mascon_id, time, COUNT(delta_h) AS n_pix,
               CAST(SUM(CAST(ROUND(delta_h*100) AS DECIMAL(38,0))) AS DOUBLE)/100 AS sum_dh
        FROM ff WHERE mascon_id IS NOT NULL GROUP BY mascon_id, time)
SELECT ff.*, CAST(-3071750 + 500*ff.ix AS DOUBLE) AS x, CAST(3071750 - 500*ff.iy AS DOUBLE) AS y,
       CASE WHEN ff.mascon_id IS NOT NULL AND ff.delta_h IS NOT NULL AND ff.lwe_length IS NOT NULL
            THEN (CASE WHEN abs(tot.sum_dh / tot.n_pix) > 0.0001 THEN ff.delta_h / tot.sum_dh * tot.n_pix * ff.lwe_length
                       ELSE ff.lwe_length END) + CAST(0 AS DOUBLE) END AS lwe_fused
FROM ff LEFT JOIN tot ON ff.mascon_id = tot.mascon_id AND ff.time = tot.time"""


@query("b5_long_sparse_chain", _CHAIN)
def b5_long_sparse_chain(spark, d):
    """Flatten (B1 static with features, B2 altimetry with features, B3 ocean with
    thermodynamics, B4 anomaly) -> long sparse table (B5): the whole reference chain."""
    from floe.plans import lsp
    static = b1_static_table(spark, d)
    alt = b2_altimetry_table(spark, d)
    oc = select.drop_null(q_grid._thermo(spark, d).select("iy", "ix", "time", "thetao", "so", "T_f", "T_star"),
                          "thetao")
    an = b4_anomaly_table(spark, d)
    return lsp.build_long_sparse(alt, oc, static, an, G, sum_scale=2)

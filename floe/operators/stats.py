"""Aggregations, audits' building blocks, ordering and gap checks.

Everything is one distributed pass (``agg``/``groupBy`` with map-side partial
aggregation). Nothing here funnels a table through one task: global order
questions (gaps, ranks) use deterministic range buckets whose bounds come from
approximate quantiles, exact quantiles are selected digit by digit (``quantiles``),
and monotonicity is a self-join on the successor index.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.functions.grid import col
from floe.operators.joins import broadcast_checked
from floe.operators.quantiles import percentile_names, quantile_values


def _r(c: Column, nd: int | None) -> Column:
    return F.round(c, nd) if nd is not None else c


def summary(df: DataFrame, cols: list[str], where: Column | None = None, nd: int | None = 6) -> DataFrame:
    """A1: min / max / mean / count per variable in one pass, unpivoted."""
    d = df.where(where) if where is not None else df
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
                 _r(F.avg(v), nd).alias(f"{c}__mean"), F.count(v).alias(f"{c}__count")]
    wide = d.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`, `{c}__mean`, `{c}__count`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, vmin, vmax, vmean, n_valid)")


def valid_per_step(df: DataFrame, value: str, steps: DataFrame | None = None, time: str = "time") -> DataFrame:
    """A2: valid count per time step; steps without data show 0.

    With no separate step list, one grouped pass suffices: a step whose rows
    all lack ``value`` still forms a group with count 0.
    """
    counts = df.groupBy(time).agg(F.count(value).alias("n_valid"))
    if steps is None or steps is df:
        return counts.select(time, F.col("n_valid").cast("long").alias("n_valid"))
    return (steps.select(time).distinct().join(counts, time, "left")
            .select(time, F.coalesce("n_valid", F.lit(0)).cast("long").alias("n_valid")))


def valid_per_pixel(df: DataFrame, value: str, n_steps: Column | int | None = None, keys=("iy", "ix"), time: str = "time") -> DataFrame:
    """A3: per-pixel valid counts and the share of fully covered pixels.

    Without ``n_steps`` the distinct times of ``df`` (nulls aside) are counted in the same pass: grouping sets give
    the pixels and the steps, and a histogram of the counts, one entry per count, decides which pixels are full.
    """
    if n_steps is None:
        sets = (df.groupingSets([[F.col(k) for k in keys], [F.col(time)]], *keys, time)
                .agg(F.grouping(time).alias("_pixel"), F.count(value).alias("n")))
        pixel = F.col("_pixel") == 1
        hist = sets.groupBy("_pixel", "n").agg(F.count(F.lit(1)).alias("_c"), F.count(time).alias("_steps"))
        whole = hist.agg(F.coalesce(F.sum(F.when(pixel, F.col("_c"))), F.lit(0).cast("long")).alias("n_pixels"),
                         F.sum(F.when(~pixel, F.col("_steps"))).alias("_t"),
                         F.min(F.when(pixel, F.col("n"))).alias("min_count"), F.max(F.when(pixel, F.col("n"))).alias("max_count"),
                         F.collect_list(F.when(pixel, F.struct("n", "_c"))).alias("_h"))
        full = F.aggregate("_h", F.lit(0).cast("long"), lambda acc, h: acc + F.when(h["n"] == F.col("_t"), h["_c"]).otherwise(0))
        return whole.select("n_pixels", F.round(F.try_divide(full, "n_pixels"), 6).alias("share_full"), "min_count", "max_count")
    nT = F.lit(n_steps) if isinstance(n_steps, int) else n_steps
    per = df.groupBy(*keys).agg(F.count(value).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_pixels"),
                   F.round(F.avg((F.col("n") == nT).cast("int")), 6).alias("share_full"),
                   F.min("n").alias("min_count"), F.max("n").alias("max_count"))


def temporal_moments(df: DataFrame, value: str, keys=("iy", "ix"), nd: int | None = 6) -> DataFrame:
    """A4: per-pixel mean and population std over time."""
    return df.groupBy(*keys).agg(_r(F.avg(value), nd).alias("mean"),
                                 _r(F.stddev_pop(value), nd).alias("std"),
                                 F.count(value).alias("n"))


def quadrant_stats(df: DataFrame, value: str, ny: int, nx: int, nd: int | None = 6) -> DataFrame:
    """A5: statistics per quadrant (N/S by row half, W/E by column half)."""
    q = F.concat(F.when(F.col("iy") < ny // 2, "N").otherwise("S"),
                 F.when(F.col("ix") < nx // 2, "W").otherwise("E"))
    return df.groupBy(q.alias("quadrant")).agg(_r(F.avg(value), nd).alias("mean"),
                                               _r(F.stddev_pop(value), nd).alias("std"),
                                               F.count(value).alias("n"))


def robust_stats(df: DataFrame, value: str, warn_abs: float, nd: int | None = 6) -> DataFrame:
    """Min, max, mean, median, std (+ warning flag when |v| exceeds ``warn_abs``).

    The median is the exact quantile by radix selection (no sort, no single-task buffer).
    """
    v = F.col(value)
    median = F.lit(quantile_values(df, value, [0.5])[0]).cast("double")
    return df.agg(F.min(v).alias("vmin"), F.max(v).alias("vmax"), _r(F.avg(v), nd).alias("vmean"), _r(F.stddev_pop(v), nd).alias("vstd"),
                  F.count(v).alias("n"), F.bool_or(F.abs(v) > warn_abs).alias("warn_out_of_typical")).select(
        "vmin", "vmax", "vmean", _r(median, nd).alias("vmedian"), "vstd", "n", "warn_out_of_typical")


def weighted_mean(df: DataFrame, value: str, weight: str | None, by: str = "time", nd: int | None = 6) -> DataFrame:
    """sum(v*w)/sum(w over valid v), w = weight with nulls as 0; null when total weight is 0."""
    v = F.col(value)
    if weight is None:
        return df.groupBy(by).agg(_r(F.avg(v), nd).alias("wmean"))
    w = F.coalesce(F.col(weight), F.lit(0.0))
    num = F.sum(v * w)
    den = F.sum(F.when(v.isNotNull(), w))
    return df.groupBy(by).agg(_r(F.try_divide(num, F.when(den != 0, den)), nd).alias("wmean"))


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int = 100) -> DataFrame:
    """Fixed-range histogram; the last bin is closed on the right."""
    v = F.col(value)
    b = F.least(F.floor((v - F.lit(lo)) * F.lit(float(bins)) / F.lit(float(hi - lo))) + 1, F.lit(bins))
    return (df.where(v.between(lo, hi)).groupBy(b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_lo", F.lit(lo) + (F.col("bin") - 1) * F.lit((hi - lo) / bins)))


def coverage(df: DataFrame, value: str, canvas_cells: int, by: str = "time", nd: int = 6) -> DataFrame:
    """Valid / total against the canvas (sparse rows undercount the total)."""
    return df.groupBy(by).agg(F.count(value).alias("n_valid")).select(
        by, "n_valid", F.lit(canvas_cells).cast("long").alias("n_total"),
        F.round(F.col("n_valid") * F.lit(100.0) / F.lit(float(canvas_cells)), nd).alias("pct"))


def qc_counters(df: DataFrame, value: str, lo: float, hi: float, by: Column | str | None = None) -> DataFrame:
    """P11 + A10: null out values outside (lo, hi) and count processed / masked in one pass."""
    v = F.col(value)
    bad = v.isNotNull() & ~((v > lo) & (v < hi))
    g = df.groupBy(by) if by is not None else df.groupBy()
    return g.agg(F.count(v).alias("n_processed"), F.count_if(bad).alias("n_masked"),
                 F.round(F.count_if(bad) * F.lit(100.0) / F.greatest(F.count(v), F.lit(1)), 6).alias("pct_masked"))


def resolution(df: DataFrame, coord: str, nd: int = 6) -> DataFrame:
    """(max - min) / (n - 1) over distinct coordinates."""
    return df.agg(F.min(coord).alias("cmin"), F.max(coord).alias("cmax"),
                  F.count_distinct(coord).alias("n")).withColumn(
        "res", F.round(F.try_divide(F.col("cmax") - F.col("cmin"), (F.col("n") - 1).cast("double")), nd))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def percentiles(df: DataFrame, value: str, ps=(0.02, 0.98), exact: bool = True, nd: int | None = 9) -> DataFrame:
    """Exact (linear interpolation, as NumPy) or approximate percentiles; one row."""
    names = percentile_names(ps)
    if not exact:
        return df.agg(*[_r(F.percentile_approx(value, p, 10000), nd).alias(n) for p, n in zip(ps, names)])
    found = quantile_values(df, value, ps)
    one = df.sparkSession.createDataFrame([tuple(found)], ", ".join(f"{n} double" for n in names))
    return one.select(*[_r(F.col(n), nd).alias(n) for n in names])


def exact_quantiles(df: DataFrame, value: str, ps) -> DataFrame:
    """Exact quantiles ``(p, q)`` of a column by radix selection: four passes at most, see ``quantiles.quantile_values``."""
    found = quantile_values(df, value, ps)
    return df.sparkSession.createDataFrame([(float(p), q) for p, q in zip(ps, found)], "p double, q double")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Number of rows violating each rule (one pass), unpivoted."""
    wide = df.agg(*[F.count_if(p).alias(n) for n, p in rules.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, n_violations)")


def extents(df: DataFrame, by: str, res: float, x: str = "x", y: str = "y") -> DataFrame:
    """Per-tile extent, counts and half-cell edges.

    Rows are first reduced to one per (tile, x) and one per (tile, y), so that the distinct
    counts need no expansion of every row.
    """
    h = res / 2.0
    cols = (df.groupBy(by, x).agg(F.min(y).alias("_y0"), F.max(y).alias("_y1"), F.count(F.lit(1)).alias("_n"))
            .groupBy(by).agg(F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.min("_y0").alias("y_min"), F.max("_y1").alias("y_max"),
                             F.count(x).alias("nx"), F.sum("_n").alias("n")))
    rows = df.groupBy(by, y).agg(F.count(F.lit(1)).alias("_n")).groupBy(by).agg(F.count(y).alias("ny")).withColumnRenamed(by, "_by")
    return (cols.join(rows, cols[by].eqNullSafe(rows["_by"]))
            .select(by, "x_min", "x_max", "y_min", "y_max", "nx", "ny", "n")
            .withColumns({"left": F.col("x_min") - h, "right": F.col("x_max") + h, "bottom": F.col("y_min") - h, "top": F.col("y_max") + h}))


def _sides(a: DataFrame, b: DataFrame, by: str) -> tuple[Column, Column, Column]:
    """Common width and height of boxes ``a`` and ``b`` (negative: the gap), and whether ``a`` comes first by its lower edge."""
    dx = F.least("a_x_max", "b_x_max") - F.greatest("a_x_min", "b_x_min")
    dy = F.least("a_y_max", "b_y_max") - F.greatest("a_y_min", "b_y_min")
    return dx, dy, F.struct(F.col("a_y_min"), F.col(f"a_{by}")) < F.struct(F.col("b_y_min"), F.col(f"b_{by}"))


def _named(df: DataFrame, side: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in cols], *[c for c in df.columns if c not in cols])


def tile_pairs(ext: DataFrame, by: str) -> DataFrame:
    """J10 + O2: overlap or gap of every two tile boxes, pairs in order of the lower edge.

    A row for every pair is the result, so it is for as many tiles as can be looked at (a broadcast nested
    loop over the extents, after a check of their size). ``overlapping_pairs`` finds the overlaps among many.
    """
    a, b = (_named(ext, side, ext.columns) for side in "ab")
    dx, dy, first = _sides(a, b, by)
    p = a.join(broadcast_checked(b), first)
    both = (dx > 0) & (dy > 0)
    return p.select(F.col(f"a_{by}").alias("tile_a"), F.col(f"b_{by}").alias("tile_b"), dx.alias("dx"), dy.alias("dy"), both.alias("overlap"),
                    F.when(both, F.floor(dx / 1000).cast("long")).alias("overlap_cells_x"),
                    F.when(both, F.floor(dx / 1000 * (dy / 1000)).cast("long")).alias("overlap_area_km2"))


def overlapping_pairs(ext: DataFrame, by: str) -> DataFrame:
    """J10 for any number of boxes: only the pairs that overlap, found by an equi-join on grid cells.

    * A box belongs to the level whose cells (2^level wide) are at least as large as it, so it touches at most
      3 x 3 of them, whatever the mix of sizes. It is looked for in its own level and all coarser ones that occur.
    * A pair meets in the level of its larger box, and only the cell that holds the lower corner of the
      common area reports it: every pair once, without a distinct.
    * Boxes without width or height overlap nothing; nor do those with null bounds.
    """
    cols = [by, "x_min", "x_max", "y_min", "y_max", "_level"]
    size = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"))
    boxes = (ext.where((F.col("x_max") > F.col("x_min")) & (F.col("y_max") > F.col("y_min")))
             .withColumn("_level", F.ceil(F.log2(size)).cast("int")).select(*cols))
    levels = boxes.agg(F.collect_set("_level")).scalar()  # one number per binary order of magnitude

    def cells(df):
        s = F.pow(F.lit(2.0), F.col("_l"))
        for axis in "xy":
            df = df.withColumn(f"_c{axis}", F.explode(F.sequence(F.floor(F.col(f"{axis}_min") / s), F.floor(F.col(f"{axis}_max") / s))))
        return df
    home = cells(boxes.withColumn("_l", F.col("_level")))
    probe = cells(boxes.withColumn("_l", F.explode(levels)).where(F.col("_l") >= F.col("_level")))
    a, b = _named(probe, "a", cols), _named(home, "b", cols)
    dx, dy, first = _sides(a, b, by)
    s = F.pow(F.lit(2.0), F.col("_l"))
    owner = [F.floor(F.greatest(f"a_{v}_min", f"b_{v}_min") / s) == F.col(f"_c{v}") for v in "xy"]
    met = (a.join(b, ["_l", "_cx", "_cy"]).where((dx > 0) & (dy > 0) & owner[0] & owner[1])
           .where((F.col("a__level") < F.col("b__level")) | first))
    one, two = F.col(f"a_{by}"), F.col(f"b_{by}")
    return met.select(F.when(first, one).otherwise(two).alias("tile_a"), F.when(first, two).otherwise(one).alias("tile_b"), dx.alias("dx"), dy.alias("dy"),
                      F.floor(dx / 1000).cast("long").alias("overlap_cells_x"), F.floor(dx / 1000 * (dy / 1000)).cast("long").alias("overlap_area_km2"))


def successor_violations(df: DataFrame, pos: str, value: str, increasing: bool = True) -> DataFrame:
    """Monotonicity of ``value`` along an index column, as a self-join on pos+1.

    Distributed (an equi-join on the index), no global sort or single task.
    """
    d = df.select(F.col(pos).alias("p"), F.col(value).alias("v")).distinct()
    nxt = d.select((F.col("p") - 1).alias("p"), F.col("v").alias("v_next"))
    j = d.join(nxt, "p")
    bad = (F.col("v_next") <= F.col("v")) if increasing else (F.col("v_next") >= F.col("v"))
    return j.agg(F.count(F.lit(1)).alias("n_steps"), F.count_if(bad).alias("n_violations"),
                 F.coalesce(F.bool_and(~bad), F.lit(True)).alias("monotonic"))


def range_bucket(values: DataFrame, c: str, buckets: int | None = None) -> Column:
    """A deterministic range bucket of ``c`` (balanced by approximate quantiles).

    The bucket bounds are computed once (``buckets - 1`` scalars on the
    driver) and the bucket is then a pure Column expression. Every branch of a
    plan, and every retried task, assigns a value to the same bucket - unlike
    ``spark_partition_id()`` after a sampled range shuffle, whose bounds may
    differ between two evaluations.
    """
    spark = values.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    key = _numeric_key(values, c)
    if n <= 1:
        return F.lit(0)
    probs = [i / n for i in range(1, n)]
    # bounds from the raw column: one pass, no distinct shuffle; they only steer balance
    bounds = values.select(key.alias("_k")).approxQuantile("_k", probs, 0.001)
    bounds = sorted({float(b) for b in bounds if b is not None})
    if not bounds:
        return F.lit(0)
    return bucket_of(key, bounds)


def bucket_of(key: Column, bounds: list[float]) -> Column:
    """Bucket ``b`` holds ``bounds[b-1] <= key < bounds[b]``; a null key is in bucket 0.

    A binary search in one sorted array literal: the expression is the same size for any number of bounds, and
    a row costs about log2(len(bounds)) comparisons.
    """
    array = F.lit(np.array(bounds, np.float64))
    steps = F.sequence(F.lit(1), F.lit(max(len(bounds).bit_length(), 1)))

    def narrow(at, _):
        mid = F.shiftright(at["lo"] + at["hi"], 1)
        above = key >= F.get(array, mid)
        more = at["lo"] < at["hi"]
        return F.struct(F.when(more & above, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(more & F.coalesce(~above, F.lit(True)), mid).otherwise(at["hi"]).alias("hi"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), narrow, lambda at: at["lo"])


def _numeric_key(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType.typeName()
    if t == "date":
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"),
                                F.col(c).cast("timestamp_ntz")).cast("double")
    if t == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(c)).cast("double")
    if t == "timestamp":
        return F.unix_micros(F.col(c)).cast("double")
    return F.col(c).cast("double")


def positions(df: DataFrame, c: str, partitions: int | None = None) -> DataFrame:
    """0-based rank ``pos`` of every distinct value of ``c`` and the number of values ``n``.

    Distributed: distinct (map-side), deterministic range buckets,
    ``row_number`` inside each bucket, plus an offset per bucket from a table
    with one row per bucket. No window spans the whole axis.
    """
    raw = df.select(c).where(F.col(c).isNotNull())
    t = raw.distinct().withColumn("_pid", range_bucket(raw, c, partitions))
    t = t.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(c)) - 1)
    per = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_pid", F.coalesce(F.sum("_pc").over(wp), F.lit(0)).alias("_off"),
                      F.sum("_pc").over(Window.partitionBy(F.lit(1))).alias("n"))
    return (t.join(F.broadcast(offs), "_pid")  # one row per bucket: bounded by construction
            .select(c, (F.col("_off") + F.col("_rn")).cast("long").alias("pos"), F.col("n").cast("long").alias("n")))


def consecutive_gaps(df: DataFrame, ts: str, unit_micros: int = 86_400_000_000,
                     partitions: int | None = None) -> DataFrame:
    """Gaps between consecutive distinct timestamps, in whole ``unit_micros`` units.

    Scale design: distinct (map-side), deterministic range buckets of time
    (balanced by approximate quantiles), ``lag`` inside each bucket, then the
    first row of each bucket is linked to the last row of the previous bucket
    through a table with one row per bucket (bounded by the bucket count).
    """
    c = F.col(ts)
    if df.schema[ts].dataType.typeName() == "date":
        c = c.cast("timestamp_ntz")  # zone-free; never through the session time zone
    raw = df.select(c.alias("t")).where(F.col("t").isNotNull())
    t = raw.distinct().withColumn("pid", range_bucket(raw, "t", partitions))
    w = Window.partitionBy("pid").orderBy("t")
    t = t.withColumn("prev", F.lag("t").over(w))
    bounds = t.groupBy("pid").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))
    wb = Window.orderBy("pid")
    link = bounds.withColumn("prev_last", F.lag("last_t").over(wb)).select("pid", "first_t", "prev_last")
    t = t.join(F.broadcast(link), "pid").withColumn(  # one row per bucket: bounded by construction
        "prev", F.when(F.col("t") == F.col("first_t"), F.col("prev_last")).otherwise(F.col("prev")))
    us = F.timestamp_diff("MICROSECOND", F.col("prev"), F.col("t"))
    return (t.where(F.col("prev").isNotNull())
            .select(F.col("prev").alias("prev_ts"), F.col("t").alias(ts),
                    F.floor(us / F.lit(unit_micros)).cast("long").alias("gap")))


def gap_summary(gaps: DataFrame, threshold: int, nd: int = 6) -> DataFrame:
    return gaps.agg(F.count(F.lit(1)).alias("n_gaps"), F.round(F.avg("gap"), nd).alias("avg_gap"),
                    F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"),
                    F.count_if(F.col("gap") > threshold).alias("n_large"))


def null_pattern_mismatch(df: DataFrame, a: str, b: str) -> DataFrame:
    """U4: rows where exactly one of two columns is null (mask equality check)."""
    return df.agg(F.count_if(col(a).isNull() != col(b).isNull()).alias("n_mismatch"),
                  F.count(F.lit(1)).alias("n"))

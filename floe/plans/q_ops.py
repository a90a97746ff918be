"""Registered queries: mosaic (M), statistics (A, W4, W5, J10), selection (P),
ordering and sets (O, U) and the smaller joins (J4-J9, J14-J15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from floe import constants as C
from floe.functions.grid import FIXTURE_GRID as G
from floe.operators import joins, mosaic, quantiles, select, stats
from floe.operators.joins import broadcast_checked
from floe.plans.registry import query
from floe.session import materialize
from floe.sources import fixtures as fx

W = fx.ctes
XY = "CAST(-3071750 + 500*ix AS DOUBLE) AS x, CAST(3071750 - 500*iy AS DOUBLE) AS y"
_ROWS = "(SELECT max(p_partkey // 50) + 1 FROM part)"


def _xy(df):
    return df.withColumns({"x": G.x("ix"), "y": G.y("iy")})


def _bb(spark, d):
    from floe.plans import lsp
    return lsp.build_backbone(fx.fx_icesat(spark, d), fx.fx_ocean(spark, d))


_BB = """, bb AS (SELECT COALESCE(a.iy, o.iy) AS iy, COALESCE(a.ix, o.ix) AS ix, COALESCE(a.time, o.time) AS time,
              a.delta_h, a.delta_h_sigma, a.ice_area, o.thetao, o.so
       FROM fx_icesat a FULL OUTER JOIN fx_ocean o ON a.iy = o.iy AND a.ix = o.ix AND a.time = o.time)
"""

# ---------------------------------------------------------------- mosaic ---

@query("m1_mosaic", W("fx_tiles") + """
SELECT iy, ix, time, delta_h, delta_h_sigma, tile_order FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY iy, ix, time ORDER BY delta_h_sigma NULLS LAST, tile_order) AS rn
  FROM fx_tiles WHERE delta_h_sigma IS NOT NULL OR tile_order = 0) WHERE rn = 1""")
def m1_mosaic(spark, d):
    return mosaic.mosaic(fx.fx_tiles(spark, d), "delta_h_sigma")


@query("m2_argmin_overlaps", W("fx_tiles") + """
SELECT iy, ix, time, n_valid, tile_order, delta_h_sigma FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY iy, ix, time) AS n_valid,
         ROW_NUMBER() OVER (PARTITION BY iy, ix, time ORDER BY delta_h_sigma, tile_order) AS rn
  FROM fx_tiles WHERE delta_h_sigma IS NOT NULL) WHERE rn = 1 AND n_valid > 1""")
def m2_argmin_overlaps(spark, d):
    return mosaic.argmin_overlaps(fx.fx_tiles(spark, d), "delta_h_sigma")


@query("m3_overlaps", W("fx_tiles") + """
SELECT iy, ix, time, COUNT(delta_h_sigma) AS n_valid FROM fx_tiles GROUP BY iy, ix, time
HAVING COUNT(delta_h_sigma) > 1""")
def m3_overlaps(spark, d):
    return mosaic.overlaps(fx.fx_tiles(spark, d), "delta_h_sigma")


@query("m4_seam_presence", W("fx_tiles") + """
SELECT ix % 7 AS product, bool_or(abs(500*(ix - 24)) < 10) AS seam_x, bool_or(abs(500*(iy - 1) + 500*(ix % 5)) < 10) AS seam_y
FROM fx_tiles GROUP BY ix % 7""")
def m4_seam_presence(spark, d):
    """M4: products of which some touch a seam and some don't."""
    t = fx.fx_tiles(spark, d).select((F.col("ix") % 7).alias("product"), ((F.col("ix") - 24) * 500).alias("x"),
                                     ((F.col("iy") - 1) * 500 + F.col("ix") % 5 * 500).alias("y"))
    return mosaic.seam_presence(t, "product")


@query("u1_union_tiles", W("fx_tiles") + """
SELECT iy, ix, time, delta_h, delta_h_sigma, 'A' || CAST(tile_order + 1 AS VARCHAR) AS tile_id, tile_order FROM fx_tiles""")
def u1_union_tiles(spark, d):
    t = fx.fx_tiles(spark, d)
    parts = {f"A{i + 1}": t.where(F.col("tile_order") == i).drop("tile_order") for i in range(4)}
    return mosaic.union_tiles(parts)


# ------------------------------------------------------------ statistics ---

_A1_VARS = ["delta_h", "ice_area", "thetao", "so"]
_A1 = W("fx_static", "fx_icesat", "fx_ocean") + _BB + """, m AS (
  SELECT bb.* FROM bb JOIN fx_static s ON bb.iy = s.iy AND bb.ix = s.ix WHERE s.mask IN (1, 3))
""" + " UNION ALL ".join(
    f"SELECT '{v}' AS variable, MIN(CAST({v} AS DOUBLE)) AS vmin, MAX(CAST({v} AS DOUBLE)) AS vmax, "
    f"ROUND(AVG(CAST({v} AS DOUBLE)), 6) AS vmean, COUNT({v}) AS n_valid FROM m" for v in _A1_VARS)


@query("a1_summary", _A1)
def a1_summary(spark, d):
    bb = _bb(spark, d)
    ice = select.keep_codes(fx.fx_static(spark, d)).select("iy", "ix")
    return stats.summary(joins.mask_semi(bb, ice, ["iy", "ix"]), _A1_VARS)


@query("a2_valid_per_step", W("fx_icesat", "fx_ocean") + _BB + """
SELECT t.time, CAST(COALESCE(c.n_valid, 0) AS BIGINT) AS n_valid
FROM (SELECT DISTINCT time FROM bb) t LEFT JOIN (SELECT time, COUNT(delta_h) AS n_valid FROM bb GROUP BY time) c
ON t.time = c.time""")
def a2_valid_per_step(spark, d):
    return stats.valid_per_step(_bb(spark, d), "delta_h")


@query("a3_valid_per_pixel", W("fx_icesat", "fx_ocean") + _BB + """
, per AS (SELECT iy, ix, COUNT(delta_h) AS n FROM bb GROUP BY iy, ix)
SELECT COUNT(*) AS n_pixels,
       ROUND(AVG(CASE WHEN n = (SELECT COUNT(DISTINCT time) FROM bb) THEN 1 ELSE 0 END), 6) AS share_full,
       MIN(n) AS min_count, MAX(n) AS max_count FROM per""")
def a3_valid_per_pixel(spark, d):
    return stats.valid_per_pixel(_bb(spark, d), "delta_h")


@query("a4_temporal_moments", W("fx_icesat") + """
SELECT iy, ix, ROUND(AVG(delta_h), 6) AS mean, ROUND(STDDEV_POP(delta_h), 6) AS std, COUNT(delta_h) AS n
FROM fx_icesat GROUP BY iy, ix""")
def a4_temporal_moments(spark, d):
    return stats.temporal_moments(fx.fx_icesat(spark, d), "delta_h")


@query("a5_quadrant_stats", W("fx_icesat") + f"""
SELECT (CASE WHEN iy < {_ROWS} // 2 THEN 'N' ELSE 'S' END) || (CASE WHEN ix < 25 THEN 'W' ELSE 'E' END) AS quadrant,
       ROUND(AVG(delta_h), 6) AS mean, ROUND(STDDEV_POP(delta_h), 6) AS std, COUNT(delta_h) AS n
FROM fx_icesat GROUP BY 1""")
def a5_quadrant_stats(spark, d):
    return stats.quadrant_stats(fx.fx_icesat(spark, d), "delta_h", fx.grid_rows(spark, d), fx.NX)


@query("a6_robust_stats", """
SELECT MIN(value) AS vmin, MAX(value) AS vmax, ROUND(AVG(value), 6) AS vmean, ROUND(MEDIAN(value), 6) AS vmedian,
       ROUND(STDDEV_POP(value), 6) AS vstd, COUNT(value) AS n, bool_or(abs(value) > 200) AS warn_out_of_typical
FROM events""")
def a6_robust_stats(spark, d):
    return stats.robust_stats(fx.table(spark, d, "events"), "value", C.LWE_TYPICAL_ABS)


@query("a7_weighted_mean", W("fx_icesat") + """
SELECT time, ROUND(SUM(delta_h * COALESCE(ice_area, 0)) / NULLIF(SUM(CASE WHEN delta_h IS NOT NULL THEN COALESCE(ice_area, 0) END), 0), 6) AS wmean
FROM fx_icesat GROUP BY time""")
def a7_weighted_mean(spark, d):
    return stats.weighted_mean(fx.fx_icesat(spark, d), "delta_h", "ice_area")


@query("a8_histogram", """
SELECT CAST(LEAST(floor((value - 0.0) * 100.0 / 100.0) + 1, 100) AS INT) AS bin, COUNT(*) AS n,
       CAST(0.0 AS DOUBLE) + (CAST(LEAST(floor((value - 0.0) * 100.0 / 100.0) + 1, 100) AS INT) - 1) * CAST(1.0 AS DOUBLE) AS bin_lo
FROM events WHERE value BETWEEN 0 AND 100 GROUP BY 1""")
def a8_histogram(spark, d):
    return stats.histogram(fx.table(spark, d, "events"), "value", 0.0, 100.0, 100)


@query("a9_coverage", W("fx_icesat") + f"""
SELECT time, COUNT(delta_h) AS n_valid, CAST(50 * {_ROWS} AS BIGINT) AS n_total,
       ROUND(COUNT(delta_h) * 100.0 / CAST(50 * {_ROWS} AS DOUBLE), 6) AS pct
FROM fx_icesat GROUP BY time""")
def a9_coverage(spark, d):
    return stats.coverage(fx.fx_icesat(spark, d), "delta_h", fx.NX * fx.grid_rows(spark, d))


@query("a10_qc_counters", """
SELECT CAST(ts AS DATE) AS day, COUNT(value) AS n_processed,
       COUNT(*) FILTER (WHERE value IS NOT NULL AND NOT (value > 0 AND value < 100)) AS n_masked,
       ROUND(COUNT(*) FILTER (WHERE value IS NOT NULL AND NOT (value > 0 AND value < 100)) * 100.0
             / GREATEST(COUNT(value), 1), 6) AS pct_masked
FROM events GROUP BY 1""")
def a10_qc_counters(spark, d):
    return stats.qc_counters(fx.table(spark, d, "events"), "value", 0.0, 100.0,
                             by=F.to_date("ts").alias("day"))


@query("a11_row_counts", W("fx_static") + """
SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE mask IN (1, 3)) AS n_kept FROM fx_static""")
def a11_row_counts(spark, d):
    s = fx.fx_static(spark, d)
    return s.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("mask").isin(*C.ICE_CODES)).alias("n_kept"))


@query("a12_resolution", W("fx_static") + """
SELECT 'x' AS axis, MIN(x) AS cmin, MAX(x) AS cmax, COUNT(DISTINCT x) AS n,
       ROUND((MAX(x) - MIN(x)) / CAST(COUNT(DISTINCT x) - 1 AS DOUBLE), 6) AS res FROM fx_static
UNION ALL
SELECT 'y', MIN(y), MAX(y), COUNT(DISTINCT y), ROUND((MAX(y) - MIN(y)) / CAST(COUNT(DISTINCT y) - 1 AS DOUBLE), 6) FROM fx_static""")
def a12_resolution(spark, d):
    s = fx.fx_static(spark, d)
    return (stats.resolution(s, "x").select(F.lit("x").alias("axis"), "*")
            .unionByName(stats.resolution(s, "y").select(F.lit("y").alias("axis"), "*")))


@query("a13_duplicate_keys", W("fx_tiles") + """
SELECT iy, ix, time, COUNT(*) AS n FROM fx_tiles GROUP BY iy, ix, time HAVING COUNT(*) > 1""")
def a13_duplicate_keys(spark, d):
    return stats.duplicate_keys(fx.fx_tiles(spark, d), ["iy", "ix", "time"])


@query("a14_percentiles", """
SELECT ROUND(quantile_cont(value, 0.02), 9) AS p02, ROUND(quantile_cont(value, 0.98), 9) AS p98 FROM events""")
def a14_percentiles(spark, d):
    return stats.percentiles(fx.table(spark, d, "events"), "value")


_PS = (0.001, 0.02, 0.25, 0.5, 0.975, 0.999)


@query("a14_many_percentiles", "SELECT " + ", ".join(f"ROUND(quantile_cont(value, {p}), 9) AS {n}" for p, n in zip(_PS, quantiles.percentile_names(_PS))) + " FROM events")
def a14_many_percentiles(spark, d):
    return stats.percentiles(fx.table(spark, d, "events"), "value", _PS)


@query("a14_sketch_percentiles", "SELECT event_type, p, COUNT(value) AS n, TRUE AS within FROM events, (VALUES " + ", ".join(f"(CAST({p} AS DOUBLE))" for p in _PS) + ") t(p) GROUP BY event_type, p")
def a14_sketch_percentiles(spark, d):
    """A14 at scale: a sketch per type and day is stored, the days of a type are merged; the exact rank of each answer is within 1%."""
    e = fx.table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    stored = materialize(quantiles.step_sketches(e, "value", ("event_type", "day")), "sketches")
    found = quantiles.sketch_quantiles(stored, _PS, ("event_type",)).groupBy("event_type").agg(F.collect_list(F.struct("p", "q")).alias("pq"))
    ranked = e.where(F.col("value").isNotNull()).join(broadcast_checked(found), "event_type").select("event_type", "value", F.explode("pq").alias("c"))
    counts = ranked.groupBy("event_type", "c.p").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < F.col("c.q")).alias("below"),
                                                     F.count_if(F.col("value") <= F.col("c.q")).alias("up_to"))
    within = (F.col("below") <= (F.col("p") + 0.01) * F.col("n")) & (F.col("up_to") >= (F.col("p") - 0.01) * F.col("n"))
    return counts.select("event_type", "p", "n", within.alias("within"))


@query("a15_rule_counts", W("fx_static") + """
SELECT 'thickness_exceeds_draft' AS rule, COUNT(*) FILTER (WHERE thickness > abs(bed) + 0.01) AS n_violations FROM fx_static
UNION ALL
SELECT 'surface_not_integer', COUNT(*) FILTER (WHERE abs(surface - round(surface)) > 0.01) FROM fx_static""")
def a15_rule_counts(spark, d):
    s = fx.fx_static(spark, d)
    return stats.rule_counts(s, {
        "thickness_exceeds_draft": F.col("thickness") > F.abs("bed") + 0.01,
        "surface_not_integer": F.abs(F.col("surface") - F.round("surface")) > 0.01})


_EXT = f""", t AS (SELECT tile_order, {XY} FROM fx_tiles),
ext AS (SELECT tile_order, MIN(x) AS x_min, MAX(x) AS x_max, MIN(y) AS y_min, MAX(y) AS y_max,
               COUNT(DISTINCT x) AS nx, COUNT(DISTINCT y) AS ny, COUNT(*) AS n,
               MIN(x) - 250.0 AS "left", MAX(x) + 250.0 AS "right", MIN(y) - 250.0 AS bottom, MAX(y) + 250.0 AS top
        FROM t GROUP BY tile_order)
"""


@query("a16_tile_extents", W("fx_tiles") + _EXT + "SELECT * FROM ext")
def a16_tile_extents(spark, d):
    return stats.extents(_xy(fx.fx_tiles(spark, d)), "tile_order", 500.0)


@query("j10_tile_pairs", W("fx_tiles") + _EXT + """
, r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY y_min, tile_order) AS rk FROM ext),
p AS (SELECT a.tile_order AS tile_a, b.tile_order AS tile_b,
             LEAST(a.x_max, b.x_max) - GREATEST(a.x_min, b.x_min) AS dx,
             LEAST(a.y_max, b.y_max) - GREATEST(a.y_min, b.y_min) AS dy
      FROM r a JOIN r b ON a.rk < b.rk)
SELECT tile_a, tile_b, dx, dy, (dx > 0 AND dy > 0) AS overlap,
       CASE WHEN dx > 0 AND dy > 0 THEN CAST(floor(dx / 1000) AS BIGINT) END AS overlap_cells_x,
       CASE WHEN dx > 0 AND dy > 0 THEN CAST(floor(dx / 1000 * (dy / 1000)) AS BIGINT) END AS overlap_area_km2
FROM p""")
def j10_tile_pairs(spark, d):
    ext = stats.extents(_xy(fx.fx_tiles(spark, d)), "tile_order", 500.0)
    return stats.tile_pairs(ext, "tile_order")


_BOX = """CAST(tile_order * 100000 + year(time) * 4 + quarter(time) AS BIGINT)"""


@query("j10_overlapping_boxes", W("fx_tiles") + f"""
, t AS (SELECT {_BOX} AS box, {XY} FROM fx_tiles),
ext AS (SELECT box, MIN(x) AS x_min, MAX(x) AS x_max, MIN(y) AS y_min, MAX(y) AS y_max FROM t GROUP BY box),
p AS (SELECT a.box AS tile_a, b.box AS tile_b, LEAST(a.x_max, b.x_max) - GREATEST(a.x_min, b.x_min) AS dx,
             LEAST(a.y_max, b.y_max) - GREATEST(a.y_min, b.y_min) AS dy
      FROM ext a JOIN ext b ON a.y_min < b.y_min OR (a.y_min = b.y_min AND a.box < b.box))
SELECT tile_a, tile_b, dx, dy, CAST(floor(dx / 1000) AS BIGINT) AS overlap_cells_x,
       CAST(floor(dx / 1000 * (dy / 1000)) AS BIGINT) AS overlap_area_km2 FROM p WHERE dx > 0 AND dy > 0""")
def j10_overlapping_boxes(spark, d):
    """J10 among many boxes, one per tile and step: overlaps found by a join on grid cells."""
    boxes = _xy(fx.fx_tiles(spark, d)).withColumn("box", F.expr(_BOX))
    return stats.overlapping_pairs(stats.extents(boxes, "box", 500.0), "box")


_GAPS = """
WITH t AS (SELECT DISTINCT ts AS t FROM events WHERE ts IS NOT NULL),
g AS (SELECT LAG(t) OVER (ORDER BY t) AS prev_ts, t AS ts FROM t)
"""
_GAP_EXPR = "CAST(floor(CAST(datediff('microsecond', prev_ts, ts) AS DOUBLE) / 60000000) AS BIGINT)"


def _gaps(spark, d):
    return stats.consecutive_gaps(fx.table(spark, d, "events"), "ts", unit_micros=60_000_000)


@query("w4_time_gaps", _GAPS + f"SELECT prev_ts, ts, {_GAP_EXPR} AS gap FROM g WHERE prev_ts IS NOT NULL")
def w4_time_gaps(spark, d):
    return _gaps(spark, d)


@query("w4_gap_summary", _GAPS + f""", gg AS (SELECT {_GAP_EXPR} AS gap FROM g WHERE prev_ts IS NOT NULL)
SELECT COUNT(*) AS n_gaps, ROUND(AVG(gap), 6) AS avg_gap, MIN(gap) AS min_gap, MAX(gap) AS max_gap,
       COUNT(*) FILTER (WHERE gap > 20) AS n_large FROM gg""")
def w4_gap_summary(spark, d):
    return stats.gap_summary(_gaps(spark, d), 20)


@query("o3_first_large_gaps", _GAPS + f"""
SELECT prev_ts, ts, {_GAP_EXPR} AS gap FROM g WHERE prev_ts IS NOT NULL AND {_GAP_EXPR} > 20 ORDER BY ts LIMIT 5""")
def o3_first_large_gaps(spark, d):
    """O3: a top-k report - the first five gaps above the threshold."""
    return _gaps(spark, d).where(F.col("gap") > 20).orderBy("ts").limit(5)


@query("w5_monotonic", W("fx_static") + """
, xs AS (SELECT DISTINCT ix AS p, x AS v FROM fx_static), ys AS (SELECT DISTINCT iy AS p, y AS v FROM fx_static),
jx AS (SELECT a.v, b.v AS v_next FROM xs a JOIN xs b ON b.p - 1 = a.p),
jy AS (SELECT a.v, b.v AS v_next FROM ys a JOIN ys b ON b.p - 1 = a.p)
SELECT 'x' AS axis, COUNT(*) AS n_steps, COUNT(*) FILTER (WHERE v_next <= v) AS n_violations,
       COALESCE(bool_and(NOT (v_next <= v)), TRUE) AS monotonic FROM jx
UNION ALL
SELECT 'y', COUNT(*), COUNT(*) FILTER (WHERE v_next >= v), COALESCE(bool_and(NOT (v_next >= v)), TRUE) FROM jy
UNION ALL
SELECT 'bed', COUNT(*), COUNT(*) FILTER (WHERE v_next <= v), COALESCE(bool_and(NOT (v_next <= v)), TRUE) FROM (
  SELECT a.v, b.v AS v_next FROM (SELECT ix AS p, MAX(bed) AS v FROM fx_static GROUP BY ix) a JOIN (SELECT ix AS p, MAX(bed) AS v FROM fx_static GROUP BY ix) b ON b.p - 1 = a.p)""")
def w5_monotonic(spark, d):
    s = fx.fx_static(spark, d)
    return (stats.successor_violations(s, "ix", "x", True).select(F.lit("x").alias("axis"), "*")
            .unionByName(stats.successor_violations(s, "iy", "y", False).select(F.lit("y").alias("axis"), "*"))
            .unionByName(stats.successor_violations(s.groupBy("ix").agg(F.max("bed").alias("v")), "ix", "v", True).select(F.lit("bed").alias("axis"), "*")))


# ------------------------------------------------------------- selection ---

@query("p1_column_subset", W("fx_icesat") + "SELECT iy, ix, time, delta_h FROM fx_icesat")
def p1_column_subset(spark, d):
    return fx.fx_icesat(spark, d).select("iy", "ix", "time", "delta_h")


@query("p2_select_present", W("fx_icesat") + "SELECT iy, ix, time, delta_h, ice_area FROM fx_icesat")
def p2_select_present(spark, d):
    return select.select_present(fx.fx_icesat(spark, d), ["iy", "ix", "time", "delta_h", "ice_area",
                                                          "h_surface_dynamic", "surface_slope"])


@query("p3_rename", W("fx_static") + """
SELECT ix, iy, x, y, surface AS surface_m, thickness, bed AS bed_m, mask, mascon_id FROM fx_static""")
def p3_rename(spark, d):
    return select.rename(fx.fx_static(spark, d), {"surface": "surface_m", "bed": "bed_m", "absent": "x2"})


@query("p4_drop_tolerant", W("fx_static") + "SELECT ix, iy, x, y, surface, thickness, bed, mask FROM fx_static")
def p4_drop_tolerant(spark, d):
    return select.drop_tolerant(fx.fx_static(spark, d), "mascon_id", "not_a_column")


@query("p5_keep_ice", W("fx_static") + "SELECT * FROM fx_static WHERE mask IN (1, 3)")
def p5_keep_ice(spark, d):
    return select.keep_codes(fx.fx_static(spark, d))


@query("p6_null_outside_ice", W("fx_static") + """
SELECT ix, iy, x, y, CASE WHEN mask IN (1, 3) THEN surface END AS surface, thickness,
       CASE WHEN mask IN (1, 3) THEN bed END AS bed, mask, mascon_id FROM fx_static""")
def p6_null_outside_ice(spark, d):
    return select.null_outside(fx.fx_static(spark, d), ["surface", "bed"], F.col("mask").isin(*C.ICE_CODES))


@query("p7_drop_null", W("fx_tiles") + "SELECT * FROM fx_tiles WHERE delta_h_sigma IS NOT NULL")
def p7_drop_null(spark, d):
    return select.drop_null(fx.fx_tiles(spark, d), "delta_h_sigma")


@query("p8_time_slice", """
SELECT * FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-11'""")
def p8_time_slice(spark, d):
    return select.time_slice(fx.table(spark, d, "events"), "ts", "2024-01-05", "2024-01-10")


@query("p9_middle_step", W("fx_icesat") + """
, s AS (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS pos, COUNT(*) OVER () AS n FROM (SELECT DISTINCT time FROM fx_icesat))
SELECT f.* FROM fx_icesat f JOIN s ON f.time = s.time WHERE s.pos = n // 2""")
def p9_middle_step(spark, d):
    return select.pick_steps(fx.fx_icesat(spark, d), "middle")


@query("p9_every_10th_step", W("fx_icesat") + """
, s AS (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS pos FROM (SELECT DISTINCT time FROM fx_icesat))
SELECT f.* FROM fx_icesat f JOIN s ON f.time = s.time WHERE s.pos % 10 = 0""")
def p9_every_10th_step(spark, d):
    return select.pick_steps(fx.fx_icesat(spark, d), "every", every=10)


@query("p9_strided_sample", W("fx_icesat") + """
, s AS (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS pos FROM (SELECT DISTINCT time FROM fx_icesat))
SELECT f.* FROM fx_icesat f JOIN s ON f.time = s.time WHERE s.pos % 10 = 0 AND iy % 10 = 0 AND ix % 10 = 0""")
def p9_strided_sample(spark, d):
    return select.strided_sample(fx.fx_icesat(spark, d), every=10, every_cell=10)


@query("p10_bbox_subset", W("fx_target_xy", "fx_ocean") + """
, e AS (SELECT MIN(20000*ix - 500000) AS x0, MAX(20000*ix - 500000) AS x1, MIN(3000000 - 20000*iy) AS y0, MAX(3000000 - 20000*iy) AS y1 FROM fx_ocean)
SELECT t.* FROM fx_target_xy t, e WHERE t.tx BETWEEN e.x0 - 1000 AND e.x1 + 1000 AND t.ty BETWEEN e.y0 - 1000 AND e.y1 + 1000""")
def p10_bbox_subset(spark, d):
    """P10: targets inside the extent of a smaller grid."""
    ref = fx.fx_ocean(spark, d).select((F.col("ix") * 20000 - 500000).alias("tx"), (F.lit(3000000) - F.col("iy") * 20000).alias("ty"))
    return select.bbox_subset(fx.fx_target_xy(spark, d), ref, 1000.0, x="tx", y="ty")


@query("p11_qc_null_out", """
SELECT event_id, ts, CASE WHEN value > 0 AND value < 100 THEN value END AS value FROM events""")
def p11_qc_null_out(spark, d):
    return select.qc_null_out(fx.table(spark, d, "events").select("event_id", "ts", "value"), "value", 0.0, 100.0)


@query("p12_lat_range_max", W("fx_source_ll") + """
SELECT MAX(v) AS v_max, COUNT(*) AS n FROM fx_source_ll WHERE lat BETWEEN -90 AND -60""")
def p12_lat_range_max(spark, d):
    s = fx.fx_source_ll(spark, d)
    return s.where(F.col("lat").between(-90, -60)).agg(F.max("v").alias("v_max"), F.count(F.lit(1)).alias("n"))


@query("p13_add_time", W("fx_static") + "SELECT *, DATE '2000-01-01' AS time FROM fx_static")
def p13_add_time(spark, d):
    return select.add_time_if_missing(fx.fx_static(spark, d), F.to_date(F.lit("2000-01-01")))


@query("p14_null_guard", W("fx_icesat", "fx_ocean") + _BB + """
SELECT * FROM bb WHERE delta_h IS NOT NULL AND thetao IS NOT NULL AND so IS NOT NULL""")
def p14_null_guard(spark, d):
    return _bb(spark, d).where(select.all_present("delta_h", "thetao", "so"))


@query("p15_fill_zero", W("fx_tiles") + """
SELECT iy, ix, time, tile_order, delta_h, COALESCE(delta_h_sigma, 0) AS delta_h_sigma FROM fx_tiles""")
def p15_fill_zero(spark, d):
    return select.fill_zero(fx.fx_tiles(spark, d), ["delta_h_sigma"])


@query("p16_replace_if_exists", W("fx_icesat") + """
SELECT iy, ix, time, delta_h * 2.0 AS delta_h, delta_h_sigma, ice_area * 2.0 AS ice_area FROM fx_icesat""")
def p16_replace_if_exists(spark, d):
    return select.replace_if_exists(fx.fx_icesat(spark, d), ["delta_h", "ice_area", "thetao"],
                                    lambda c: F.col(c) * 2.0)


@query("p17_canonical_order", W("fx_icesat") + f"SELECT time, {XY}, iy, ix, delta_h FROM fx_icesat")
def p17_canonical_order(spark, d):
    return select.canonical_order(_xy(fx.fx_icesat(spark, d)).select("iy", "ix", "delta_h", "time", "x", "y"))


@query("p18_first_steps", W("fx_icesat") + """
, s AS (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS pos FROM (SELECT DISTINCT time FROM fx_icesat))
SELECT f.* FROM fx_icesat f JOIN s ON f.time = s.time WHERE s.pos < 3""")
def p18_first_steps(spark, d):
    return select.first_steps(fx.fx_icesat(spark, d), 3)


@query("p19_file_parts", """
SELECT file_name, token, count(*) AS count FROM (
  SELECT name AS file_name, CASE WHEN len(string_split(name, '_')) >= 2 THEN string_split(name, '_')[2] END AS token
  FROM (SELECT CASE WHEN l_linenumber = 7 THEN 'plain.nc' ELSE 'ATL15_A' || l_linenumber || '_' || l_returnflag || '.nc' END AS name FROM lineitem))
GROUP BY file_name, token""")
def p19_file_parts(spark, d):
    """File name and name token of product paths (one kind of name has no token)."""
    li = fx.table(spark, d, "lineitem")
    named = F.concat(F.lit("file:/store/a_b/ATL15_A"), F.col("l_linenumber"), F.lit("_"), F.col("l_returnflag"), F.lit(".nc"))
    path = F.when(F.col("l_linenumber") == 7, F.lit("file:/store/a_b/plain.nc")).otherwise(named)
    name, token = select.file_parts(path)
    return li.select(name.alias("file_name"), token.alias("token")).groupBy("file_name", "token").count()


# ------------------------------------------------------- ordering / sets ---

@query("o1_sort_coordinates", W("fx_static") + "SELECT * FROM fx_static ORDER BY x ASC, y DESC")
def o1_sort_coordinates(spark, d):
    return fx.fx_static(spark, d).orderBy(F.col("x").asc(), F.col("y").desc())


@query("u3_coordinate_difference", W("fx_static", "fx_icesat") + """
, s AS (SELECT iy, ix FROM fx_static WHERE thickness > 500),
a AS (SELECT DISTINCT iy, ix FROM fx_icesat WHERE delta_h > 0.02)
SELECT iy, ix, 'static_only' AS side FROM (SELECT iy, ix FROM s EXCEPT ALL SELECT iy, ix FROM a)
UNION ALL
SELECT iy, ix, 'data_only' FROM (SELECT iy, ix FROM a EXCEPT ALL SELECT iy, ix FROM s)""")
def u3_coordinate_difference(spark, d):
    """Cells with thick ice against cells that rose, both ways."""
    s = fx.fx_static(spark, d).where(F.col("thickness") > 500).select("iy", "ix")
    a = fx.fx_icesat(spark, d).where(F.col("delta_h") > 0.02).select("iy", "ix").distinct()
    return (s.exceptAll(a).withColumn("side", F.lit("static_only"))
            .unionByName(a.exceptAll(s).withColumn("side", F.lit("data_only"))))


@query("u4_null_pattern", W("fx_icesat", "fx_ocean") + _BB + """
SELECT COUNT(*) FILTER (WHERE (thetao IS NULL) <> (so IS NULL)) AS n_mismatch, COUNT(*) AS n FROM bb""")
def u4_null_pattern(spark, d):
    return stats.null_pattern_mismatch(_bb(spark, d), "thetao", "so")


@query("u4_mask_intersection", W("fx_static", "fx_icesat") + """
SELECT iy, ix FROM fx_static WHERE mask IN (1, 3) INTERSECT SELECT iy, ix FROM fx_icesat""")
def u4_mask_intersection(spark, d):
    ice = select.keep_codes(fx.fx_static(spark, d)).select("iy", "ix")
    return ice.intersect(fx.fx_icesat(spark, d).select("iy", "ix"))


# ------------------------------------------------------------------ joins ---

@query("j4_static_align", W("fx_static", "fx_coarse") + """
, topo AS (SELECT iy, ix, surface, bed, thickness, mask FROM fx_static),
masc AS (SELECT iy, ix, mascon_id FROM fx_static WHERE mascon_id IS NOT NULL),
crs AS (SELECT cy AS iy, cx AS ix, v AS coarse_v FROM fx_coarse WHERE v IS NOT NULL)
SELECT COALESCE(topo.iy, masc.iy, crs.iy) AS iy, COALESCE(topo.ix, masc.ix, crs.ix) AS ix,
       surface, bed, thickness, mask, mascon_id, coarse_v
FROM topo FULL OUTER JOIN masc ON topo.iy = masc.iy AND topo.ix = masc.ix
FULL OUTER JOIN crs ON COALESCE(topo.iy, masc.iy) = crs.iy AND COALESCE(topo.ix, masc.ix) = crs.ix""")
def j4_static_align(spark, d):
    s = fx.fx_static(spark, d)
    topo = s.select("iy", "ix", "surface", "bed", "thickness", "mask")
    masc = s.where(F.col("mascon_id").isNotNull()).select("iy", "ix", "mascon_id")
    crs = fx.fx_coarse(spark, d).where(F.col("v").isNotNull()).select(
        F.col("cy").alias("iy"), F.col("cx").alias("ix"), F.col("v").alias("coarse_v"))
    return joins.outer_align([topo, masc, crs], ["iy", "ix"])


@query("j5_dynamic_align", W("fx_icesat", "fx_ocean", "fx_tiles") + """
, t1 AS (SELECT iy, ix, time, MIN(delta_h) AS dh_tiles FROM fx_tiles GROUP BY iy, ix, time)
SELECT COALESCE(a.iy, o.iy, t1.iy) AS iy, COALESCE(a.ix, o.ix, t1.ix) AS ix, COALESCE(a.time, o.time, t1.time) AS time,
       a.delta_h, o.so, t1.dh_tiles
FROM fx_icesat a FULL OUTER JOIN fx_ocean o ON a.iy = o.iy AND a.ix = o.ix AND a.time = o.time
FULL OUTER JOIN t1 ON COALESCE(a.iy, o.iy) = t1.iy AND COALESCE(a.ix, o.ix) = t1.ix AND COALESCE(a.time, o.time) = t1.time""")
def j5_dynamic_align(spark, d):
    a = fx.fx_icesat(spark, d).select("iy", "ix", "time", "delta_h")
    o = fx.fx_ocean(spark, d).select("iy", "ix", "time", "so")
    t1 = fx.fx_tiles(spark, d).groupBy("iy", "ix", "time").agg(F.min("delta_h").alias("dh_tiles"))
    return joins.outer_align([a, o, t1], ["iy", "ix", "time"], partition_by=["iy", "ix"])


@query("j6_surface_dynamic", W("fx_static", "fx_icesat") + """
SELECT a.iy, a.ix, a.time, s.surface + a.delta_h AS h_surface_dynamic
FROM fx_icesat a JOIN fx_static s ON a.iy = s.iy AND a.ix = s.ix""")
def j6_surface_dynamic(spark, d):
    from floe.functions.thermo import dynamic_surface
    a = fx.fx_icesat(spark, d)
    s = fx.fx_static(spark, d).select("iy", "ix", "surface")
    return a.join(s, ["iy", "ix"], "inner").select("iy", "ix", "time", dynamic_surface().alias("h_surface_dynamic"))


@query("j7_mask_semi", W("fx_static", "fx_icesat") + """
SELECT * FROM fx_icesat a WHERE EXISTS (SELECT 1 FROM fx_static s WHERE s.iy = a.iy AND s.ix = a.ix AND s.mask IN (1, 3))""")
def j7_mask_semi(spark, d):
    ice = select.keep_codes(fx.fx_static(spark, d)).select("iy", "ix")
    return joins.mask_semi(fx.fx_icesat(spark, d), ice, ["iy", "ix"])


@query("j8_reindex_canvas", W("fx_static", "fx_tiles") + """
, ext AS (SELECT MIN(iy) AS iy0, MAX(iy) AS iy1, MIN(ix) AS ix0, MAX(ix) AS ix1 FROM fx_tiles),
canvas AS (SELECT r.iy, c.ix FROM (SELECT unnest(range(iy0, iy1 + 1)) AS iy FROM ext) r,
                                   (SELECT unnest(range(ix0, ix1 + 1)) AS ix FROM ext) c)
SELECT CAST(canvas.iy AS INT) AS iy, CAST(canvas.ix AS INT) AS ix, s.surface, s.mask
FROM canvas LEFT JOIN fx_static s ON canvas.iy = s.iy AND canvas.ix = s.ix AND s.mask <> 0""")
def j8_reindex_canvas(spark, d):
    from floe.sources.readers import canvas_from_extent
    canvas = canvas_from_extent(fx.fx_tiles(spark, d), "iy", "ix")
    s = fx.fx_static(spark, d).where(F.col("mask") != 0).select("iy", "ix", "surface", "mask")
    return canvas.join(s, ["iy", "ix"], "left")


@query("j9_coverage_gaps", W("fx_static", "fx_ocean") + """
, e AS (SELECT DISTINCT iy, ix FROM fx_static WHERE mask IN (1, 3)), p AS (SELECT DISTINCT iy, ix FROM fx_ocean)
SELECT iy, ix, 'expected_missing' AS kind FROM (SELECT * FROM e EXCEPT SELECT * FROM p)
UNION ALL SELECT iy, ix, 'unexpected_present' FROM (SELECT * FROM p EXCEPT SELECT * FROM e)""")
def j9_coverage_gaps(spark, d):
    ice = select.keep_codes(fx.fx_static(spark, d))
    return joins.coverage_gaps(ice, fx.fx_ocean(spark, d), ["iy", "ix"])


@query("j14_coordinate_equality", W("fx_static") + """
, g AS (SELECT iy, ix, CAST(-3071750 + 500*ix + CASE WHEN mask = 0 THEN 100 WHEN mask = 1 THEN 20 ELSE 0 END AS DOUBLE) AS gx, CAST(3071750 - 500*iy AS DOUBLE) AS gy FROM fx_static),
u AS (SELECT x, y, 1 AS l, 0 AS r FROM fx_static UNION ALL SELECT gx, gy, 0, 1 FROM g),
m AS (SELECT x, y, SUM(l) AS nl, SUM(r) AS nr FROM u GROUP BY x, y)
SELECT 'n_left' AS metric, CAST(SUM(nl) AS BIGINT) AS n FROM m
UNION ALL SELECT 'n_right', CAST(SUM(nr) AS BIGINT) FROM m
UNION ALL SELECT 'n_only_left', CAST(SUM(GREATEST(nl - nr, 0)) AS BIGINT) FROM m
UNION ALL SELECT 'n_only_right', CAST(SUM(GREATEST(nr - nl, 0)) AS BIGINT) FROM m
UNION ALL SELECT 'n_not_close', COUNT(*) FROM fx_static s JOIN g ON s.iy = g.iy AND s.ix = g.ix
  WHERE NOT (abs(s.x - g.gx) <= 1e-8 + 1e-5 * abs(g.gx) AND abs(s.y - g.gy) <= 1e-8 + 1e-5 * abs(g.gy))""")
def j14_coordinate_equality(spark, d):
    s = fx.fx_static(spark, d)
    # cells of one mask value are off by more than the tolerance, those of another by less
    off = F.when(F.col("mask") == 0, F.lit(100.0)).when(F.col("mask") == 1, F.lit(20.0)).otherwise(F.lit(0.0))
    g = s.select("iy", "ix", (G.x("ix") + off).alias("gx"), G.y("iy").alias("gy"))
    eq = joins.multiset_compare(s.select("x", "y"), g.select(F.col("gx").alias("x"), F.col("gy").alias("y")))
    close = joins.tolerant_equal(F.col("x"), F.col("gx")) & joins.tolerant_equal(F.col("y"), F.col("gy"))
    pos = s.join(g, ["iy", "ix"]).agg(F.lit("n_not_close").alias("metric"), F.count_if(~close).alias("n"))
    return eq.unionByName(pos)


@query("j15_merge_latlon", W("fx_source_ll") + """
, land AS (SELECT lat, lon, v AS land_v FROM fx_source_ll WHERE v IS NOT NULL),
ocean AS (SELECT lat, lon, v AS ocean_v FROM fx_source_ll WHERE v IS NULL OR v > 1000)
SELECT COALESCE(land.lat, ocean.lat) AS lat, COALESCE(land.lon, ocean.lon) AS lon, land_v, ocean_v
FROM land FULL OUTER JOIN ocean ON land.lat = ocean.lat AND land.lon = ocean.lon""")
def j15_merge_latlon(spark, d):
    s = fx.fx_source_ll(spark, d)
    land = s.where(F.col("v").isNotNull()).select("lat", "lon", F.col("v").alias("land_v"))
    ocean = s.where(F.col("v").isNull() | (F.col("v") > 1000)).select("lat", "lon", F.col("v").alias("ocean_v"))
    return joins.outer_align([land, ocean], ["lat", "lon"])


@query("j16_combine_tiles", W("fx_tiles") + """
SELECT iy, ix, time, delta_h, delta_h_sigma, tile_order FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY iy, ix, time ORDER BY delta_h_sigma NULLS LAST, tile_order) AS rn
  FROM fx_tiles WHERE delta_h_sigma IS NOT NULL OR tile_order = 0) WHERE rn = 1""")
def j16_combine_tiles(spark, d):
    """Separately read tiles combined by coordinates (U1), overlaps resolved by M1."""
    t = fx.fx_tiles(spark, d)
    parts = {f"A{i + 1}": t.where(F.col("tile_order") == i).drop("tile_order") for i in range(4)}
    return mosaic.mosaic(mosaic.union_tiles(parts).drop("tile_id"), "delta_h_sigma")


@query("o2_tile_order", W("fx_tiles") + _EXT + """
SELECT tile_order, y_min, ROW_NUMBER() OVER (ORDER BY y_min, tile_order) AS rank FROM ext""")
def o2_tile_order(spark, d):
    """O2: tiles ordered by their lower edge (a table with one row per tile)."""
    from pyspark.sql import Window
    ext = stats.extents(_xy(fx.fx_tiles(spark, d)), "tile_order", 500.0)
    return ext.select("tile_order", "y_min", F.row_number().over(Window.orderBy("y_min", "tile_order")).cast("long").alias("rank"))

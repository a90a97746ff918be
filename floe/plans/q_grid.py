"""Registered queries: regridding (J11-J13), stencils (W6, W7), scalar functions
(F1-F16) and sources (S1-S9)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions import grid as gf
from floe.functions import thermo, timefn
from floe.functions.grid import FIXTURE_GRID as G
from floe.functions.proj import xy_to_latlon
from floe.functions.timefn import quarter_start
from floe.functions import proj
from floe.operators import regrid, stencil
from floe.plans.registry import query
from floe.session import scratch_path
from floe.sources import fixtures as fx
from floe.sources import readers

W = fx.ctes
_ROWS = "(SELECT max(p_partkey // 50) + 1 FROM part)"


def _d(x: float) -> str:
    """A DOUBLE literal for DuckDB with the exact value of the Python float."""
    return f"CAST('{x!r}' AS DOUBLE)"


# ------------------------------------------------------------- bilinear ---

def _targets_2x(coarse):
    """500 m targets of a 1 km node lattice: four per node, at node units .25/.75."""
    ab = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    t = coarse.select("cy", "cx", F.explode(ab).alias("o")).select(
        (F.col("cy") * 2 + F.col("o.a")).cast("int").alias("iy"), (F.col("cx") * 2 + F.col("o.b")).cast("int").alias("ix"))
    return t.withColumns({"fx": F.lit(0.25) + F.lit(0.5) * F.col("ix").cast("double"),
                          "fy": F.lit(0.25) + F.lit(0.5) * F.col("iy").cast("double")})


_BIL = """
, t AS (SELECT 2*cy + a AS iy, 2*cx + b AS ix FROM fx_coarse, (VALUES (0), (1)) A(a), (VALUES (0), (1)) B(b)),
tt AS (SELECT CAST(iy AS INT) AS iy, CAST(ix AS INT) AS ix,
              CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(ix AS DOUBLE) AS fx,
              CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(iy AS DOUBLE) AS fy FROM t),
tw AS (SELECT *, CAST(floor(fx) AS INT) AS sx, CAST(floor(fy) AS INT) AS sy FROM tt),
bil AS (SELECT tw.iy, tw.ix,
  CASE WHEN c00.v IS NOT NULL AND c01.v IS NOT NULL AND c10.v IS NOT NULL AND c11.v IS NOT NULL THEN
    ((CAST(1 AS DOUBLE) - (fy - sy)) * (CAST(1 AS DOUBLE) - (fx - sx))) * c00.v
    + ((CAST(1 AS DOUBLE) - (fy - sy)) * (fx - sx)) * c01.v
    + ((fy - sy) * (CAST(1 AS DOUBLE) - (fx - sx))) * c10.v
    + ((fy - sy) * (fx - sx)) * c11.v END AS v
  FROM tw LEFT JOIN fx_coarse c00 ON c00.cy = sy AND c00.cx = sx
  LEFT JOIN fx_coarse c01 ON c01.cy = sy AND c01.cx = sx + 1
  LEFT JOIN fx_coarse c10 ON c10.cy = sy + 1 AND c10.cx = sx
  LEFT JOIN fx_coarse c11 ON c11.cy = sy + 1 AND c11.cx = sx + 1)
"""


@query("j12_bilinear", W("fx_coarse") + _BIL + "SELECT iy, ix, v FROM bil")
def j12_bilinear(spark, d):
    c = fx.fx_coarse(spark, d)
    return regrid.bilinear(c, _targets_2x(c), ["iy", "ix"])


@query("j13_apply_weights", W("fx_coarse") + _BIL + "SELECT iy * 100 + ix AS dst_id, ROUND(v, 6) AS v FROM bil")
def j13_apply_weights(spark, d):
    c = fx.fx_coarse(spark, d)
    t = _targets_2x(c).withColumn("dst_id", F.col("iy") * 100 + F.col("ix"))
    w = regrid.bilinear_weights(t, "dst_id", "fy", "fx", lambda sy, sx: sy * 1000 + sx)
    src = c.select((F.col("cy") * 1000 + F.col("cx")).alias("src_id"), "v")
    out = regrid.apply_weights(src, w)
    return out.select("dst_id", F.round("v", 6).alias("v"))


# ------------------------------------------------------------ nearest ---

def _latlon_sql(x: str, y: str) -> tuple[str, str]:
    """F4 inverse projection written out in SQL (same formula as the Column version)."""
    tc_amc = proj._TC / (proj.C.WGS84_A * proj._MC)
    chi = f"({_d(math.pi / 2)} - atan(sqrt({x}*{x} + {y}*{y}) * {_d(tc_amc)}) * CAST(2 AS DOUBLE))"
    phi = (f"({chi} + {_d(proj._K2)} * sin({chi} * 2) + {_d(proj._K4)} * sin({chi} * 4)"
           f" + {_d(proj._K6)} * sin({chi} * 6) + {_d(proj._K8)} * sin({chi} * 8))")
    lat = f"(-({phi}) * {_d(180.0 / math.pi)})"
    lon = f"(atan2({x}, {y}) * {_d(180.0 / math.pi)})"
    return lat, lon


_LAT, _LON = _latlon_sql("tx", "ty")


@query("f4_inverse_projection", W("fx_target_xy") + f"""
SELECT dst_id, ROUND({_LAT}, 9) AS lat, ROUND({_LON}, 9) AS lon FROM fx_target_xy""")
def f4_inverse_projection(spark, d):
    t = fx.fx_target_xy(spark, d)
    lat, lon = xy_to_latlon("tx", "ty")
    return t.select("dst_id", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


def _nearest(spark, d):
    nrows = fx.grid_rows(spark, d)
    src = fx.fx_source_ll(spark, d, nrows)
    lat, lon = xy_to_latlon("tx", "ty")
    tgt = fx.fx_target_xy(spark, d, nrows).select("dst_id", lat.alias("lat"), lon.alias("lon"))
    dlat = 40.0 / nrows
    return regrid.nearest_regular(src, tgt, lat0=-90.0 + dlat / 2, dlat=dlat, lon0=-176.4, dlon=7.2,
                                  n_lat=nrows, n_lon=fx.NX)


_NN = f"""
, tgt AS (SELECT dst_id, {_LAT} AS lat, {_LON} AS lon FROM fx_target_xy),
tu AS (SELECT dst_id, cos(radians(lat))*cos(radians(lon)) AS x, cos(radians(lat))*sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM tgt),
su AS (SELECT src_id, v, cos(radians(lat))*cos(radians(lon)) AS x, cos(radians(lat))*sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM fx_source_ll),
nn AS (SELECT dst_id, src_id, v FROM (
  SELECT tu.dst_id, su.src_id, su.v,
         ROW_NUMBER() OVER (PARTITION BY tu.dst_id ORDER BY (tu.x-su.x)*(tu.x-su.x) + (tu.y-su.y)*(tu.y-su.y) + (tu.z-su.z)*(tu.z-su.z), su.src_id) AS rn
  FROM tu, su) WHERE rn = 1)
"""


@query("j11_nearest_neighbour", W("fx_source_ll", "fx_target_xy") + _NN + "SELECT * FROM nn")
def j11_nearest_neighbour(spark, d):
    return _nearest(spark, d)


@query("b6_anomaly_regrid", W("fx_source_ll", "fx_target_xy") + _NN + f"""
, an AS (SELECT CAST(l_partkey AS INT) AS src_id, {fx._qtr('l_shipdate')} AS time, MAX(l_quantity) * 200 - 3600 AS lwe FROM lineitem GROUP BY 1, 2),
sl AS (SELECT * FROM an WHERE time BETWEEN DATE '1993-01-01' AND DATE '1996-12-31'),
ts AS (SELECT DISTINCT time FROM sl)
SELECT nn.dst_id, ts.time, CASE WHEN lwe > -5000 AND lwe < 5000 THEN lwe END AS lwe
FROM nn CROSS JOIN ts LEFT JOIN sl ON sl.src_id = nn.src_id AND sl.time = ts.time""")
def b6_anomaly_regrid(spark, d):
    """B6 with its time axis, through the job: days decoded (F3), steps sliced (P8), targets -> lat/lon (F4) -> nearest source
    (J11, once) -> weights applied to every step (J13) -> QC (P11) -> regions written (K4) and read back."""
    from floe.plans import jobs
    nrows = fx.grid_rows(spark, d)
    dlat = 40.0 / nrows
    source, grid, targets, weights, out = (scratch_path(spark, f"b6-{n}") for n in ("source", "grid", "targets", "weights", "out"))
    steps = fx.table(spark, d, "lineitem").groupBy(F.col("l_partkey").cast("int").alias("src_id"), quarter_start("l_shipdate").alias("q")).agg(
        (F.max("l_quantity") * 200 - 3600).alias("lwe"))
    steps.select("src_id", (F.date_diff("q", F.lit("1990-01-01").cast("date")) + F.lit(0.25)).cast("double").alias("time"), "lwe").write.parquet(source)
    fx.fx_source_ll(spark, d, nrows).select("src_id", "si", "sj", "lat", "lon").write.parquet(grid)
    fx.fx_target_xy(spark, d, nrows).select("dst_id", F.col("tx").alias("x"), F.col("ty").alias("y")).write.parquet(targets)
    table, _ = jobs.run_anomaly_regrid(spark, source, grid, targets, weights, out, -90.0 + dlat / 2, dlat, -176.4, 7.2, nrows, fx.NX,
                                       epoch="1990-01-01", first_day="1993-01-01", last_day="1996-12-31")
    return table.select("dst_id", "time", "lwe")


# -------------------------------------------------------------- stencils ---

def _slope_sql(src: str, val: str, ny: str, nx: str, extra_keys: tuple[str, ...] = ()) -> str:
    on = "".join(f" AND n.{k} = s.{k}" for k in extra_keys)
    keys = ", ".join(f"s.{k}" for k in extra_keys)
    keys = (keys + ", ") if keys else ""
    return f"""
SELECT s.iy, s.ix, {keys}CAST(sqrt(gx * gx + gy * gy) AS FLOAT) AS slope FROM (
  SELECT s.iy, s.ix, {keys}
    ((CASE WHEN s.iy = {ny} - 1 THEN s.{val} ELSE dn.{val} END) - (CASE WHEN s.iy = 0 THEN s.{val} ELSE up.{val} END)) / CAST(1000 AS DOUBLE) AS gy,
    ((CASE WHEN s.ix = {nx} - 1 THEN s.{val} ELSE rt.{val} END) - (CASE WHEN s.ix = 0 THEN s.{val} ELSE lf.{val} END)) / CAST(1000 AS DOUBLE) AS gx
  FROM {src} s
  LEFT JOIN {src} up ON up.iy = s.iy - 1 AND up.ix = s.ix{on.replace('n.', 'up.')}
  LEFT JOIN {src} dn ON dn.iy = s.iy + 1 AND dn.ix = s.ix{on.replace('n.', 'dn.')}
  LEFT JOIN {src} lf ON lf.iy = s.iy AND lf.ix = s.ix - 1{on.replace('n.', 'lf.')}
  LEFT JOIN {src} rt ON rt.iy = s.iy AND rt.ix = s.ix + 1{on.replace('n.', 'rt.')}) s"""


@query("w6_slope", W("fx_static") + _slope_sql("fx_static", "bed", _ROWS, "50"))
def w6_slope(spark, d):
    s = fx.fx_static(spark, d)
    return stencil.slope(s, "bed", fx.grid_rows(spark, d), fx.NX).select("iy", "ix", "slope")


_HSD = """
, hsd AS (SELECT a.iy, a.ix, a.time, s.surface + a.delta_h AS h FROM fx_icesat a JOIN fx_static s ON a.iy = s.iy AND a.ix = s.ix)
"""


@query("w6_slope_dynamic", W("fx_static", "fx_icesat") + _HSD + _slope_sql("hsd", "h", _ROWS, "50", ("time",)))
def w6_slope_dynamic(spark, d):
    a = fx.fx_icesat(spark, d)
    s = fx.fx_static(spark, d).select("iy", "ix", "surface")
    h = a.join(s, ["iy", "ix"]).select("iy", "ix", "time", thermo.dynamic_surface().alias("h"))
    return stencil.slope(h, "h", fx.grid_rows(spark, d), fx.NX, by=("time",)).select("iy", "ix", "time", "slope")


_EDT = """
, gnd AS (SELECT iy, ix FROM fx_static WHERE mask = 1),
edt AS (SELECT s.iy, s.ix, CASE WHEN s.mask = 1 THEN CAST(0 AS FLOAT)
             ELSE CAST(sqrt(CAST(MIN((s.iy - g.iy) * (s.iy - g.iy) + (s.ix - g.ix) * (s.ix - g.ix)) AS DOUBLE)) * CAST(500 AS DOUBLE) AS FLOAT) END AS dist
        FROM fx_static s LEFT JOIN gnd g ON TRUE GROUP BY s.iy, s.ix, s.mask)
"""


@query("w7_grounding_distance", W("fx_static") + _EDT + "SELECT * FROM edt")
def w7_grounding_distance(spark, d):
    s = fx.fx_static(spark, d).select("iy", "ix", "mask")
    return stencil.distance_to_sources(s, F.col("mask") == 1, fx.grid_rows(spark, d)).select("iy", "ix", "dist")


# -------------------------------------------------------------- functions ---

@query("f1_snap", W("fx_static") + """
SELECT iy, ix, round_even((x + 123.0) / 1000, 0) * 1000 AS x_snap, round_even((y - 377.0) / 1000, 0) * 1000 AS y_snap FROM fx_static""")
def f1_snap(spark, d):
    s = fx.fx_static(spark, d)
    return s.select("iy", "ix", gf.snap(F.col("x") + 123.0, 1000).alias("x_snap"),
                    gf.snap(F.col("y") - 377.0, 1000).alias("y_snap"))


@query("f2_coords_from_index", W("fx_icesat") + """
SELECT iy, ix, time, CAST(-3071750 + 500*ix AS DOUBLE) AS x, CAST(3071750 - 500*iy AS DOUBLE) AS y FROM fx_icesat""")
def f2_coords_from_index(spark, d):
    return fx.fx_icesat(spark, d).select("iy", "ix", "time", G.x("ix").alias("x"), G.y("iy").alias("y"))


@query("f3_days_to_timestamp", """
SELECT event_id, TIMESTAMP '2002-01-01 00:00:00' + to_microseconds(CAST((CAST(event_id AS DOUBLE) / 16 + 6000) * 86400 * 1000000 AS BIGINT)) AS time
FROM events""")
def f3_days_to_timestamp(spark, d):
    e = fx.table(spark, d, "events")
    days = F.col("event_id").cast("double") / F.lit(16.0) + F.lit(6000.0)
    return e.select("event_id", timefn.days_to_timestamp(days, "2002-01-01").alias("time"))


def _thermo(spark, d):
    """Ocean match (thetao, so, draft) with pressure, freezing point and thermal driving."""
    from floe.plans.q_io import ocean_match
    om = ocean_match(spark, d).withColumn("pressure", thermo.base_pressure())
    om = om.withColumn("T_f", thermo.freezing_point())
    return om.withColumn("T_star", thermo.thermal_driving())


def _thermo_sql() -> str:
    from floe.plans.q_io import _THERMO_SQL
    return _THERMO_SQL


@query("f5_f9_thermodynamics", W("fx_static", "fx_ocean") + _thermo_sql() + "SELECT * FROM th")
def f5_f9_thermodynamics(spark, d):
    return _thermo(spark, d)


@query("f10_elementary", W("fx_static") + """
SELECT iy, ix, abs(bed) AS abs_bed, sqrt(thickness) AS sqrt_thickness, iy // 4 AS iy_div4,
       LEAST(surface, thickness) AS lo, GREATEST(surface, thickness) AS hi FROM fx_static""")
def f10_elementary(spark, d):
    s = fx.fx_static(spark, d)
    return s.select("iy", "ix", F.abs("bed").alias("abs_bed"), F.sqrt("thickness").alias("sqrt_thickness"),
                    F.expr("iy div 4").cast("int").alias("iy_div4"),
                    F.least("surface", "thickness").alias("lo"), F.greatest("surface", "thickness").alias("hi"))


@query("f11_finite", W("fx_tiles") + """
, v AS (SELECT iy, ix, time, tile_order, CASE tile_order WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN delta_h_sigma * 'inf'::DOUBLE
          ELSE delta_h_sigma END AS sigma FROM fx_tiles)
SELECT iy, ix, time, tile_order, (sigma IS NOT NULL AND NOT isnan(sigma) AND abs(sigma) < 'inf'::DOUBLE) AS sigma_finite FROM v""")
def f11_finite(spark, d):
    """F11 over nulls, NaN and infinities (two of the tiles)."""
    sigma = F.when(F.col("tile_order") == 1, F.lit(float("nan"))).when(
        F.col("tile_order") == 2, F.col("delta_h_sigma") * F.lit(float("inf"))).otherwise(F.col("delta_h_sigma"))
    t = fx.fx_tiles(spark, d).withColumn("sigma", sigma)
    return t.select("iy", "ix", "time", "tile_order", gf.is_finite("sigma").alias("sigma_finite"))


@query("f12_isclose", W("fx_static") + """
SELECT iy, ix, abs(x - (x + 20 * (ix % 3))) <= 1.0 + 1e-5 * abs(x + 20 * (ix % 3)) AS x_close FROM fx_static""")
def f12_isclose(spark, d):
    """coordinates against copies that are off by nothing, by less and by more than the tolerance."""
    s = fx.fx_static(spark, d)
    return s.select("iy", "ix", gf.isclose(F.col("x"), F.col("x") + F.col("ix") % 3 * 20, atol=1.0).alias("x_close"))


@query("f13_try_cast", W("fx_static") + """
SELECT iy, ix, TRY_CAST(CASE WHEN mascon_id IS NULL THEN 'NaN'::DOUBLE ELSE CAST(mascon_id AS DOUBLE) END AS INT) AS mascon_int FROM fx_static""")
def f13_try_cast(spark, d):
    s = fx.fx_static(spark, d)
    m = F.when(F.col("mascon_id").isNull(), F.lit(float("nan"))).otherwise(F.col("mascon_id").cast("double"))
    return s.select("iy", "ix", m.try_cast("int").alias("mascon_int"))


@query("f14_date_format", """
SELECT event_id, strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def f14_date_format(spark, d):
    e = fx.table(spark, d, "events")
    return e.select("event_id", timefn.fmt_month("ts").alias("month"), timefn.fmt_day("ts").alias("day"))


@query("f15_truncate_text", """
SELECT doc_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 97) || '...' ELSE text END AS text_short FROM documents""")
def f15_truncate_text(spark, d):
    doc = fx.table(spark, d, "documents")
    return doc.select("doc_id", gf.truncate_text("text", 100).alias("text_short"))


@query("f16_cell_edges", W("fx_static") + """
SELECT iy, ix, x - 250.0 AS x_left, x + 250.0 AS x_right, y - 250.0 AS y_bottom, y + 250.0 AS y_top FROM fx_static""")
def f16_cell_edges(spark, d):
    s = fx.fx_static(spark, d)
    (xl, xr), (yb, yt) = gf.cell_edges("x", 500.0), gf.cell_edges("y", 500.0)
    return s.select("iy", "ix", xl.alias("x_left"), xr.alias("x_right"), yb.alias("y_bottom"), yt.alias("y_top"))


# ---------------------------------------------------------------- sources ---

_PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])


@query("s1_parquet_scan", "SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size > 10")
def s1_parquet_scan(spark, d):
    p = readers.read_table(spark, f"{d}/part.parquet", schema=_PART_SCHEMA)
    return p.where(F.col("p_size") > 10).select("p_partkey", "p_size", "p_retailprice")


@query("s3_cube_to_long", W("fx_static") + "SELECT iy, ix, surface AS v FROM fx_static")
def s3_cube_to_long(spark, d):
    s = fx.fx_static(spark, d)
    chunks = readers.long_to_cube(s, "surface", 10)
    return readers.cube_to_long(chunks, "v").where(F.col("v").isNotNull())


@query("s5_master_grid", W("fx_static") + "SELECT iy, ix, y, x FROM fx_static")
def s5_master_grid(spark, d):
    g = gf.Grid(G.x0, G.y0, G.res, fx.NX, fx.grid_rows(spark, d))
    return readers.master_grid(spark, g)


@query("s6_canvas_from_extent", W("fx_icesat") + """
, ext AS (SELECT MIN(iy) AS iy0, MAX(iy) AS iy1, MIN(ix) AS ix0, MAX(ix) AS ix1 FROM fx_icesat)
SELECT CAST(r.iy AS INT) AS iy, CAST(c.ix AS INT) AS ix FROM (SELECT unnest(range(iy0, iy1 + 1)) AS iy FROM ext) r,
       (SELECT unnest(range(ix0, ix1 + 1)) AS ix FROM ext) c""")
def s6_canvas_from_extent(spark, d):
    return readers.canvas_from_extent(fx.fx_icesat(spark, d))


@query("s7_input_check", """
SELECT 'part' AS name, true AS exists, COUNT(*) AS n FROM part UNION ALL SELECT 'lineitem', true, COUNT(*) FROM lineitem
UNION ALL SELECT 'orders', true, COUNT(*) FROM orders UNION ALL SELECT 'events', true, COUNT(*) FROM events
UNION ALL SELECT 'not_a_table', false, CAST(NULL AS BIGINT)""")
def s7_input_check(spark, d):
    """Existence of every input table, and the rows of those that are there."""
    names = ["part", "lineitem", "orders", "events", "not_a_table"]
    missing = set(readers.missing_inputs(spark, [f"{d}/{n}.parquet" for n in names]))
    rows = [fx.table(spark, d, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), F.lit(True).alias("exists"), "n")
            if f"{d}/{n}.parquet" not in missing else
            spark.range(1).select(F.lit(n).alias("name"), F.lit(False).alias("exists"), F.lit(None).cast("long").alias("n")) for n in names]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("s8_sanitize_time", """
SELECT l_orderkey, l_linenumber, l_shipdate AS time FROM lineitem""")
def s8_sanitize_time(spark, d):
    li = fx.table(spark, d, "lineitem")
    nanos = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("l_shipdate")) * 1000
    raw = li.select("l_orderkey", "l_linenumber", nanos.alias("time"))
    return readers.sanitize_time(raw, "time")


def _s9_sql() -> str:
    def row(c, t, number, width):
        v = f"CAST(CAST({c} AS INT) AS DOUBLE)" if t == "boolean" else f"CAST({c} AS DOUBLE)"
        lo, hi = (f"MIN({v})", f"MAX({v})") if number else ("CAST(NULL AS DOUBLE)",) * 2
        first, last = ("CAST(NULL AS VARCHAR)",) * 2 if number else (f"CAST(MIN({c}) AS VARCHAR)", f"CAST(MAX({c}) AS VARCHAR)")
        size = f"COUNT(*) * {width}" if width else f"CAST(SUM(strlen({c})) AS BIGINT)"
        return (f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS n_valid, {lo} AS vmin, {hi} AS vmax, {first} AS first, {last} AS last, "
                f"CAST(NULL AS VARCHAR) AS units, COUNT(*) AS n_rows, {size} AS est_bytes FROM s9")
    return W("fx_static", "fx_icesat") + """
, s9 AS (SELECT a.iy, a.time, a.delta_h, s.mask = 3 AS floating, 'cell-' || a.ix AS label, s.mascon_id
         FROM fx_icesat a JOIN fx_static s ON a.iy = s.iy AND a.ix = s.ix)
""" + " UNION ALL ".join(row(*x) for x in [("iy", "int", True, 4), ("time", "date", False, 4), ("delta_h", "double", True, 8), ("floating", "boolean", True, 1),
                                           ("label", "string", False, 0), ("mascon_id", "int", True, 4)])


@query("s9_profile", _s9_sql())
def s9_profile(spark, d):
    """S9 over numbers, dates, booleans and strings."""
    s = fx.fx_static(spark, d).select("iy", "ix", (F.col("mask") == 3).alias("floating"), "mascon_id")
    t = fx.fx_icesat(spark, d).join(s, ["iy", "ix"]).select(
        "iy", "time", "delta_h", "floating", F.concat(F.lit("cell-"), F.col("ix")).alias("label"), "mascon_id")
    return readers.profile(t)

"""Domain tables derived from the driver's TPC-H-like tables.

Every fixture is computed by Spark from whole driver tables, so its size grows
with the scale factor. Each has a DataFrame builder (used by ``queries()``) and
an equivalent DuckDB CTE (used by ``oracle_sql()``); both produce the same rows.

Grid: 50 columns, ``ix = key % 50``, ``iy = key div 50``; time is a quarter start
(DATE). Source lat/lon spacing and target spacing scale with the number of grid
rows so that the geometry stays valid at every scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.functions.timefn import quarter_start
from floe.operators.joins import spread

NX = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec2(c):
    return F.col(c).cast("decimal(10,2)")


def _by_part(li: DataFrame, *more: str):
    """Line items by part and quarter (and ``more``); few share a group, so they are dealt to tasks before they are grouped."""
    used = li.select("l_partkey", quarter_start("l_shipdate").alias("time"), "l_linenumber", "l_quantity", "l_discount", "l_tax")
    used = used.withColumn("tile_order", (F.col("l_linenumber") % 4).cast("int"))
    return spread(used, "l_partkey", "time").groupBy("l_partkey", "time", *more)


def _grid_keys(key: str):
    k = F.col(key)
    return (k % NX).cast("int").alias("ix"), F.floor(k / F.lit(NX)).cast("int").alias("iy")


def fx_static(spark, sf_dir) -> DataFrame:
    """Topography and mascon map per cell (unique per (iy, ix))."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    ix = (k % NX).cast("int")
    iy = F.floor(k / F.lit(NX)).cast("int")
    blk = F.floor(F.floor(k / F.lit(NX)) / F.lit(4)).cast("int") * 5 + F.floor((k % NX) / F.lit(10)).cast("int")
    thickness = (F.col("p_size") * 40).cast("double")
    return p.select(
        ix.alias("ix"), iy.alias("iy"),
        (F.lit(-3071750) + F.lit(500) * (k % NX)).cast("double").alias("x"),
        (F.lit(3071750) - F.lit(500) * F.floor(k / F.lit(NX))).cast("double").alias("y"),
        F.col("p_retailprice").alias("surface"),
        thickness.alias("thickness"),
        (F.col("p_retailprice") - thickness).alias("bed"),
        F.when(F.col("p_size") % 5 == 4, F.lit(1)).otherwise(F.col("p_size") % 5).cast("int").alias("mask"),
        F.when(blk % 7 == 4, F.lit(None)).otherwise(blk).cast("int").alias("mascon_id"),
    )


def fx_icesat(spark, sf_dir) -> DataFrame:
    """Altimetry (odd line numbers), unique per (iy, ix, time)."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") % 2 == 1)
    return (_by_part(li)
            .agg(F.sum(_dec2("l_discount") - _dec2("l_tax")).cast("double").alias("delta_h"),
                 F.min("l_tax").alias("delta_h_sigma"),
                 (F.min("l_quantity") * F.lit(5000.0)).alias("ice_area"))
            .select(*_grid_keys("l_partkey"), "time", "delta_h", "delta_h_sigma", "ice_area"))


def fx_ocean(spark, sf_dir) -> DataFrame:
    """Ocean temperature/salinity (even line numbers), unique per (iy, ix, time)."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") % 2 == 0)
    return (_by_part(li)
            .agg((F.max("l_quantity") / F.lit(10.0) - F.lit(2.0)).alias("thetao"),
                 (F.lit(33.0) + F.max("l_discount") * F.lit(10.0)).alias("so"))
            .select(*_grid_keys("l_partkey"), "time", "thetao", "so"))


def fx_grace(spark, sf_dir) -> DataFrame:
    """Mascon anomalies per (mascon_id, time); a third of the cells without a value."""
    o = table(spark, sf_dir, "orders")
    m = (F.col("o_custkey") % 50).cast("int")
    known = (F.col("o_custkey") % 50 + F.quarter("o_orderdate")) % 3 != 0
    return (o.groupBy(m.alias("mascon_id"), quarter_start("o_orderdate").alias("time"))
            .agg((F.sum(F.when(known, F.col("o_totalprice").cast("decimal(14,2)"))).cast("double")
                  / F.lit(1000000.0)).alias("lwe_length")))


def fx_tiles(spark, sf_dir) -> DataFrame:
    """Four overlapping tiles with ties and missing sigma."""
    li = table(spark, sf_dir, "lineitem")
    return (_by_part(li, "tile_order")
            .agg(F.sum(_dec2("l_discount") - _dec2("l_tax")).cast("double").alias("delta_h"),
                 F.min("l_tax").alias("_s"))
            .select(*_grid_keys("l_partkey"), "time", "tile_order", "delta_h",
                    F.when(F.col("_s") == 0, F.lit(None)).otherwise(F.col("_s")).alias("delta_h_sigma")))


def fx_coarse(spark, sf_dir) -> DataFrame:
    """1 km nodes at (1000*cx, -1000*cy) with some null values."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select((k % NX).cast("int").alias("cx"), F.floor(k / F.lit(NX)).cast("int").alias("cy"),
                    F.when(F.col("p_size") % 11 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("v"))


def grid_rows(spark, sf_dir) -> int:
    """Number of grid rows of the part-derived grid (a scalar of grid metadata).

    One column's maximum, read anew each time: a memo by path would go stale when the table changes.
    """
    return int(table(spark, sf_dir, "part").agg(F.max(F.floor(F.col("p_partkey") / NX)) + 1).first()[0])


def fx_source_ll(spark, sf_dir, nrows: int | None = None) -> DataFrame:
    """Regular lat/lon source grid: 50 longitudes (7.2 deg), latitudes spread over -90..-50."""
    nrows = nrows or grid_rows(spark, sf_dir)
    dlat = 40.0 / nrows
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    si = F.floor(k / F.lit(NX)).cast("int")
    return p.select(k.cast("int").alias("src_id"), si.alias("si"), (k % NX).cast("int").alias("sj"),
                    (F.lit(-90.0 + dlat / 2) + si.cast("double") * F.lit(dlat)).alias("lat"),
                    F.expr("CAST(-176.4 + 7.2 * (p_partkey % 50) AS DOUBLE)").alias("lon"),
                    F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("v"))


def fx_target_xy(spark, sf_dir, nrows: int | None = None) -> DataFrame:
    """Projected targets covering the continent (pole included)."""
    nrows = nrows or grid_rows(spark, sf_dir)
    step = 6000000.0 / nrows
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(k.cast("int").alias("dst_id"),
                    (F.lit(-2940000) + F.lit(120000) * (k % NX)).cast("double").alias("tx"),
                    (F.lit(3000000.0) - F.lit(step) * F.floor(k / F.lit(NX)).cast("double")).alias("ty"))


# ---------------------------------------------------------------------------
# DuckDB CTEs (oracle side). ``QTR`` is expanded inline.

def _qtr(c: str) -> str:
    return f"make_date(year({c}), 3*quarter({c})-2, 1)"


_ROWS = "(SELECT CAST(max(p_partkey // 50) + 1 AS DOUBLE) FROM part)"

SQL = {
    "fx_static": f"""
SELECT CAST(p_partkey%50 AS INT) AS ix, CAST(floor(p_partkey/50.0) AS INT) AS iy,
       CAST(-3071750 + 500*(p_partkey%50) AS DOUBLE) AS x,
       CAST(3071750 - 500*floor(p_partkey/50.0) AS DOUBLE) AS y,
       p_retailprice AS surface, CAST(p_size*40 AS DOUBLE) AS thickness,
       p_retailprice - CAST(p_size*40 AS DOUBLE) AS bed,
       CAST(CASE WHEN p_size%5=4 THEN 1 ELSE p_size%5 END AS INT) AS mask,
       CAST(CASE WHEN (CAST(floor(floor(p_partkey/50.0)/4.0) AS INT)*5 + CAST(floor((p_partkey%50)/10.0) AS INT))%7=4
            THEN NULL ELSE CAST(floor(floor(p_partkey/50.0)/4.0) AS INT)*5 + CAST(floor((p_partkey%50)/10.0) AS INT) END AS INT) AS mascon_id
FROM part""",
    "fx_icesat": f"""
SELECT CAST(l_partkey%50 AS INT) AS ix, CAST(floor(l_partkey/50.0) AS INT) AS iy, {_qtr('l_shipdate')} AS time,
       CAST(SUM(CAST(l_discount AS DECIMAL(10,2)) - CAST(l_tax AS DECIMAL(10,2))) AS DOUBLE) AS delta_h,
       MIN(l_tax) AS delta_h_sigma, MIN(l_quantity)*CAST(5000 AS DOUBLE) AS ice_area
FROM lineitem WHERE l_linenumber%2=1 GROUP BY l_partkey, {_qtr('l_shipdate')}""",
    "fx_ocean": f"""
SELECT CAST(l_partkey%50 AS INT) AS ix, CAST(floor(l_partkey/50.0) AS INT) AS iy, {_qtr('l_shipdate')} AS time,
       MAX(l_quantity)/CAST(10 AS DOUBLE) - CAST(2 AS DOUBLE) AS thetao,
       CAST(33 AS DOUBLE) + MAX(l_discount)*CAST(10 AS DOUBLE) AS so
FROM lineitem WHERE l_linenumber%2=0 GROUP BY l_partkey, {_qtr('l_shipdate')}""",
    "fx_grace": f"""
SELECT CAST(o_custkey%50 AS INT) AS mascon_id, {_qtr('o_orderdate')} AS time,
       CAST(SUM(CASE WHEN (o_custkey%50 + quarter(o_orderdate))%3 <> 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) END) AS DOUBLE)/CAST(1000000 AS DOUBLE) AS lwe_length
FROM orders GROUP BY CAST(o_custkey%50 AS INT), {_qtr('o_orderdate')}""",
    "fx_tiles": f"""
SELECT CAST(l_partkey%50 AS INT) AS ix, CAST(floor(l_partkey/50.0) AS INT) AS iy, {_qtr('l_shipdate')} AS time,
       CAST(l_linenumber%4 AS INT) AS tile_order,
       CAST(SUM(CAST(l_discount AS DECIMAL(10,2)) - CAST(l_tax AS DECIMAL(10,2))) AS DOUBLE) AS delta_h,
       CASE WHEN MIN(l_tax)=0 THEN NULL ELSE MIN(l_tax) END AS delta_h_sigma
FROM lineitem GROUP BY l_partkey, {_qtr('l_shipdate')}, l_linenumber%4""",
    "fx_coarse": """
SELECT CAST(p_partkey%50 AS INT) AS cx, CAST(floor(p_partkey/50.0) AS INT) AS cy,
       CASE WHEN p_size%11=0 THEN NULL ELSE p_retailprice END AS v FROM part""",
    "fx_source_ll": f"""
SELECT CAST(p_partkey AS INT) AS src_id, CAST(floor(p_partkey/50.0) AS INT) AS si, CAST(p_partkey%50 AS INT) AS sj,
       (CAST(-90.0 AS DOUBLE) + (CAST(40.0 AS DOUBLE)/{_ROWS})/2) + CAST(CAST(floor(p_partkey/50.0) AS INT) AS DOUBLE) * (CAST(40.0 AS DOUBLE)/{_ROWS}) AS lat,
       CAST(-176.4 + 7.2*(p_partkey%50) AS DOUBLE) AS lon,
       CASE WHEN p_size%7=0 THEN NULL ELSE p_retailprice END AS v FROM part""",
    "fx_target_xy": f"""
SELECT CAST(p_partkey AS INT) AS dst_id, CAST(-2940000 + 120000*(p_partkey%50) AS DOUBLE) AS tx,
       CAST(3000000 AS DOUBLE) - (CAST(6000000 AS DOUBLE)/{_ROWS}) * CAST(floor(p_partkey/50.0) AS DOUBLE) AS ty FROM part""",
}


def ctes(*names: str) -> str:
    """``WITH`` clause defining the named fixtures for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"

"""Registered queries: long sparse table and its stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from floe.functions.grid import FIXTURE_GRID
from floe.operators import fuse
from floe.operators.joins import full_outer_join
from floe.plans import lsp
from floe.plans.registry import query
from floe.session import materialize
from floe.sources import fixtures as fx

# --- oracle building blocks (DuckDB) ---------------------------------------

_FX = fx.ctes("fx_static", "fx_icesat", "fx_ocean", "fx_grace")

_BB = """
bb AS (SELECT COALESCE(a.iy, o.iy) AS iy, COALESCE(a.ix, o.ix) AS ix, COALESCE(a.time, o.time) AS time,
              a.delta_h, a.delta_h_sigma, a.ice_area, o.thetao, o.so
       FROM fx_icesat a FULL OUTER JOIN fx_ocean o ON a.iy = o.iy AND a.ix = o.ix AND a.time = o.time)"""
_ST = """
st AS (SELECT bb.*, s.surface, s.thickness, s.bed, s.mask, s.mascon_id
       FROM bb LEFT JOIN fx_static s ON bb.iy = s.iy AND bb.ix = s.ix)"""
_GR = """
gr AS (SELECT st.*, g.lwe_length FROM st LEFT JOIN fx_grace g ON st.mascon_id = g.mascon_id AND st.time = g.time)"""
_FF = """
ff AS (SELECT iy, ix, time, surface, thickness, bed, mask, mascon_id, delta_h_sigma,
              LAST_VALUE(delta_h IGNORE NULLS) OVER w AS delta_h,
              LAST_VALUE(ice_area IGNORE NULLS) OVER w AS ice_area,
              LAST_VALUE(thetao IGNORE NULLS) OVER w AS thetao,
              LAST_VALUE(so IGNORE NULLS) OVER w AS so,
              LAST_VALUE(lwe_length IGNORE NULLS) OVER w AS lwe_length
       FROM gr WINDOW w AS (PARTITION BY iy, ix ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_TOT = """
tot AS (SELECT mascon_id, time, COUNT(delta_h) AS n_pix,
               CAST(SUM(CAST(ROUND(delta_h*100) AS DECIMAL(38,0))) AS DOUBLE)/100 AS sum_dh
        FROM ff WHERE mascon_id IS NOT NULL GROUP BY mascon_id, time)"""
_FUSED = """
fused AS (SELECT ff.*, CAST(-3071750 + 500*ff.ix AS DOUBLE) AS x, CAST(3071750 - 500*ff.iy AS DOUBLE) AS y,
                 CASE WHEN ff.mascon_id IS NOT NULL AND ff.delta_h IS NOT NULL AND ff.lwe_length IS NOT NULL
                      THEN (CASE WHEN abs(tot.sum_dh / tot.n_pix) > 0.0001
                                 THEN ff.delta_h / tot.sum_dh * tot.n_pix * ff.lwe_length
                                 ELSE ff.lwe_length END) + CAST(0 AS DOUBLE) END AS lwe_fused
          FROM ff LEFT JOIN tot ON ff.mascon_id = tot.mascon_id AND ff.time = tot.time)"""


def _with(*parts: str) -> str:
    return _FX + "," + ",".join(parts) + "\n"


def _inputs(spark, d):
    return (fx.fx_icesat(spark, d), fx.fx_ocean(spark, d), fx.fx_static(spark, d), fx.fx_grace(spark, d))


# --- queries ---------------------------------------------------------------

@query("b5_long_sparse", _with(_BB, _ST, _GR, _FF, _TOT, _FUSED) + "SELECT * FROM fused")
def b5_long_sparse(spark, d):
    alt, oce, sta, gra = _inputs(spark, d)
    return lsp.build_long_sparse(alt, oce, sta, gra, FIXTURE_GRID, sum_scale=2)


@query("j1_backbone", _with(_BB) + "SELECT * FROM bb")
def j1_backbone(spark, d):
    alt, oce, _, _ = _inputs(spark, d)
    return lsp.build_backbone(alt, oce)


@query("j1_full_outer_join", _with(_BB) + "SELECT * FROM bb")
def j1_full_outer_join(spark, d):
    """J1 in its literal full-outer-join form (kept for comparison with the union form)."""
    alt, oce, _, _ = _inputs(spark, d)
    return full_outer_join(alt, oce, ["iy", "ix", "time"])


@query("j2_static_left_join", _with(_BB, _ST) + "SELECT * FROM st")
def j2_static_left_join(spark, d):
    alt, oce, sta, _ = _inputs(spark, d)
    return fuse.enrich_static(lsp.build_backbone(alt, oce), sta.drop("x", "y"))


@query("j3_anomaly_left_join", _with(_BB, _ST, _GR) + "SELECT * FROM gr")
def j3_anomaly_left_join(spark, d):
    return lsp.build_enriched(*_inputs(spark, d))


@query("w1_forward_fill", _with(_BB, _ST, _GR, _FF) + "SELECT * FROM ff")
def w1_forward_fill(spark, d):
    return lsp.build_filled(*_inputs(spark, d))


@query("w2_mascon_totals", _with(_BB, _ST, _GR, _FF, _TOT) + "SELECT * FROM tot")
def w2_mascon_totals(spark, d):
    filled = lsp.build_filled(*_inputs(spark, d))
    return (fuse.mascon_totals(filled, sum_scale=2)
            .select("mascon_id", "time", F.col("_n_pix").alias("n_pix"), F.col("_sum_dh").alias("sum_dh")))


@query("a17_mascon_totals", _with(_BB, _ST, _GR, _FF, _TOT) + "SELECT * FROM tot")
def a17_mascon_totals(spark, d):
    """N and sum(dh) per (mascon, time) - the grouped form of W2."""
    return w2_mascon_totals(spark, d)


@query("w3_signal_fusion", _with(_BB, _ST, _GR, _FF, _TOT, _FUSED)
       + "SELECT iy, ix, time, mascon_id, delta_h, lwe_length, lwe_fused FROM fused")
def w3_signal_fusion(spark, d):
    return b5_long_sparse(spark, d).select("iy", "ix", "time", "mascon_id", "delta_h", "lwe_length", "lwe_fused")


_A18 = """
SELECT mascon_id, time, COUNT(*) AS n_rows, COUNT(lwe_fused) AS n_fused,
       CAST(SUM(CAST(round_even(lwe_fused*1000000, 0) AS DECIMAL(38,0))) AS DOUBLE)/1000000 AS sum_fused,
       CAST(SUM(CAST(ROUND(delta_h*100) AS DECIMAL(38,0))) AS DOUBLE)/100 AS sum_dh,
       MIN(lwe_length) AS min_lwe, MAX(lwe_length) AS max_lwe,
       MIN(lwe_length) = MAX(lwe_length) AS uniform_anomaly
FROM fused WHERE mascon_id IS NOT NULL AND lwe_fused IS NOT NULL GROUP BY mascon_id, time"""


@query("a18_conservation", _with(_BB, _ST, _GR, _FF, _TOT, _FUSED) + _A18)
def a18_conservation(spark, d):
    """Per (mascon, time) totals of the fused signal against the anomaly.

    When the anomaly is the same on all pixels of a group (``uniform_anomaly``),
    sum(lwe_fused) equals N * lwe_length; groups with mixed (filled) anomalies
    are reported as such (finding D4).
    """
    fused = materialize(b5_long_sparse(spark, d), "fused")
    r6 = F.lit(1000000.0)
    return (fused.where(F.col("mascon_id").isNotNull() & F.col("lwe_fused").isNotNull())
            .groupBy("mascon_id", "time")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("lwe_fused").alias("n_fused"),
                 (F.sum(F.rint(F.col("lwe_fused") * r6).cast("decimal(38,0)")).cast("double") / r6).alias("sum_fused"),
                 fuse.exact_sum("delta_h", 2).alias("sum_dh"),
                 F.min("lwe_length").alias("min_lwe"), F.max("lwe_length").alias("max_lwe"))
            .withColumn("uniform_anomaly", F.col("min_lwe") == F.col("max_lwe")))

"""Backbone, forward fill, fusion and the size-checked join (hand-computed micro tables)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from floe import constants as C
from floe.operators import fuse, joins

D = [dt.date(2000, 1, 1), dt.date(2000, 4, 1), dt.date(2000, 7, 1), dt.date(2000, 10, 1)]


def test_backbone_union_equals_full_outer(spark):
    a = spark.createDataFrame([(0, 0, D[0], 1.0), (0, 0, D[1], 2.0), (1, 0, D[0], 3.0)],
                              "iy int, ix int, time date, delta_h double")
    o = spark.createDataFrame([(0, 0, D[1], 9.0), (2, 2, D[2], 8.0)], "iy int, ix int, time date, thetao double")
    u = sorted(fuse.backbone(a, o).select("iy", "ix", "time", "delta_h", "thetao").collect())
    j = sorted(joins.full_outer_join(a, o, ["iy", "ix", "time"]).select("iy", "ix", "time", "delta_h", "thetao").collect())
    assert u == j
    assert len(u) == 4


def test_forward_fill_stays_in_pixel_and_never_backfills(spark):
    rows = [(0, 0, D[0], None), (0, 0, D[1], 1.0), (0, 0, D[2], None), (0, 0, D[3], None),
            (0, 1, D[0], 5.0), (0, 1, D[1], None)]
    df = spark.createDataFrame(rows, "iy int, ix int, time date, delta_h double")
    out = {(r.ix, r.time): r.delta_h for r in fuse.forward_fill(df, ["delta_h"]).collect()}
    assert out[(0, D[0])] is None          # no backward fill
    assert out[(0, D[2])] == 1.0 and out[(0, D[3])] == 1.0
    assert out[(1, D[1])] == 5.0           # pixel 1 keeps its own value, never pixel 0's


def _fuse_rows(spark, rows):
    df = spark.createDataFrame(rows, "iy int, ix int, time date, mascon_id int, delta_h double, lwe_length double")
    return {(r.iy, r.ix): r.lwe_fused for r in fuse.fuse_signal(df, cut_lineage=False).collect()}


def test_fusion_pattern_uniform_and_null(spark):
    t = D[0]
    out = _fuse_rows(spark, [
        (0, 0, t, 1, 1.0, 10.0), (0, 1, t, 1, 3.0, 10.0),            # pattern: S=4, N=2
        (1, 0, t, 2, 0.00001, 7.0), (1, 1, t, 2, -0.00001, 7.0),     # |S/N| below floor: uniform
        (2, 0, t, None, 1.0, 5.0), (2, 1, t, 3, None, 5.0), (2, 2, t, 3, 2.0, None)])
    assert out[(0, 0)] == 1.0 / 4.0 * 2 * 10.0 and out[(0, 1)] == 3.0 / 4.0 * 2 * 10.0
    assert out[(1, 0)] == 7.0 and out[(1, 1)] == 7.0
    assert out[(2, 0)] is None and out[(2, 1)] is None and out[(2, 2)] is None


def test_fusion_conserves_uniform_anomaly(spark):
    t = D[0]
    vals = [0.3, -0.1, 0.7, 0.25, 1.5]
    out = _fuse_rows(spark, [(0, i, t, 1, v, 12.5) for i, v in enumerate(vals)])
    assert abs(sum(out.values()) - len(vals) * 12.5) < 1e-9


def test_sized_join_salted_path_equals_broadcast(spark):
    big = spark.createDataFrame([(i, i % 3 if i % 5 else None, float(i)) for i in range(200)],
                                "iy int, mascon_id int, v double").withColumn("ix", F.lit(0))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "mascon_id int, name string")
    b = sorted(joins.sized_join(big, small, ["mascon_id"], "left").select("iy", "name").collect())
    s = sorted(joins.sized_join(big, small, ["mascon_id"], "left", max_bytes=0, salt_by=["iy", "ix"],
                                salt_buckets=7).select("iy", "name").collect())
    assert b == s and len(b) == 200


def test_fusion_under_a_hot_mascon(spark):
    """One mascon holds over a third of all rows: grouped totals, forced salted join and the
    literal window form give the same fused values."""
    from floe.plans import lsp
    from floe.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    d = SF_SMALL
    static = fx.fx_static(spark, d).withColumn(
        "mascon_id", F.when(F.col("iy") % 3 == 0, F.lit(7)).otherwise(F.col("mascon_id") % 3))
    grace = fx.fx_grace(spark, d).where(F.col("mascon_id") < 8)
    filled = lsp.build_filled(fx.fx_icesat(spark, d), fx.fx_ocean(spark, d), static, grace)
    n = filled.count()
    hot = filled.where(F.col("mascon_id") == 7).count()
    assert hot * 3 > n

    def fused(df):
        return {(r.iy, r.ix, r.time): r.lwe_fused for r in df.select("iy", "ix", "time", "lwe_fused").collect()}

    a = fused(fuse.fuse_signal(filled, sum_scale=2))
    # the formula over a window: pixel / region mean x signal, evenly where the mean says nothing
    mean = F.avg("delta_h").over(Window.partitionBy("mascon_id", "time"))
    even = F.abs(mean) <= C.FUSION_MIN_MEAN_DH_M
    value = F.when(even, F.col("lwe_length")).otherwise(F.col("delta_h") / mean * F.col("lwe_length"))
    b = fused(filled.withColumn("lwe_fused", F.when(F.col("mascon_id").isNotNull() & F.col("delta_h").isNotNull(), value)))
    totals = fuse.mascon_totals(filled, sum_scale=2)
    c = fused(joins.sized_join(filled, totals, ["mascon_id", "time"], "left", max_bytes=0, salt_by=["iy", "ix"])
              .withColumn("lwe_fused", fuse.fused_value()))
    assert a.keys() == b.keys() == c.keys()
    for k in a:
        assert a[k] == c[k]
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) <= 1e-9 * max(1.0, abs(a[k]))


def test_single_shuffle_fill_equals_join_form(spark):
    """The static-rows-in-the-shuffle fill equals the literal join form on the fixture."""
    from floe.plans import lsp
    from floe.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    d = SF_SMALL
    args = (fx.fx_icesat(spark, d), fx.fx_ocean(spark, d), fx.fx_static(spark, d), fx.fx_grace(spark, d))
    a, b = lsp.build_filled(*args), lsp.build_filled_joins(*args)
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)

    def rows(df):
        return sorted((tuple(r) for r in df.select(*cols).collect()),
                      key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(a) == rows(b)


def test_filled_table_salted_anomaly_join_equals_broadcast(spark):
    """The anomaly table over the broadcast budget takes the salted shuffle join; same rows."""
    from floe.plans import lsp
    from floe.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    d = SF_SMALL
    args = (fx.fx_icesat(spark, d), fx.fx_ocean(spark, d), fx.fx_static(spark, d), fx.fx_grace(spark, d))
    a, b = lsp.build_filled(*args), lsp.build_filled(*args, max_bytes=0)
    cols = sorted(a.columns)

    def rows(df):
        return sorted((tuple(r) for r in df.select(*cols).collect()),
                      key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(a) == rows(b)

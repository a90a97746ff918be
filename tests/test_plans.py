"""Physical-plan properties the design relies on (checked on the executed plans)."""

import re

import __spark_entry__ as E
from floe.plans import lsp
from floe.sources import fixtures as fx
from tests.conftest import SF_SMALL

Q = E.queries()


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _initial(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fill_reuses_backbone_partitioning(spark):
    d = SF_SMALL
    f = lsp.build_filled(fx.fx_icesat(spark, d), fx.fx_ocean(spark, d), fx.fx_static(spark, d), fx.fx_grace(spark, d))
    plan = _plan(f)
    # exactly one exchange keyed by the pixel (the backbone); the window adds none
    pixel_exchanges = re.findall(r"Exchange hashpartitioning\(iy#\d+, ix#\d+, \d+\)", plan)
    assert len(pixel_exchanges) == 1, plan
    assert "Window" in plan


def test_filled_table_one_shuffle_one_sort_without_broadcast(spark):
    """Even when the static table is too large to broadcast, the filled table needs one pixel
    shuffle and one sort: static rows ride in the same shuffle (no sort-merge join)."""
    d = SF_SMALL
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = lsp.build_filled(fx.fx_icesat(spark, d), fx.fx_ocean(spark, d), fx.fx_static(spark, d),
                             fx.fx_grace(spark, d))
        plan = _initial(f)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(iy#\d+, ix#\d+, \d+\)", plan)) == 1
    assert len(re.findall(r"\bSort \[iy#", plan)) == 1
    assert len(re.findall(r"\bWindow \[", plan)) == 2


def test_no_window_over_mascons(spark):
    plan = _plan(Q["b5_long_sparse"](spark, SF_SMALL))
    assert not re.search(r"windowspecdefinition\(mascon_id", plan)
    assert "BroadcastHashJoin" in plan            # totals joined back after the size check


def test_totals_pass_reads_three_columns(spark):
    plan = _plan(Q["w2_mascon_totals"](spark, SF_SMALL))
    assert "HashAggregate" in plan and "partial_count" in plan   # map-side partial aggregation


def test_slope_one_exchange_for_both_axes(spark):
    """Halo tiles: one shuffle by tile; both axis windows reuse it (sorts only)."""
    plan = _initial(Q["w6_slope"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(_ty#", plan)) == 1
    assert not re.findall(r"Exchange hashpartitioning\((ix|iy)#", plan)
    assert len(re.findall(r"\bWindow \[", plan)) == 2


def test_projection_and_filter_reach_the_scan(spark):
    df = Q["s1_parquet_scan"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,10)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>" in plan


def test_step_folders_are_pruned(spark):
    df = Q["s2_step_directory"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time" in plan


def test_union_backbone_pushes_key_filters_into_both_scans(spark):
    from pyspark.sql import functions as F
    d = SF_SMALL
    bb = lsp.build_backbone(spark.read.parquet(_store(spark, fx.fx_icesat(spark, d))),
                            spark.read.parquet(_store(spark, fx.fx_ocean(spark, d))))
    plan = bb.where(F.col("iy") == 1)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PushedFilters: \[IsNotNull\(iy\), EqualTo\(iy,1\)\]", plan)) == 2, plan


def _store(spark, df):
    from floe.session import scratch_path
    p = scratch_path(spark, "plan")
    df.write.parquet(p)
    return p

"""Groupings whose tasks grow with the stored input, so that the memory of a task doesn't."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from floe.operators import joins, mosaic, regrid
from floe.plans import lsp
from floe.session import scratch_path
from floe.sources import fixtures as fx
from floe.streaming import incremental

SF = "/root/testdata/sf0.001"


def _dealt(df) -> list[int]:
    """Numbers of the shuffles that name their number themselves."""
    return [int(n) for n in re.findall(r"hashpartitioning\([^\n]*?, (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())]


@pytest.mark.parametrize("build", [
    lambda s: fx.fx_icesat(s, SF), lambda s: mosaic.mosaic(fx.fx_tiles(s, SF), "delta_h_sigma"),
    lambda s: regrid.upsample2x(fx.fx_coarse(s, SF)), lambda s: lsp.build_backbone(fx.fx_icesat(s, SF), fx.fx_ocean(s, SF))])
def test_tasks_grow_with_the_input_and_rows_stay(spark, monkeypatch, build):
    few = build(spark)
    assert not _dealt(few)
    want = sorted(map(tuple, few.collect()), key=str)
    monkeypatch.setattr(joins, "TASK_INPUT_BYTES", 400)
    many = build(spark)
    once = _dealt(many)
    assert once and min(once) > spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, many.collect()), key=str) == want
    monkeypatch.setattr(joins, "TASK_INPUT_BYTES", 100)
    assert all(3 * a < b for a, b in zip(once, _dealt(build(spark))))


def test_stored_bytes_are_those_of_the_files(spark):
    p = scratch_path(spark, "a folder")
    spark.range(1000).repartition(3).write.parquet(p)
    assert joins._stored_bytes(spark.read.parquet(p)) > 1000 and joins._stored_bytes(spark.range(10)) == 0
    assert joins._stored_bytes(fx.table(spark, SF, "part")) == 7241


def test_a_batch_is_dealt_by_its_rows(spark, monkeypatch):
    rows = spark.range(400).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"), F.col("id").alias(incremental.VERSION))
    monkeypatch.setattr(incremental, "BATCH_TASK_ROWS", 10)
    tasks = incremental.batch_tasks(rows)
    got = incremental.newest(rows, ["k"], tasks)
    assert tasks == 40 and _dealt(got) == [40]
    assert sorted((r.k, r.v) for r in got.collect()) == [(k, 300 + k) for k in range(100)]

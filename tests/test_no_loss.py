"""Operators that must not lose, merge or move rows: alignment, weights, nearest neighbour, the long table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floe.functions.grid import FIXTURE_GRID
from floe.operators import joins, regrid
from floe.plans import lsp

D1, D2 = dt.date(2000, 1, 1), dt.date(2000, 4, 1)


def test_align_refuses_a_column_of_two_inputs(spark):
    a = spark.createDataFrame([(1, 3)], "k int, mascon_id int")
    with pytest.raises(ValueError, match="mascon_id"):
        joins.outer_align([a, a.withColumn("v", F.lit(1))], ["k"])


def test_align_refuses_a_key_that_is_there_twice(spark):
    a = spark.createDataFrame([(1, 1), (1, 5), (2, 2)], "k int, a int")
    b = spark.createDataFrame([(1, 7), (3, 8)], "k int, b int")
    with pytest.raises(Exception, match="holds a key twice"):
        joins.outer_align([a, b], ["k"]).collect()
    # the join form keeps both
    assert sorted(joins.full_outer_join(a, b, ["k"]).collect(), key=str) == sorted([(1, 1, 7), (1, 5, 7), (2, 2, None), (3, None, 8)], key=str)


def test_align_null_keys_match_nothing(spark):
    a = spark.createDataFrame([(1, None, 1), (None, None, 2), (1, 1, 3)], "k int, l int, a int")
    b = spark.createDataFrame([(1, None, 7), (1, 1, 8)], "k int, l int, b int")
    want = [(1, None, 1, None), (None, None, 2, None), (1, None, None, 7), (1, 1, 3, 8)]
    assert sorted(map(tuple, joins.outer_align([a, b], ["k", "l"]).collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, joins.full_outer_join(a, b, ["k", "l"]).collect()), key=str) == sorted(want, key=str)


def test_weights_give_a_row_for_every_destination_and_step(spark):
    src = spark.createDataFrame([(1, D1, 2.0), (2, D1, 4.0), (1, D2, None), (2, D2, 6.0)], "src_id int, time date, v double")
    w = spark.createDataFrame([(10, 1, 0.5), (10, 2, 0.5), (11, 2, 1.0), (12, 99, 1.0), (13, 1, 0.5), (13, 99, 0.5)], "dst_id int, src_id int, w double")
    got = {(r.dst_id, r.time): r.v for r in regrid.apply_weights(src, w, by=("time",)).collect()}
    assert got == {(10, D1): 3.0, (10, D2): None, (11, D1): 4.0, (11, D2): 6.0, (12, D1): None, (12, D2): None, (13, D1): None, (13, D2): None}
    one = {r.dst_id: r.v for r in regrid.apply_weights(src.where(F.col("time") == D1).drop("time"), w).collect()}
    assert one == {10: 3.0, 11: 4.0, 12: None, 13: None}


@pytest.mark.parametrize("only", [(8, 0), (8, 3), (0, 1), (4, 2)])
def test_nearest_finds_the_only_source_from_everywhere(spark, only):
    """A 9 x 4 grid with one source: every target must reach it."""
    src = spark.createDataFrame([(7, *only, -88.0 + 4 * only[0], -135.0 + 90 * only[1], 1.5)], "src_id int, si int, sj int, lat double, lon double, v double")
    targets = spark.createDataFrame([(i, -88.0 + 4 * (i // 4), -135.0 + 90 * (i % 4)) for i in range(36)], "dst_id int, lat double, lon double")
    got = regrid.nearest_regular(src, targets, -88.0, 4.0, -135.0, 90.0, 9, 4).collect()
    assert sorted((r.dst_id, r.src_id, r.v) for r in got) == [(i, 7, 1.5) for i in range(36)]
    none = regrid.nearest_regular(src.limit(0), targets, -88.0, 4.0, -135.0, 90.0, 9, 4).collect()
    assert sorted((r.dst_id, r.src_id) for r in none) == [(i, None) for i in range(36)]


def test_long_table_keeps_columns_and_rows_without_a_time(spark):
    alt = spark.createDataFrame([(0, 0, D1, 1.0, 0.1), (0, 0, None, 9.0, 0.2), (1, 0, None, 3.0, None)], "iy int, ix int, time date, delta_h double, delta_h_sigma double")
    oce = spark.createDataFrame([(0, 0, D2, -1.0, 34.0, "x")], "iy int, ix int, time date, thetao double, so double, note string")
    sta = spark.createDataFrame([(0, 0, 5, 100.0), (1, 0, 6, 200.0), (9, 9, 6, 1.0)], "iy int, ix int, mascon_id int, bed double")
    ano = spark.createDataFrame([(5, D1, 0.5), (5, D2, 0.7)], "mascon_id int, time date, lwe_length double")
    got = {(r.iy, r.ix, r.time): r for r in lsp.build_long_sparse(alt, oce, sta, ano, FIXTURE_GRID).collect()}
    assert set(got) == {(0, 0, D1), (0, 0, None), (1, 0, None), (0, 0, D2)}
    assert got[0, 0, D1].delta_h_sigma == 0.1 and got[0, 0, D2].note == "x" and got[0, 0, D2].delta_h_sigma is None
    assert got[0, 0, D2].delta_h == 1.0 and got[1, 0, None].bed == 200.0 and got[0, 0, None].delta_h == 9.0


def test_only_small_rows_of_hot_keys_are_copied(spark):
    """A key with a third of all rows is salted; the other 600 small rows are sent once. Rows equal the plain join's."""
    big = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 500 == 1, F.lit(None)).otherwise(F.col("id") % 600).cast("int").alias("k"), F.col("id").alias("row"))
    small = spark.range(600).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    keyed = big.where("k IS NOT NULL")
    assert joins.hot_keys(keyed, ["k"], 8) == [(7,)] and joins.hot_keys(small, ["k"], 8) == []
    a, b = joins.salted_sides(keyed, small, ["k"], F.pmod(F.xxhash64("row"), F.lit(8)), 8)
    assert b.count() == 599 + 8 and a.count() == keyed.count()
    assert a.where("k = 7").select("_salt").distinct().count() == 8 and a.where("k <> 7 AND _salt <> 0").count() == 0
    for how in ("left", "inner"):
        got = joins.sized_join(big, small, ["k"], how, max_bytes=0, salt_by=["row"], salt_buckets=8)
        want = big.join(small, ["k"], how)
        assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    even = joins.sized_join(small, small.withColumnRenamed("v", "w"), ["k"], "left", max_bytes=0)
    assert even.count() == 600 and even.where("v <> w").count() == 0


def test_broadcasts_are_measured_in_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("s"))
    assert joins.measured_bytes(wide) >= 1_000_000 and not joins.fits_broadcast(wide, 900_000)
    assert joins.measured_bytes(spark.range(100).select(F.sequence(F.lit(1), F.lit(1000)).alias("a"))) >= 400_000
    assert joins.measured_bytes(wide.limit(0)) == 0

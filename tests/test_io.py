"""Sources, sinks and streaming: NaN handling, chunk decoding, time sanitising, idempotence."""

import datetime as dt
import glob
import math
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.session import scratch_path
from floe.sinks import writers
from floe.sources import readers
from floe.streaming import incremental


def test_nanos_are_converted_exactly(spark):
    cases = {1546344000123456000: dt.datetime(2019, 1, 1, 12, 0, 0, 123456),
             1546344000123456999: dt.datetime(2019, 1, 1, 12, 0, 0, 123456),
             1546344000000000001: dt.datetime(2019, 1, 1, 12, 0, 0, 0),
             -1500: dt.datetime(1969, 12, 31, 23, 59, 59, 999998)}
    df = spark.createDataFrame([(k,) for k in cases], "time long")
    got = {r.k: r.time for r in readers.sanitize_time(df.withColumn("k", F.col("time"))).collect()}
    assert got == cases


def test_read_table_turns_nan_into_null(spark):
    p = scratch_path(spark, "nan")
    spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "k int, v double").write.parquet(p)
    got = {r.k: r.v for r in readers.read_table(spark, p).collect()}
    assert got == {1: None, 2: 1.5, 3: None}
    q = scratch_path(spark, "nanf")
    spark.createDataFrame([(1, float("nan"))], "k int, v float").write.parquet(q)
    back = readers.read_table(spark, q)
    assert dict(back.dtypes)["v"] == "float" and back.first().v is None


def test_cube_to_long_positions_and_nan(spark):
    chunks = spark.createDataFrame([(10, 20, 2, 3, [0.0, 1.0, float("nan"), 3.0, 4.0, 5.0])],
                                   "y0 int, x0 int, ny int, nx int, values array<double>")
    got = {(r.iy, r.ix): r.v for r in readers.cube_to_long(chunks).collect()}
    assert got[(10, 20)] == 0.0 and got[(10, 22)] is None and got[(11, 20)] == 3.0 and got[(11, 22)] == 5.0
    assert len(got) == 6


def test_sanitize_time_nanos_and_zoned(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        nanos = 1546344000123456789  # 2019-01-01 12:00:00.123456789 UTC
        df = spark.createDataFrame([(nanos,)], "time long")
        r = readers.sanitize_time(df).first()
        assert r.time == dt.datetime(2019, 1, 1, 12, 0, 0, 123456)
        z = spark.sql("SELECT timestamp'2019-07-01 12:00:00 UTC' AS time")
        assert readers.sanitize_time(z).first().time == dt.datetime(2019, 7, 1, 12, 0)
        assert dict(readers.sanitize_time(z).dtypes)["time"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_validate_inputs_lists_every_missing_path(spark):
    p = scratch_path(spark, "exists")
    spark.range(3).write.parquet(p)
    with pytest.raises(FileNotFoundError) as e:
        readers.validate_inputs(spark, [p, p + "-a", p + "-b"])
    assert "2 required source(s)" in str(e.value) and p + "-a" in str(e.value) and p + "-b" in str(e.value)


def test_write_if_absent_keeps_first_version(spark):
    p = scratch_path(spark, "ignore")
    writers.write_if_absent(spark.range(3), p)
    assert not writers.write_if_absent(spark.range(10), p)
    assert spark.read.parquet(p).count() == 3


def test_what_a_failed_write_left_is_written_over(spark):
    p = scratch_path(spark, "failed")
    spark.range(3).write.parquet(p)
    (Path(p.removeprefix("file:")) / "_SUCCESS").unlink()
    assert writers.write_if_absent(lambda: spark.range(10), p, spark=spark)
    assert spark.read.parquet(p).count() == 10
    assert not writers.write_if_absent(lambda: 1 / 0, p, spark=spark)  # not even planned


def test_one_step_spreads_over_files(spark):
    """A single step, and a single (step, tile), is written by more than one task."""
    df = spark.range(40_000).selectExpr("CAST(id DIV 200 AS INT) iy", "CAST(id % 200 AS INT) ix", "DATE'2000-01-01' AS time", "id AS v").repartition(8)
    for name, write in (("k2", lambda p: writers.write_steps(df, p)), ("k4", lambda p: writers.overwrite_regions(df, p)),
                        ("k11", lambda p: writers.write_layout(df, p, partitions=4))):
        p = scratch_path(spark, name)
        old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            write(p)
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        back = spark.read.parquet(p)
        assert len(back.inputFiles()) >= 4 and back.count() == 40_000


_STEP = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.IntegerType()), T.StructField("time", T.DateType())])
D1, D2 = dt.date(2000, 1, 1), dt.date(2000, 4, 1)


def _stored(spark, target):
    return sorted((r.k, r.v, r.time) for r in spark.read.schema(_STEP).parquet(target).collect())


def test_stream_reruns_and_corrections(spark):
    inbox, target, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ck"))
    load = lambda: incremental.load_new_steps(spark, inbox, _STEP, target, ckpt, keys=("k",))
    spark.createDataFrame([(1, 1, D1), (2, 1, D1)], _STEP).write.parquet(f"{inbox}/a")
    assert load() == 1
    assert load() == 0   # nothing new
    time.sleep(1.1)      # files are ordered by modification time
    spark.createDataFrame([(3, 1, D2)], _STEP).write.parquet(f"{inbox}/b")
    spark.createDataFrame([(1, 9, D1)], _STEP).write.parquet(f"{inbox}/c")          # corrects one row of step D1
    load()
    want = [(1, 9, D1), (2, 1, D1), (3, 1, D2)]
    assert _stored(spark, target) == want
    # the same files again, from a lost checkpoint: nothing changes
    incremental.load_new_steps(spark, inbox, _STEP, target, scratch_path(spark, "ck2"), keys=("k",), max_files_per_trigger=1)
    assert _stored(spark, target) == want


@pytest.mark.parametrize("split", ["batches", "folders", "runs"])
def test_a_split_step_ends_complete(spark, split):
    inbox, target, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ck"))
    load = lambda: incremental.load_new_steps(spark, inbox, _STEP, target, ckpt, keys=("k",),
                                              max_files_per_trigger=1 if split == "batches" else None)
    for i in range(3):
        where = f"{inbox}/A{i}" if split == "folders" else inbox
        spark.createDataFrame([(i, i, D1)], _STEP).coalesce(1).write.mode("append").parquet(where)
        if split == "runs":
            load()
    load()
    assert _stored(spark, target) == [(i, i, D1) for i in range(3)]


def test_metadata_survives_parquet(spark):
    p = scratch_path(spark, "meta")
    df = writers.with_metadata(spark.range(2).withColumn("v", F.lit(1.0)), {"v": {"units": "m"}})
    df.write.parquet(p)
    assert spark.read.parquet(p).schema["v"].metadata["units"] == "m"


def test_narrow_floats(spark):
    df = writers.narrow_floats(spark.createDataFrame([(1, math.pi)], "k int, v double"))
    assert dict(df.dtypes) == {"k": "int", "v": "float"}


def test_file_sink_stream_appends_exactly_once(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("time", T.DateType())])
    inbox, target, ckpt = (scratch_path(spark, n) for n in ("fin", "fout", "fck"))
    d1 = dt.date(2000, 1, 1)
    spark.createDataFrame([(1, d1), (2, d1)], schema).write.parquet(f"{inbox}/a")
    incremental.append_new_steps(spark, inbox, schema, target, ckpt)
    incremental.append_new_steps(spark, inbox, schema, target, ckpt)   # re-run: nothing new
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2]


def test_regions_sharing_a_folder_are_replaced_one_by_one(spark):
    """K4 with several regions in a folder: the regions of the new rows are replaced, null keys too, all others stay; replays agree."""
    schema = "step string, day date, g int, tile int, v double"
    days = [None, dt.date(2020, 1, 1), dt.date(2021, 1, 1)]
    rows = [(t, d, g, i, 1.0 + n) for t in ("a", "b", None) for d in days
            for n, (g, i) in enumerate(((0, 0), (0, 0), (0, 1), (0, None), (1, 16), (None, None), (None, 5)))]
    df = spark.createDataFrame(rows, schema)
    news = [("a", days[1], 0, 0, 70.0), (None, None, None, None, 80.0), ("", days[2], 0, 1, 90.0), ("b", days[2], 0, None, 95.0), ("c", days[1], 7, 99, 99.0)]
    new = spark.createDataFrame(news, schema)
    p, keys, folders = scratch_path(spark, "k4-shared"), ["step", "day", "tile"], ["step", "day", "g"]
    writers.overwrite_regions(df, p, keys, folders)

    def region(r):
        return (r[0] or None, *r[1:4])
    want = [r for r in rows if region(r) not in {region(n) for n in news}] + [(n[0] or None, *n[1:]) for n in news]
    assert len(rows) + len(news) - len(want) == 5  # two rows of one region, one of each of three
    for _ in range(2):
        writers.overwrite_regions(new, p, keys, folders)
        got = [tuple(r) for r in spark.read.schema(schema).parquet(p).select("step", "day", "g", "tile", "v").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    writers.overwrite_regions(new.where("v < 0"), p, keys, folders)  # no region: nothing changes
    assert spark.read.schema(schema).parquet(p).count() == len(want)


def test_folders_of_untouched_steps_are_not_written_again(spark):
    p, keys, folders = scratch_path(spark, "k4-kept"), ["step", "tile"], ["step", "g"]
    df = spark.range(40).selectExpr("cast(id % 4 AS int) AS step", "cast(id AS int) AS tile", "cast(id div 20 AS int) AS g", "cast(id AS double) AS v")
    writers.overwrite_regions(df, p, keys, folders)

    def files():
        return {f for f in glob.glob(f"{p.removeprefix('file:')}/step=*/g=*/*.parquet")}
    before = files()
    writers.overwrite_regions(df.where("tile = 5").withColumn("v", F.lit(-1.0)), p, keys, folders)
    assert all("/step=1/g=0/" in f for f in before ^ files()) and before ^ files()
    assert sorted(r.v for r in spark.read.parquet(p).collect()) == sorted(-1.0 if i == 5 else float(i) for i in range(40))


def test_region_folders_grow_with_squares_of_tiles(spark):
    """K4's query: a folder for 64 x 64 tiles of a step, not for each tile."""
    import __spark_entry__ as E
    from floe.session import _scratch_root
    top = f"{_scratch_root(spark).removeprefix('file:')}/k4-*"
    before = set(glob.glob(top))
    E.queries()["k4_region_overwrite"](spark, "/root/testdata/sf0.01")
    made = [d for d in set(glob.glob(top)) - before if glob.glob(f"{d}/time=*")]
    assert len(made) == 1 and len(glob.glob(f"{made[0]}/time=*/*/*/")) == len(glob.glob(f"{made[0]}/time=*")) > 20

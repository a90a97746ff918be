"""Forms of operators for large inputs: blocked weights, box overlaps by cells, chunk arrays in linear time, the Z-order layout."""

import datetime as dt
import os
import random
import time
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from floe import session
from floe.functions.grid import morton
from floe.operators import regrid, stats
from floe.session import checkpoint_dir, materialize, remove_scratch, scratch_path
from floe.sinks import writers
from floe.sources import readers


def exchanges(df) -> list[int]:
    """Rows that each shuffle of an executed plan wrote."""
    out = []

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(p.plan())
        if name == "ShuffleExchangeExec":
            out.append(p.metrics().apply("shuffleRecordsWritten").value())
        it = p.children().iterator()
        while it.hasNext():
            walk(it.next())
    walk(df._jdf.queryExecution().executedPlan())
    return out


def _steps(n):
    return [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(n)]


def test_blocked_weights_equal_the_sums_written_out(spark):
    """Holes, null values, sources and steps that lack altogether, negative ids, null ids, blocks of 8 ids."""
    rng = random.Random(5)
    days = _steps(4)
    src = {(s, t): rng.choice([None, rng.uniform(-5, 5), rng.uniform(-5, 5)]) for s in range(-20, 40) for t in days if rng.random() < 0.9 and not (s > 30 and t == days[1])}
    w = [(d, rng.choice([None, *range(-25, 45)]) if d % 9 == 0 else rng.randrange(-18, 30), rng.uniform(0, 1)) for d in range(60) for _ in range(rng.randrange(1, 5))]
    a = spark.createDataFrame([(s, t, v) for (s, t), v in src.items()] + [(None, days[0], 1.0)], "src_id int, time date, v double")
    b = spark.createDataFrame(w, "dst_id int, src_id int, w double")
    got = {(r.dst_id, r.time): r.v for r in regrid.apply_weights(a, b, by=("time",), block=8).collect()}
    want = {}
    for d in range(60):
        for t in days:
            vs = [(x, src.get((s, t)) if s is not None else None) for dd, s, x in w if dd == d]
            want[d, t] = None if any(v is None for _, v in vs) else sum(x * v for x, v in vs)
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)
    assert sum(v is not None for v in want.values()) > 50


def test_blocked_weights_refuse_a_source_held_twice(spark):
    a = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0)], "src_id int, time int, v double")
    w = spark.createDataFrame([(1, 1, 1.0)], "dst_id int, src_id int, w double")
    with pytest.raises(Exception, match="held twice"):
        regrid.apply_weights(a, w, by=("time",)).collect()
    assert regrid.apply_weights(a.limit(0), w, by=("time",)).collect() == []


def test_blocked_weights_shuffle_no_row_per_weight_and_step(spark):
    """60 steps, 16,000 weights, of which one hot source feeds a third: shuffled rows stay far below weights x steps."""
    steps, dst = 60, 4000
    src = spark.range(4096).select(F.col("id").alias("src_id"), F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")).withColumn("v", (F.col("src_id") % 7 + F.col("step")).cast("double"))
    w = (spark.range(dst, numPartitions=2).select(F.col("id").alias("dst_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
         .select("dst_id", F.when(F.col("dst_id") % 3 == 0, F.lit(100)).otherwise(F.col("dst_id")).alias("src_id"), F.lit(0.25).alias("w")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = regrid.apply_weights(src, w, by=("step",), block=64)
        rows = {(r.dst_id, r.step): r.v for r in out.collect()}
        # src rows come in as one per cell and step; what leaves the product is one partial sum per destination, step and task
        product = [n for n in exchanges(out) if n != 4096 * steps]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows) == dst * steps
    assert all(v == (100 % 7 if d % 3 == 0 else d % 7) + s for (d, s), v in rows.items())
    assert 16_000 in product and max(n for n in product) <= 1.05 * dst * steps < 16_000 * steps / 3


def _boxes(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y, w, h = rng.uniform(-500, 500), rng.uniform(-500, 500), rng.choice([0, 1, 3, 40, 900]) * rng.random(), rng.choice([0, 2, 64, 500]) * rng.random()
        out.append((i, x, x + w, y, y + h))
    return out + [(n, 0.0, 64.0, 0.0, 64.0), (n + 1, 0.0, 64.0, 0.0, 64.0), (n + 2, 64.0, 128.0, 0.0, 64.0), (n + 3, -2000.0, 2000.0, -2000.0, 2000.0), (n + 4, None, 1.0, 0.0, 1.0)]


_EXT = "tile int, x_min double, x_max double, y_min double, y_max double"


def test_overlaps_equal_all_pairs(spark):
    """Mixed sizes, points and lines, equal boxes, touching edges, one box over all, a null bound."""
    boxes = _boxes(250, 3)
    got = sorted((r.tile_a, r.tile_b, r.dx, r.dy) for r in stats.overlapping_pairs(spark.createDataFrame(boxes, _EXT), "tile").collect())
    want = []
    ok = [b for b in boxes if None not in b]
    for a in ok:
        for b in ok:
            dx, dy = min(a[2], b[2]) - max(a[1], b[1]), min(a[4], b[4]) - max(a[3], b[3])
            if (a[3], a[0]) < (b[3], b[0]) and dx > 0 and dy > 0:
                want.append((a[0], b[0], dx, dy))
    assert got == sorted(want) and len(want) > 300
    assert stats.overlapping_pairs(spark.createDataFrame([], _EXT), "tile").collect() == []


def test_a_hundred_thousand_tiles(spark):
    """400 x 250 tiles, each overlapping its eight neighbours by a margin, and one box over 100 of them: no nested loop."""
    t = spark.range(100_000).select(F.col("id").cast("int").alias("tile"), (F.col("id") % 400 * 100.0).alias("x_min"), (F.floor(F.col("id") / 400) * 100.0).alias("y_min"))
    t = t.select("tile", "x_min", (F.col("x_min") + 110).alias("x_max"), "y_min", (F.col("y_min") + 110).alias("y_max"))
    big = spark.createDataFrame([(100_000, 1015.0, 1995.0, 1015.0, 1995.0)], _EXT)
    out = stats.overlapping_pairs(t.unionByName(big), "tile")
    n = out.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("tile_a") == 100_000) | (F.col("tile_b") == 100_000)).alias("big")).first()
    assert n.n - n.big == 399 * 250 + 400 * 249 + 2 * 399 * 249
    assert n.big == 100
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()


def test_chunks_hold_cells_at_their_places(spark):
    cells = [(y, x, None if (y, x) == (3, 3) else float(10 * y + x)) for y in range(2, 9) for x in range(1, 7) if (y + x) % 3]
    df = spark.createDataFrame(cells, "iy int, ix int, v double")
    rows = readers.long_to_cube(df, "v", 4).collect()
    assert {(r.y0, r.x0) for r in rows} == {(y // 4 * 4, x // 4 * 4) for y, x, _ in cells}
    known = {(y, x): v for y, x, v in cells if v is not None}
    for r in rows:
        assert len(r["values"]) == 16
        for i, v in enumerate(r["values"]):
            at = known.get((r.y0 + i // 4, r.x0 + i % 4))
            assert (v != v) if at is None else v == at
    with pytest.raises(Exception, match="held twice"):
        readers.long_to_cube(df.unionByName(df.limit(1)), "v", 4).collect()


def test_chunks_take_linear_time(spark):
    """One chunk of 1024 x 1024: sixteen times the cells of 256 x 256 in far less than the square of the time."""
    def run(n):
        df = spark.range(n * n).where("id % 5 <> 0").select(F.floor(F.col("id") / n).cast("int").alias("iy"), (F.col("id") % n).cast("int").alias("ix"), F.col("id").cast("double").alias("v"))
        at = time.time()
        r = readers.long_to_cube(df, "v", n).select(F.size("values").alias("n"), F.get("values", F.lit(n + 1)).alias("v")).collect()
        assert [tuple(x) for x in r] == [(n * n, float(n + 1) if (n + 1) % 5 else r[0].v)]
        return time.time() - at
    run(256)
    small, large = run(256), run(1024)
    assert large < 64 * max(small, 0.2)


def test_z_order_keys(spark):
    pairs = [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (12287, 12287), (5, 70000), (2**31 - 1, 2**31 - 1)]
    got = [r.z for r in spark.createDataFrame(pairs, "iy int, ix int").select(morton().alias("z")).collect()]
    assert got == [sum(((y >> b & 1) << 2 * b + 1) | ((x >> b & 1) << 2 * b) for b in range(32)) for y, x in pairs]


def test_a_box_reads_a_bounded_share_of_the_row_groups(spark, tmp_path):
    """512 x 512 cells: row groups that a 64 x 64 box (1.6% of the cells) may touch hold at most a sixteenth of all rows; in
    row order the box's rows alone, 64 of 512, would be an eighth."""
    n = 512
    df = spark.range(n * n).select((F.col("id") % n).cast("int").alias("ix"), F.floor(F.col("id") / n).cast("int").alias("iy"), F.lit(dt.date(2000, 1, 1)).alias("time"), F.xxhash64("id").alias("v"))
    p = str(tmp_path / "z")
    writers.write_layout(df, p, partitions=4, row_group_bytes=16_384)
    groups = []
    for f in spark.read.parquet(p).inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            st = {c: meta.row_group(g).column(names.index(c)).statistics for c in ("iy", "ix")}
            groups.append((meta.row_group(g).num_rows, st["iy"].min, st["iy"].max, st["ix"].min, st["ix"].max))
    assert sum(g[0] for g in groups) == n * n and len(groups) > 50
    for y, x in ((0, 0), (128, 320), (64, 448)):
        touched = sum(g[0] for g in groups if g[1] < y + 64 and g[2] >= y and g[3] < x + 64 and g[4] >= x)
        assert touched <= n * n / 16
    assert spark.read.parquet(p).count() == n * n


@pytest.mark.parametrize("holes", [True, False])
def test_steps_are_counted_with_the_pixels(spark, holes):
    rng = random.Random(5)
    rows = [(i // 7, i % 7, dt.date(2000, 1, 1 + t) if t < 6 else None, None if (holes or i % 3) and rng.random() < 0.2 else 1.0)
            for i in range(60) for t in range(7) if t < 6 or i % 10 == 0]
    df = spark.createDataFrame(rows, "iy int, ix int, time date, v double")
    n = defaultdict(int)
    for y, x, _, v in rows:
        n[y, x] += v is not None
    got = stats.valid_per_pixel(df, "v").collect()
    assert [tuple(r) for r in got] == [(60, round(sum(c == 6 for c in n.values()) / 60, 6), min(n.values()), max(n.values()))]
    assert [tuple(r) for r in stats.valid_per_pixel(df, "v", 6).collect()] == [tuple(r) for r in got]
    assert [tuple(r) for r in stats.valid_per_pixel(df.limit(0), "v").collect()] == [(0, None, None, None)]


def test_scratch_goes_and_other_applications_keep_theirs(spark, monkeypatch):
    root = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "floe-out")
    assert f"/floe-out/{spark.sparkContext.applicationId}/" in scratch_path(spark, "t")
    other = materialize(spark.range(5), "kept")
    monkeypatch.setattr(session, "_scratch_root", lambda _: f"{root}/application-of-its-own")  # the other tests' tables are in this one's
    mine = materialize(spark.range(10), "gone")
    assert mine.count() == 10 and os.listdir(f"{root}/application-of-its-own")
    remove_scratch(spark)
    assert not os.path.exists(f"{root}/application-of-its-own") and other.count() == 5
    remove_scratch(spark)  # nothing left to delete

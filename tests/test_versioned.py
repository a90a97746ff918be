"""T1 as a versioned table: whole versions, small deltas, replays, compaction."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import types as T

from floe.session import scratch_path
from floe.streaming import versioned

_STEP = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.IntegerType()), T.StructField("time", T.DateType())])
D1, D2 = dt.date(2000, 1, 1), dt.date(2000, 4, 1)


class Table:
    def __init__(self, spark):
        self.spark = spark
        self.inbox, self.target, self.ckpt = (scratch_path(spark, n) for n in ("vin", "vout", "vck"))

    def put(self, name, rows):
        self.spark.createDataFrame(rows, _STEP).coalesce(1).write.parquet(f"{self.inbox}/{name}")
        time.sleep(1.1)  # files are ordered by modification time

    def load(self, ckpt=None, **kw):
        return versioned.load_versioned(self.spark, self.inbox, _STEP, self.target, ckpt or self.ckpt, keys=("k",), **kw)

    def frame(self, version=None):
        return versioned.read_versioned(self.spark, self.target, _STEP, keys=("k",), version=version)

    def rows(self, version=None):
        return sorted(((r.k, r.v, r.time) for r in self.frame(version).collect()), key=str)

    def files(self):
        root = f"{self.target}/data".removeprefix("file:")
        found = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}
        assert found
        return found


def test_late_rows_are_deltas_and_readers_keep_their_version(spark):
    t = Table(spark)
    assert t.rows() == []
    t.put("a", [(k, 1, d) for k in range(50) for d in (D1, D2)] + [(7, 1, None)])
    assert t.load() == 1 and t.load() == 0
    first, before = t.rows(), t.files()
    reader = t.frame()
    t.put("b", [(3, 9, D1)])      # one late row corrects D1
    assert t.load() == 1
    after = t.files()
    assert all(after[f] == at for f, at in before.items())     # nothing rewritten
    new = [f for f in after if f not in before]
    assert len(new) == 1 and spark.read.parquet(new[0]).count() == 1
    assert sorted(((r.k, r.v, r.time) for r in reader.collect()), key=str) == first == t.rows(version=1)
    assert t.rows() == sorted([(k, 9 if (k, d) == (3, D1) else 1, d) for k in range(50) for d in (D1, D2)] + [(7, 1, None)], key=str)


def test_an_uncommitted_load_is_not_seen(spark, monkeypatch):
    t = Table(spark)
    t.put("a", [(1, 1, D1)])
    t.load()
    t.put("b", [(2, 2, D1), (2, 2, D2)])
    commit = versioned._commit
    monkeypatch.setattr(versioned, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost before the manifest")))
    with pytest.raises(Exception):
        t.load()
    assert t.rows() == [(1, 1, D1)] and len(versioned.versions(spark, t.target)) == 1
    monkeypatch.setattr(versioned, "_commit", commit)
    assert t.load() == 1          # the batch is replayed
    want = [(1, 1, D1), (2, 2, D1), (2, 2, D2)]
    assert t.rows() == sorted(want, key=str)

    def lost_after(*a):
        commit(*a)
        raise OSError("lost after the manifest")
    t.put("c", [(3, 3, D1)])
    monkeypatch.setattr(versioned, "_commit", lost_after)
    with pytest.raises(Exception):
        t.load()
    monkeypatch.setattr(versioned, "_commit", commit)
    n = len(versioned.versions(spark, t.target))
    assert t.load() == 0 and len(versioned.versions(spark, t.target)) == n     # committed already: skipped
    assert t.rows() == sorted([*want, (3, 3, D1)], key=str)


def test_replays_compaction_and_vacuum_keep_the_rows(spark):
    t = Table(spark)
    for i in range(4):
        t.put(f"d{i}", [(k, 10 * i + k, D1) for k in range(i, 4)] + ([(0, 0, D2)] if i == 0 else []))
        t.load()
    want = t.rows()
    assert want == sorted([(k, 10 * k + k, D1) for k in range(4)] + [(0, 0, D2)], key=str)
    t.load(ckpt=scratch_path(spark, "vck2"), max_files_per_trigger=1)      # all files again, in an order of their own
    assert t.rows() == want
    before = t.files()
    assert versioned.compact(spark, t.target, _STEP, keys=("k",), deltas=2) == [str(D1)]
    assert t.rows() == want and all(f in t.files() for f in before)
    assert versioned.compact(spark, t.target, _STEP, keys=("k",), deltas=2) == []
    t.put("late", [(2, 99, D1)])
    t.load()
    gone = versioned.vacuum(spark, t.target, keep=1)
    assert len(gone) >= 3 and len(versioned.versions(spark, t.target)) == 1
    assert t.rows() == sorted([r if r[0] != 2 else (2, 99, D1) for r in want], key=str)


def test_two_writers_cannot_take_one_number(spark):
    t = Table(spark)
    t.put("a", [(1, 1, D1)])
    t.load()
    old = {"number": 0, "streams": {}, "steps": {}}
    with pytest.raises(Exception, match="exists"):
        versioned._commit(spark, t.target, old, {}, {})
    assert t.rows() == [(1, 1, D1)]

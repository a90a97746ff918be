"""T1 as a versioned table: deliveries become deltas behind a manifest that is swapped atomically.

Layout of a target folder::

    data/load=<id>/<step>=<value>/part-*.parquet    one folder per committed load, never changed
    manifest/<number>.json                          which loads hold each step, oldest first

* A load writes only the rows that arrived, so one late row does not rewrite its step.
* A load counts once its manifest is there. The manifest is written aside and renamed to the next number, which
  fails if another writer took that number. A reader takes the newest manifest and sees whole loads
  only; files are never replaced, so a reader that has planned keeps its version during later loads.
* A replayed micro-batch is either uncommitted (its folder is written over) or committed (it is skipped, by the
  stream's id and batch number). Files that come again through a new checkpoint carry the same versions, so
  the rows stay the same.
* ``compact`` merges steps of many deltas into one load; ``vacuum`` deletes loads and manifests that no kept version names.

The manifest has one entry per step and delta; it is the only thing that goes through the driver. The file system must rename
files atomically (HDFS and POSIX do).
"""

from __future__ import annotations

import json
import re
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.sinks.writers import spread_steps
from floe.streaming.incremental import VERSION, batch_tasks, newest

_LOAD = "load"
_VERSION_TYPE = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("file", T.StringType())])


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list[str]:
    p = _path(spark, folder)
    fs = _file_system(spark, p)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the committed manifests, ascending."""
    return [int(n[:-5]) for n in _children(spark, f"{target}/manifest") if re.fullmatch(r"\d{12}\.json", n)]


def manifest(spark: SparkSession, target: str, version: int | None = None) -> dict:
    """The manifest of a version (the newest by default); an empty one before the first load."""
    known = versions(spark, target)
    number = version if version is not None else known[-1] if known else 0
    if number == 0:
        return {"number": 0, "streams": {}, "steps": {}}
    return json.loads(spark.read.text(f"{target}/manifest/{number:012d}.json", wholetext=True).first()[0])


def _commit(spark: SparkSession, target: str, old: dict, streams: dict, steps: dict) -> None:
    number = old["number"] + 1
    aside = _path(spark, f"{target}/manifest/.{uuid.uuid4().hex}")
    out = _file_system(spark, aside).create(aside, False)
    out.write(bytearray(json.dumps({"number": number, "streams": streams, "steps": steps}).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(aside, _path(spark, f"{target}/manifest/{number:012d}.json"), no_options)


def _step_text(step_col: str):
    return F.coalesce(F.col(step_col).cast("string"), F.lit(""))


def _write_load(rows: DataFrame, target: str, load: str, step_col: str) -> list[str]:
    """Write a load; returns its steps (one value per step on the driver)."""
    spark = rows.sparkSession
    path = f"{target}/data/{_LOAD}={load}"
    spread_steps(rows, [step_col]).write.mode("overwrite").option("compression", "zstd").partitionBy(step_col).parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    return sorted(r[0] for r in back.select(_step_text(step_col)).distinct().collect())


def _live_rows(spark: SparkSession, target: str, steps: dict, schema: T.StructType, step_col: str, keys) -> DataFrame:
    """Rows of the given steps with their versions: steps of one load as stored, the others merged to the newest of each key."""
    full = T.StructType([*schema.fields, T.StructField(VERSION, _VERSION_TYPE), T.StructField(_LOAD, T.StringType())])
    columns = [*schema.names, VERSION]
    whole = [f"{loads[0]}/{s}" for s, loads in steps.items() if len(loads) == 1]
    parts = [f"{load}/{s}" for s, loads in steps.items() if len(loads) > 1 for load in loads]
    loads = sorted({load for ls in steps.values() for load in ls})
    if not loads:
        return spark.createDataFrame([], T.StructType(full.fields[:-1]))
    table = spark.read.schema(full).option("basePath", f"{target}/data").parquet(*[f"{target}/data/{_LOAD}={load}" for load in loads])
    place = F.concat(F.col(_LOAD), F.lit("/"), _step_text(step_col))  # of partition columns only: prunes folders when planned
    out = table.where(place.isin(whole)).select(*columns)
    if parts:
        out = out.unionByName(newest(table.where(place.isin(parts)).select(*columns), [step_col, *keys]))
    return out


def read_versioned(spark: SparkSession, target: str, schema: T.StructType, step_col: str = "time", keys: tuple[str, ...] = ("iy", "ix"),
                   version: int | None = None) -> DataFrame:
    """The table as of a committed version (the newest by default)."""
    return _live_rows(spark, target, manifest(spark, target, version)["steps"], schema, step_col, keys).select(*schema.names)


def load_versioned(spark: SparkSession, source_dir: str, schema: T.StructType, target: str, checkpoint: str, step_col: str = "time",
                   keys: tuple[str, ...] = ("iy", "ix"), max_files_per_trigger: int | None = None) -> int:
    """Load all newly arrived files of ``source_dir`` as deltas; returns the loads committed.

    ``keys`` identify a row within its step; of rows with equal keys the one of the newest file counts.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    version = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
    stream = reader.parquet(source_dir).select("*", version.alias(VERSION))
    started, ids, committed = threading.Event(), [], []

    def add(batch: DataFrame, epoch: int) -> None:
        started.wait()
        old = manifest(spark, target)
        if old["streams"].get(ids[0], -1) >= epoch:
            return
        load = f"{ids[0]}-{epoch:09d}"
        steps = dict(old["steps"])
        for s in _write_load(newest(batch, [step_col, *keys], batch_tasks(batch)), target, load, step_col):
            steps[s] = [*steps.get(s, []), load]
        _commit(spark, target, old, {**old["streams"], ids[0]: epoch}, steps)
        committed.append(load)

    q = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    ids.append(str(q.id))
    started.set()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return len(committed)


def compact(spark: SparkSession, target: str, schema: T.StructType, step_col: str = "time", keys: tuple[str, ...] = ("iy", "ix"),
            deltas: int = 8) -> list[str]:
    """Merge the steps that more than ``deltas`` loads hold into one load; returns these steps. Other steps aren't read."""
    old = manifest(spark, target)
    many = {s: loads for s, loads in old["steps"].items() if len(loads) > deltas}
    if many:
        load = f"compact-{uuid.uuid4().hex}"
        _write_load(_live_rows(spark, target, many, schema, step_col, keys), target, load, step_col)
        _commit(spark, target, old, old["streams"], {**old["steps"], **{s: [load] for s in many}})
    return sorted(many)


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete the loads that none of the last ``keep`` versions names, and older manifests; returns these loads.

    For the writer, between loads: a load that is being written is not named yet. Readers of deleted versions fail.
    """
    known = versions(spark, target)
    old, kept = known[:-keep], known[-keep:]
    named = {load for v in kept for loads in manifest(spark, target, v)["steps"].values() for load in loads}
    gone = [n[len(_LOAD) + 1:] for n in _children(spark, f"{target}/data") if n.startswith(f"{_LOAD}=") and n[len(_LOAD) + 1:] not in named]
    for p in [f"{target}/manifest/{v:012d}.json" for v in old] + [f"{target}/data/{_LOAD}={load}" for load in gone]:
        hp = _path(spark, p)
        _file_system(spark, hp).delete(hp, True)
    return gone

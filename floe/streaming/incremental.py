"""Incremental load of newly arrived time steps with Structured Streaming.

New step files land in an input folder; a file-source stream (declared
schema, no inference) picks up only files it has not seen (tracked in the
checkpoint). The unit of replacement is the row key (e.g. pixel and step), not
the step: a step may be split over files, folders, micro-batches and runs in any
way and ends complete, and a corrected delivery replaces the rows it holds.

Each micro-batch is merged with the stored rows of the steps it touches; of
each key the newest version stays (``_version``: modification time and path
of the file it came from). The merged steps are written to a scratch table
first and then put in place by dynamic partition overwrite. A replayed batch
merges to the same rows, so the sink is idempotent. ``trigger(availableNow=True)``
processes everything available, then stops, which makes the same code usable
as a scheduled batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.operators.joins import spread
from floe.session import materialize
from floe.sinks.writers import spread_steps

VERSION = "_version"


#: Rows of a stream's batch that one task groups.
BATCH_TASK_ROWS = 250_000


def batch_tasks(batch: DataFrame) -> int:
    """Tasks for a stream's batch, whose files its plan doesn't name: its rows are counted."""
    return -(-batch.count() // BATCH_TASK_ROWS)


def newest(rows: DataFrame, keys: list[str], tasks: int | None = None) -> DataFrame:
    """The newest version of each key (one aggregate; ``tasks`` as in ``spread``).

    Rows of one file share a version; a key that a delivery holds twice keeps the row that is
    greatest in all columns, so replays agree.
    """
    values = F.struct(*[c for c in rows.columns if c not in keys])
    return (spread(rows, *keys, tasks=tasks).groupBy(*keys).agg(F.max_by(values, F.struct(F.col(VERSION).alias("v"), F.to_json(values).alias("j"))).alias("_new"))
            .select(*keys, "_new.*").select(*rows.columns))


def load_new_steps(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                   checkpoint: str, step_col: str = "time", keys: tuple[str, ...] = ("iy", "ix"),
                   max_files_per_trigger: int | None = None) -> int:
    """Process all newly arrived files of ``source_dir`` into ``target``; returns batches run.

    ``keys`` identify a row within its step. ``max_files_per_trigger`` only bounds the size of a
    micro-batch; it doesn't change the result. The target holds one more column, ``_version``.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    version = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
    stream = reader.parquet(source_dir).select("*", version.alias(VERSION))
    batches = []

    def merge_steps(batch: DataFrame, epoch_id: int) -> None:
        row_keys = [step_col, *keys]
        rows = materialize(newest(batch, row_keys, batch_tasks(batch)), "t1-batch")
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(target)
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
            stored = spark.read.schema(rows.schema).parquet(target)
            # only the touched steps are read; their list has one row per step
            touched = stored.join(F.broadcast(rows.select(step_col).distinct()), step_col, "left_semi")
            rows = materialize(newest(rows.unionByName(touched), row_keys), "t1-merged")
        (spread_steps(rows, [step_col]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(step_col).parquet(target))
        batches.append(epoch_id)

    q = (stream.writeStream.foreachBatch(merge_steps)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return len(batches)


def append_new_steps(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                     checkpoint: str, step_col: str = "time") -> None:
    """Variant with the built-in file sink (exactly-once appends through its commit log)."""
    q = (spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source_dir)
         .writeStream.format("parquet").partitionBy(step_col)
         .option("checkpointLocation", checkpoint).option("path", target)
         .trigger(availableNow=True).start())
    q.awaitTermination()

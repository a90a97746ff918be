"""Sinks (K1-K11): distributed parquet writes with an explicit layout.

Preferred layout for gridded long tables: range-partitioned and sorted by time and
place on the Z-order curve, so row-group statistics prune boxes and time filters; time-step folders (``partitionBy``) give per-step
files without any driver loop.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions.grid import morton, tile_of
from floe.session import materialize


def _writer(df: DataFrame, mode: str, compression: str = "zstd", partition_by=None, dynamic: bool = False):
    w = df.write.mode(mode).option("compression", compression)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def write_even(df: DataFrame, path: str, files: int, mode: str = "overwrite") -> None:
    """K1: overwrite, zstd, ``files`` files of even size (round-robin)."""
    _writer(df.repartition(files), mode).parquet(path)


def with_tiles(df: DataFrame, tile: int = 2048) -> DataFrame:
    """Tile keys of a pixel (K4 layout)."""
    return df.withColumns({"tile_y": tile_of("iy", tile), "tile_x": tile_of("ix", tile)})


def write_layout(df: DataFrame, path: str, keys=("time",), mode: str = "overwrite",
                 partitions: int | None = None, row_group_bytes: int | None = None) -> None:
    """Range-partition and sort by (keys, place on the Z-order curve).

    The pixel in the range key lets a step of any size spread over several files. A row group holds a compact
    patch of cells, so its statistics of ``iy`` and ``ix`` prune boxes in both directions.
    """
    order = [*[F.col(k) for k in keys], F.col("_z")]
    d = df.withColumn("_z", morton("iy", "ix"))
    d = d.repartitionByRange(partitions, *order) if partitions else d.repartitionByRange(*order)
    w = _writer(d.sortWithinPartitions(*order).drop("_z"), mode)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    w.parquet(path)


def spread_steps(df: DataFrame, keys) -> DataFrame:
    """Rows ranged by (keys, pixel): steps lie together, and a step of any size spreads over several tasks.

    Tables without pixel columns are spread by a hash of the row instead.
    """
    pixel = [c for c in ("iy", "ix") if c in df.columns]
    rest = [F.col(c) for c in pixel] if pixel else [F.xxhash64(*[F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])]
    return df.repartitionByRange(*[F.col(k) for k in keys], *rest).sortWithinPartitions(*keys, *pixel)


def write_steps(df: DataFrame, path: str, step_col: str = "time", mode: str = "overwrite") -> None:
    """K2: one folder per time step; steps without rows simply do not appear."""
    _writer(spread_steps(df, [step_col]), mode, partition_by=[step_col]).parquet(path)


def append_steps(df: DataFrame, path: str, step_col: str = "time") -> None:
    """K3: append new steps to an existing table."""
    _writer(spread_steps(df, [step_col]), "append", partition_by=[step_col]).parquet(path)


def with_folders(df: DataFrame, tiles: int = 64) -> DataFrame:
    """Keys of the square of ``tiles`` x ``tiles`` tiles that a tile lies in (folders of small tiles in the K4 layout)."""
    return df.withColumns({"folder_y": tile_of("tile_y", tiles), "folder_x": tile_of("tile_x", tiles)})


def overwrite_regions(df: DataFrame, path: str, keys=("time",), folders=None) -> None:
    """K4: replace only the regions present in ``df``, each named by its values of ``keys`` (dynamic partition overwrite).

    Idempotent: re-running a step (e.g. a replayed batch) rewrites the same
    regions and leaves all others untouched.

    A region is a folder, unless ``folders`` names the columns of a coarser grouping (the same for all writes to a path, one value for
    a region): small regions then share a folder, so that folders and files don't multiply with them. The rows of other regions in the
    folders of ``df`` are read and written again, those of other folders aren't.
    """
    keys, place = list(keys), list(folders or keys)
    order = list(dict.fromkeys([*place, *keys]))
    if folders and _exists(df.sparkSession, path):
        df = materialize(df, "regions-new")
        df = df.unionByName(materialize(_other_regions(df, path, order, place), "regions-kept"))
    _writer(spread_steps(df, order), "overwrite", partition_by=place, dynamic=True).parquet(path)


def _other_regions(new: DataFrame, path: str, order: list[str], place: list[str]) -> DataFrame:
    """Stored rows in the folders that ``new`` has rows for, without those of its regions (``order``: their folder and key columns)."""
    def value(c: str):
        # in a folder's name an empty string is a null
        return F.when(F.col(c) != "", F.col(c)) if c in place and isinstance(new.schema[c].dataType, T.StringType) else F.col(c)

    def same(columns):
        return reduce(lambda a, b: a & b, [value(c).eqNullSafe(F.col(f"_region_{c}")) for c in columns])
    regions = new.select(*[value(c).alias(f"_region_{c}") for c in order]).distinct()
    touched = regions.select(*[f"_region_{c}" for c in place]).distinct()
    stored = new.sparkSession.read.schema(new.schema).parquet(path).select(*new.columns)
    ranged = [c for c in place if isinstance(new.schema[c].dataType, (T.DateType, T.IntegralType))]
    if ranged:  # folders beyond the bounds aren't read
        bounds = touched.agg(*[f(f"_region_{c}") for c in ranged for f in (F.min, F.max)],
                             *[F.count_if(F.col(f"_region_{c}").isNull()) for c in ranged]).first()
        for i, c in enumerate(ranged):
            within = F.col(c).between(F.lit(bounds[2 * i]).cast(new.schema[c].dataType), F.lit(bounds[2 * i + 1]).cast(new.schema[c].dataType))
            stored = stored.where(within | F.col(c).isNull() if bounds[2 * len(ranged) + i] else within)
    return stored.join(touched, same(place), "left_semi").join(regions, same(order), "left_anti")


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_complete(spark, path: str) -> bool:
    """Whether a write to ``path`` was committed (it left ``_SUCCESS``)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_if_absent(df, path: str, partition_by=None, spark=None) -> bool:
    """K5: skip the write when a complete output exists; returns whether it wrote.

    What a failed write left is no output and is written over. ``df`` may be a function that
    returns the DataFrame, so that nothing is planned or computed when the output is there.
    """
    spark = spark or df.sparkSession
    if is_complete(spark, path):
        return False
    _writer(df() if callable(df) else df, "overwrite", partition_by=partition_by).parquet(path)
    return True


def add_columns(src_path: str, dst_path: str, spark, columns: dict, partition_by=None) -> DataFrame:
    """K6: read a table, add derived columns, write a new table (never over its own input).

    Columns are added in order, so that one may use those before it.
    """
    if src_path.rstrip("/") == dst_path.rstrip("/"):
        raise ValueError("add_columns writes to a new path, not over its input")
    out = spark.read.parquet(src_path)
    for name, c in columns.items():
        out = out.withColumn(name, c)
    _writer(out, "overwrite", partition_by=partition_by).parquet(dst_path)
    return spark.read.parquet(dst_path)


def with_metadata(df: DataFrame, meta: dict[str, dict[str, str]]) -> DataFrame:
    """K8: attach attributes (long_name, units, ...) to columns; they survive parquet."""
    return df.select(*[F.col(c).alias(c, metadata=meta[c]) if c in meta else F.col(c) for c in df.columns])


def metadata_report(df: DataFrame, key: str = "units") -> list[tuple[str, str | None]]:
    return [(f.name, f.metadata.get(key)) for f in df.schema.fields]


def narrow_floats(df: DataFrame) -> DataFrame:
    """K9: every DOUBLE column becomes FLOAT (computation stays in DOUBLE upstream)."""
    return df.select(*[F.col(f.name).cast("float").alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


@contextmanager
def micros_timestamps(spark):
    """Write timestamps as INT64 microseconds for the duration of a write."""
    key = "spark.sql.parquet.outputTimestampType"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        if old is not None:
            spark.conf.set(key, old)
        else:
            spark.conf.unset(key)

"""Sources: parquet scans, step directories, grid cubes, generated grids, checks.

Grids are generated with ``spark.range`` (distributed; no driver arrays); only
grid metadata (a handful of scalars such as an extent) ever reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions.grid import Grid, dense_run, nan_to_null
from floe.functions.timefn import nanos_to_timestamp


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               nan_cols: list[str] | None = None) -> DataFrame:
    """Parquet scan with an optional declared schema; NaN -> NULL on float columns."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    floats = nan_cols if nan_cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.withColumns({c: nan_to_null(c, types[c]) for c in floats}) if floats else df


def read_steps(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A directory of per-step parts (``step=NNN`` partition folders or plain files)."""
    r = spark.read.option("recursiveFileLookup", "false")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def cube_to_long(chunks: DataFrame, value: str = "v") -> DataFrame:
    """S3: decoded chunk rows ``(time?, y0, x0, ny, nx, values ARRAY<DOUBLE>)`` -> long rows.

    One output row per array element; ``iy = y0 + pos div nx``, ``ix = x0 + pos mod nx``;
    NaN becomes NULL. Chunks are independent, so this is a narrow (no shuffle) step.
    """
    keep = [c for c in chunks.columns if c not in ("y0", "x0", "ny", "nx", "values")]
    e = chunks.select(*keep, "y0", "x0", "nx", F.posexplode("values").alias("pos", "_v"))
    return e.select(*keep,
                    (F.col("y0") + F.floor(F.col("pos") / F.col("nx"))).cast("int").alias("iy"),
                    (F.col("x0") + F.col("pos") % F.col("nx")).cast("int").alias("ix"),
                    nan_to_null("_v").alias(value))


def long_to_cube(df: DataFrame, value: str, chunk: int, keys=("iy", "ix"), extra=()) -> DataFrame:
    """Inverse of S3 (chunk rows of a flat table): dense ``chunk x chunk`` arrays, NaN where absent or null.

    One shuffle by chunk; a chunk's cells are sorted by position and its gaps filled in linear time
    (``dense_run``). A cell held twice is an error.
    """
    iy, ix = keys
    y0 = (F.floor(F.col(iy) / chunk) * chunk).cast("int")
    x0 = (F.floor(F.col(ix) / chunk) * chunk).cast("int")
    pos = ((F.col(iy) - y0) * chunk + (F.col(ix) - x0)).cast("int")
    nan = F.lit(float("nan"))
    cell = F.struct(pos.alias("p"), F.coalesce(F.col(value).cast("double"), nan).alias("v"))
    g = df.select(*extra, y0.alias("y0"), x0.alias("x0"), cell.alias("e")).groupBy(*extra, "y0", "x0").agg(F.collect_list("e").alias("es"))
    return g.select(*extra, "y0", "x0", F.lit(chunk).alias("ny"), F.lit(chunk).alias("nx"), dense_run("es", 0, chunk * chunk, nan).alias("values"))


def read_products(spark: SparkSession, config: dict[str, dict[str, str]], reader=None) -> dict[str, DataFrame]:
    """One table per (product, tile), driven by a config ``{product: {tile_id: path}}``.

    Returns ``{product: union of its tiles with a tile_id column}``.
    """
    reader = reader or (lambda p: read_table(spark, p))
    out = {}
    for product, tiles in config.items():
        frames = [reader(p).withColumn("tile_id", F.lit(t)) for t, p in tiles.items()]
        out[product] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out


def master_grid(spark: SparkSession, grid: Grid, partitions: int | None = None) -> DataFrame:
    """Every cell of a grid as a row ``(iy, ix, y, x)``, generated distributed."""
    n = grid.nx * grid.ny
    r = spark.range(0, n, 1, partitions) if partitions else spark.range(0, n)
    return r.select((F.col("id") / F.lit(grid.nx)).cast("long").cast("int").alias("iy"),
                    (F.col("id") % F.lit(grid.nx)).cast("int").alias("ix")).select(
        "iy", "ix", grid.y("iy").alias("y"), grid.x("ix").alias("x"))


def canvas_from_extent(df: DataFrame, iy: str = "iy", ix: str = "ix") -> DataFrame:
    """All cells inside the data extent (inclusive both ends), generated distributed.

    Only the four extent scalars go to the driver.
    """
    e = df.agg(F.min(iy), F.max(iy), F.min(ix), F.max(ix)).first()
    iy0, iy1, ix0, ix1 = (int(v) for v in e)
    nx, ny = ix1 - ix0 + 1, iy1 - iy0 + 1
    r = df.sparkSession.range(0, nx * ny)
    return r.select((F.lit(iy0) + (F.col("id") / F.lit(nx)).cast("long")).cast("int").alias(iy),
                    (F.lit(ix0) + F.col("id") % F.lit(nx)).cast("int").alias(ix))


def missing_inputs(spark: SparkSession, paths: list[str]) -> list[str]:
    """Every path that does not exist (checked through the Hadoop file system,
    so object stores and HDFS work; a session without a JVM gateway is an error)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def validate_inputs(spark: SparkSession, paths: list[str]) -> None:
    """Fail once, listing all missing inputs."""
    missing = missing_inputs(spark, paths)
    if missing:
        raise FileNotFoundError(f"{len(missing)} required source(s) not found: {missing}")


def sanitize_time(df: DataFrame, c: str = "time") -> DataFrame:
    """Make ``time`` a TIMESTAMP_NTZ without using the session zone.

    BIGINT (nanoseconds, as read with ``nanosAsLong``) is converted exactly
    (truncated to microseconds); TIMESTAMP_NTZ and DATE are left alone; a
    zoned TIMESTAMP is converted to its UTC wall clock.
    """
    if c not in df.columns:
        return df
    t = df.schema[c].dataType
    if isinstance(t, T.LongType):
        return df.withColumn(c, nanos_to_timestamp(c))
    if isinstance(t, T.TimestampType):
        return df.withColumn(c, nanos_to_timestamp(F.unix_micros(F.col(c)) * F.lit(1000)))
    return df


_WIDTH = {"byte": 1, "short": 2, "integer": 4, "float": 4, "long": 8, "double": 8, "boolean": 1, "date": 4}


def profile(df: DataFrame, nd: int = 6) -> DataFrame:
    """Per column: type, non-null count, smallest and largest value, units attribute and an in-memory size
    estimate (rows x type width) - one pass, unpivoted.

    Numbers and booleans (0, 1) have ``vmin`` and ``vmax``; strings, dates, timestamps and other ordered types
    ``first`` and ``last`` as text. The size of strings is that of their bytes.
    """
    fields = df.schema.fields
    aggs, parts = [F.count(F.lit(1)).alias("__rows")], []
    for i, f in enumerate(fields):
        c, t = F.col(f"`{f.name}`"), f.dataType
        number = isinstance(t, (T.NumericType, T.BooleanType))
        text = not number and isinstance(t, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
        v = c.cast("int").cast("double") if isinstance(t, T.BooleanType) else c.cast("double") if number else F.lit(None).cast("double")
        o = c if text else F.lit(None).cast("string")
        size = F.sum(F.octet_length(c)).cast("long") if isinstance(t, (T.StringType, T.BinaryType)) else F.count(F.lit(1)) * _WIDTH.get(t.typeName(), 8)
        aggs += [F.count(c).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.min(o).cast("string").alias(f"first{i}"),
                 F.max(o).cast("string").alias(f"last{i}"), size.alias(f"size{i}")]
        u = (f.metadata or {}).get("units")
        units = "CAST(NULL AS STRING)" if u is None else "'" + str(u).replace("'", "''") + "'"
        name = f.name.replace("'", "''")
        parts.append(f"'{name}', '{t.simpleString()}', n{i}, lo{i}, hi{i}, first{i}, last{i}, {units}, size{i}")
    return df.agg(*aggs).selectExpr(
        f"stack({len(fields)}, {', '.join(parts)}) AS (column_name, data_type, n_valid, vmin, vmax, first, last, units, est_bytes)", "__rows AS n_rows").select(
        "column_name", "data_type", "n_valid", "vmin", "vmax", "first", "last", "units", "n_rows", F.coalesce("est_bytes", F.lit(0)).cast("long").alias("est_bytes"))

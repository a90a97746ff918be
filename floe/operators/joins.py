"""Join strategies and the small relational operators built on them.

``sized_join`` is the one place where broadcasting is decided: the small side is
measured first (the bytes of its rows, summed); under the budget it is broadcast, above it
the join falls back to a salted shuffle join that spreads hot keys over many
tasks and keeps rows with null keys out of the shuffle altogether.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_SALT_BUCKETS = 64


#: Bytes of stored input (compressed files) whose rows one task of a large grouping gets.
TASK_INPUT_BYTES = 4 * 1024 * 1024


def _stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (one file system call per folder; a folder counts whole)."""
    spark = df.sparkSession
    folders: dict[str, list[str]] = {}
    for f in df.inputFiles():
        folders.setdefault(f.rsplit("/", 1)[0], []).append(f)
    total = 0
    for folder, files in folders.items():
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0] if len(files) == 1 else folder))
        total += p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return total


def spread(df: DataFrame, *cols: str, grow: int = 1, tasks: int | None = None) -> DataFrame:
    """``df`` partitioned by ``cols`` into so many tasks that each gets a bounded part of the input.

    The session's count (and what adaptive execution makes of it) is kept while the input is small. Beyond that, the number
    of tasks grows with the stored input, so the memory of one task doesn't. ``grow`` is the number of rows made
    from one; ``tasks`` is given where the input is no stored table (a stream's batch).
    """
    tasks = tasks or -(-_stored_bytes(df) * grow // TASK_INPUT_BYTES)
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(*cols)
    return df.repartition(tasks, *cols)


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row: 8 per fixed-size value and 16 per row; strings and binaries as long as they are, other types 4 times
    as long as their JSON text (a number in an array has 2 characters with its comma, and takes 8 bytes)."""
    w = F.lit(16 + 8 * len(schema.fields)).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            w = w + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            w = w + F.coalesce(4 * F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        elif isinstance(f.dataType, (T.DecimalType, T.VariantType, T.CalendarIntervalType)):
            w = w + F.lit(16)
    return w


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows take, summed over the rows themselves (one pass)."""
    return df.agg(F.sum(_row_bytes(df.schema))).first()[0] or 0


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Size check by the measured bytes of all rows."""
    return measured_bytes(df) <= max_bytes


def broadcast_checked(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only after the rows' bytes are measured; otherwise a plain (shuffle) join side."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def hot_keys(df: DataFrame, on: list[str], buckets: int) -> list[tuple]:
    """Keys that hold more than one row in ``4 * buckets``: fewer than that many, found by one count with map-side combination."""
    n = df.count()
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return [tuple(r) for r in counts.where(F.col("_n") * (4 * buckets) > n).select(*on).collect()]


def salted_sides(big: DataFrame, small: DataFrame, on: list[str], salt: Column, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: rows of hot keys of ``big`` get ``salt``, and the small rows of these keys a copy for each; all others get 0."""
    hot = hot_keys(big, on, buckets)
    if not hot:
        return big.withColumn("_salt", F.lit(0).cast("long")), small.withColumn("_salt", F.lit(0).cast("long"))
    fields = T.StructType([big.schema[k] for k in on])
    flagged = F.broadcast(big.sparkSession.createDataFrame(hot, fields).withColumn("_hot", F.lit(True)))  # 4 * buckets keys at most
    every = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    none = F.lit(0).cast("long")
    keyed = big.join(flagged, on, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(none)).drop("_hot")
    copies = small.join(flagged, on, "left").withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(none)))).drop("_hot")
    return keyed, copies


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
               max_bytes: int = DEFAULT_BROADCAST_BYTES,
               salt_by: list[str] | None = None,
               salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Join ``big`` with a side that is usually small.

    * broadcast when the measured size of ``small`` is within ``max_bytes``;
    * otherwise a shuffle join that is salted for hot keys only (``hot_keys``): their ``big``
      rows get a deterministic salt from ``salt_by`` (e.g. the pixel key) and their
      ``small`` rows a copy per salt, so a key holding a third of all rows spreads over
      ``salt_buckets`` tasks, and no other small row is copied. Rows of ``big`` with a null key cannot match;
      they bypass the shuffle (left join) or are dropped (inner join).
    """
    if how not in ("left", "inner"):
        raise ValueError("sized_join supports left and inner joins")
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    salt_cols = salt_by or [c for c in big.columns if c not in on][:2] or on
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(salt_buckets))
    keyed, rep = salted_sides(big.where(~null_key), small, on, salt, salt_buckets)
    joined = keyed.join(rep, on + ["_salt"], how).drop("_salt")
    if how == "inner":
        return joined
    payload = [f for f in small.schema.fields if f.name not in on]
    nulls = big.where(null_key).select(
        *big.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in payload])
    return joined.unionByName(nulls)


def outer_align(frames: list[DataFrame], keys: list[str], partition_by: list[str] | None = None) -> DataFrame:
    """Full outer alignment of frames that are unique per ``keys``.

    Written as union + group (not a chain of full outer joins): one shuffle for
    any number of inputs, and key filters still push into every scan.

    * Each non-key column comes from exactly one input; a shared one is an error.
    * A key that an input holds twice is an error when the plan runs (A13 inside the
      same aggregate, no extra pass); ``full_outer_join`` is the form for such inputs.
    * As in a join, a null in a key matches nothing: such rows stay apart, per input.
    """
    seen: dict[str, int] = {}
    for i, f in enumerate(frames):
        for c in f.columns:
            if c not in keys and seen.setdefault(c, i) != i:
                raise ValueError(f"column {c!r} comes from two inputs; rename or drop one of them")
    part = partition_by or keys
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    sided = [f.withColumn("_side", F.lit(i)) for i, f in enumerate(frames)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sided)
    values = [f for f in u.schema.fields if f.name not in keys and f.name != "_side"]

    def pick(f):
        # one value per key and column, as keys are unique per input: max is exact for orderable types;
        # maps (not orderable) take the single non-null value
        if isinstance(f.dataType, T.MapType):
            return F.first(f.name, ignorenulls=True).alias(f.name)
        return F.max(f.name).alias(f.name)
    counts = [F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(frames))]
    g = (spread(u, *part).withColumn("_apart", F.when(null_key, F.col("_side")))
         .groupBy(*keys, "_apart").agg(*[pick(f) for f in values], *counts))
    most = F.greatest(*[f"_n{i}" for i in range(len(frames))]) if len(frames) > 1 else F.col("_n0")
    unique = F.when(most > 1, F.raise_error(F.concat(F.lit(f"outer_align: an input holds a key twice: {keys} = "), F.to_json(F.struct(*keys)))).cast("boolean"))
    return g.where(F.coalesce(unique, F.lit(True))).select(*keys, *[f.name for f in values])


def full_outer_join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """J1 in its literal form (a sort-merge full outer join)."""
    return a.join(b, keys, "full_outer")


def mask_semi(df: DataFrame, mask: DataFrame, keys: list[str]) -> DataFrame:
    """Keep rows whose key is in the mask (semi-join: rows of df never duplicate,
    so the mask needs no distinct - and no extra shuffle)."""
    return df.join(mask.select(*keys), keys, "left_semi")


def coverage_gaps(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Keys expected but absent, and keys present but not expected."""
    e = expected.select(*keys).distinct()
    p = present.select(*keys).distinct()
    return (e.join(p, keys, "left_anti").withColumn("kind", F.lit("expected_missing"))
            .unionByName(p.join(e, keys, "left_anti").withColumn("kind", F.lit("unexpected_present"))))


def tolerant_equal(a: Column, b: Column, atol: float = 1e-8, rtol: float = 1e-5) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def multiset_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Exact multiset comparison of two row sets in one shuffle.

    Returns ``(metric, n)`` rows: sizes of both sides and of both differences
    (``exceptAll`` semantics), without any cross join.
    """
    cols = a.columns
    u = (a.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
         .unionByName(b.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    m = u.groupBy(*cols).agg(F.sum("_l").alias("nl"), F.sum("_r").alias("nr"))
    wide = m.agg(F.sum("nl").alias("n_left"), F.sum("nr").alias("n_right"),
                 F.sum(F.greatest(F.col("nl") - F.col("nr"), F.lit(0))).alias("n_only_left"),
                 F.sum(F.greatest(F.col("nr") - F.col("nl"), F.lit(0))).alias("n_only_right"))
    return wide.selectExpr("stack(4, 'n_left', n_left, 'n_right', n_right, 'n_only_left', n_only_left, "
                           "'n_only_right', n_only_right) AS (metric, n)").select(
        "metric", F.col("n").cast("long").alias("n"))

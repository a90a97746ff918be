"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.session import materialize

#: Word characters of the contracts: everything but space and \t \n \v \f \r. ``bytes.split()`` cuts at
#: exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def utf8(values: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    cast = values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary())
    for v in cast:
        yield v.as_py()


_SPACE = re.compile(rb"[ \t-\r]")
#: Bytes of a very long text that are cut into words at a time.
WORD_PIECE = 1 << 20


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece, cut at spaces; texts of ordinary length are one piece."""
    at = 0
    while len(text) - at > WORD_PIECE:
        cut = _SPACE.search(text, at + WORD_PIECE)
        if cut is None:
            break
        yield text[at: cut.start()].split()
        at = cut.start()
    yield (text[at:] if at else text).split()


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in slices, for work that holds Python copies of the texts it looks at."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20):
    """Arrow batches of ``size`` bytes at most (one row at least) go to the Python workers, for stages that run inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns that can be hashed (maps can't)."""
    def hashable(t: T.DataType) -> bool:
        if isinstance(t, T.MapType):
            return False
        if isinstance(t, T.ArrayType):
            return hashable(t.elementType)
        if isinstance(t, T.StructType):
            return all(hashable(f.dataType) for f in t.fields)
        return not isinstance(t, T.VariantType)
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if hashable(f.dataType)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")


def plus(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` with the fields of a DDL string added."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    return df.drop(*names)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def group_starts(table: pa.Table, keys: Iterable[str]) -> np.ndarray:
    """Row numbers at which a group of a key-sorted table begins."""
    n = table.num_rows
    if n == 0:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the rows at which groups begin, from key-sorted batches.

    Only the last, unfinished group of a batch is carried over, so memory is bounded by the
    largest group, which callers keep bounded.
    """
    carry: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        first = np.array([t.column(k)[0].as_py() for k in keys], dtype=object)
        if carry and all(carry[-1].column(k)[-1].as_py() == v for k, v in zip(keys, first)):
            starts = group_starts(t, keys)
            if len(starts) == 1:
                carry.append(t)
                continue
            carry.append(t.slice(0, int(starts[1])))
            t = t.slice(int(starts[1]))
        if carry:
            done = pa.concat_tables(carry).combine_chunks()
            yield done, group_starts(done, keys)
        starts = group_starts(t, keys)
        if len(starts) > 1:
            done = t.slice(0, int(starts[-1])).combine_chunks()
            yield done, starts[:-1]
        carry = [t.slice(int(starts[-1]))]
    if carry:
        done = pa.concat_tables(carry).combine_chunks()
        yield done, group_starts(done, keys)


def by_group(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``fn(table, starts) -> iterable of RecordBatch`` over tables of whole, bounded groups.

    One sort-based pass over the partition instead of one Python call and one frame for each group.
    """
    def run(batches):
        for t, starts in whole_groups(batches, keys):
            yield from fn(t, starts)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(a, b)`` links between long ids -> ``(node, root)`` with the smallest id reachable, for every linked node.

    Alternates large-star and small-star steps. Each round is a written table in the shared
    folder; a count and a hash sum of the links tell when nothing moves. No links of a node meet in
    one task but through joins that Spark can split, and minima are combined map-side.
    """
    def step(pairs: DataFrame) -> DataFrame:
        """(u, v): links of u, v the smaller or any; u's minimum is linked to every v and u."""
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(low.select("u", F.least("u", "m").alias("m")), "u")

    cur = materialize(edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        if now[0] == 0:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = step(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = step(large)
        cur = materialize(small.select("u", F.col("m").alias("v"))
                          .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "links")
    raise RuntimeError("components did not settle")

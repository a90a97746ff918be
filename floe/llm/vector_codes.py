"""Vector code compression: product codes of integer vectors, nearest entries by slice-and-intersect bitmasks.

A vector is cut into equal parts, each part is coded by the number of its nearest codebook entry.
For each part position and dimension the entries' coordinates are sorted once, and beside rank i stands
a uint64 mask of the entries below it, so the entries of any coordinate range are the XOR of two masks. A part is
coded by

1. *initial radius*: the usual distance between neighbouring entries;
2. *slice*: in each dimension, the mask of the entries within that radius;
3. *intersect*: the AND of the masks holds every entry in the cube around the part; only those are measured, exactly.
   Where none is in it the radius is doubled; where the nearest in it is farther than the radius, that distance becomes the
   radius and the cube then holds all entries that can be nearer. So the result is that of trying every entry.

Rounds of reassignment shuffle one row per task, part and entry (sums and counts); the codebook, 64 entries of a vector's
width, is the only thing the driver holds. All arithmetic is on integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.llm.common import fresh, plus, slices, unused
from floe.operators.joins import sized_join
from floe.session import materialize

PARTS = 16
#: Entries of a part's codebook: one bit each of a mask.
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Bytes of sums per label that are broadcast at most.
MAX_BROADCAST = 16 << 20
_ROWS = 4096


@dataclass
class SlicedEntries:
    """The entries of one part position, ready for slicing."""
    entries: np.ndarray
    coords: list[np.ndarray]
    masks: list[np.ndarray]
    radius: int

    @staticmethod
    def of(entries: np.ndarray) -> SlicedEntries:
        coords, masks = [], []
        for column in entries.T:
            order = np.argsort(column, kind="stable")
            bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
            coords.append(column[order])
            masks.append(np.concatenate([[np.uint64(0)], np.bitwise_or.accumulate(bits)]))
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2).astype(np.float64))
        np.fill_diagonal(apart, np.inf)
        usual = np.median(apart.min(axis=1)) if len(entries) > 1 else 0.0
        return SlicedEntries(entries, coords, masks, int(usual) + 1)

    def sliced(self, parts: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Mask of the entries that differ from a part by ``reach`` at most in every dimension."""
        found = np.full(len(parts), ~np.uint64(0))
        for x, coords, masks in zip(parts.T, self.coords, self.masks):
            found &= masks[np.searchsorted(coords, x + reach, "right")] ^ masks[np.searchsorted(coords, x - reach, "left")]
        return found

    def measured(self, parts: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry in each part's mask, ties to the lower number."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        number = np.zeros(len(parts), np.int64)
        rows = np.flatnonzero(found)
        left = found[rows]
        while len(rows):
            low = left & (~left + np.uint64(1))
            bit = np.frexp(low.astype(np.float64))[1] - 1  # powers of two are exact
            d = ((parts[rows] - self.entries[bit]) ** 2).sum(axis=1)
            nearer = d < best[rows]
            best[rows[nearer]], number[rows[nearer]] = d[nearer], bit[nearer]
            left = left ^ low
            rows, left = rows[left != 0], left[left != 0]
        return number, best

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each part's nearest entry, ties to the lower number."""
        number, best = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        reach = np.full(len(parts), self.radius)
        rows = np.arange(len(parts))
        while len(rows):
            found = self.sliced(parts[rows], reach[rows])
            number[rows], best[rows] = self.measured(parts[rows], found)
            enough = np.ceil(np.sqrt(best[rows].astype(np.float64))).astype(np.int64) + 1
            wider = np.where(found == 0, 2 * reach[rows], enough)
            more = (found == 0) | (best[rows] > reach[rows] ** 2)
            reach[rows] = wider
            rows = rows[more]
        return number, best


@dataclass
class Codebooks:
    """``entries[p, e]``: entry e of part position p."""
    entries: np.ndarray

    def __post_init__(self) -> None:
        self.sliced = [SlicedEntries.of(e) for e in self.entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, (vectors, parts) each."""
        cut = vectors.reshape(len(vectors), len(self.entries), -1)
        got = [s.nearest(cut[:, p]) for p, s in enumerate(self.sliced)]
        return np.stack([n for n, _ in got], axis=1), np.stack([d for _, d in got], axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of doubles as integers floor(SCALE * x), shorter rows filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    sizes = np.diff(lists.offsets.to_numpy())
    if len(flat) and 4.0 * width * np.abs(flat).max() ** 2 >= 2.0 ** 63:
        raise OverflowError(f"vector components of up to {np.abs(flat).max() / SCALE:g} have squared distances beyond 64 bits")
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat.astype(np.int64)
    return out


def usable(vec: Column) -> Column:
    """Not null, and all components are finite."""
    d = vec.cast("array<double>")
    finite = F.forall(d, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vec.isNotNull() & finite, F.lit(False))


def _updated(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by floor(sum / count) of its parts; unused ones stay."""
    context = kept.sparkSession.sparkContext.broadcast(books.entries)  # parts x entries of a vector's width
    parts, size, dims = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]):
        own = Codebooks(context.value)
        total, count = np.zeros((parts, size, dims), object), np.zeros((parts, size), np.int64)
        for b in slices(batches, _ROWS):
            v = integers(b.column(0), parts * dims)
            number, _ = own.assign(v)
            cut = v.reshape(len(v), parts, dims)
            for p in range(parts):
                count[p] += np.bincount(number[:, p], minlength=size)
                for k in range(dims):
                    s = np.zeros(size, np.int64)
                    np.add.at(s, number[:, p], cut[:, p, k])
                    total[p, :, k] += s
        at = [(p, e) for p in range(parts) for e in range(size) if count[p, e]]
        for p, e in at:
            yield pa.RecordBatch.from_arrays([pa.array([p] * dims), pa.array([e] * dims), pa.array(range(dims)), pa.array([str(x) for x in total[p, e]]),
                                              pa.array([int(count[p, e])] * dims)], names=["p", "e", "k", "s", "n"])
    sums = kept.select("v").mapInArrow(run, "p long, e long, k long, s string, n long").groupBy("p", "e", "k").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = books.entries.copy()
    for r in sums.collect():  # a row per component of the codebook at most
        out[r.p, r.e, r.k] = int(r.s) // r.n
    return Codebooks(out)


def fit(kept: DataFrame, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks from rows ``(id, v)`` with usable vectors: begun with the smallest ids (nulls last, equal ids by vector), then ``rounds`` of reassignment."""
    width = kept.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return None
    width = max(-(-width // PARTS) * PARTS, PARTS)
    first = kept.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(ENTRIES).toArrow().column("v")
    books = Codebooks(np.ascontiguousarray(integers(first, width).reshape(len(first), PARTS, -1).transpose(1, 0, 2)))
    for _ in range(rounds):
        books = _updated(kept, books)
    return books


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", rounds: int = ROUNDS,
             max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Rows with a usable vector, and a struct ``codes`` (an input column of that name is replaced): ``code`` (two hex digits a part),
    ``error`` (squared distance), ``label_error`` (its sum over equal labels, nulls together; without ``label_col`` over all rows), ``codebooks_sha256``.

    Rows whose vector is null or has null or non-finite components are dropped. A vector with fewer components than the
    longest, rounded up to a multiple of 16, counts as having zeros for the rest; so does an empty one. Repeated
    rows and ids count each time; ties go to the lower entry; with fewer than 64 rows the codebooks are
    smaller; an empty table gives an empty table. Components so large that 64 bits can't hold a squared distance are an error.
    """
    src = fresh(vectors, "codes")
    names, v = src.columns, unused(src, "_v")
    kept = materialize(src.where(usable(F.col(f"`{vec_col}`"))).withColumn(v, F.col(f"`{vec_col}`").cast("array<double>")), "codes-kept")
    books = fit(kept.select(F.col(f"`{id_col}`").alias("id"), F.col(v).alias("v")), rounds)
    schema = plus(src.schema, "codes struct<code:string,error:bigint>")
    if books is None:
        coded = src.limit(0).withColumn("codes", F.lit(None).cast(schema["codes"].dataType))
        digest = None
    else:
        context = vectors.sparkSession.sparkContext.broadcast(books.entries)
        width, digest = PARTS * books.entries.shape[2], books.digest()

        def run(batches):
            own = Codebooks(context.value)
            for b in slices(batches, _ROWS):
                number, d = own.assign(integers(b.column(v), width))
                code = [bytes(r).hex() for r in number.astype(np.uint8)]
                made = pa.StructArray.from_arrays([pa.array(code, pa.string()), pa.array(d.sum(axis=1))], names=["code", "error"])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), made], names=[*names, "codes"])
        coded = materialize(kept.mapInArrow(run, schema), "codes")
    key, total = unused(coded, "_label"), unused(coded, "_total")
    label = F.lit("") if label_col is None else F.coalesce(F.concat(F.lit("s"), F.col(f"`{label_col}`").cast("string")), F.lit(""))
    keyed = coded.withColumn(key, label)
    sums = keyed.groupBy(key).agg(F.sum("codes.error").alias(total))
    # never one task per label: the sums are broadcast, or joined to salted rows
    joined = sized_join(keyed, sums, [key], "inner", max_bytes=max_broadcast, salt_by=[id_col])
    made = F.struct("codes.code", "codes.error", F.col(total).alias("label_error"), F.lit(digest).cast("string").alias("codebooks_sha256"))
    return joined.withColumn("codes", made).select(*[F.col(f"`{c}`") for c in names], "codes")

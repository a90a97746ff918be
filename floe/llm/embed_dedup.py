"""Embedding near-duplicates by spherical-cap filters.

A filter is a random direction; a vector belongs to every filter whose inner product with it reaches a
threshold (a cap of the sphere). Directions form product codes: the space is turned at random, its
dimensions are cut into blocks, each block has Gaussian code words, and every combination of one word per
block is a direction. The scores of a vector add up block by block, so all directions beyond the threshold
are found by list decoding: partial sums that cannot reach it any more are dropped, and most directions
are never looked at.

Directions of one code share words and so are not independent. Each code turns the space independently, so
every pair at the cosine asked for, whatever its coordinates, is missed by one code with the same
probability. That is measured on random pairs with the words in use, and there are as many codes as it takes
to miss a pair in all of them with probability ``miss`` at most. The threshold follows from the number of
vectors, so that a cap holds few at any size.

Vectors that share a cap are compared in blocks of bounded size (matrix products in double precision);
a pair is counted in the lowest of its common caps only. What leaves a block is one row per vector, a
number of links and a root, never pairs. Equal vectors are compared once, as a class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.llm.common import by_group, connected_components
from floe.session import materialize

MIN_COSINE = 0.93
#: Vectors that a cap is to hold on average, the probability to miss a pair, vectors of one chunk, codes that the words are sized for.
LOAD, MISS, CHUNK, CODES = 24, 1e-8, 256, 12
#: Random pairs that a code's miss is measured on, and the miss beyond which it gets more words.
TRIALS, MAX_LOST = 2000, 0.9
#: Dimensions up to which turns are matrices; beyond, they are three rounds of random signs and a Hartley transform.
MAX_MATRIX = 128
#: Entries of the arrays that decoding makes at a time.
_ENTRIES = 1 << 18
SEED = 20_240_607


def _upper(t: float) -> float:
    return 0.5 * math.erfc(t / math.sqrt(2))


def _quantile(p: float) -> float:
    """t with P(normal >= t) = p."""
    lo, hi = -10.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _upper(mid) > p else (lo, mid)
    return lo


def _joint(t: float, cosine: float) -> float:
    """P(Y >= t | X >= t) of standard normals with correlation ``cosine``."""
    x = t + np.linspace(0, 8, 4001)
    w = np.exp(-(x * x - t * t) / 2)
    spread = math.sqrt(max(1 - cosine * cosine, 1e-12))
    y = np.array([_upper((t - cosine * v) / spread) for v in x])
    return float((w * y).sum() / w.sum())


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


@dataclass
class Caps:
    """``count`` product codes of ``words ** blocks`` directions each in ``dim`` dimensions, and the threshold of a cap."""
    dim: int
    blocks: int
    words: int
    threshold: float
    count: int = CODES

    @staticmethod
    def sized(dim: int, n: int, cosine: float = MIN_COSINE, load: int = LOAD, miss: float = MISS) -> Caps:
        share = min(0.02, load / max(n, 1))
        t = _quantile(share)
        directions = math.log(1 / miss) / _joint(t, cosine) / share / CODES
        blocks = min(dim, 2 if directions < 4e6 else 3 if directions < 4e9 else 4)
        # half the words and more codes: fewer caps for the same miss
        caps = Caps(dim, blocks, math.ceil(directions ** (1 / blocks) / 2), t)
        while (lost := caps.lost(cosine)) > MAX_LOST:
            caps.words = math.ceil(1.5 * caps.words)
        caps.count = math.ceil(math.log(miss) / math.log(lost))
        return caps

    def lost(self, cosine: float) -> float:
        """Probability that a randomly turned pair at ``cosine`` shares no cap of a code, at three standard errors above its measure."""
        rng = np.random.default_rng(SEED - self.dim)
        words, cuts, missed = self._words(), self._cuts(), 0
        size = self.words ** self.blocks
        for part in np.array_split(np.arange(TRIALS), 20):
            x = _unit(rng.standard_normal((len(part), self.dim)))
            y = x
            if self.dim > 1:
                z = rng.standard_normal(x.shape)
                y = cosine * x + math.sqrt(max(1 - cosine * cosine, 0)) * _unit(z - (z * x).sum(axis=1, keepdims=True) * x)
            found = self.decode(x, [(np.arange(self.dim), words)] * len(part))
            at, score = found // size, 0
            for b, (w, v) in enumerate(zip(words, np.split(y, cuts, axis=1))):
                score = score + (v @ w.T)[at, found // self.words ** (self.blocks - 1 - b) % self.words]
            missed += len(part) - len(np.unique(at[score >= self.threshold]))
        p = missed / TRIALS
        return p + 3 * math.sqrt(p * (1 - p) / TRIALS) + 3 / TRIALS

    def _cuts(self) -> np.ndarray:
        return np.cumsum([len(x) for x in np.array_split(np.arange(self.dim), self.blocks)])[:-1]

    def _words(self) -> list[np.ndarray]:
        rng = np.random.default_rng(SEED + self.dim)
        return [rng.standard_normal((self.words, len(x))) for x in np.array_split(np.arange(self.dim), self.blocks)]

    def codes(self) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """Order of the dimensions, after its turn, for each code, and the code words by block, the same for all."""
        rng, words = np.random.default_rng([SEED, self.dim, 1]), self._words()
        return [(rng.permutation(self.dim), words) for _ in range(self.count)]

    def turns(self):
        """Function of unit vectors (n, dim) that gives them turned at random for each code, (n, count, dim)."""
        rng = np.random.default_rng([SEED, self.dim, 2])
        if self.dim > MAX_MATRIX:
            signs = rng.choice([-1.0, 1.0], (3, self.count, self.dim))

            def turn(x: np.ndarray) -> np.ndarray:
                x = x[:, None, :]
                for s in signs:
                    f = np.fft.fft(x * s, norm="ortho")
                    x = f.real - f.imag
                return x
            return turn
        q, r = np.linalg.qr(rng.standard_normal((self.count, self.dim, self.dim)))
        q *= np.sign(np.diagonal(r, axis1=1, axis2=2))[:, None, :]  # uniform over all turns
        every = np.concatenate(list(q), axis=1)
        return lambda x: (x @ every).reshape(len(x), self.count, self.dim)

    def decode(self, x: np.ndarray, codes) -> np.ndarray:
        """Sorted numbers of the directions whose caps hold the unit vector ``x``, or for each code a vector of its own."""
        x = np.take_along_axis(np.broadcast_to(x, (len(codes), self.dim)), np.stack([order for order, _ in codes]), 1)
        scores = [v @ w.T for v, w in zip(np.split(x, self._cuts(), axis=1), codes[0][1])]
        rest = [np.zeros(len(codes))]
        for s in reversed(scores[1:]):
            rest.insert(0, rest[0] + s.max(axis=1))
        step = max(1, _ENTRIES // self.words ** min(2, self.blocks))
        found = []
        for i in range(0, len(codes), step):
            ids = at = np.arange(i, min(i + step, len(codes)))
            sums = np.zeros(len(at))
            for s, r in zip(scores, rest):
                now = sums[:, None] + s[at]
                # partial sums that the best words to come can still lift over the threshold
                row, word = np.nonzero(now >= (self.threshold - r[at])[:, None])
                sums, ids, at = now[row, word], ids[row] * self.words + word, at[row]
            found.append(ids)
        return np.sort(np.concatenate(found))


def _compare(cosine: float, dtype):
    """Links inside a block: ``(cid, n, root)`` for every vector that has one."""
    def unit(raw: list[bytes]) -> np.ndarray:
        x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
        return x / np.sqrt((x * x).sum(axis=1))[:, None]

    def run(t: pa.Table, starts: np.ndarray):
        cid, copies, cap, i, j, chunk = (t.column(c).to_numpy() for c in ("cid", "copies", "f", "i", "j", "c"))
        vec, lists = t.column("vec").to_pylist(), t.column("fs").combine_chunks()
        flat, offs = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        out = ([], [], [])
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
            if e - s < 2:
                continue
            x = unit(vec[s:e])
            near = x @ x.T >= cosine
            if i[s] == j[s]:
                np.fill_diagonal(near, False)
            else:
                side = chunk[s:e] == i[s]
                near &= side[:, None] != side[None, :]
            linked = np.flatnonzero(near.any(axis=1))
            if not len(linked):
                continue
            near = near[np.ix_(linked, linked)]
            rows = s + linked
            # pairs that also share a lower cap are counted there
            low = [f[f < cap[s]] for f in (flat[offs[r]: offs[r + 1]] for r in rows)]
            names, inv = np.unique(np.concatenate(low), return_inverse=True)
            counted = near
            if len(names):
                has = np.zeros((len(rows), len(names)), np.float32)
                has[np.repeat(np.arange(len(rows)), [len(f) for f in low]), inv] = 1
                counted = near & (has @ has.T == 0)
            root = np.arange(len(rows))
            while True:
                new = np.minimum(root, np.where(near, root[None, :], len(rows)).min(axis=1))
                if (new == root).all():
                    break
                root = new
            out[0].append(cid[rows])
            out[1].append(counted @ copies[rows])
            out[2].append(cid[rows][root])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["cid", "n", "root"])
    return run


def near_links(classes: DataFrame, *, cosine: float, dtype: str, dim: int, n_largest: int, load: int, chunk: int) -> DataFrame:
    """Distinct vectors ``(cid, lab, copies, vec)`` of one dimension -> ``(cid, n, root)`` rows, several per vector."""
    caps = Caps.sized(dim, n_largest, cosine, load)

    def decode(batches):
        codes, turn = caps.codes(), caps.turns()
        step = max(1, _ENTRIES // (caps.count * caps.dim))
        for b in batches:
            x = _unit(np.frombuffer(b"".join(b.column("vec").to_pylist()), dtype).reshape(b.num_rows, dim).astype(np.float64))
            found = [caps.decode(v, codes) for i in range(0, len(x), step) for v in turn(x[i: i + step])]
            yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("lab"), pa.array(found, pa.list_(pa.int64()))], names=["cid", "lab", "fs"])

    lists = materialize(classes.select("cid", "lab", "vec").mapInArrow(decode, "cid long, lab long, fs array<long>"), "caps")
    one = lists.select("cid", "lab", F.explode("fs").alias("f"))
    shared = one.groupBy("lab", "f").agg(F.count("*").alias("m")).where("m > 1")
    # chunks of each shared cap; then back to one row per vector, so that vectors are shuffled once, to their blocks
    mine = (one.join(shared, ["lab", "f"]).select("cid", F.struct("f", F.ceil(F.col("m") / chunk).cast("long").alias("b")).alias("fb"))
            .groupBy("cid").agg(F.sort_array(F.collect_list("fb")).alias("fbs")))
    rows = (classes.join(mine, "cid").select("cid", "lab", "copies", "vec", F.col("fbs.f").alias("fs"), F.posexplode("fbs").alias("p", "x"))
            # of a vector's caps only the lower ones go along
            .select("cid", "lab", "copies", "vec", F.slice("fs", F.lit(1), F.col("p")).alias("fs"), F.col("x.f").alias("f"), F.col("x.b").alias("b"))
            .withColumn("c", F.pmod(F.xxhash64("cid", "f"), F.col("b")))
            .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b") - 1)))
            .select("cid", "lab", "copies", "vec", "fs", "f", "c", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j")))
    return by_group(rows, ["lab", "f", "i", "j"], _compare(cosine, dtype), "cid long, n long, root long")


def _label_number(df: DataFrame, col: str) -> Column:
    """Whole-number labels as they are, others as a 64-bit hash; null where the label is null."""
    whole = isinstance(df.schema[col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.col(f"`{col}`").cast("long") if whole else F.when(F.col(f"`{col}`").isNotNull(), F.xxhash64(F.col(f"`{col}`").cast("string")))


def embedding_groups(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     cosine: float = MIN_COSINE, load: int = LOAD, chunk: int = CHUNK) -> DataFrame:
    """Per row ``id_col``, ``n_links`` (other rows at ``cosine`` or more under the same label), ``component_id`` and ``kept``.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label,
    link with nothing and are their own component. Vectors of different lengths never link. Equal
    vectors and repeated rows link with each other. A null id takes part but is never a component's id unless
    all its members' ids are null. Other columns are ignored; an empty table gives an empty table.
    """
    element = vectors.schema[vector_col].dataType.elementType
    wide = "float" if isinstance(element, T.FloatType) else "double"
    dtype = "<f4" if wide == "float" else "<f8"
    vec = F.col(f"`{vector_col}`").cast(f"array<{wide}>")
    src = vectors.select(F.col(f"`{id_col}`").alias("id"), _label_number(vectors, label_col).alias("lab"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.col("vec").isNotNull() & F.col("lab").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)
    rows = src.withColumn("ok", F.coalesce(ok, F.lit(False)))
    rows = rows.withColumns({"k1": F.when(F.col("ok"), F.xxhash64("lab", "vec")), "k2": F.when(F.col("ok"), F.xxhash64("vec", "lab", F.lit("second")))})

    def raw(batches):
        for b in batches:
            data = [v.values.to_numpy(zero_copy_only=False).astype(dtype).tobytes() for v in b.column("vec")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("k1", "k2", "lab", "copies", "low")), pa.array(data, pa.binary())],
                                             names=["k1", "k2", "lab", "copies", "low", "vec"])
    id_type = src.schema["id"].dataType.simpleString()
    classes = (rows.where("ok").groupBy("k1", "k2").agg(F.first("lab").alias("lab"), F.count("*").alias("copies"), F.min("id").alias("low"), F.first("vec").alias("vec"))
               .select("k1", "k2", "lab", "copies", "low", "vec").mapInArrow(raw, f"k1 long, k2 long, lab long, copies long, low {id_type}, vec binary"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("size", F.length("vec")), "vectors")

    links = None
    itemsize = np.dtype(dtype).itemsize
    largest = classes.groupBy("size", "lab").agg(F.count("*").alias("n")).groupBy("size").agg(F.max("n").alias("n")).collect()
    for s in largest:  # one code for each length of vectors
        part = near_links(classes.where(F.col("size") == s.size), cosine=cosine, dtype=dtype, dim=s.size // itemsize, n_largest=s.n, load=load, chunk=chunk)
        links = part if links is None else links.unionByName(part)
    own = src.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if links is None:
        return own
    links = materialize(links, "vector-links")
    roots = connected_components(links.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct())
    counts = links.groupBy("cid").agg(F.sum("n").alias("n"))
    known = (classes.select("k1", "k2", "cid", "copies", "low").join(counts, "cid", "left")
             .join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
             .select("k1", "k2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "low", F.coalesce("root", "cid").alias("root")))
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = materialize(known.join(lows, "root").select("k1", "k2", "n_links", "component_id"), "vector-classes")
    found = (rows.select("id", "ok", "k1", "k2").join(known, ["k1", "k2"], "left"))
    n = F.coalesce("n_links", F.lit(0)).cast("long")
    comp = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(id_col), n.alias("n_links"), comp.alias("component_id"), F.col("id").eqNullSafe(comp).alias("kept"))

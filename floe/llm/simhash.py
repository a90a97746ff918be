"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: 64 bits, each the majority of that bit over the XXH64 of all word shingles.

Candidates. The binary Golay code (23, 12) is perfect with radius 3: every 23-bit word decodes to one
12-bit index. The indices of a word and of its 23 neighbours at one bit are 1 or 6 in number, and two
words at 2 or fewer bits have one in common, since some word lies within one bit of both. A fingerprint
is cut into segments of 23, 23 and 18 bits. At 2 or fewer differing bits one segment is free of errors
(pigeonhole) and the next one, in a circle, has 2 at most: so two such fingerprints share a key made of
the exact segment and one Golay index of the next. Keys are joined and distances verified.

A key held by more than ``bucket`` fingerprints is not paired. Its fingerprints instead meet at common
neighbours: two fingerprints at 2 or fewer bits have a word within one bit of both, and all
fingerprints around one word are linked, 65 at most. This is exact, with 65 rows a fingerprint at most.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import connected_components, plus, row_hash, utf8, word_pieces
from floe.session import materialize

SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: Fingerprints of one key that are compared in pairs; more go by common neighbours.
BUCKET = 32
_CHUNK = 1 << 16

#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY_POLY = 0b101011100011


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of ``shingle``-word shingles; text without words: 0."""
    counts, n, held = np.zeros(64, np.int64), 0, []
    for words in word_pieces((text or b"").lower()):
        words = held + words
        if len(words) >= shingle:
            counts += _bit_counts(words, shingle)
            n += len(words) - shingle + 1
        held = words[1 - shingle:] if shingle > 1 else []
    if not n:
        if not held:
            return 0
        counts, n = _bit_counts(held, len(held)), 1
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _bit_counts(words: list[bytes], k: int) -> np.ndarray:
    """How many of the hashes of all ``k``-word shingles have each bit."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    spans = list(zip(begins[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()))
    h = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(spans), _CHUNK):
        part = np.array([h(joined[a:b], SEED) for a, b in spans[i:i + _CHUNK]], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def _syndrome(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][words & 255] ^ table[1][(words >> 8) & 255] ^ table[2][(words >> 16) & 127]


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainder tables by byte, and the error pattern (weight 3 at most) of each remainder."""
    rem = []
    for i in range(23):
        r = 1 << i
        for b in range(22, 10, -1):
            if r >> b & 1:
                r ^= GOLAY_POLY << (b - 11)
        rem.append(r)
    table = np.zeros((3, 256), np.int64)
    for k in range(3):
        for v in range(256):
            for j in range(8):
                if v >> j & 1 and 8 * k + j < 23:
                    table[k][v] ^= rem[8 * k + j]
    errors = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= rem[b]
            errors[s] = sum(1 << b for b in bits)
    return table, errors


def golay_indices(words: np.ndarray) -> np.ndarray:
    """(n,) 23-bit words -> (n, 24) sorted indices of the word and its neighbours at one bit; repeats are -1."""
    table, errors = _golay()
    flips = np.concatenate(([0], 1 << np.arange(23)))
    w = words[:, None] ^ flips[None, :]
    idx = np.sort((w ^ errors[_syndrome(w, table)]) >> 11, axis=1)
    idx[:, 1:][idx[:, 1:] == idx[:, :-1]] = -1
    return idx


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint64 fingerprints -> (row numbers, keys): circle position, exact segment, Golay index of the next."""
    seg = [(fps & np.uint64((1 << 23) - 1)).astype(np.int64), ((fps >> np.uint64(23)) & np.uint64((1 << 23) - 1)).astype(np.int64),
           (fps >> np.uint64(46)).astype(np.int64)]
    rows, keys = [], []
    for i in range(3):
        idx = golay_indices(seg[(i + 1) % 3])
        r, c = np.nonzero(idx >= 0)
        rows.append(r)
        keys.append((np.int64(i) << 35) | (seg[i][r] << 12) | idx[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(docs: DataFrame, *, text_col: str = "text", keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of every row and ``fp`` (the fingerprint as a signed long)."""
    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in utf8(b.column("_text"))), np.uint64, b.num_rows)
            cols = [b.column(c) for c in keep] + [pa.array(fp.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "fp"])
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = plus(src.drop("_text").schema, "fp long")
    return src.mapInArrow(run, schema)


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Distinct ``fp`` -> links ``(a, b)`` that connect exactly what links at ``max_bits`` or fewer bits connect."""
    if not 0 <= max_bits <= 2:
        raise ValueError("one Golay segment covers two errors: max_bits is 0, 1 or 2")

    def run(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            rows, keys = fuzzy_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["key", "fp"])

    keys = fps.select("fp").mapInArrow(run, "key long, fp long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = materialize(keys.join(shared, "key"), "golay-keys")
    apart = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    small = keyed.where(F.col("n") <= bucket)
    pairs = (small.alias("a").join(small.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & apart)
             .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct())

    masks = [0] if max_bits == 0 else [0, *((1 << i) - (1 << 64 if i == 63 else 0) for i in range(64))]
    crowd = keyed.where(F.col("n") > bucket).select("fp").distinct()
    around = crowd.select("fp", F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.col("fp").bitwiseXOR(m))).alias("w"))
    if max_bits == 1:
        # two fingerprints at one bit: the even one stands for the pair
        odd = F.bit_count("fp") % 2 == 1
        around = around.where(odd | (F.col("w") == F.col("fp")))
    met = around.groupBy("w").agg(F.collect_list("fp").alias("near")).where(F.size("near") > 1)
    if max_bits == 1:
        met = met.where(F.array_contains("near", F.col("w")))
        star = met.select(F.explode("near").alias("a"), F.col("w").alias("b")).where("a <> b")
    else:
        star = met.select(F.explode("near").alias("a"), F.array_min("near").alias("b")).where("a <> b")
    return pairs.unionByName(star)


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, extra: list[str] | None = None) -> DataFrame:
    """Every row's ``id_col`` (and ``extra`` columns), ``fp``, ``root`` (of its group, a fingerprint) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` or fewer bits. Null and
    wordless texts have fingerprint 0 and link like any other. Rows with a null id take part; the
    component of null ids only is null. Equal texts, tied and repeated rows share a fingerprint and are
    one node. Other columns are ignored; an empty table gives an empty table.
    """
    keep = list(dict.fromkeys([id_col, *(extra or [])]))
    rows = materialize(fingerprints(docs, text_col=text_col, keep=keep, shingle=shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("low")), "fingerprint-nodes")
    roots = connected_components(fingerprint_links(nodes, max_bits))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    nodes = materialize(nodes.join(lows, "root").select("fp", "root", "component_id"), "fingerprint-components")
    return rows.join(nodes, "fp")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null last), ties by a hash of the row.

    The choice is made on (id, row hash) only; the texts are shuffled once, to join the choice.
    """
    hashed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), row_hash(docs).alias("rh"))
    grouped = simhash_groups(hashed, id_col="id", text_col="text", shingle=shingle, max_bits=max_bits, extra=["rh"])
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("rh").alias("h"))
    chosen = grouped.groupBy("root").agg(F.min(order).alias("c"))
    key = lambda i, h: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("~")), h.cast("string"))
    chosen = chosen.select(key(F.col("c.i"), F.col("c.h")).alias("_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key(F.col(f"`{id_col}`"), row_hash(docs)).alias("_key"))
    return rows.join(chosen, "_key").groupBy("_key").agg(F.first("_row").alias("_row")).select("_row.*")

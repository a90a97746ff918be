"""Exact removal of repeated substrings, with a sparse suffix array spread over Spark tasks.

Every byte covered by a string of ``min_bytes`` that also starts elsewhere (in any document, overlaps
counted) is removed. Four steps:

1. Anchors. Suffixes are sorted only where they must be: at positions picked by their content. Of all
   ``GRAM``-byte strings in a window of ``min_bytes`` the one with the lowest hash is an anchor, so equal
   windows have equal anchors, and every repeat of ``min_bytes`` holds one in each occurrence. An
   anchor's context is the stretch in which windows around it can lie.
2. Only grams that occur twice go on. Their number sets the size of a Bloom filter (bounded; it only
   saves shuffling, a join decides), by which a second scan sends on the anchors that may repeat.
   Anchors whose whole context occurs twice are settled by counting.
3. The other contexts meet by gram, each distinct context once (tasks send the bytes of a context once). A group is an enhanced sparse suffix array:
   the suffixes at the anchors, sorted, with their common prefixes. A stack scan gives its intervals; in
   each, the texts to the left are sorted and scanned the same way, and a left interval whose members
   differ in what precedes it, and which is not one of a deeper right interval, is a maximal repeat with all
   its occurrences.
4. Groups of more than ``group`` distinct contexts are never gathered. Their windows are parted by position:
   the bytes common to all windows of a part make a longer key, and the rows are grouped anew, down to
   single windows, where equality of keys settles all.

Documents are known by a hash of their text (128 bits of SHA-256); equal texts have equal results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.llm.common import by_group, fresh, plus, slices, utf8
from floe.operators.joins import broadcast_checked
from floe.session import materialize

MIN_BYTES = 200
GRAM = 80
#: Distinct contexts of a key that are sorted in one task.
GROUP = 256
#: Parts that the windows of larger groups are cut into at a time.
PARTS = 4
#: Contexts that a task remembers having sent.
SENT = 100_000
#: Bits of a Bloom filter for each gram, and at most.
BLOOM_BITS, BLOOM_MAX = 16, 1 << 27
#: Bytes looked at together; bounds a worker's arrays whatever the length of a text.
PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Anchors:
    """Picks the anchors of texts; one per task."""

    def __init__(self, min_bytes: int, gram: int = GRAM):
        if min_bytes <= gram:
            raise ValueError("a repeat is longer than a gram")
        self.min_bytes, self.gram, self.width = min_bytes, gram, min_bytes - gram + 1
        n = PIECE + 4 * min_bytes
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of the gram at every position that has one; never zero."""
        q, n = self.gram, len(data)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
            h = (sums[q:] - sums[:-q]) * self.down[: n - q + 1]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return h | np.uint64(1)

    def _extreme(self, h: np.ndarray, op, fill: int) -> np.ndarray:
        """``op`` over each ``width`` consecutive values: from block-wise running values, in linear time."""
        w, n = self.width, len(h)
        blocks = -(-n // w)
        padded = np.full(blocks * w, fill, np.uint64)
        padded[:n] = h
        grid = padded.reshape(blocks, w)
        ahead = op.accumulate(grid, axis=1).ravel()
        back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        return op(back[: n - w + 1], ahead[w - 1: n])

    def _pick(self, data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of anchors; ``valid`` marks the positions at which a window starts."""
        h = self._hashes(data)
        low = self._extreme(h, np.minimum, _MASK)
        low[~valid[: len(low)]] = 0
        pad = np.zeros(self.width - 1, np.uint64)
        held = self._extreme(np.concatenate([pad, low, pad]), np.maximum, 0)
        at = np.flatnonzero(held == h)
        return at, h[at]

    def of_texts(self, texts: list[bytes]):
        """Yields (number of the text, positions, hashes); short texts are looked at together."""
        held, size = [], 0
        for i, t in enumerate(texts):
            if len(t) < self.min_bytes:
                continue
            if len(t) > PIECE:
                yield i, *self._long(t)
                continue
            if size + len(t) > PIECE:
                yield from self._together(held)
                held, size = [], 0
            held.append((i, t))
            size += len(t)
        yield from self._together(held)

    def _together(self, held):
        if not held:
            return
        data = np.frombuffer(b"".join(t for _, t in held), np.uint8)
        ends = np.cumsum([len(t) for _, t in held])
        valid = np.ones(len(data), bool)
        for e in ends:
            valid[e - self.min_bytes + 1: e] = False
        at, h = self._pick(data, valid)
        cuts = np.searchsorted(at, ends)
        a = 0
        for (i, t), b, e in zip(held, cuts, ends):
            yield i, at[a:b] - (e - len(t)), h[a:b]
            a = b

    def _long(self, t: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Windows that start in one piece are looked at with what they reach; an anchor may come twice."""
        found: dict[int, int] = {}
        for a in range(0, len(t) - self.min_bytes + 1, PIECE):
            data = np.frombuffer(t[a: a + PIECE + self.min_bytes - 1], np.uint8)
            valid = np.zeros(len(data), bool)
            valid[: len(data) - self.min_bytes + 1] = True
            at, h = self._pick(data, valid)
            found.update(zip((at + a).tolist(), h.tolist()))
        at = np.array(sorted(found), np.int64)
        return at, np.array([found[int(p)] for p in at], np.uint64)

    def contexts(self, t: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) byte of each anchor's context."""
        return np.maximum(at - (self.min_bytes - self.gram), 0), np.minimum(at + self.min_bytes, len(t))


def _digest(data: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(data, seed)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


class Bloom:
    """Two bits for each key."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, keys: np.ndarray) -> np.ndarray:
        m = np.uint64(len(self.words) * 64 - 1)
        hit = np.ones(len(keys), bool)
        for p in (keys & m, (keys >> np.uint64(34)) & m):
            hit &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return hit

    @staticmethod
    def of(keys: DataFrame, n: int, column: str = "ah") -> Bloom:
        """Filter of ``n`` distinct long keys. What reaches the driver is the filter, bounded by ``BLOOM_MAX`` bits."""
        bits = min(BLOOM_MAX, 1 << max(16, math.ceil(math.log2(max(1, n * BLOOM_BITS)))))
        c = F.col(column)
        both = F.array(c.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(c, 34).bitwiseAND(F.lit(bits - 1)))
        one = keys.select(F.explode(both).alias("p"))
        # a 64-bit shift of a long one, folded by word
        words = (one.select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 AS int))").alias("b"))
                 .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
        out = np.zeros(bits // 64, np.uint64)
        out[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
        return Bloom(out)


def text_key(data: Column) -> Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, 16)


def _bytes(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))


def _anchor_keys(texts: DataFrame, min_bytes: int, gram: int) -> DataFrame:
    """``(ah, ch)`` of every anchor: hashes of its gram and of its context."""
    def run(batches):
        pick = Anchors(min_bytes, gram)
        for b in slices(batches):
            data = list(utf8(b.column("data")))
            for i, at, h in pick.of_texts(data):
                t = data[i]
                lo, hi = pick.contexts(t, at)
                ch = [_digest(t[a:c], p - a) for a, c, p in zip(lo.tolist(), hi.tolist(), at.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), _signed(ch)], names=["ah", "ch"])
    return texts.select("data").mapInArrow(_merged(run), "ah long, ch long")


def _merged(run, rows: int = 20_000):
    """Small batches of ``run`` put together, as each batch costs a trip to the JVM."""
    def out(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if n:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return out


_HITS = "ah long, ch long, k binary, pos int, left int, right int, ctx binary, mixed boolean"


def _anchor_hits(texts: DataFrame, min_bytes: int, gram: int, any_of, mixed) -> DataFrame:
    """Anchors that a filter lets through; ``mixed`` by another filter if their gram has several contexts, then
    with the bytes of the context when the task meets it first."""
    def run(batches):
        pick, sent = Anchors(min_bytes, gram), set()
        for b in slices(batches):
            data, keys = list(utf8(b.column("data"))), b.column("k")
            for i, at, h in pick.of_texts(data):
                hit = any_of.value.has(h)
                if not hit.any():
                    continue
                at, h, t = at[hit], h[hit], data[i]
                more = mixed.value.has(h)
                lo, hi = pick.contexts(t, at)
                left = at - lo
                digests, ctx = [], []
                for a, c, x, m, g in zip(lo.tolist(), hi.tolist(), left.tolist(), more.tolist(), h.tolist()):
                    part = t[a:c]
                    d = _digest(part, x)
                    digests.append(d)
                    if m and (g, d) not in sent:
                        if len(sent) >= SENT:
                            sent.clear()
                        sent.add((g, d))
                        ctx.append(part)
                    else:
                        ctx.append(None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), _signed(digests), pa.array([keys[i].as_py()] * len(at), pa.binary()),
                     pa.array(at.astype(np.int32)), pa.array(left.astype(np.int32)), pa.array((hi - at).astype(np.int32)),
                     pa.array(ctx, pa.binary()), pa.array(more)],
                    names=["ah", "ch", "k", "pos", "left", "right", "ctx", "mixed"])
    return texts.select("k", "data").mapInArrow(_merged(run), _HITS)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n - 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _intervals(lcp: list[int], least: int):
    """Intervals (first, last, depth) of sorted strings that share ``depth`` >= ``least`` bytes and no more, by a stack scan.

    ``lcp[i]`` is what strings i and i + 1 share.
    """
    stack: list[tuple[int, int]] = []
    for i, d in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][1] > d:
            first, depth = stack.pop()
            yield first, i, depth
        if d >= least and (not stack or stack[-1][1] < d):
            stack.append((first, d))


def maximal_repeats(contexts: list[tuple[bytes, bytes]], min_bytes: int):
    """Maximal repeats of ``min_bytes`` around one gram: yields (members, bytes shared to the left, to the right).

    ``contexts`` are distinct pairs (bytes before the anchor, reversed; bytes from the anchor on).
    """
    if len(contexts) == 2:
        (l0, r0), (l1, r1) = contexts
        right = _common(r0, r1)
        left = _common(l0, l1) if right + min(len(l0), len(l1)) >= min_bytes else 0
        if left + right >= min_bytes:
            yield [0, 1], left, right
        return
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    suffix = [contexts[i][1] for i in order]
    most = max(len(x[0]) for x in contexts)
    lcp = [_common(a, b) for a, b in zip(suffix, suffix[1:])]
    for first, last, right in _intervals(lcp, min_bytes - most):
        rank = {order[i]: i for i in range(first, last + 1)}
        by_left = sorted(rank, key=lambda i: contexts[i][0])
        before = [contexts[i][0] for i in by_left]
        lcs = [_common(a, b) for a, b in zip(before, before[1:])]
        for a, b, left in _intervals(lcs, min_bytes - right):
            members = by_left[a: b + 1]
            ranks = sorted(rank[i] for i in members)
            # the members differ to the left of ``left``; if they agree beyond ``right``, a deeper interval has them
            if min(lcp[ranks[0]: ranks[-1]]) == right:
                yield members, left, right


def _repeats_in_groups(groups: DataFrame, min_bytes: int) -> DataFrame:
    """``(ah, c, k, pos, left, ctx)``, a row per distinct context -> spans ``(k, b, e)`` of the single ones.

    All repeats around an occurrence hold its anchor, so their union is one span.
    """
    def run(t: pa.Table, starts: np.ndarray):
        c, pos, left = (t.column(x).to_numpy() for x in ("c", "pos", "left"))
        ctx, keys = t.column("ctx").to_pylist(), t.column("k")
        ends = [*starts[1:].tolist(), t.num_rows]
        ks, b, e = [], [], []
        for s, end in zip(starts.tolist(), ends):
            if end - s < 2:
                continue
            sides = []
            for i in range(s, end):
                at = int(left[i])
                sides.append((ctx[i][:at][::-1], ctx[i][at:]))
            reach: dict[int, tuple[int, int]] = {}
            for members, l, r in maximal_repeats(sides, min_bytes):
                for m in members:
                    x, y = reach.get(m, (0, 0))
                    reach[m] = max(x, l), max(y, r)
            for m, (l, r) in reach.items():
                if c[s + m] == 1:
                    ks.append(s + m)
                    b.append(int(pos[s + m]) - l)
                    e.append(int(pos[s + m]) + r)
        if ks:
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(ks)).combine_chunks(), pa.array(b, pa.int32()), pa.array(e, pa.int32())], names=["k", "b", "e"])
    return by_group(groups.select("ah", "c", "k", "pos", "left", "ctx"), ["ah"], run, "k binary, b int, e int")


def _parted(rows: DataFrame, min_bytes: int) -> DataFrame:
    """Each context's windows in parts, keyed by what all windows of a part share; the context cut to the part."""
    def run(batches):
        for b in batches:
            n = b.num_rows
            ah, left, lo, hi = (b.column(x).to_pylist() for x in ("ah", "left", "lo", "hi"))
            ctx = b.column("ctx").to_pylist()
            take, out = [], {x: [] for x in ("ah", "ch", "left", "right", "ctx", "lo", "hi")}
            for i in range(n):
                step = -(-(hi[i] - lo[i] + 1) // PARTS)
                at, data = left[i], ctx[i]
                for x in range(lo[i], hi[i] + 1, step):
                    y = min(x + step - 1, hi[i])
                    # windows start at x..y from the anchor; those that the context holds
                    s, t = max(x, -at), min(y, len(data) - at - min_bytes)
                    if s > t:
                        continue
                    part = data[at + s: at + t + min_bytes]
                    take.append(i)
                    out["ah"].append(_digest(data[at + y: at + x + min_bytes], (ah[i] * 1009 + x) & _MASK))
                    out["ch"].append(_digest(part, s & _MASK))
                    out["left"].append(-s)
                    out["right"].append(t + min_bytes)
                    out["ctx"].append(part)
                    out["lo"].append(x)
                    out["hi"].append(y)
            pick = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [_signed(out["ah"]), _signed(out["ch"]), *(b.column(x).take(pick) for x in ("c", "k", "pos")),
                 *(pa.array(out[x], pa.int32()) for x in ("left", "right")), pa.array(out["ctx"], pa.binary()),
                 *(pa.array(out[x], pa.int32()) for x in ("lo", "hi"))],
                names=["ah", "ch", "c", "k", "pos", "left", "right", "ctx", "lo", "hi"])
    return rows.select("ah", "c", "k", "pos", "left", "ctx", "lo", "hi").mapInArrow(
        run, "ah long, ch long, c long, k binary, pos int, left int, right int, ctx binary, lo int, hi int")


def _resolve(rows: DataFrame, min_bytes: int, group: int, levels: int) -> list[DataFrame]:
    """Spans of occurrences ``(ah, ch, c, k, pos, left, right, ctx, lo, hi)``; ``c`` counts occurrences that a row stands for.

    Rows that stand for several are partners only: their own spans were found when they were put together.
    ``ctx`` is null where another row with the same ``ah`` and ``ch`` has it.
    """
    spans = []
    for _ in range(levels + 1):
        # k and pos are those of the only occurrence, or not used
        each = materialize(rows.groupBy("ah", "ch").agg(
            F.sum("c").alias("c"), *[F.max(x).alias(x) for x in ("k", "pos", "left", "ctx", "lo", "hi")]), "contexts")
        twice = each.where("c > 1").select("ah", "ch")
        spans.append(rows.where((F.col("c") == 1) & (F.col("left") + F.col("right") >= min_bytes)).select("ah", "ch", "k", "pos", "left", "right")
                     .join(twice, ["ah", "ch"])
                     .select("k", (F.col("pos") - F.col("left")).alias("b"), (F.col("pos") + F.col("right")).alias("e")))
        # the keys of large groups are few; they are broadcast when a count proves it, else joined by a shuffle
        large = materialize(each.groupBy("ah").agg(F.count("*").alias("m")).where(F.col("m") > group).select("ah"), "large-groups")
        if large.isEmpty():
            return [*spans, _repeats_in_groups(each, min_bytes)]
        large = broadcast_checked(large, 16 << 20)
        spans.append(_repeats_in_groups(each.join(large, "ah", "left_anti"), min_bytes))
        rows = materialize(_parted(each.join(large, "ah", "left_semi"), min_bytes), "parts")
        # keys that occur once need no further look
        again = rows.groupBy("ah").agg(F.sum("c").alias("n")).where("n > 1").select("ah")
        rows = rows.join(again, "ah")
    raise RuntimeError("windows were parted down to one and still differ")


def repeat_spans(docs: DataFrame, *, text_col: str = "text", min_bytes: int = MIN_BYTES, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``(k, spans)``: for each text with repeats, its key and an unordered array of begin * 2^32 + end."""
    spark = docs.sparkSession
    data = _bytes(docs, text_col)
    texts = docs.select(data.alias("data")).where(F.length("data") >= min_bytes).select(text_key(F.col("data")).alias("k"), "data")
    repeated = materialize(_anchor_keys(texts, min_bytes, gram).groupBy("ah")
                           .agg(F.count("*").alias("n"), F.min("ch").alias("a"), F.max("ch").alias("z")).where("n > 1")
                           .select("ah", (F.col("a") != F.col("z")).alias("mixed")), "repeated-grams")
    counts = repeated.agg(F.count("*"), F.count_if("mixed")).first()
    every = spark.sparkContext.broadcast(Bloom.of(repeated, counts[0]))
    mixed = spark.sparkContext.broadcast(Bloom.of(repeated.where("mixed"), counts[1]))
    hits = materialize(_anchor_hits(texts, min_bytes, gram, every, mixed), "anchors")
    # what passes a filter by chance: here the join drops it, among the mixed it is alone with its gram
    whole = (hits.where(~F.col("mixed") & (F.col("left") + F.col("right") >= min_bytes)).select("ah", "k", "pos", "left", "right")
             .join(repeated.where("not mixed").select("ah"), "ah")
             .select("k", (F.col("pos") - F.col("left")).alias("b"), (F.col("pos") + F.col("right")).alias("e")))
    span = min_bytes - gram
    rows = hits.where("mixed").select("ah", "ch", F.lit(1).cast("long").alias("c"), "k", "pos", "left", "right", "ctx",
                                      F.lit(-span).alias("lo"), F.lit(0).alias("hi"))
    spans = [whole]
    if counts[1]:
        spans += _resolve(rows, min_bytes, group, math.ceil(math.log(span + 1, PARTS)) + 1)
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    packed = (F.col("b").cast("long") * (1 << 32) + F.col("e")).alias("s")
    return out.select("k", packed).groupBy("k").agg(F.collect_set("s").alias("spans"))


def remove_repeats(docs: DataFrame, *, text_col: str = "text", min_bytes: int = MIN_BYTES, gram: int = GRAM, group: int = GROUP,
                   as_text: bool = False) -> DataFrame:
    """``docs`` with a struct ``dedup`` (an input column of that name is replaced): ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs) and ``kept`` (the remaining bytes; cuts may split a character). With
    ``as_text``, ``kept`` is a string, without what is left of split characters.

    Null text counts as empty and keeps nothing. Texts under ``min_bytes`` are whole. Copies and repeated rows
    repeat each other entirely; ids play no part, so ties don't matter. An empty table gives an empty table.
    """
    src = fresh(docs, "dedup")
    names = src.columns
    spans = repeat_spans(src, text_col=text_col, min_bytes=min_bytes, gram=gram, group=group)
    data = src.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), _bytes(src, text_col).alias("data"))
    joined = data.withColumn("k", text_key(F.col("data"))).join(spans, "k", "left").select("row", "data", "spans")

    def run(batches):
        for b in batches:
            n = np.zeros((3, b.num_rows), np.int64)
            kept = []
            for i, (t, s) in enumerate(zip(utf8(b.column("data")), b.column("spans"))):
                n[0, i] = len(t)
                if not s.is_valid:
                    kept.append(t)
                    continue
                cut = np.sort(s.values.to_numpy())
                begins, ends = cut >> 32, np.maximum.accumulate(cut & 0xFFFFFFFF)
                first = np.concatenate([[True], begins[1:] > ends[:-1]])
                a, z = begins[first], ends[np.concatenate([first[1:], [True]])]
                n[1, i], n[2, i] = (z - a).sum(), len(a)
                stay = zip([0, *z.tolist()], [*a.tolist(), len(t)])
                kept.append(b"".join([t[x:y] for x, y in stay]))
            left = pa.array([t.decode("utf-8", "ignore") for t in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            made = pa.StructArray.from_arrays([*(pa.array(x) for x in n), left],
                                              names=["n_bytes", "n_removed", "n_spans", "kept"])
            yield pa.RecordBatch.from_arrays([b.column("row"), made], names=["row", "dedup"])
    schema = plus(joined.select("row").schema, f"dedup struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept:{'string' if as_text else 'binary'}>")
    return joined.mapInArrow(run, schema).select("row.*", "dedup")

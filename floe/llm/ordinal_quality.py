"""Quality classifier: ordinal regression with cumulative links on graded ratings.

P(grade >= k) = sigmoid(score - threshold_k): one set of hashed-text weights is shared by all grades and the
thresholds are ordered (the first plus positive gaps). Features of a text are the presence of its
words and of their beginnings, hashed, and the relative frequencies of its adjacent byte pairs.

The model is fitted on a bounded sample of rated rows (``max_train``, those whose ids hash lowest)
by full-batch Adam on the driver, which receives the features that the tasks made, never texts; every document is then
scored in one pass over its whole text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import fresh, plus, unused, utf8

WORD_BUCKETS = 1 << 17
#: Bytes of a word's beginning that make a feature beside the whole word.
STEMS = (4, 5, 6)
#: Frequencies are scaled so that their weights are of the size of the word weights.
PAIR_SCALE = 50.0
#: Rated rows that the model is fitted on, at most.
MAX_TRAIN = 8_000
#: Byte pairs nearer to no correlation with the grade than so many standard errors are left out.
MIN_Z = 4.0
#: Texts added to each word's counts at the base rate.
SMOOTHING = 10.0
#: A document is selected when its probability of the best grade is this at least.
MIN_TAIL = 0.8
#: A byte pair weighs nothing in an empty text; texts are looked at in pieces of this size.
_PIECE = 1 << 20
#: Entries of the design that are multiplied at a time; bounds the driver's temporary arrays.
_BLOCK = 1 << 19
_LETTERS = re.compile(rb"[a-z0-9\x80-\xff]+")


def word_buckets(text: bytes) -> np.ndarray:
    """Sorted hashed ids of the distinct words, of any length, and of their beginnings of ``STEMS`` bytes.

    Words are runs of ASCII letters and digits (lower-cased) and non-ASCII bytes.
    """
    if len(text) > _PIECE:  # without a list of all words
        words = {m[0] for m in _LETTERS.finditer(text.lower())}
    else:
        words = set(_LETTERS.findall(text.lower()))
    words |= {w[:k] for k in STEMS for w in words if len(w) > k}
    return np.unique(np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in words), np.int64, len(words)))


def _pairs(text: bytes):
    """Adjacent byte pairs as numbers below 65536, piece by piece."""
    for i in range(0, max(len(text) - 1, 0), _PIECE):
        a = np.frombuffer(text[i:i + _PIECE + 1], np.uint8).astype(np.int64)
        yield (a[:-1] << 8) | a[1:]


@dataclass
class OrdinalModel:
    words: np.ndarray       # weight by word bucket
    pairs: np.ndarray       # weight by byte pair
    thresholds: np.ndarray  # ascending, one fewer than grades

    def score(self, text: bytes | None) -> float:
        if not text:
            return 0.0
        s = float(self.words[word_buckets(text)].sum())
        if len(text) > 1:
            s += PAIR_SCALE * sum(float(self.pairs[p].sum()) for p in _pairs(text)) / (len(text) - 1)
        return s

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """(n, grades - 1) probabilities of grade >= 1, 2, ..."""
        return 1.0 / (1.0 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)))


#: Word buckets, byte pairs and their counts in a text: at most 131,072 and 65,536 numbers, however long it is.
Features = tuple[np.ndarray, np.ndarray, np.ndarray]
_PACKED = (np.int32, np.uint16, np.int32)


def features(text: bytes) -> Features:
    counts = np.zeros(65536, np.int64)
    for p in _pairs(text):
        counts += np.bincount(p, minlength=65536)
    pairs = counts.nonzero()[0]
    return tuple(a.astype(t) for a, t in zip((word_buckets(text), pairs, counts[pairs]), _PACKED))


def _frequencies(counts: np.ndarray) -> np.ndarray:
    """Scaled relative frequencies of a text's byte pairs."""
    return PAIR_SCALE * counts / max(counts.sum(), 1)


def _associated_pairs(rows: list[Features], grades: np.ndarray, min_z: float) -> np.ndarray:
    """Byte pairs whose correlation with the grade is beyond ``min_z`` standard errors in the sample."""
    n, g = len(grades), grades - grades.mean()
    s1, s2, sg = np.zeros((3, 65536))
    for (_, p, c), x in zip(rows, g):
        v = _frequencies(c)
        s1[p] += v
        s2[p] += v * v
        sg[p] += v * x
    spread = np.sqrt(np.maximum(s2 - s1 * s1 / n, 0) * max(g @ g, 1e-12))
    return np.abs(sg) * np.sqrt(n) > min_z * np.maximum(spread, 1e-9)


def _design(rows: list[Features], pairs: np.ndarray):
    """Rows of (feature, value) as flat arrays with row starts; the byte pairs in use come after the word buckets."""
    ptr = np.cumsum([0] + [len(w) + int(pairs[p].sum()) for w, p, _ in rows])
    idx, val = np.empty(ptr[-1], np.int32), np.ones(ptr[-1], np.float32)
    for (w, p, c), i, j in zip(rows, ptr, ptr[1:]):
        used, mid = pairs[p], i + len(w)
        idx[i:mid], idx[mid:j] = w, p[used].astype(np.int32) + WORD_BUCKETS
        val[mid:j] = _frequencies(c)[used]
    return idx, val, ptr


def _blocks(n: int):
    return [slice(i, i + _BLOCK) for i in range(0, n, _BLOCK)]


def _odds(idx: np.ndarray, row: np.ndarray, grades: np.ndarray, n_grades: int, d: int) -> np.ndarray:
    """Scale of a word feature: half the square of its smoothed log odds of a grade below the best, against the base rate.

    Words seen in few texts, or as often in good ones, are scaled down and so can't be learnt by heart.
    Byte pairs keep a scale of one.
    """
    low = grades < n_grades - 1
    base = min(max(low.mean(), 1e-3), 1 - 1e-3)
    worse, better = np.zeros((2, d))
    for b in _blocks(len(idx)):
        n = np.bincount(idx[b], weights=low[row[b]], minlength=d)
        worse += n
        better += np.bincount(idx[b], minlength=d) - n
    out = (np.log((worse + SMOOTHING * base) / (better + SMOOTHING * (1 - base))) - np.log(base / (1 - base))) ** 2 / 2
    out[WORD_BUCKETS:] = 1.0
    return out


def fit(texts: list[bytes], grades: np.ndarray, n_grades: int, **options) -> OrdinalModel:
    """``fit_features`` on the features of ``texts``."""
    return fit_features([features(t) for t in texts], grades, n_grades, **options)


def fit_features(rows: list[Features], grades: np.ndarray, n_grades: int, *, steps: int = 150, rate: float = 0.1,
                 l2: float = 1e-4, min_z: float = MIN_Z) -> OrdinalModel:
    """Full-batch Adam on the mean negative log-likelihood; deterministic."""
    idx, val, ptr = _design(rows, _associated_pairs(rows, grades, min_z))
    d, n = WORD_BUCKETS + 65536, len(rows)
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(ptr))
    scale = _odds(idx, row, grades, n_grades, d)
    blocks = _blocks(len(idx))
    for b in blocks:
        val[b] *= scale[idx[b]].astype(np.float32)
    counts = np.bincount(grades, minlength=n_grades)[::-1].cumsum()[::-1][1:] / n
    base = -np.log((counts + 1e-3) / (1 - counts + 1e-3))
    gaps = np.maximum(np.diff(base), 0.1)
    theta = np.concatenate([np.zeros(d), base[:1], np.log(np.expm1(gaps))])  # gaps by softplus
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        cut = theta[d] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(theta[d + 1:])))])
        s = np.zeros(n)
        for b in blocks:
            s += np.bincount(row[b], weights=val[b] * theta[idx[b]], minlength=n)
        up = 1 / (1 + np.exp(-np.clip(s[:, None] - cut, -40, 40)))       # P(grade >= k)
        full = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], axis=1)
        prob = np.maximum(full[np.arange(n), grades] - full[np.arange(n), grades + 1], 1e-9)
        slope = np.concatenate([np.zeros((n, 1)), up * (1 - up), np.zeros((n, 1))], axis=1)
        lo, hi = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        gs = -(lo - hi) / prob / n
        gc = np.zeros(n_grades + 1)
        np.add.at(gc, grades, lo / prob / n)
        np.add.at(gc, grades + 1, -hi / prob / n)
        gc = gc[1:-1]
        g = np.empty_like(theta)
        g[:d] = l2 * theta[:d]
        for b in blocks:
            g[:d] += np.bincount(idx[b], weights=val[b] * gs[row[b]], minlength=d)
        g[d] = gc.sum()
        g[d + 1:] = gc[::-1].cumsum()[::-1][1:] / (1 + np.exp(-theta[d + 1:]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    cut = theta[d] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(theta[d + 1:])))])
    weights = theta[:d] * scale
    return OrdinalModel(weights[:WORD_BUCKETS].copy(), weights[WORD_BUCKETS:].copy(), cut)


def graded_sample(docs: DataFrame, ratings: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  grade_col: str = "grade", max_train: int = MAX_TRAIN) -> list[tuple[Features, int]]:
    """At most ``max_train`` (features, grade) pairs: the rated ids that hash lowest, in that order.

    Features are made where the texts are, so the driver receives a bounded number of values per row.
    Ids rated more than once take their lowest grade; rows without id, grade or text are left out.
    """
    by_hash = F.xxhash64("id")
    rated = (ratings.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna()
             .groupBy("id").agg(F.min("grade").alias("grade")).orderBy(by_hash, "id").limit(max_train))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).dropna()
    # the rated side is bounded by max_train rows of two numbers
    rows = texts.join(F.broadcast(rated), "id").select(by_hash.alias("h"), "id", F.xxhash64("text").alias("t"), "grade", "text")

    def make(batches):
        for b in batches:
            made = [features(t) for t in utf8(b.column("text"))]
            packed = [pa.array([m[i].tobytes() for m in made], pa.binary()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *packed], names=[*names, *parts])
    names, parts = ["h", "id", "t", "grade"], ["words", "pairs", "counts"]
    schema = plus(rows.drop("text").schema, ", ".join(f"{c} binary" for c in parts))
    found = rows.mapInArrow(make, schema).orderBy("h", "id", "t").limit(max_train).select("grade", *parts).toArrow()
    columns = [[np.frombuffer(v.as_buffer(), t) for v in found.column(c)] for c, t in zip(parts, _PACKED)]
    return list(zip(zip(*columns), found.column("grade").to_pylist()))


def score_documents(docs: DataFrame, model: OrdinalModel, *, text_col: str = "text", out_col: str = "quality") -> DataFrame:
    """``docs`` with a struct ``quality`` (an input column of that name is replaced): ``expected_grade``,
    ``tail`` (probability of the best grade) and ``score``.

    Null and empty texts have score 0. Each row is scored by itself, so ties, repeated rows and other
    columns don't matter; an empty table gives an empty table.
    """
    src = fresh(docs, out_col)
    names, held = src.columns, unused(src, "_text")
    context = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: the feature buckets

    def run(batches):
        m = context.value
        for b in batches:
            s = np.fromiter((m.score(t) for t in utf8(b.column(held))), np.float64, b.num_rows)
            tails = m.tails(s)
            made = pa.StructArray.from_arrays([pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(s)],
                                              names=["expected_grade", "tail", "score"])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), made], names=[*names, out_col])
    schema = plus(src.schema, f"`{out_col}` struct<expected_grade:double,tail:double,score:double>")
    return src.withColumn(held, F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)


def rate_documents(docs: DataFrame, ratings: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   grade_col: str = "grade", n_grades: int = 3, max_train: int = MAX_TRAIN) -> DataFrame:
    """Fits on the rated sample and scores every document; see ``score_documents``.

    Without two different grades in the sample nothing can be learnt, and every document gets the best
    grade with certainty.
    """
    sample = graded_sample(docs, ratings, id_col=id_col, text_col=text_col, grade_col=grade_col, max_train=max_train)
    grades = np.array([g for _, g in sample], dtype=np.int64)
    if len(grades) and (grades.min() < 0 or grades.max() >= n_grades):
        raise ValueError(f"grades run from 0 to {n_grades - 1}")
    if len(set(grades.tolist())) < 2:
        model = OrdinalModel(np.zeros(WORD_BUCKETS), np.zeros(65536), np.full(n_grades - 1, -60.0))
    else:
        model = fit_features([f for f, _ in sample], grades, n_grades)
    return score_documents(docs, model, text_col=text_col)

"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio of trusted target to raw corpus.

Two multinomials over hashed byte n-grams are counted: one over trusted documents, one over all
documents. A text's score is the mean over its n-grams of log p_target - log p_raw; it is kept when the score
reaches a fixed threshold. No sampling: the same text always gets the same verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import fresh, plus, unused, utf8, word_pieces

GRAM = 4
BUCKETS = 1 << 16
#: Mean log-likelihood ratio (natural log, per n-gram) from which a text is kept.
THRESHOLD = -0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: Added to each bucket, as a share of an even spread.
SMOOTHING = 0.5
_PIECE = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


def _classes() -> np.ndarray:
    """Bit 0: begins a character that belongs to a word; bit 1: symbol."""
    t = np.zeros(256, np.uint8)
    t[[b for b in range(256) if not 0x80 <= b < 0xC0 and b not in _SPACE]] |= 1
    t[list(SYMBOLS)] |= 2
    return t


_CLASS = _classes()


def gram_buckets(text: bytes):
    """Buckets of the byte n-grams of a text, piece by piece."""
    for i in range(0, len(text) - GRAM + 1, _PIECE):
        a = np.frombuffer(text[i: i + _PIECE + GRAM - 1], np.uint8).astype(np.uint32)
        h = a[: len(a) - GRAM + 1].copy()
        for k in range(1, GRAM):
            h <<= 8
            h |= a[k: len(a) - GRAM + 1 + k]
        h *= np.uint32(0x9E3779B1)
        yield h >> np.uint32(16)


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; null counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    number: dict[bytes, int] = {}
    ids = np.concatenate([np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in word_pieces(text)])
    kinds = sum(np.bincount(_CLASS[np.frombuffer(text[i: i + _PIECE], np.uint8)], minlength=4) for i in range(0, len(text), _PIECE))
    seen = [line for line in text.split(b"\n") if line.strip()] if b"\n" in text else []
    return len(ids), int(kinds[1] + kinds[3]), int(kinds[2] + kinds[3]), len(seen) - len(set(seen)), repeat_words(ids, len(number))


def repeat_words(ids: np.ndarray, size: int) -> int:
    """Words (as numbers below ``size``, the number of different ones) that lie in a 3-word window found twice or more."""
    n = len(ids)
    if n < 4 or size == n:
        return 0
    pair = ids[:-1] * size + ids[1:]
    if size ** 3 < 1 << 62:
        triple = pair[:-1] * size + ids[2:]
    else:
        triple = np.unique(pair, return_inverse=True)[1][:-1] * size + ids[2:]
    order = np.argsort(triple, kind="stable")
    s = triple[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def gram_counts(texts: DataFrame, col: str) -> np.ndarray:
    """Count of every bucket over all texts. Each task sends one row per bucket; sums are combined by Spark."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in utf8(b.column(0)):
                for h in gram_buckets(t) if t else ():
                    total += np.bincount(h, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "n"])
    sums = (texts.select(F.col(f"`{col}`").cast("string").alias("t")).mapInArrow(run, "b int, n long")
            .groupBy("b").agg(F.sum("n").alias("n")).toArrow())  # a row per bucket at most
    out = np.zeros(BUCKETS, np.int64)
    out[sums.column("b").to_numpy()] = sums.column("n").to_numpy()
    return out


@dataclass
class Ratio:
    """Log-likelihood ratio of each bucket."""
    weights: np.ndarray

    @staticmethod
    def of(target: np.ndarray, raw: np.ndarray) -> Ratio:
        def logp(n):
            even = max(n.sum(), 1) / BUCKETS * SMOOTHING
            return np.log((n + even) / (n + even).sum())
        return Ratio(logp(target) - logp(raw))

    def score(self, text: bytes | None) -> float:
        """Mean ratio per n-gram; 0 for texts shorter than an n-gram."""
        if not text or len(text) < GRAM:
            return 0.0
        return sum(float(self.weights[h].sum()) for h in gram_buckets(text)) / (len(text) - GRAM + 1)


def judge_documents(docs: DataFrame, target: DataFrame, *, text_col: str = "text", target_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct ``rules`` (an input column of that name is replaced): the base counts, ``base_failed``, ``score``, ``kept``.

    ``target`` holds the trusted texts; the raw multinomial is counted over all of ``docs``. Null text has no
    words and fails the base rules. Rows are judged one by one, so ties, repeated rows and other columns
    don't matter. Without trusted texts both multinomials are even and only the base rules decide. An empty
    table gives an empty table.
    """
    src = fresh(docs, "rules")
    names, held = src.columns, unused(src, "_text")
    trusted = gram_counts(target, target_col)
    ratio = Ratio.of(trusted, gram_counts(src, text_col)) if trusted.any() else Ratio(np.zeros(BUCKETS))
    context = docs.sparkSession.sparkContext.broadcast(ratio)  # a number for each bucket
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches):
        ratio = context.value
        for b in batches:
            n = np.zeros((b.num_rows, len(counts)), np.int64)
            score = np.zeros(b.num_rows)
            for i, t in enumerate(utf8(b.column(held))):
                n[i] = base_counts(t)
                score[i] = ratio.score(t)
            failed = (n[:, 0] < MIN_WORDS) | (100 * n[:, 4] > MAX_REPEAT_PERCENT * n[:, 0])
            made = pa.StructArray.from_arrays([*(pa.array(n[:, k]) for k in range(len(counts))), pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))],
                                              names=[*counts, "base_failed", "score", "kept"])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), made], names=[*names, "rules"])
    schema = plus(src.schema, f"rules struct<{','.join(f'{c}:bigint' for c in counts)},base_failed:boolean,score:double,kept:boolean>")
    return src.withColumn(held, F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)

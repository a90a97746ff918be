"""URL filters: host and path rules first, logistic regression on hashed character n-grams for the rest.

A rule is ``host/path``: it fits its host and all subdomains when the URL's path starts with the rule's;
the longest rule wins. The regression sees n-grams of the host and of the path, hashed apart, and is
trained on a small labelled table of URLs. It is fitted on the driver, as that table is bounded.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.llm.common import fresh, plus, unused

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
#: Labelled URLs that the model is fitted on, at most: those that hash lowest.
MAX_TRAIN = 4_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Mapping[str, str]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, or nulls. ``rules`` is a short list: one condition each."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (len(r), r)):  # the longest is asked first
        h, slash, p = name.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(rules[name])).otherwise(verdict)
    return rule, verdict


def url_features(host: str, path: str) -> np.ndarray:
    """Sorted distinct buckets of the n-grams of host and path, each with marks at both ends."""
    grams = set()
    for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            grams.update(kind + text[i: i + n] for i in range(len(text) - n + 1))
    return np.unique(np.fromiter((zlib.crc32(g.encode()) % BUCKETS for g in grams), np.int64, len(grams)))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def block_score(self, host: str, path: str) -> float:
        """Log odds of blocking."""
        f = url_features(host, path)
        return self.bias + float(self.weights[f].sum()) / np.sqrt(max(len(f), 1))


def fit(urls: list[tuple[str, str]], block: np.ndarray, *, steps: int = 300, rate: float = 0.5, l2: float = 1e-4) -> UrlModel:
    """Full-batch Adam on the logistic loss, both classes weighing the same; deterministic. One class only: that
    class for everything."""
    n = len(urls)
    if n == 0 or block.all() or not block.any():
        return UrlModel(np.zeros(BUCKETS), 30.0 if n and block.all() else -30.0)
    feats = [url_features(*u) for u in urls]
    idx, row = np.concatenate(feats), np.repeat(np.arange(n), [len(f) for f in feats])
    val = 1 / np.sqrt(np.array([max(len(f), 1) for f in feats]))[row]
    weight = np.where(block > 0, n / (2 * block.sum()), n / (2 * (n - block.sum())))
    theta, m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, steps + 1):
        s = theta[-1] + np.bincount(row, weights=val * theta[idx], minlength=n)
        err = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - block) * weight / n
        g = np.append(np.bincount(idx, weights=val * err[row], minlength=BUCKETS) + l2 * theta[:-1], err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return UrlModel(theta[:-1].copy(), float(theta[-1]))


def labelled_sample(pages: DataFrame, rules: Mapping[str, str], *, url_col: str = "url", max_train: int = MAX_TRAIN) -> DataFrame:
    """A small labelled URL table ``(host, path, label)``: distinct URLs that a rule decides, those that hash lowest."""
    u = F.col(f"`{url_col}`")
    d = pages.select(url_host(u).alias("host"), url_path(u).alias("path")).distinct()
    _, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return (d.withColumn("label", verdict).where("label is not null")
            .orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_train))


def train(labelled: DataFrame, max_train: int = MAX_TRAIN) -> UrlModel:
    """Fits on ``(host, path, label)`` rows, ``max_train`` at most, in hash order; null labels are left out."""
    rows = (labelled.select("host", "path", "label").where("label is not null")
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_train).collect())
    return fit([(r.host or "", r.path or "") for r in rows], np.array([r.label == "block" for r in rows], dtype=float))


def judge_urls(pages: DataFrame, rules: Mapping[str, str], model: UrlModel, *, url_col: str = "url") -> DataFrame:
    """``pages`` with a struct ``filter`` (an input column of that name is replaced): ``host``, ``path``, ``rule``, ``verdict``.

    A null URL and one without ``://`` have empty host and path, fit no rule, and get the model's verdict on
    empty strings. URLs are judged one by one, so ties, repeated rows and other columns don't matter; an empty
    table gives an empty table.
    """
    if any("/" not in r or v not in ("allow", "block") for r, v in rules.items()):
        raise ValueError("rules are host/path, verdicts allow or block")
    src = fresh(pages, "filter")
    names = src.columns
    u, held = F.col(f"`{url_col}`"), unused(src, "_url")
    rule, verdict = matching_rule(F.col(f"{held}.host"), F.col(f"{held}.path"), rules)
    d = (src.withColumn(held, F.struct(url_host(u).alias("host"), url_path(u).alias("path")))
         .withColumn(held, F.struct(f"{held}.*", rule.alias("rule"), verdict.alias("verdict"))))
    context = pages.sparkSession.sparkContext.broadcast(model)  # a number for each bucket

    def run(batches):
        m = context.value
        for b in batches:
            host, path, rule, verdict = b.column(held).flatten()
            said = [v if v is not None else ("block" if m.block_score(h, p) >= 0 else "allow")
                    for h, p, v in zip(host.to_pylist(), path.to_pylist(), verdict.to_pylist())]
            made = pa.StructArray.from_arrays([host, path, rule, pa.array(said, pa.string())], names=["host", "path", "rule", "verdict"])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), made], names=[*names, "filter"])
    return d.mapInArrow(run, plus(src.schema, "filter struct<host:string,path:string,rule:string,verdict:string>"))

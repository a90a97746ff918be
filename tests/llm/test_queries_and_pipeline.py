import ctypes
import re

import numpy as np
import pytest
import sentencepiece
import xxhash

import corpus_pipeline
from floe.llm import ordinal_quality, queries
from tests.conftest import SF_SMALL
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_suffix_dedup import brute as brute_repeats
from tests.llm.test_chat_and_mixing import brute_targets
from tools.oracle_check import duck, rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_stages_equal_brute_force(spark):
    """Each stage over what the one before it kept."""
    docs = queries.table(spark, SF_SMALL, "documents")
    cols = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "mixing sources to target weights",
                                                      "SentencePiece encoding and decoding"]

    def go(name, df):
        out = stage[name](spark, df, SF_SMALL)
        assert name.startswith("Sentence") or out.columns == cols
        out = spark.createDataFrame(out.collect(), out.schema)
        return out, out.collect()

    rows = docs.collect()
    labels = {r.doc_id: r for r in queries.table(spark, SF_SMALL, "labels").collect()}
    order = lambda i: ctypes.c_int64(xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42)).value
    sample = sorted((r for r in rows if r.doc_id in labels), key=lambda r: (order(r.doc_id), r.doc_id))
    model = ordinal_quality.fit([r.text.encode() for r in sample], np.array([labels[r.doc_id].quality + 1 - labels[r.doc_id].toxic for r in sample]), 3)
    tails = model.tails(np.array([model.score(r.text.encode()) for r in rows]))[:, -1]
    df, got = go("quality classifier", docs)
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r, t in zip(rows, tails) if t >= ordinal_quality.MIN_TAIL)

    comp = brute_components([brute_fingerprint(r.text) for r in got], [r.doc_id for r in got])
    want = sorted(r for r, c in zip(got, comp) if c == r.doc_id)
    df, got = go("SimHash near-dedup", df)
    assert sorted(got) == want

    want = []
    for r, (_, removed, _, kept) in zip(got, brute_repeats([r.text.encode() for r in got])):
        text = kept.decode("utf-8", "ignore")
        if not removed:
            want.append(r.asDict())
        elif text:
            want.append(r.asDict() | {"text": text, "n_chars": len(text)})
    df, got = go("suffix-array dedup", df)
    assert sorted((r.asDict() for r in got), key=lambda r: r["doc_id"]) == sorted(want, key=lambda r: r["doc_id"])

    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    target = brute_targets(sizes)
    before = {r.doc_id: r for r in got}
    df, got = go("mixing sources to target weights", df)
    taken = {s: 0 for s in sizes}
    times = {}
    for r in got:
        assert before[r.doc_id] == r
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        taken[r.source] += words(r.text)
    assert max(times.values()) <= 3
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(words(r.text) for r in before.values() if r.source == s)

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    want = sorted((r.doc_id, lib.encode(r.text or "")) for r in got)
    _, got = go("SentencePiece encoding and decoding", df)
    assert sorted((r.doc_id, r.ids) for r in got) == want and all(r.n_tokens == len(r.ids) for r in got)


def test_run_chains_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == [*queries.table(spark, SF_SMALL, "documents").columns, "ids", "n_tokens"] and out.count() > 50


def test_stages_on_messy_and_empty_rows(spark, messy, empty):
    plain = messy.select("doc_id", "text", "lang", "source", "n_chars", "fp", "mix", "dedup")
    for rows in (plain, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_SMALL)
            assert set(out.columns) >= set(rows.columns) - {"mix"} and (rows is plain or out.count() == 0)
            if rows is plain:
                assert out.count() <= 3 * plain.count()

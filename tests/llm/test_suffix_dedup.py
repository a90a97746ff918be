import hashlib
import random

import numpy as np
import pytest

from floe.llm import queries, suffix_dedup
from tests.conftest import SF_SMALL


def brute(texts, n=200):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    count = {}
    for b in texts:
        for i in range(len(b) - n + 1):
            count[b[i:i + n]] = count.get(b[i:i + n], 0) + 1
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if count[b[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def documents(seed, n=60):
    """Random texts with shared passages of lengths around the limit, near copies, runs and periods."""
    rng = random.Random(seed)
    letters = "abcdefgh é日"

    def some(k):
        return "".join(rng.choice(letters) for _ in range(k))
    shared = [some(k) for k in (60, 120, 199, 200, 201, 230, 420, 900)]
    out = []
    for i in range(n):
        parts = [some(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), some(rng.randint(0, 40))]
        out.append("".join(parts))
    base = some(1500)
    for _ in range(25):  # near copies
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(letters)
        out.append("".join(t))
    return out + ["x" * 700, "ab" * 400, "x" * 199, "x" * 200, shared[3], shared[3], some(300) * 3, "", None]


@pytest.mark.parametrize("kw", [{}, {"group": 2}, {"gram": 30, "group": 5}])
def test_equals_brute_force(spark, kw):
    texts = documents(7)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(5)
    got = {r.i: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, **kw).select("i", "dedup.*").collect()}
    want = brute([(t or "").encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want


def test_anchors_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = "".join(documents(3)[:40]).encode() + b"z" * 3000
    (_, at, h), = suffix_dedup.Anchors(200, 80).of_texts([text])
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 10)
    (_, at2, h2), = suffix_dedup.Anchors(200, 80).of_texts([text])
    assert at.tolist() == at2.tolist() and h.tolist() == h2.tolist()
    # every window of 200 bytes holds an anchor's gram
    assert np.diff(np.concatenate([[-1], at, [len(text) - 80 + 1]])).max() <= 121


def test_maximal_repeats_have_all_occurrences():
    """Against all pairs: each repeat's members, and nothing that could be longer for the same members."""
    rng = random.Random(5)
    for _ in range(300):
        ctx = list({(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))), b"G" + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))))
                    for _ in range(rng.randint(2, 9))})
        if len(ctx) < 2:
            continue
        common = suffix_dedup._common
        want = set()
        for i in range(len(ctx)):
            for j in range(i):
                left, right = common(ctx[i][0], ctx[j][0]), common(ctx[i][1], ctx[j][1])
                if left + right >= 6:
                    want.add((frozenset(k for k in range(len(ctx)) if common(ctx[i][0], ctx[k][0]) >= left and common(ctx[i][1], ctx[k][1]) >= right), left, right))
        got = [(frozenset(m), a, b) for m, a, b in suffix_dedup.maximal_repeats(ctx, 6)]
        assert len(got) == len(set(got)) and set(got) == want


def test_messy_rows(messy, empty):
    rows = messy.collect()
    want = brute([(r.text or "").encode() for r in rows])
    got = suffix_dedup.remove_repeats(messy)
    assert sorted(got.columns) == sorted(messy.columns)  # its own column replaces the input's
    assert sorted((str(r.doc_id), r.text is None, *[bytes(x) if i == 3 else x for i, x in enumerate(r.dedup)]) for r in got.collect()) == sorted(
        (str(r.doc_id), r.text is None, *w) for r, w in zip(rows, want))
    text = {r.doc_id: r.dedup.kept for r in suffix_dedup.remove_repeats(messy, as_text=True).collect()}
    assert text[7] == "before  after the end".replace("  ", "") or "shared" not in text[7]
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for d, w in zip(docs, brute([(d.text or "").encode() for d in docs]))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op5_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == want

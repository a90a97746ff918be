import re

import numpy as np
import pytest
import xxhash

from floe.llm import common, queries, simhash
from tests.conftest import SF_SMALL


def brute_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, bits=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [min((ids[j] for j in range(len(fps)) if find(j) == find(i) and ids[j] is not None), default=None) for i in range(len(fps))]


def test_fingerprint_equals_definition():
    for t in (None, "", " \t", "One", "one two", "A b C d e F g", "x " * 500, "Ä ß\x1cÉ é\x85y"):
        assert simhash.fingerprint(t.encode() if t is not None else None) == brute_fingerprint(t)


def test_long_texts_do_not_depend_on_pieces(monkeypatch):
    texts = ["One two three FOUR five six seven eight nine ten eleven " * 9, "a", "a b", "x" * 60, " a  b \n c ", ""]
    for size in (1, 5, 17, 64):
        monkeypatch.setattr(common, "WORD_PIECE", size)
        for k in (1, 2, 3):
            assert [simhash.fingerprint(t.encode(), k) for t in texts] == [brute_fingerprint(t, k) for t in texts]


def test_golay_code_is_perfect():
    table, errors = simhash._golay()
    assert len(set(errors.tolist())) == 2048 and max(bin(e).count("1") for e in errors) == 3
    words = np.arange(0, 1 << 23, 4099)
    idx = simhash.golay_indices(words)
    sizes = {int((row >= 0).sum()) for row in idx}
    assert sizes <= {1, 6}


def test_two_bits_always_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for _ in range(6):
        flips = np.zeros(300, np.uint64)
        for _ in range(2):
            flips |= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
        keys = []
        for fps in (a, a ^ flips):
            rows, k = simhash.fuzzy_keys(fps)
            keys.append([set(k[rows == i].tolist()) for i in range(300)])
        assert all(x & y for x, y in zip(*keys))


@pytest.mark.parametrize("bucket", [32, 1])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_what_brute_force_connects(spark, bits, bucket):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base[:6]:
        for _ in range(8):
            b = int(b) ^ (1 << int(rng.integers(64)))
            fps.add(b)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp long")
    roots = {r.node % (1 << 64): r.root for r in common.connected_components(simhash.fingerprint_links(df, bits, bucket)).collect()}
    got = [roots.get(f, int(np.array(f, np.uint64).view(np.int64))) for f in fps]
    want = brute_components(fps, list(range(len(fps))), bits)
    assert [got.index(g) for g in got] == want


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.root for r in common.connected_components(spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def test_messy_rows(messy, empty):
    got = simhash.simhash_groups(messy).collect()
    rows = messy.collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], fps, brute_components(fps, [r.doc_id for r in rows])), key=str)
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], key=str) == want
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    # 2, 3, 9 and the null id have no words; 1 and 6 are equal
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([1, 2, 5, 7, 8, 10, None], key=str)
    assert simhash.simhash_groups(empty).count() == simhash.keep_one(empty).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op1_simhash_dedup"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [brute_fingerprint(d.text) for d in docs]
    comp = brute_components(fps, [d.doc_id for d in docs])
    assert got == {d.doc_id: (f"{f:016x}", c) for d, f, c in zip(docs, fps, comp)}

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from floe.llm import embed_dedup, queries
from tests.conftest import SF_SMALL


def brute(rows, cosine=0.93):
    """(id, n_links, component_id, kept) of (id, vector, label) rows."""
    def ok(v, lab):
        return lab is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    link = [[i != j and ok(rows[i][1], rows[i][2]) and ok(rows[j][1], rows[j][2]) and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
             and np.dot(rows[i][1], rows[j][1]) / math.sqrt(np.dot(rows[i][1], rows[i][1]) * np.dot(rows[j][1], rows[j][1])) >= cosine
             for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for j in range(n):
                if link[x][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        comp = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], sum(link[i]), comp, rows[i][0] == comp))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()], key=str)


def clusters(seed, n=220, dim=64):
    """Near copies at several distances, some in chains, under few labels."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        x = rng.standard_normal(dim)
        lab = int(rng.integers(3))
        for _ in range(int(rng.integers(1, 12))):
            rows.append([len(rows), [float(np.float32(v)) for v in x], lab])
            x = x / np.linalg.norm(x) + rng.standard_normal(dim) * rng.choice([0.005, 0.02, 0.045])
    return rows[:n]


def test_random_near_copies(spark):
    for seed, chunk in ((1, 256), (2, 4)):
        rows = clusters(seed)
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        a, b = got(embed_dedup.embedding_groups(df, chunk=chunk)), brute(rows)
        links = [x[1] for x in b]
        assert sum(x[1] for x in a) >= 0.99 * sum(links)
        assert sum(x == y for x, y in zip(a, b)) >= 0.98 * len(b)


def test_list_decoding_finds_every_cap():
    caps = embed_dedup.Caps(10, 3, 5, 1.1)
    codes = caps.codes()
    x = np.random.default_rng(3).standard_normal(10)
    x /= np.linalg.norm(x)
    want = []
    for k, (order, (a, b, c)) in enumerate(codes):
        p, q, r = np.split(x[order], np.cumsum([a.shape[1], b.shape[1]]))
        for i in range(125):
            if a[i // 25] @ p + b[i // 5 % 5] @ q + c[i % 5] @ r >= 1.1:
                want.append(k * 125 + i)
    assert caps.decode(x, codes).tolist() == want


@pytest.mark.parametrize("dim, n", [(64, 2_000), (64, 200_000), (3, 2_000), (200, 20_000)])
def test_recall_of_dominant_coordinates(dim, n):
    """Pairs at the cosine asked for, most of whose norm lies in one coordinate or two."""
    caps, rng = embed_dedup.Caps.sized(dim, n), np.random.default_rng(dim + n)
    codes, turn = caps.codes(), caps.turns()
    e, sharp, pairs = np.eye(dim), math.sqrt(1 - 0.9301 ** 2), []
    for i in range(150):
        x = e[i % dim] + (0 if i % 2 else 0.05 / math.sqrt(dim) * rng.standard_normal(dim))
        x /= np.linalg.norm(x)
        z = e[(i + 1) % dim] if i % 3 else rng.standard_normal(dim)
        z = z - (z @ x) * x
        pairs += [x, 0.9301 * x + sharp * z / np.linalg.norm(z)]
    pairs = np.array(pairs)
    found = [set(caps.decode(v, codes)) for i in range(0, len(pairs), 20) for v in turn(pairs[i: i + 20])]
    assert all(a & b for a, b in zip(found[::2], found[1::2]))


@pytest.mark.parametrize("dim", [1, 2, 3, 64, 129, 200])
def test_turns_keep_products(dim):
    caps = embed_dedup.Caps(dim, 1, 2, 1.0, 5)
    x = np.random.default_rng(dim).standard_normal((4, dim))
    for k in range(5):
        y = caps.turns()(x)[:, k]
        assert np.allclose(y @ y.T, x @ x.T) and not np.allclose(np.abs(y), np.abs(x)) or dim == 1


def test_missed_pairs_set_the_number_of_codes():
    for dim, n in ((1, 100), (2, 5_000), (64, 100), (64, 5_000), (300, 5_000)):
        caps = embed_dedup.Caps.sized(dim, n)
        assert caps.lost(embed_dedup.MIN_COSINE) ** caps.count <= embed_dedup.MISS


def test_invalid_vectors_ties_and_clashes(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    rows = [(1, v, 1), (2, w, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1),
            (9, [1.0, float("nan"), 3.0], 1), (10, [1.0, float("inf"), 3.0], 1), (11, v, 1), (11, v, 1), (None, w, 1), (12, [1.0, 2.0], 1),
            (None, [9.0, -9.0, 0.0], 1), (13, [2.0, 4.0, 6.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows)
    assert got(embed_dedup.embedding_groups(df.withColumns({c: F.lit(1) for c in ("id", "lab", "vec", "cid", "n", "root", "ok", "k1")}))) == want
    strings = df.withColumn("label", F.concat(F.lit("x"), F.col("label")))
    assert got(embed_dedup.embedding_groups(strings)) == want
    assert embed_dedup.embedding_groups(df.limit(0)).count() == 0


def test_null_string_labels_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, None), (2, v, None), (3, v, "a"), (4, v, "a"), (5, v, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert got(embed_dedup.embedding_groups(df)) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert got(queries.QUERIES["op3_embedding_dedup"](spark, SF_SMALL)) == brute(rows)

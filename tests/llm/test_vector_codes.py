import hashlib
import math

import numpy as np
import pytest

from floe.llm import vector_codes
from floe.llm.vector_codes import ENTRIES, PARTS, SlicedEntries, compress


def brute(rows, rounds=2):
    """rows (id, vector, label) -> {row number: (code, error, label_error)}, digest; all by trying every entry."""
    kept = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(-(-max(len(r[1]) for _, r in kept) // PARTS), 1) * PARTS
    size = width // PARTS
    ints = {i: [math.floor(256 * x) for x in r[1]] + [0] * (width - len(r[1])) for i, r in kept}
    first = sorted(kept, key=lambda x: (x[1][0] is None, x[1][0] or 0, [float(v) for v in x[1][1]]))[:ENTRIES]
    books = [[ints[i][p * size:(p + 1) * size] for i, _ in first] for p in range(PARTS)]

    def assign(v, p):
        part = v[p * size:(p + 1) * size]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        got = {i: [assign(v, p) for p in range(PARTS)] for i, v in ints.items()}
        for p in range(PARTS):
            for k in range(len(books[p])):
                mine = [ints[i][p * size:(p + 1) * size] for i in ints if got[i][p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    got = {i: [assign(v, p) for p in range(PARTS)] for i, v in ints.items()}
    error = {i: sum(d for d, _ in g) for i, g in got.items()}
    labels = {}
    for i in got:
        labels[rows[i][2]] = labels.get(rows[i][2], 0) + error[i]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ("".join(f"{k:02x}" for _, k in got[i]), error[i], labels[rows[i][2]]) for i in got}, digest


def test_slices_and_nearest():
    rnd = np.random.default_rng(1)
    for size, dims, spread in ((64, 4, 300), (64, 1, 5), (1, 3, 10), (17, 6, 3), (64, 2, 1)):
        entries = rnd.integers(-spread, spread, (size, dims))
        parts = rnd.integers(-2 * spread, 2 * spread, (500, dims))
        s = SlicedEntries.of(entries)
        d = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        number, best = s.nearest(parts)
        assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()  # argmin: the lowest of ties
        for reach in (0, 1, spread // 2, 9 * spread):
            inside = (np.abs(parts[:, None, :] - entries[None]) <= reach).all(axis=2)
            want = [sum(1 << int(e) for e in np.flatnonzero(r)) for r in inside]
            assert [int(m) for m in s.sliced(parts, np.full(len(parts), reach))] == want
    # the masks spare work: few entries of a spread codebook are in the first cube
    s = SlicedEntries.of(rnd.integers(-1000, 1000, (64, 4)))
    assert np.mean([bin(int(m)).count("1") for m in s.sliced(rnd.integers(-1000, 1000, (500, 4)), np.full(500, s.radius))]) < 6


def table(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2], i) for i, r in enumerate(rows)], "vec_id long, embedding array<float>, label string, row int")


def messy_rows(n, dims, seed):
    rnd = np.random.default_rng(seed)
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(int(i), f(rnd.normal(size=dims)), [None, "a", "b"][i % 3]) for i in rnd.permutation(n)]
    rows += [rows[0], (3, rows[1][1], "a"), (None, f(rnd.normal(size=dims)), None), (900, None, "a"), (901, [1.0] * (dims - 1) + [None], "b"),
             (902, [float("nan")] + [0.0] * (dims - 1), "b"), (-5, [float("inf")] * dims, "b"), (903, [0.0] * dims, "zero"), (904, f([-1 / 512] * dims), "zero")]
    return rows


@pytest.mark.parametrize("n,dims,extra,max_broadcast", [(150, 32, [], 1 << 20), (20, 16, [], 0), (90, 32, [(905, [1.5] * 5, "short"), (906, [], "short")], 0),
                                                        (40, 7, [], 1 << 20)])
def test_codes_equal_brute_force(spark, n, dims, extra, max_broadcast):
    rows = messy_rows(n, dims, n) + extra
    want, digest = brute(rows)
    got = compress(table(spark, rows).repartition(5), max_broadcast=max_broadcast).collect()
    assert {r.row: (r.codes.code, r.codes.error, r.codes.label_error) for r in got} == want and len(got) == len(want)
    assert {r.codes.codebooks_sha256 for r in got} == {digest}


def test_clashing_names_no_label_and_empty(spark):
    from pyspark.sql import functions as F
    rows = messy_rows(30, 16, 4)
    df = table(spark, rows).withColumns({c: F.lit("own") for c in ("v", "_v", "codes", "_label", "_total", "id", "code")})
    out = compress(df, label_col=None)
    assert out.columns == [c for c in df.columns if c != "codes"] + ["codes"]
    got = out.collect()
    assert {r.codes.label_error for r in got} == {sum(r.codes.error for r in got)} and all(r._v == r.id == "own" for r in got)
    for nothing in (table(spark, []), table(spark, rows).where("embedding IS NULL")):
        assert compress(nothing).collect() == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 64 bits"):
        compress(table(spark, [(1, [1e30] * 16, "a")])).collect()
    assert vector_codes.SCALE == 256

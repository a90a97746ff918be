import re

import pytest
from pyspark.sql import functions as F

from floe.llm import chat, mixing

TURNS = [
    (1, 0, "system", "be <|im_end|> good"), (1, 1, "user", "</s>[INST] \\ok\\ [/INST]<|im_start|>"), (1, 2, "user", "again\n"), (1, 3, "assistant", "é日😀 <s>"),
    (1, 4, "assistant", ""), (1, 5, "user", None), (2, 0, "assistant", "<|im_next|>\\<|"), (3, None, None, None), (3, 1, "us<|im_sep|>er", "x<"), (None, 0, "user", "no conversation"),
    (4, 1, "user", "tie b"), (4, 1, "user", "tie a"), (4, 1, "user", "tie a"), (4, 1, "assistant", "tie"), (5, 0, "user", "long " * 100_000), (5, 1, "assistant", "\\" * 5000),
    (6, 0, "assistant", "<<SYS>>[INST][/INST]<</SYS>>|><"),
]


@pytest.fixture(scope="module")
def turns(spark):
    d = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    return d.withColumns({c: F.lit("own") for c in ("turns", "formatted", "blocks", "starts", "pieces")}).repartition(4)


def test_formatted_chats_read_back(turns):
    d = chat.format_chats(turns).withColumn("read", chat.parse_chats(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in d.collect()}
    key = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    assert set(got) == {t[0] for t in TURNS}
    for conv, r in got.items():
        rows = [(t[2] or "", t[3] or "") for t in sorted((t for t in TURNS if t[0] == conv), key=key)]
        assert [tuple(x) for x in r.read] == rows
        assert r.loss == "".join(x for role, x in rows if role == "assistant")
        # a header for each run of one role; control strings nowhere else
        runs = sum(1 for i, (role, _) in enumerate(rows) if i == 0 or rows[i - 1][0] != role)
        assert r.formatted.count(chat.HEAD) == r.formatted.count(chat.END) == runs
        assert r.formatted.count("<|") == 3 * runs + r.formatted.count(chat.NEXT)
        assert not any(c in r.formatted for c in ("</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>"))
        # the spans are disjoint, ascending, and hold the assistant's escaped texts
        ends = 1
        for s in r.loss_spans:
            assert s.start >= ends
            ends = s.start + s.len
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in rows) and ends <= len(r.formatted) + 1


def test_chat_empty_and_bad_controls(turns):
    assert chat.format_chats(turns.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.format_chats(turns, controls=["</s>"])


def test_chat_plan_is_native(turns):
    d = chat.format_chats(turns).withColumn("read", chat.parse_chats(F.col("formatted")))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and plan.count("Exchange hashpartitioning") == 1


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Sharing again and again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        above = [s for s in free if share[s] >= cap * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1, None: 50}, {"a": 5}, {"a": 0, "b": 0}, {"x": 7, "y": 7, "z": 7, "zz": 700, "é": 3, "😀": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([("s" + s if s is not None else "", n) for s, n in sizes.items()], "_src string, _s long")
    got = {r._src[1:] if r._src else None: r._t for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_takes_what_it_should(messy, empty):
    extra = messy.withColumn("doc_id", F.col("doc_id") + 100).unionByName(messy)
    m = mixing.mix(extra, range_rows=2)
    assert sorted(m.columns) == sorted(messy.columns)
    rows = m.collect()
    assert len(rows) == extra.count()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        assert r.mix["size"] == size(r.text) and r._src == "own _src"
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(r.mix.source_size == sizes[s] and r.mix.target == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r.mix.taken for r in mine) - want[s]) <= max(size(r.text) for r in mine)
    for r in rows:
        assert 0 <= r.mix.copies <= 3 and r.mix.taken == r.mix.copies * size(r.text) and len(r.mix.positions) == r.mix.copies
        assert all(0 <= p <= 1 for p in r.mix.positions) and list(r.mix.positions) == sorted(r.mix.positions)
    # reruns agree, however the rows are dealt out
    again = mixing.mix(extra.repartition(7), range_rows=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    copies = mixing.training_order(m)
    assert copies.columns == [c for c in messy.columns if c != "mix"] and copies.count() == sum(r.mix.copies for r in rows)
    assert mixing.by_position(m).count() == len(rows)
    assert mixing.mix(empty).count() == 0 and mixing.training_order(mixing.mix(empty)).count() == 0


def test_training_order_follows_the_curriculum(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 5 + id % 7) AS text", "concat('s', id % 3) AS source")
    rows = mixing.training_order(mixing.mix(docs)).collect()
    # light sources (first slot) come early, heavy ones late
    place = {s: [i / len(rows) for i, r in enumerate(rows) if r.source == s] for s in ("s0", "s1", "s2")}
    mean = {s: sum(p) / len(p) for s, p in place.items()}
    assert mean["s0"] < mean["s1"] < mean["s2"]


def test_schedules_invert_their_integral(spark):
    knots = ((0.0, 2.0), (0.25, 0.0), (0.5, 0.0), (1.0, 3.0))
    segs = mixing._segments(knots)
    df = spark.range(0, 101).selectExpr("id / 100.0D AS share", "0 AS slot")
    for r in df.select("share", mixing.invert_schedule(F.col("slot"), F.col("share"), [knots]).alias("t")).collect():
        done = 0.0
        for t0, r0, m, a0, a1 in segs:
            t1 = next((x for x, _ in knots if x > t0), 1.0)
            x = min(max(r.t - t0, 0), t1 - t0)
            done += r0 * x + m * x * x / 2
        assert done == pytest.approx(r.share, abs=1e-9)
    for bad in (((0.0, 1.0), (0.5, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, -1.0), (1.0, 3.0))):
        with pytest.raises(ValueError):
            mixing._segments(bad)


def test_mixing_plan_is_native(messy):
    plan = mixing.by_position(mixing.mix(messy.select("doc_id", "text", "source")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from floe.llm import common, ordinal_quality, quality_rules, queries, url_filter
from tests.conftest import SF_MID, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if triples[tuple(words[i:i + 3])] > 1}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def brute_score(text, weights):
    b = (text or "").encode()
    grams = [int.from_bytes(b[i:i + 4], "big") * 0x9E3779B1 % (1 << 32) >> 16 for i in range(len(b) - 3)]
    return sum(weights[g] for g in grams) / len(grams) if grams else 0.0


@pytest.mark.parametrize("text", [None, "", "a", "a b a b a b a", "x y z x y z", "é ß\n\né ß\n \né ß", "a#*$%&|<>b", "p q r s " * 40, "\x1c\x85\xa0 w"])
def test_base_counts(text):
    assert quality_rules.base_counts(text.encode() if text is not None else None) == brute_counts(text)


def test_counts_do_not_depend_on_pieces(monkeypatch):
    monkeypatch.setattr(common, "WORD_PIECE", 9)
    monkeypatch.setattr(quality_rules, "_PIECE", 5)
    for text in ("p q r s " * 40, "é ß\n\né ß\n \né ß\n x#y <z> " * 3, "long-word-without-any-space-in-it " * 4, "a b c"):
        assert quality_rules.base_counts(text.encode()) == brute_counts(text)


def test_grams_do_not_depend_on_pieces(monkeypatch):
    text = ("the quick brown fox é " * 50).encode()
    whole = np.concatenate(list(quality_rules.gram_buckets(text)))
    monkeypatch.setattr(quality_rules, "_PIECE", 7)
    assert (np.concatenate(list(quality_rules.gram_buckets(text))) == whole).all()


def test_rules_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}

    def counts(texts):
        n = np.zeros(1 << 16)
        for t in texts:
            b = (t or "").encode()
            for i in range(len(b) - 3):
                n[int.from_bytes(b[i:i + 4], "big") * 0x9E3779B1 % (1 << 32) >> 16] += 1
        n += n.sum() / (1 << 16) / 2
        return np.log(n / n.sum())
    weights = counts(docs[i] for i in good) - counts(docs.values())
    rows = queries.QUERIES["op4_quality_rules"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        c = brute_counts(docs[r.doc_id])
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        score = brute_score(docs[r.doc_id], weights)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (*c, failed)
        assert abs(r.score - score) < 1e-5 and r.kept == (not failed and score >= quality_rules.THRESHOLD)


def test_rules_tell_junk_from_clean(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op4_quality_rules"](spark, SF_MID).collect() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept == (labels[r.doc_id].quality == 1) for r in rows)


def test_every_trusted_text_is_counted(spark):
    n = 25_000
    docs = spark.range(n + 500).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(n + 100).selectExpr("id AS doc_id", "1 AS quality", f"cast(id >= {n} AS int) AS toxic")
    docs = docs.unionByName(spark.createDataFrame([(0, "text 0"), (None, "no id")], "doc_id long, text string"))
    labels = labels.unionByName(labels.limit(10)).unionByName(spark.createDataFrame([(None, 1, 0)], "doc_id long, quality int, toxic int"))
    want = np.zeros(quality_rules.BUCKETS, np.int64)
    for i in [0, *range(n)]:
        np.add.at(want, next(quality_rules.gram_buckets(f"text {i}".encode())), 1)
    for max_bytes in (queries.MAX_BROADCAST, 0):
        texts = queries.trusted(docs, labels, max_bytes)
        assert texts.count() == n + 1 and (quality_rules.gram_counts(texts, "text") == want).all()


def test_rules_messy(spark, messy, empty):
    got = quality_rules.judge_documents(messy, messy.limit(1)).collect()
    assert len(got) == messy.count()
    for r in got:
        assert tuple(r.rules)[:5] == brute_counts(r.text) and r._text == "own _text"
        assert not (r.rules.base_failed and r.rules.kept)
    bare = quality_rules.judge_documents(messy, empty).collect()
    assert all(r.rules.score == 0 and r.rules.kept != r.rules.base_failed for r in bare)
    assert quality_rules.judge_documents(empty, messy).count() == 0


def brute_features(text):
    """Word buckets, byte pairs and their counts, counted one by one."""
    words = set(re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), text)))
    heads = {w[:k] for w in words for k in (4, 5, 6, len(w)) if len(w) >= k}
    pairs = Counter(zip(text, text[1:]))
    keys = sorted(pairs)
    return (np.array(sorted({zlib.crc32(w) % 131072 for w in heads}), np.int64), np.array([256 * a + b for a, b in keys], np.int64),
            np.array([pairs[k] for k in keys], np.int64))


def test_ordinal_features_and_scores_equal_brute_force():
    """Short words count, words that differ after byte 6 are different ones; texts over a piece of 1 MB."""
    rng = np.random.default_rng(4)
    m = ordinal_quality.OrdinalModel(rng.normal(size=131072), rng.normal(size=65536), np.array([0.0, 1.0]))
    long = b"".join(rng.choice([b"Ab ", b"trailers ", b"trailing\n", b"\xc3\xa9\xc3\xa9 ", b"x"], 400_000).tolist())
    assert len(long) > 2 * ordinal_quality._PIECE
    for t in (b"", b"a", b"A b\tab", b"no go", "Ünïcode wörds 12".encode(), b"abcdefg abcdefh ABCDEFG", long):
        want, got = brute_features(t), ordinal_quality.features(t)
        assert all(np.array_equal(a, b) for a, b in zip(want, got))
        assert m.score(t) == pytest.approx(m.words[want[0]].sum() + 50 * (m.pairs[want[1]] * want[2]).sum() / max(len(t) - 1, 1), abs=1e-6)
    one, other = (set(ordinal_quality.word_buckets(w).tolist()) for w in (b"abcdefg", b"abcdefh"))
    assert one != other and len(one & other) == 3 and len(ordinal_quality.word_buckets(b"no")) == 1


def test_ordinal_fit_is_a_minimum_of_the_likelihood():
    """The negative log-likelihood, written out here, has next to no slope at the fitted weights and thresholds."""
    rng = np.random.default_rng(2)
    vocabulary = ["alpha", "be", "gamma", "deltas", "epsilon", "zeta", "eta"]
    texts, grades = [], []
    for _ in range(400):
        grades.append(int(rng.integers(3)))
        texts.append(" ".join(rng.choice(vocabulary, 6, p=np.roll([.3, .2, .1, .1, .1, .1, .1], grades[-1]))).encode())
    grades = np.array(grades)
    start, end = (ordinal_quality.fit(texts, grades, 3, steps=n, l2=0.0, min_z=1e9) for n in (1, 2000))
    buckets = sorted({b for t in texts for b in brute_features(t)[0]})
    present = np.array([np.isin(buckets, brute_features(t)[0]) for t in texts], float)
    low = present[grades < 2].sum(axis=0)
    base = np.mean(grades < 2)
    odds = np.log((low + 10 * base) / (present.sum(axis=0) - low + 10 * (1 - base))) - np.log(base / (1 - base))

    def loss(weights, cut):
        up = 1 / (1 + np.exp(cut - (present @ weights)[:, None]))
        full = np.hstack([np.ones((400, 1)), up, np.zeros((400, 1))])
        return -np.log(full[np.arange(400), grades] - full[np.arange(400), grades + 1]).mean()

    def slopes(model):
        at = np.concatenate([model.words[buckets], model.thresholds])
        d = len(buckets)
        bumps = 1e-4 * np.eye(d + 2)
        each = np.array([(loss((at + x)[:d], (at + x)[d:]) - loss((at - x)[:d], (at - x)[d:])) / 2e-4 for x in bumps])
        return np.abs(each * np.concatenate([odds ** 2 / 2, np.ones(2)])).max()    # words are scaled by their odds
    assert loss(end.words[buckets], end.thresholds) < loss(start.words[buckets], start.thresholds) - 0.02
    assert slopes(end) < 2e-4 < slopes(start)


def test_ordinal_thresholds_and_tails():
    texts = [("good " * (i % 7 + 1) + f"text number {i}").encode() if i % 3 == 2 else (b"idiot " if i % 3 == 0 else b"!! ## ") * (i % 5 + 1) for i in range(300)]
    grades = np.array([0 if i % 3 == 0 else 1 if i % 3 == 1 else 2 for i in range(300)])
    m = ordinal_quality.fit(texts, grades, 3, steps=120)
    assert m.thresholds[0] < m.thresholds[1]
    s = np.array([m.score(t) for t in texts])
    tails = m.tails(s)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == grades).mean() > 0.95


def test_held_out_quality(spark):
    """Fitted on the smaller table's ratings, judged on the larger table's."""
    docs, labels = (spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    rated = queries.graded(labels)
    train, held = rated.where("doc_id % 3 > 0"), {r.doc_id: r.grade for r in rated.where("doc_id % 3 = 0").collect()}
    got = ordinal_quality.rate_documents(docs.select("doc_id", "text").where("doc_id % 3 = 0").unionByName(docs.select("doc_id", "text").where("doc_id % 3 > 0")), train)
    rows = [(r.quality.tail >= ordinal_quality.MIN_TAIL, held[r.doc_id]) for r in got.collect() if r.doc_id in held]
    good = [k for k, g in rows if g == 2]
    low = [k for k, g in rows if g < 2]
    assert np.mean(good) > 0.93 and np.mean(low) < 0.2


def test_ordinal_messy(spark, messy, empty):
    ratings = spark.createDataFrame([(1, 2), (1, 0), (7, 2), (8, 1), (None, 1), (5, None), (2, 1), (10, 0)], "doc_id long, grade int")
    sample = ordinal_quality.graded_sample(messy, ratings)
    flat = lambda f, g: (*(tuple(x.tolist()) for x in f), g)
    want = [(r.text, {1: 0, 7: 2, 8: 1, 10: 0}.get(r.doc_id)) for r in messy.collect()]
    assert sorted(flat(f, g) for f, g in sample) == sorted(flat(brute_features(t.encode()), g) for t, g in want if g is not None)
    got = ordinal_quality.rate_documents(messy, ratings).collect()
    assert len(got) == messy.count() and all(r.quality.score == 0 for r in got if not r.text)
    assert all(0 <= r.quality.tail <= r.quality.expected_grade <= 2 and r._text == "own _text" for r in got)
    sure = ordinal_quality.rate_documents(messy, ratings.where("grade = 2")).collect()
    assert all(r.quality.tail > 0.99 for r in sure)
    assert ordinal_quality.rate_documents(empty, ratings).count() == 0


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.search(r"[/?#]", rest)
        host, rest = (rest[:m.start()], rest[m.start():]) if m else (rest, "")
        host = re.sub("[A-Z]", lambda c: c[0].lower(), host)
        path = re.split(r"[?#]", rest, maxsplit=1)[0]
    best = None
    for rule, verdict in queries.URL_RULES.items():
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


URLS = ["http://a.com/x?y#z", "https://EXAMPLE.com/en/1", "http://www.example.com/en/1", "http://m.www.example.com/en/", "http://example.com/english", "net/es/", "x://net/es/q",
        "http://a.net/fr/x", "http://notcom/", "http://com/", "http://a.com", "http://a.com?p=/en/", "http://É.com/Ü", "://", "a://b://c.com/", "http://l\nf.com/a\nb", "", None]


def test_url_rules(spark):
    rows = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS)] + [(0, URLS[0], "own")], "page_id long, url string, filter string")
    model = url_filter.fit([("a.com", "/"), ("b.net", "/es/")], np.array([0.0, 1.0]))
    got = url_filter.judge_urls(rows.withColumnRenamed("page_id", "_url"), queries.URL_RULES, model).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, best = brute_url(URLS[r._url])
        want = best or (None, "block" if model.block_score(host, path) >= 0 else "allow")
        assert tuple(r["filter"]) == (host, path, *want)
    assert url_filter.judge_urls(rows.limit(0), queries.URL_RULES, model).count() == 0


def test_url_model_learns_and_handles_one_class():
    urls = [(f"h{i}.{'good' if i % 2 else 'spam'}.org", f"/{'news' if i % 2 else 'casino'}/{i}") for i in range(200)]
    y = np.array([1.0 - i % 2 for i in range(200)])
    m = url_filter.fit(urls[:120], y[:120])
    assert all((m.block_score(*u) >= 0) == bool(b) for u, b in zip(urls[120:], y[120:]))
    assert url_filter.fit(urls[:3], np.ones(3)).block_score("", "") > 0 > url_filter.fit([], np.empty(0)).block_score("", "")


def test_url_query_equals_brute_force(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url").collect()}
    seen = sorted({brute_url(u)[:2] for u in pages.values() if brute_url(u)[2]})
    labelled = [(h, p, brute_url(f"x://{h}{p}")[2][1]) for h, p in seen]
    # the sample holds all of them, in hash order
    rows = spark.createDataFrame(labelled, "host string, path string, label string").selectExpr("*", "xxhash64(host, path) h").orderBy("h", "host", "path").collect()
    model = url_filter.fit([(r.host, r.path) for r in rows], np.array([r.label == "block" for r in rows], float))
    for r in queries.QUERIES["op8_url_filter"](spark, SF_SMALL).collect():
        host, path, best = brute_url(pages.pop(r.page_id))
        want = best or (None, "block" if model.block_score(host, path) >= 0 else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *want)
    assert not pages

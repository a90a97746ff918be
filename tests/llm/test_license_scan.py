import itertools
import random
import re

import pytest

from floe.llm import common, license_scan, queries
from floe.llm.license_scan import LicenseScanner, TokenAutomaton, chain_matches, outer_spans, words_of
from tests.conftest import SF_MID

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_places(words):
    out = []
    for p, (_, phrase) in enumerate(license_scan.PHRASES):
        want = phrase.split()
        out += [(i, p) for i in range(len(words) - len(want) + 1) if words[i:i + len(want)] == want]
    return sorted(out)


def plain_statistics(words, strings):
    """Longest run ending at each word that a string holds, by trying all."""
    runs = {tuple(s[i:j]) for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    return [max((n for n in range(e + 2) if n and tuple(words[e - n + 1:e + 1]) in runs), default=0) for e in range(len(words))]


def plain_spans(words, scanner):
    """Matches by trying all places of all templates, then chains, shares and outer spans."""
    found, score = [], 0.0
    templates = [plain_words(t) for _, t in scanner.templates]
    lengths = plain_statistics(words, [plain_words(t) for _, t in (*scanner.phrases, *scanner.templates)])
    for (label, _), t in zip(scanner.templates, templates):
        matches = []
        for e, n in enumerate(lengths):
            if n >= scanner.min_match and (e + 1 == len(lengths) or lengths[e + 1] != n + 1):
                matches += [(e - n + 1, i, n) for i in range(len(t) - n + 1) if t[i:i + n] == words[e - n + 1:e + 1]]
        for first, last, covered in chain_matches(matches, scanner.max_gap):
            score = max(score, covered / len(t))
            if covered / len(t) >= scanner.min_share:
                found.append((label, first, last, covered / len(t)))
    return outer_spans(found), score


def licence_texts(n, seed):
    rnd = random.Random(seed)
    bank = sorted({w for _, t in (*license_scan.PHRASES, *license_scan.TEMPLATES) for w in plain_words(t)}) + ["stranger", "été", "x1"]
    for _ in range(n):
        parts = []
        for _ in range(rnd.randrange(1, 6)):
            t = plain_words(rnd.choice((*license_scan.PHRASES, *license_scan.TEMPLATES))[1])
            a, b = sorted(rnd.sample(range(len(t) + 1), 2))
            cut = t[a:b] if rnd.random() < 0.6 else list(t)
            if rnd.random() < 0.5:
                cut.insert(rnd.randrange(len(cut) + 1), rnd.choice(bank))
            parts += cut + [rnd.choice(bank) for _ in range(rnd.randrange(4))]
        yield " ".join(w.upper() if rnd.random() < 0.2 and w.isascii() else w for w in parts)


def test_words():
    for text in ("", "A-b_C9 \x1cÉté\tx\x00y日本 `q`~z", "MIT License", "é" * 3 + "[ß]"):
        assert [w.decode() for w in words_of(text.encode())] == plain_words(text)


def test_statistics_and_places_equal_trying_all():
    rnd = random.Random(5)
    for _ in range(60):
        strings = [[rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 9))] for _ in range(rnd.randrange(1, 5))]
        a = TokenAutomaton(strings)
        text = [rnd.randrange(0, 5) for _ in range(40)]
        walked = list(a.walk(text))
        assert [n for _, n in walked] == plain_statistics(text, strings)
        for e, (state, n) in enumerate(walked):
            want = {(t, i + n - 1) for t, s in enumerate(strings) for i in range(len(s) - n + 1) if n and s[i:i + n] == text[e - n + 1:e + 1]}
            assert set(a.places[state]) == want


def test_chains_equal_all_subsets():
    rnd = random.Random(2)
    for _ in range(80):
        matches = sorted({(rnd.randrange(30), rnd.randrange(30), rnd.randrange(2, 7)) for _ in range(rnd.randrange(1, 8))})
        gap, best = 5, 0
        for k in range(1, len(matches) + 1):
            for c in itertools.combinations(matches, k):
                covered = c[0][2]
                for (d, t, n), (e, u, m) in zip(c, c[1:]):
                    shared = max(0, d + n - e, t + n - u)
                    if not (d < e and t < u and shared < m and e - d - n <= gap and u - t - n <= gap):
                        break
                    covered += m - shared
                else:
                    best = max(best, covered)
        chains = chain_matches(matches, gap)
        assert max(c[2] for c in chains) == best and sum(c[2] for c in chains) <= sum(m[2] for m in matches)


def test_scan_equals_trying_all(monkeypatch):
    scanner = LicenseScanner()
    for i, text in enumerate(licence_texts(120, 3)):
        monkeypatch.setattr(common, "WORD_PIECE", 1 << 20 if i % 2 else 40)  # pieces end inside matches and phrases
        words = plain_words(text)
        s = scanner.scan(text.encode())
        spans, score = plain_spans(words, scanner)
        assert s.n_words == len(words) and s.places == plain_places(words)
        assert s.spans == spans and s.score == (1.0 if s.places else score)


@pytest.mark.parametrize("label,text", license_scan.TEMPLATES)
def test_template_is_found_with_words_lost_and_added(label, text):
    scanner = LicenseScanner()
    words = plain_words(text)
    for body in (words, words[:4] + words[5:] if len(words) > 20 else words, words[:9] + ["indeed"] + words[9:]):
        s = scanner.scan(("some text before " + " ".join(body) + " and some after").encode())
        assert label in {x[0] for x in s.spans} and s.score >= license_scan.MIN_SHARE
    assert not scanner.scan(" ".join(words[::-1]).encode()).spans


def test_nearest_version_wins():
    spans = LicenseScanner().scan(b"This work is licensed under the GNU General Public License, version 3.").spans
    assert [s[0] for s in spans] == ["gpl-3.0"]


def test_query_over_whole_table(spark):
    docs = queries.table(spark, SF_MID, "documents").collect()
    scanner = LicenseScanner()
    out = {r.doc_id: r for r in queries.QUERIES["op11_license_scan"](spark, SF_MID).collect()}
    assert len(out) == len(docs)
    for d in docs:
        words = plain_words(d.text)
        places = plain_places(words)
        base = sorted({license_scan.PHRASES[p][0] for _, p in places})
        r = out[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base))
        assert set(base) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        if places:
            spans, _ = plain_spans(words, scanner)
            assert r.labels == ",".join(sorted({*base, *(s[0] for s in spans)}))
    assert any(r.labels != r.base_labels for r in out.values())


def test_messy_and_empty(spark, messy, empty):
    out = license_scan.scan_documents(messy.withColumnRenamed("mix", "license"))
    rows = out.collect()
    assert len(rows) == messy.count() and out.columns[:-1] == [c for c in messy.columns if c != "mix"]
    for r in rows:
        assert r.license.n_words == len(plain_words(r.text)) and r.license.score == 0 and not r.license.places
    assert license_scan.scan_documents(empty).count() == 0

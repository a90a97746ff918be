"""Licence scans: matching statistics against a generalised suffix automaton of licence tokens, chained into template spans.

The tokens of all templates go into one suffix automaton. A text is streamed through it word by word; at each word
the state is the longest run of words ending there that some template holds. From these statistics come

* *phrases*: a template whose whole token string ends at the word. Each state knows the phrases that end in all
  of its strings, so one lookup per word finds every place of every phrase, overlapping ones included;
* *matches*: runs of ``min_match`` words or more that can't be made longer, with their places in templates.
  Matches of one template in the same order and at most ``max_gap`` words apart are chained; a chain
  covers template words, and one that covers ``min_share`` of its template is a span with the template's label,
  unless it lies inside a longer span.

A word outside the templates sends the automaton to its root, so only runs of template words are streamed. The
automaton is fixed data of some thousand states; texts are scanned row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import fresh, plus, slices, unused, utf8, word_pieces

MIN_MATCH = 3
MAX_GAP = 12
MIN_SHARE = 0.7
#: Phrases of which every place counts, and their labels.
PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))
#: Public licence notices.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                 "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
                 "notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "GNU Lesser General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
                     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc0", "Creative Commons Zero v1.0 Universal public domain dedication"),
    ("all-rights-reserved", "All rights reserved."),
)
_ZERO = np.zeros(1, bool)
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of letters, digits and everything beyond ASCII, A-Z lower-cased."""
    return text.translate(_WORDS).split()


class TokenAutomaton:
    """Generalised suffix automaton of token strings, with the places (template, last position) of every state."""

    def __init__(self, strings: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.places: list[list[tuple[int, int]]] = [[]]
        for t, tokens in enumerate(strings):
            last = 0
            for i, token in enumerate(tokens):
                last = self._append(last, token)
                self.places[last].append((t, i))
        for s in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.places[self.link[s]].extend(self.places[s])
        self.places = [sorted(set(p)) if s else [] for s, p in enumerate(self.places)]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.places.append([])
        return len(self.length) - 1

    def _split(self, p: int, token: int) -> int:
        """The state of the longest string of ``p`` plus ``token``, parted from longer ones where need be."""
        q = self.next[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        part = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = part
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = part
            p = self.link[p]
        return part

    def _append(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, token)
        return new

    def walk(self, tokens: Iterable[int], state: int = 0, length: int = 0) -> Iterable[tuple[int, int]]:
        """After each token, the state and the length of the longest string ending there that a template holds."""
        follow, link, longest = self.next, self.link, self.length
        for token in tokens:
            while state and token not in follow[state]:
                state = link[state]
                length = longest[state]
            if token in follow[state]:
                state = follow[state][token]
                length += 1
            yield state, length


@dataclass(frozen=True)
class Scan:
    """What a text holds: places (first word, phrase) and spans (label, first word, last word, covered share)."""
    n_words: int
    places: list[tuple[int, int]]
    spans: list[tuple[str, int, int, float]]
    score: float


def chain_matches(matches: list[tuple[int, int, int]], max_gap: int) -> list[tuple[int, int, int]]:
    """Best chains of one template's matches (first word, first template word, length), as (first word, last word, covered template words).

    In a chain both places grow, both gaps are ``max_gap`` at most, and what two matches share counts once. Each
    match is chained to the predecessor that gives most covered words; chains are taken by covered words, each up to
    the matches taken before. Only matches whose end is within reach of the next one's start are compared.
    """
    matches = sorted(matches)
    best = [m[2] for m in matches]
    back = [-1] * len(matches)
    longest = max((m[2] for m in matches), default=0)
    low = 0
    for j, (d, t, n) in enumerate(matches):
        while matches[low][0] + longest + max_gap < d:
            low += 1
        for i in range(low, j):
            di, ti, ni = matches[i]
            shared = max(0, di + ni - d, ti + ni - t)
            if di < d and ti < t and shared < n and d - (di + ni) <= max_gap and t - (ti + ni) <= max_gap and best[i] + n - shared > best[j]:
                best[j], back[j] = best[i] + n - shared, i
    chains, used = [], set()
    for j in sorted(range(len(matches)), key=lambda j: (-best[j], matches[j])):
        i, first = j, -1
        while i >= 0 and i not in used:
            used.add(i)
            first, i = i, back[i]
        if first >= 0:  # cut where it meets a chain taken before
            chains.append((matches[first][0], matches[j][0] + matches[j][2] - 1, best[j] - (best[i] if i >= 0 else 0)))
    return sorted(chains)


def outer_spans(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Spans (label, first, last, share) that don't lie inside a longer one: of templates that share words, the one that fits more of them."""
    out, reach, start = [], -1, -1
    for s in sorted(set(spans), key=lambda s: (s[1], -s[2], s[0], -s[3])):
        if s[2] > reach or (s[1], s[2]) == (start, reach):
            out.append(s)
            start, reach = s[1], s[2]
    return out


class _Stream:
    """A text on its way through the automaton."""

    def __init__(self, scanner: LicenseScanner):
        self.scanner, self.state, self.length = scanner, 0, 0
        self.places: list[tuple[int, int]] = []
        self.found: dict[int, list[tuple[int, int, int]]] = {}

    def feed(self, tokens: Iterable[int], first: int) -> None:
        """Template words of which the first is word ``first`` of the text."""
        _, automaton, ending, _ = self.scanner.built
        least = self.scanner.min_match
        word = first
        for state, length in automaton.walk(tokens, self.state, self.length):
            if self.length >= least and length != self.length + 1:
                self._match(word - 1)
            self.state, self.length = state, length
            for size, p in ending[state]:
                if size <= length:
                    self.places.append((word - size + 1, p))
            word += 1

    def stop(self, word: int) -> None:
        """Word ``word`` is in no template, or is the end."""
        if self.length >= self.scanner.min_match:
            self._match(word - 1)
        self.state = self.length = 0

    def _match(self, last: int) -> None:
        n, phrases = self.length, len(self.scanner.phrases)
        for t, at in self.scanner.built[1].places[self.state]:
            if t >= phrases:
                self.found.setdefault(t, []).append((last - n + 1, at - n + 1, n))


class LicenseScanner:
    """Phrases and templates in one automaton, and the scan of a text."""

    def __init__(self, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES,
                 min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, min_share: float = MIN_SHARE):
        self.phrases, self.templates = tuple(phrases), tuple(templates)
        self.min_match, self.max_gap, self.min_share = min_match, max_gap, min_share

    def __reduce__(self):
        return LicenseScanner, (self.phrases, self.templates, self.min_match, self.max_gap, self.min_share)

    @cached_property
    def built(self):
        strings = [words_of(text.encode()) for _, text in (*self.phrases, *self.templates)]
        if not all(strings):
            raise ValueError("phrases and templates have one word at least")
        numbers: dict[bytes, int] = {}
        tokens = [[numbers.setdefault(w, len(numbers) + 1) for w in s] for s in strings]
        automaton = TokenAutomaton(tokens)
        home = []
        for s in tokens[:len(self.phrases)]:
            home.append(list(automaton.walk(s))[-1][0])
        # phrases that end in every string of a state that is longer than its link, by state: (words, phrase), shortest first
        ending: list[tuple[tuple[int, int], ...]] = [()] * len(automaton.length)
        for state in sorted(range(1, len(ending)), key=automaton.length.__getitem__):
            own = sorted((len(tokens[p]), p) for p, h in enumerate(home) if h == state)
            ending[state] = (*ending[automaton.link[state]], *own)
        return numbers, automaton, ending, [len(t) for t in tokens]

    def scan(self, text: bytes | None) -> Scan:
        numbers, _, _, sizes = self.built
        stream, n_words, known = _Stream(self), 0, numbers.get
        least = min(self.min_match, *sizes)  # no shorter run of template words can tell anything
        for words in word_pieces(text.translate(_WORDS)) if text else ():
            n = len(words)
            ids = np.fromiter(map(known, words, repeat(0)), np.int32, n)
            edge = np.flatnonzero(np.diff(np.concatenate([_ZERO, ids > 0, _ZERO])))
            for a, b in edge.reshape(-1, 2).tolist():
                if a:
                    stream.stop(n_words)
                if b - a >= least or a == 0 or b == n:
                    stream.feed(ids[a:b].tolist(), n_words + a)
                    if b < n:
                        stream.stop(n_words + b)
            if n and ids[-1] == 0:
                stream.stop(n_words)
            n_words += n
        stream.stop(n_words)
        spans, score = [], 0.0
        for t, matches in sorted(stream.found.items()):
            for first, last, covered in chain_matches(matches, self.max_gap):
                share = covered / sizes[t]
                score = max(score, share)
                if share >= self.min_share:
                    spans.append((self.templates[t - len(self.phrases)][0], first, last, share))
        return Scan(n_words, sorted(stream.places), outer_spans(spans), 1.0 if stream.places else score)


def scan_documents(docs: DataFrame, *, text_col: str = "text", scanner: LicenseScanner | None = None) -> DataFrame:
    """``docs`` with a struct ``license`` (an input column of that name is replaced): ``n_words``, ``places`` (word, label) of
    phrases, ``spans`` (label, first, last, share) of templates, and ``score``, the largest share of a template
    that a chain covers, 1 where a phrase stands.

    Null and empty texts have no words, places or spans and score 0. Words are numbered from 0 over the whole text, however long.
    Rows are scanned one by one, so ties, repeated rows and other columns don't matter; an empty table gives an empty table.
    """
    src = fresh(docs, "license")
    names, held = src.columns, unused(src, "_text")
    scanner = scanner or LicenseScanner()

    def run(batches):
        for b in slices(batches):
            rows = []
            for t in utf8(b.column(held)):
                s = scanner.scan(t)
                rows.append({"n_words": s.n_words, "places": [{"word": w, "label": scanner.phrases[p][0]} for w, p in s.places],
                             "spans": [dict(zip(("label", "first", "last", "share"), x)) for x in s.spans], "score": s.score})
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(rows, made)], names=[*names, "license"])
    made = pa.struct([("n_words", pa.int64()), ("places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
                      ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())]))),
                      ("score", pa.float64())])
    schema = plus(src.schema, "license struct<n_words:bigint,places:array<struct<word:bigint,label:string>>,"
                              "spans:array<struct<label:string,first:bigint,last:bigint,share:double>>,score:double>")
    return src.withColumn(held, F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)

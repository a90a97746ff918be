"""SentencePiece BPE encoding and decoding by backtracking, exact.

The merge result of a text is the one sequence of pieces in which every two neighbours are
compatible, that is, merging their joined text anew gives just these two. An Aho-Corasick scan finds the
longest piece at every position; the encoder goes from left to right with the longest piece, takes
the next shorter one when a piece doesn't fit its left neighbour, and steps back when none is left.
A bitfield holds the positions from which no encoding exists, so no position fails twice.

Two facts of the vocabulary, verified when it is loaded, bound the work:

* no piece has a space mark after another character, so text is cut before each run of marks;
* pieces with equal scores (whose order depends on position) are runs of space marks only, and no
  other piece holds two marks. They merge after everything else, from left to right, and are
  merged literally.

Characters outside the vocabulary stand alone and become byte pieces. Two adjacent characters that no
piece holds side by side are never merged across, so text is also cut between them; what remains are
short strings that come back often, and a task remembers a bounded number of them, as packed ids.

Whether two pieces are compatible is read off their merge trees: going back in time along the seam between them, every pair
of symbols that once stood side by side there is looked up; the pieces fit when none of these pairs
would have merged before its symbols were used up inside their own piece.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from functools import lru_cache
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import fresh, plus, slices, unused

MARK = "▁"
_ESCAPE = re.compile("[\udc80-\udcff]")
#: Encoded strings that a generation of a worker's memory holds (there are two), and their longest.
CACHE_PARTS = 150_000
CACHE_CHARS = 48
#: Characters of a very long text that are encoded at a time (cut before space marks).
LONG_CHARS = 1 << 20
#: Pairs of pieces whose fit a task remembers.
FITS = 250_000
_LATE = 1 << 60


class Memory:
    """A bounded dictionary: when the young generation is full it becomes the old one, and that is forgotten.

    A string is kept from its second sight on (by a bitmap of hashes), as most strings come once.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}
        self.seen = bytearray(1 << 21)

    def get(self, key: str) -> bytes | None:
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self._keep(key, got)
        return got

    def put(self, key: str, ids: bytes) -> None:
        if len(key) <= CACHE_CHARS:
            at = hash(key) & (1 << 21) - 1
            if self.seen[at]:
                self._keep(key, ids)
            else:
                self.seen[at] = 1

    def clear(self) -> None:
        self.young, self.old, self.seen = {}, {}, bytearray(1 << 21)

    def _keep(self, key: str, ids: bytes) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young, self.seen = self.young, {}, bytearray(1 << 21)
        self.young[key] = ids


class PieceBpe:
    def __init__(self, model_path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self._normalize = sp.normalize
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.byte_of: dict[int, int] = {}
        plain: dict[str, int] = {}
        score: dict[str, float] = {}
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_of[i] = int(p[3:5], 16)
                self.byte_ids[self.byte_of[i]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain[p], score[p] = i, sp.get_score(i)
        if len(self.byte_of) != 256:
            raise ValueError("the model has no byte pieces to fall back on")
        seen: dict[float, int] = {}
        for p, s in score.items():
            if len(p) > 1:
                seen[s] = seen.get(s, 0) + 1
        marks = {p for p in plain if len(p) > 1 and not p.strip(MARK)}
        tied = {p for p, s in score.items() if len(p) > 1 and seen[s] > 1}
        if not tied <= marks or any(MARK + MARK in p for p in plain if p not in marks) or any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("the model's pieces tie in score or cross space marks in ways that this encoder doesn't cover")
        if marks and min(s for p, s in score.items() if len(p) > 1 and p not in marks) <= max(score[p] for p in marks):
            raise ValueError("runs of space marks merge before other pieces in this model")
        self.ids = {p: i for p, i in plain.items() if p not in marks}
        self._marks = {p: i for p, i in plain.items() if p in marks}
        self._score = score
        self._adjacent = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self._trie = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) > 1:  # characters stand for themselves
                self._trie.add_word(p, i)
        self._trie.make_automaton()
        self._size = [len(p) for p in self.pieces]
        self._plant_trees(n)
        self._fits: dict[int, bool] = {}  # by number of the left piece (-1: the start) times n plus that of the right
        self._code = "H" if n <= 1 << 16 else "I"
        self._packed = np.dtype(self._code)
        self._lone = self._pack([self.ids[MARK]]) if MARK in self.ids else None
        self._shorter = [-2] * n  # longest piece that is a proper prefix; -1: none, -2: not looked up yet
        self._parts = Memory(CACHE_PARTS // 2)  # by characters
        self._marked = Memory(CACHE_PARTS)  # by the characters after a space mark
        self._runs: dict[int, bytes] = {}
        self._text = [p.replace(MARK, " ") for p in self.pieces]
        # bytes beyond ASCII as escapes, to be joined to characters
        self._escaped = [bytes([self.byte_of[i]]).decode("utf-8", "surrogateescape") if i in self.byte_of else "" if i in self.silent
                         else " ⁇ " if i == self.unknown else t for i, t in enumerate(self._text)]
        self.digits = [str(i) for i in range(n)]

    def merge(self, text: str, vocabulary: dict[str, int] | None = None) -> list[str]:
        """Literal merging: the best-scored adjacent pair first, the leftmost of equals."""
        vocabulary = self.ids if vocabulary is None else vocabulary
        score = self._score
        sym: list[str | None] = list(text)
        nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < len(sym) and (p := sym[i] + sym[j]) in vocabulary:
                heapq.heappush(heap, (-score[p], i, sym[i], sym[j]))
        for i in range(len(sym) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if sym[i] != a or (j := nxt[i]) >= len(sym) or sym[j] != b:
                continue
            sym[i], sym[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[j] < len(sym):
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return [s for s in sym if s is not None]

    def _plant_trees(self, n: int) -> None:
        """For each piece, when it is merged (rank by score, -1: a character) and of which two; ``_seams`` has the rank of what two pieces merge to.

        The split of a piece is the one whose parts fit side by side until its own rank. A piece without
        such a split, or with a part that merges later than itself, is left to literal merging.
        """
        self._rank, self._left, self._right = [-1] * n, [-1] * n, [-1] * n
        self._seams: dict[int, int] = {}
        self._literal: set[int] = set()
        order = sorted((p for p in self.ids if len(p) > 1), key=lambda p: -self._score[p])
        for r, p in enumerate(order):
            self._rank[self.ids[p]] = r
        for p in order:
            i = self.ids[p]
            splits = [(a, b) for k in range(1, len(p)) if (a := self.ids.get(p[:k], -1)) >= 0 and (b := self.ids.get(p[k:], -1)) >= 0]
            for a, b in splits:
                self._seams[a * n + b] = self._rank[i]
        for p in order:
            i = self.ids[p]
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k], -1), self.ids.get(p[k:], -1)
                if a >= 0 and b >= 0 and max(self._rank[a], self._rank[b]) < self._rank[i] and not {a, b} & self._literal and self._seam_holds(a, b, False):
                    self._left[i], self._right[i] = a, b
                    break
            else:
                self._literal.add(i)

    def _seam_holds(self, x: int, y: int, top: bool = True) -> bool:
        """Whether no two symbols that meet at the seam of pieces ``x`` and ``y`` merge; ``top``: the whole pieces count too.

        A pair merges when the better of its own rank and its symbols' births comes before either is used up. At equal
        ranks the left merge goes first, so the left symbol must outlive the pair and the right one may end with it.
        """
        n, rank, seams = len(self.pieces), self._rank, self._seams
        used_x = used_y = _LATE
        while True:
            born_x, born_y = rank[x], rank[y]
            if top:
                at = seams.get(x * n + y)
                if at is not None:
                    at = max(at, born_x, born_y)
                    if at < used_x and at <= used_y:
                        return False
            top = True
            if born_x > born_y:
                x, used_x = self._right[x], born_x
            elif born_y >= 0:
                y, used_y = self._left[y], born_y
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        """Whether piece ``a`` (-1: the start) then piece ``b`` is what merging their joined text gives."""
        key = a * len(self.pieces) + b
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) >= FITS:
                self._fits.clear()
            if a in self._literal or b in self._literal:
                pair = [self.pieces[i] for i in (a, b) if i >= 0]
                ok = self.merge("".join(pair)) == pair
            else:
                ok = a < 0 or self._seam_holds(a, b)
            self._fits[key] = ok
        return ok

    def forget(self) -> None:
        """Empties the memories; tables of the vocabulary stay."""
        self._fits.clear()
        self._parts.clear()
        self._marked.clear()

    def _pack(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()

    def shorter(self, i: int) -> int:
        """The longest piece that is a proper prefix of piece ``i``, or -1."""
        got = self._shorter[i]
        if got == -2:
            p = self.pieces[i]
            got = self._shorter[i] = next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1)
        return got

    def backtrack(self, text: str) -> list[int]:
        """Ids of the pieces of a text whose characters are all in the vocabulary."""
        whole = self.ids.get(text)
        if whole is not None and self.fits(-1, whole):
            return [whole]
        n, size, n_pieces = len(text), self._size, len(self.pieces)
        longest = [*map(self.ids.__getitem__, text), -1]
        for end, i in self._trie.iter(text):
            longest[end + 1 - size[i]] = i  # ends ascend, so the longest piece of a position comes last
        open_at = bytearray(b"\1") * (n + 1)  # 0: no encoding goes on from here
        known, shorter = self._fits.get, self._shorter
        out: list[int] = []
        last, pos, piece = -1, 0, longest[0]
        while pos < n:
            while piece >= 0:
                end = pos + size[piece]
                if open_at[end]:
                    ok = known(last * n_pieces + piece)
                    if ok or ok is None and self.fits(last, piece):
                        out.append(piece)
                        last, pos, piece = piece, end, longest[end]
                        break
                less = shorter[piece]
                piece = less if less != -2 else self.shorter(piece)
            else:
                open_at[pos] = 0
                piece = out.pop()
                pos -= size[piece]
                last = out[-1] if out else -1
        return out

    def _part(self, part: str) -> bytes:
        """Packed ids of one space mark (or none) and the characters up to the next."""
        joined = list(map(self._adjacent.__contains__, map(add, part, part[1:])))
        if all(joined):
            return self._known(part)
        out, start, cut = [], 0, joined.index(False)
        while True:
            out.append(self._known(part[start:cut + 1]))
            start = cut + 1
            try:
                cut = joined.index(False, start)
            except ValueError:
                out.append(self._known(part[start:]))
                return b"".join(out)

    def _known(self, text: str) -> bytes:
        """Packed ids of one character, or of characters that all stand side by side in some piece."""
        got = self._parts.get(text)
        if got is None:
            if len(text) == 1 and text not in self.ids:
                got = [self.byte_ids[b] for b in text.encode("utf-8")]
            else:
                got = self.backtrack(text)
            got = self._pack(got)
            self._parts.put(text, got)
        return got

    def _run(self, k: int) -> bytes:
        """Packed ids of ``k`` space marks that merge with nothing else."""
        got = self._runs.get(k)
        if got is None:
            got = self._pack([self._marks[p] if p in self._marks else self.ids[p] for p in self.merge(MARK * k, self._marks)])
            if k <= 256:
                self._runs[k] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        """Ids without begin and end ids; null: none."""
        return self.encode_array(text).tolist()

    def encode_array(self, text: str | None) -> np.ndarray:
        """The same, as an array."""
        norm = self._normalize(text) if text else ""
        if len(norm) <= LONG_CHARS:
            return np.frombuffer(self._encode(norm), self._packed)
        out: list[bytes] = []
        at = 0
        while at < len(norm):
            cut = norm.find(MARK, at + LONG_CHARS)
            while cut > 0 and norm[cut - 1] == MARK:  # a run of marks stays together
                cut = norm.find(MARK, cut + 1)
            cut = len(norm) if cut < 0 else cut
            out.append(self._encode(norm[at:cut]))
            at = cut
        return np.frombuffer(b"".join(out), self._packed)

    def _encode(self, norm: str) -> bytes:
        """Packed ids of normalised text that begins at a run of space marks, or at the start."""
        parts = norm.split(MARK)
        out: list[bytes] = []
        if parts[0]:
            out.append(self._part(parts[0]))
        marked, lone, run = self._marked, self._lone, 0
        size = self._packed.itemsize
        for p in parts[1:]:
            if not p:
                run += 1
                continue
            got = marked.young.get(p) or marked.get(p)
            if got is None:
                got = self._part(MARK + p)
                marked.put(p, got)
            if run:
                if got[:size] == lone:
                    out.append(self._run(run + 1))
                    out.append(got[size:])
                else:
                    out.append(self._run(run))
                    out.append(got)
                run = 0
            else:
                out.append(got)
        if run:
            out.append(self._run(run))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids, as the library's ``decode``: one leading space of the first piece goes, byte pieces
        join to characters, a byte that begins no valid character becomes U+FFFD."""
        if not self.silent.isdisjoint(ids):
            return self._decode_any(ids)
        said = "".join(map(self._escaped.__getitem__, ids))
        if said.startswith(" ") and ids[0] not in self.byte_of and ids[0] != self.unknown:
            said = said[1:]
        if not _ESCAPE.search(said):
            return said
        try:
            return said.encode("utf-8", "surrogateescape").decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_any(ids)

    def _decode_any(self, ids: list[int]) -> str:
        """The same, id by id: for bytes that form no character."""
        out: list[str] = []
        held = bytearray()
        byte_of, text = self.byte_of, self._text
        first = True
        for i in ids:
            b = byte_of.get(i)
            if b is not None:
                held.append(b)
                first = False
                continue
            if held:
                out.append(_characters(bytes(held)))
                held.clear()
            if i in self.silent:
                continue
            if i == self.unknown:
                out.append(" ⁇ ")
            else:
                t = text[i]
                out.append(t[1:] if first and t.startswith(" ") else t)
            first = False
        if held:
            out.append(_characters(bytes(held)))
        return "".join(out)


def _characters(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(data):
            for k in (1, 2, 3, 4):
                try:
                    out.append(data[i:i + k].decode("utf-8"))
                    i += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@lru_cache(maxsize=2)
def tokenizer(model_path: str) -> PieceBpe:
    """One per Python worker. Tasks empty its memories when they end, so an idle worker holds the vocabulary only."""
    return PieceBpe(model_path)


def encode_documents(docs: DataFrame, model_path: str, *, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array<int>; an input column of that name is replaced). Null and empty text: no ids.

    Row by row: ties, repeated rows and other columns don't matter. ``model_path`` is a path that
    every worker has. An empty table gives an empty table.
    """
    src = fresh(docs, out_col)
    names, held = src.columns, unused(src, "_text")

    def run(batches):
        t = tokenizer(model_path)
        try:
            for b in slices(batches):
                ids = [t.encode_array(x.as_py()) for x in b.column(held)]
                starts = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                made = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(ids, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), made], names=[*names, out_col])
        finally:
            t.forget()
    return (src.withColumn(held, F.col(f"`{text_col}`").cast("string"))
            .mapInArrow(run, plus(src.schema, f"`{out_col}` array<int>")))


def decode_documents(rows: DataFrame, model_path: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``decoded`` (replaced if there). Null ids: empty text."""
    src = fresh(rows, out_col)
    names = src.columns

    def run(batches):
        t = tokenizer(model_path)
        for b in batches:
            said = pa.array([t.decode(x.as_py() or []) for x in b.column(ids_col)], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), said], names=[*names, out_col])
    return src.mapInArrow(run, plus(src.schema, f"`{out_col}` string"))


def round_trip_digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text; per row ``id_col``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The same encoder and decoder as above, with digests taken inside the task so that no ids are moved.
    """
    src = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(batches):
        t = tokenizer(model_path)
        digits = t.digits
        try:
            for b in batches:
                n, ids_sha, text_sha = np.empty(b.num_rows, np.int64), [], []
                for k, x in enumerate(b.column("_text")):
                    ids = t.encode(x.as_py())
                    n[k] = len(ids)
                    ids_sha.append(hashlib.sha256(",".join([digits[i] for i in ids]).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(t.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(ids_sha), pa.array(text_sha)],
                                                 names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            t.forget()
    schema = plus(src.select(id_col).schema, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return src.mapInArrow(run, schema)

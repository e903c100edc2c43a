"""SentencePiece BPE encoding by suffix-array matching, and decoding.

A text becomes ``▁`` and its characters with blanks as ``▁``; it is cut into
units of ``▁`` runs and what follows (no piece goes over such a cut, so units
are independent). For each stretch of a batch, the distinct units are
concatenated and their suffixes sorted as far as the longest piece reaches
(prefix doubling); every piece of the vocabulary is found by two binary
searches, which give the range of its occurrences. The occurrences are edges
from their start to their end; sorted by position they are relaxed: in each
unit the best-scored edge that joins two adjacent symbols (the leftmost of
equals) replaces them, until none is left. That is the BPE rule. All units
take a step at a time. Units over ``LONG`` characters are first cut between
characters that stand together in no piece, as nothing is joined there; what is
still longer uses a heap. Units are worked through ``STRETCH`` characters at a
time, so a long text needs no more memory, unless it goes on without any such
place (say, millions of one letter).
Characters outside the vocabulary become byte pieces.

Defined results: null and empty texts have no ids; repeated rows are encoded
alike; an empty table gives an empty one. Decoding puts pieces together, reads
``▁`` as a blank and drops the first one; control ids are nothing, bytes that
aren't UTF-8 become U+FFFD. A ``▁`` in a text comes back as a blank.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LONG = 128
#: Characters of text in one stretch.
STRETCH = 2 << 20
_MARK = "▁"
_UNIT = re.compile(f"{_MARK}+[^{_MARK}]*")
_MODELS: dict[str, "Pieces"] = {}


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)


class _Numbering(dict):
    """Numbers new keys in the order they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Pieces:
    """A BPE model's vocabulary, prepared for searching."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        if not all(model.is_byte(int(i)) for i in self.bytes):
            raise ValueError("the model has no byte pieces")
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        text = {i: model.id_to_piece(i) for i in plain}
        if any(_MARK in t.lstrip(_MARK) for t in text.values()):
            raise ValueError("a piece goes over the start of a word")
        self.single = np.full(0x110000, -1, dtype=np.int32)
        many = []
        for i, t in text.items():
            if len(t) == 1:
                self.single[ord(t)] = i
            else:
                many.append(i)
        alphabet = sorted({c for i in many for c in text[i]})
        if len(alphabet) >= 1 << 16:
            raise ValueError("more than 65,535 characters in pieces")
        self.rank_of = np.zeros(0x110000, dtype=np.uint64)  # 0: in no longer piece
        self.rank_of[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        # every two neighbouring characters of a piece
        self.pairs = np.unique(np.array([self._pair(ord(x), ord(y)) for i in many for x, y in zip(text[i], text[i][1:])], dtype=np.uint64))
        self.ids = np.array(many, dtype=np.int32)
        self.sizes = np.array([len(text[i]) for i in many], dtype=np.int64)
        self.longest = int(self.sizes.max())
        self.words = 1  # of four characters each; a power of two
        while 4 * self.words < self.longest:
            self.words *= 2
        table = np.zeros((len(many), 4 * self.words), dtype=np.uint64)
        for k, i in enumerate(many):
            table[k, :len(text[i])] = self.rank_of[[ord(c) for c in text[i]]]
        past = np.where(np.arange(4 * self.words) < self.sizes[:, None], table, np.uint64(0xFFFF))
        self.low, self.high = self._packed(table), self._packed(past)
        self.score = np.unique([model.get_score(i) for i in many], return_inverse=True)[1].astype(np.int64)
        self.out = [model.id_to_piece(i).replace(_MARK, " ").encode() if i in text else b"" for i in range(n)]
        for b, i in enumerate(self.bytes):
            self.out[i] = bytes([b])
        self.out[model.unk_id()] = " ⁇ ".encode()

    def _pair(self, x, y) -> np.ndarray:
        return (self.rank_of[x] << np.uint64(16)) | self.rank_of[y]

    def _cut(self, unit: str) -> list[str]:
        """A long unit, cut between characters that stand together in no piece: nothing is joined over such a place."""
        cp = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        pair = self._pair(cp[:-1], cp[1:])
        known = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        cuts = (np.flatnonzero(~known) + 1).tolist()
        return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]

    @staticmethod
    def _packed(rows: np.ndarray) -> np.ndarray:
        r = rows.reshape(len(rows), -1, 4)
        return (r[:, :, 0] << np.uint64(48)) | (r[:, :, 1] << np.uint64(32)) | (r[:, :, 2] << np.uint64(16)) | r[:, :, 3]

    def _suffixes(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in order of as many characters as pieces reach, and four packed characters from each place."""
        c = np.concatenate([chars, np.zeros(4 * self.words + 4, np.uint64)])
        packed = (c[:-3] << np.uint64(48)) | (c[1:-2] << np.uint64(32)) | (c[2:-1] << np.uint64(16)) | c[3:]
        n, key, step = len(chars), packed[:len(chars)], 4
        while True:
            order = np.argsort(key)
            if step >= 4 * self.words:
                return order, packed
            ahead = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate([[1], ahead[1:] != ahead[:-1]]))
            key = rank * (n + 1) + np.concatenate([rank[step:], np.zeros(min(step, n), np.int64)])
            step *= 2

    def _search(self, order: np.ndarray, packed: np.ndarray, words: np.ndarray, after: bool) -> np.ndarray:
        """For every piece: how many suffixes are below its words (or not above them)."""
        lo, hi = np.zeros(len(words), np.int64), np.full(len(words), len(order), np.int64)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            at = order[np.minimum(mid, len(order) - 1)]
            below, equal = np.zeros(len(words), bool), np.ones(len(words), bool)
            for j in range(self.words):
                w = packed[at + 4 * j]
                below |= equal & (w < words[:, j])
                equal &= w == words[:, j]
            right = (below | (equal & after)) & open_
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)

    def _edges(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``slot[start * (longest + 1) + size]`` -> edge or -1; the edges' pieces and scores, sorted by position."""
        order, packed = self._suffixes(chars)
        begin, stop = self._search(order, packed, self.low, False), self._search(order, packed, self.high, True)
        count = stop - begin
        piece = np.repeat(np.arange(len(self.ids)), count)
        key = order[_ranges(begin, count)] * (self.longest + 1) + self.sizes[piece]
        by_place = np.argsort(key)
        slot = np.full((len(chars) + 1) * (self.longest + 1), -1, dtype=np.int32)
        slot[key[by_place]] = np.arange(len(key))
        return slot, piece[by_place], self.score[piece[by_place]]

    def _join(self, size: np.ndarray, nxt: np.ndarray, prv: np.ndarray, alive: np.ndarray, unit: np.ndarray, slot: np.ndarray, score: np.ndarray, at: np.ndarray) -> None:
        """Relax the edges of the units whose places are ``at``, one join in each unit at a time."""
        wide = self.longest + 1

        def edge(left: np.ndarray) -> np.ndarray:
            right = nxt[left]
            both = size[left] + size[right]
            return np.where((right >= 0) & (both < wide), slot[left * wide + np.minimum(both, wide - 1)], -1)

        best_edge = np.full(len(size), -1, dtype=np.int64)
        best_edge[at] = edge(at)
        while len(at):
            e = best_edge[at]
            value = np.where(e >= 0, (score[e] << 32) | (0xFFFFFFFF - at), -1)
            first = np.flatnonzero(np.concatenate([[True], unit[at][1:] != unit[at][:-1]]))
            best = np.maximum.reduceat(value, first)
            each = np.repeat(best, np.diff(np.append(first, len(at))))
            left = at[(value == each) & (value >= 0)]
            right = nxt[left]
            size[left] += size[right]
            far = nxt[right]
            nxt[left] = far
            prv[far[far >= 0]] = left[far >= 0]
            alive[right] = False
            best_edge[left] = edge(left)
            before = prv[left]
            before = before[before >= 0]
            best_edge[before] = edge(before)
            at = at[(each >= 0) & alive[at]]

    def _join_long(self, a: int, b: int, size: np.ndarray, alive: np.ndarray, slot: np.ndarray, score: np.ndarray) -> None:
        """The same for one long unit, by a heap of its adjacent pairs."""
        wide, n = self.longest + 1, b - a
        length, nxt, prv, agenda = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1)), []
        dead = [False] * n

        def offer(left: int) -> None:
            right = nxt[left]
            if left >= 0 and right < n and (both := length[left] + length[right]) < wide and (e := slot[(a + left) * wide + both]) >= 0:
                heapq.heappush(agenda, (-int(score[e]), left, right, both))

        for i in range(n):
            offer(i)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if dead[left] or dead[right] or nxt[left] != right or length[left] + length[right] != both:
                continue
            length[left], dead[right], nxt[left] = both, True, nxt[right]
            if nxt[left] < n:
                prv[nxt[left]] = left
            offer(left)
            if prv[left] >= 0:
                offer(prv[left])
        size[a:b], alive[a:b] = length, ~np.array(dead)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after the other, and each unit's first (with the end)."""
        cp = np.frombuffer("\0".join([*units, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        length = np.array([len(u) for u in units], dtype=np.int64)
        begin = np.cumsum(length + 1) - (length + 1)
        unit = np.repeat(np.arange(len(units)), length + 1)
        chars = self.rank_of[cp]
        chars[begin + length] = 0  # a NUL stands behind each unit
        slot, piece, score = self._edges(chars)
        n = len(cp)
        size, alive = np.ones(n, dtype=np.int64), np.ones(n, dtype=bool)
        alive[begin + length] = False
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[begin + length - 1] = -1
        prv[begin] = -1
        short = (length <= LONG)[unit] & alive & (len(piece) > 0)
        self._join(size, nxt, prv, alive, unit, slot, score, np.flatnonzero(short))
        for k in np.flatnonzero((length > LONG) & (len(piece) > 0)):
            self._join_long(int(begin[k]), int(begin[k] + length[k]), size, alive, slot, score)
        at = np.flatnonzero(alive)
        e = slot[at * (self.longest + 1) + size[at]]
        ids = np.where(size[at] > 1, self.ids[piece[np.maximum(e, 0)]] if len(piece) else -1, self.single[cp[at]])
        ids = ids.astype(np.int32)
        lost = ids < 0
        wide = lost & (cp[at] >= 128)
        ids[lost & ~wide] = self.bytes[cp[at][lost & ~wide]]
        count = np.ones(len(at), dtype=np.int64)
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in cp[at][wide]]
        count[wide] = [len(x) for x in spelled]
        out = np.repeat(ids, count)
        if spelled:
            first = np.cumsum(count) - count
            out[_ranges(first[wide], count[wide])] = self.bytes[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        tokens = np.concatenate([[0], np.cumsum(count)])
        return out, tokens[np.searchsorted(at, np.append(begin, n))]

    def _encode_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode_units`, about ``STRETCH`` characters at a time."""
        ids, first, a = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while a < len(units):
            b, seen = a, 0
            while b < len(units) and (b == a or seen + len(units[b]) <= STRETCH):
                seen, b = seen + len(units[b]), b + 1
            found, edges = self.encode_units(units[a:b])
            first.append(first[-1][-1] + edges[1:])
            ids.append(found)
            a = b
        return np.concatenate(ids), np.concatenate(first)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text."""
        a = 0
        while a < len(texts):
            number, rows, seen = _Numbering(), [], 0
            while a < len(texts) and (not rows or seen + len(texts[a] or "") <= STRETCH):
                text = texts[a] or ""
                found = _UNIT.findall(_MARK + text.replace(" ", _MARK)) if text else []
                if any(len(u) > LONG for u in found):
                    found = [part for u in found for part in (self._cut(u) if len(u) > LONG else (u,))]
                rows.append(np.fromiter(map(number.__getitem__, found), dtype=np.int64, count=len(found)))
                seen, a = seen + len(text), a + 1
            ids, first = self._encode_all(list(number))
            for r in rows:
                yield ids[_ranges(first[r], first[r + 1] - first[r])]

    def decode(self, ids) -> str:
        text = b"".join([self.out[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """The worker's prepared model of this file."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, n_tokens, ids_crc32, ids`` of every document; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts, done = batch.column(1).to_pylist(), 0
            held: list[np.ndarray] = []

            def flush(done=0):
                n = np.array([len(x) for x in held], dtype=np.int64)
                flat = np.concatenate(held) if held else np.zeros(0, np.int32)
                return pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, len(held)), batch.column(1).slice(done, len(held)), pa.array(n),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in held], type=pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))],
                    names=[id_col, text_col, "n_tokens", "ids_crc32", "ids"])

            for ids in model.encode(texts):
                held.append(ids)
                if len(held) == 2048:
                    yield flush(done)
                    done, held = done + len(held), []
            if held:
                yield flush(done)
    d = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias(text_col))
    return d.mapInArrow(run, f"`{id_col}` {d.schema[0].dataType.simpleString()}, `{text_col}` string, n_tokens long, ids_crc32 long, ids array<int>")


def decoded(ids: Column, path: str) -> Column:
    """The text of a column of ids."""
    def of(rows: pd.Series) -> pd.Series:
        model = pieces(path)
        return pd.Series([None if r is None else model.decode(r.tolist()) for r in rows], dtype=object)
    return F.pandas_udf(of, "string")(ids)

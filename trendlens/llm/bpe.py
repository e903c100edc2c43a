"""Byte-level BPE with the tokenizers library, each distinct piece encoded once per worker.

The vocabulary's pre-tokenizer begins a new token at each space that a
non-space character follows, whatever stands before it. So a text may be cut
before such spaces without changing its ids. (Spaces before a byte that could
open a non-ASCII space aren't cut at, which is always safe.) Pieces repeat a
lot: a worker keeps the ids of those it has met, by a 64-bit hash of their
bytes, and passes only new ones to the library. It starts anew beyond
``CACHE_PIECES``, so its memory is bounded. A text that holds an added token's
string goes to the library as a whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text_kernels import chunks, mix64, powers, utf8

CACHE_PIECES = 2_000_000
#: The library gets so many pieces in one call.
PART = 50_000
#: Bytes of text worked on at once; the arrays over them take some 45 bytes for each.
CHUNK = 1 << 19
_SPACE = 0x20
_NO_CUT_BEFORE = np.zeros(256, dtype=bool)
_NO_CUT_BEFORE[:_SPACE + 1] = True
_NO_CUT_BEFORE[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # first bytes of non-ASCII spaces
_ENCODERS: dict[str, "Encoder"] = {}


def _pieces(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces start: at each text and before each space that opens a token."""
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[:-2] = (raw[:-1] == _SPACE) & ~_NO_CUT_BEFORE[raw[1:]]
    inner = begins[(begins > 0) & (begins < len(raw))]
    cut[inner - 1] = False  # a text's last byte: what follows is another text
    cut[begins] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Encodes texts to the ids that ``Tokenizer.encode`` gives with ``add_special_tokens=False``.

    With ``added`` the strings of added tokens in a text become those tokens, as
    the library does by default; else they are ordinary text
    (``encode_special_tokens``).
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = not added
        self._added = [t.content for t in self._library.get_added_tokens_decoder().values()] if added else []
        vocab = self._library.get_vocab()
        self._id_type = np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32
        self._opens = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self._opens[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True  # the byte-level form of a space
        self._forget()

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)  # sorted hashes
        self._begin = np.zeros(0, np.int64)   # where their ids are
        self._size = np.zeros(0, np.int32)
        self._ids = np.zeros(1 << 16, self._id_type)
        self._used = 0

    def _encode_new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' ids one after the other, and how many each has."""
        sizes = np.zeros(len(pieces), dtype=np.int32)
        found = []
        plain = np.array([p[:1] == " " and " " not in p[1:] for p in pieces], dtype=bool)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        for a in range(0, int(plain.sum()), PART):
            part = order[a:min(a + PART, int(plain.sum()))]
            ids = np.array(self._library.encode_batch_fast(["".join([pieces[i] for i in part])], add_special_tokens=False)[0].ids, dtype=self._id_type)
            opens = np.flatnonzero(self._opens[ids])
            sizes[part] = np.diff(np.append(opens, len(ids)))
            found.append(ids)
        rest = order[int(plain.sum()):]
        for i, e in zip(rest, self._library.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            found.append(np.array(e.ids, dtype=self._id_type))
            sizes[i] = len(e.ids)
        ids = np.concatenate(found) if found else np.zeros(0, self._id_type)
        begin = np.zeros(len(pieces), dtype=np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        self._append(ids)
        return begin + self._used - len(ids), sizes

    def _append(self, ids: np.ndarray) -> None:
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[self._used:self._used + len(ids)] = ids
        self._used += len(ids)

    def _look_up(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece are, and how many."""
        lengths = np.diff(np.append(starts, len(raw)))
        place = np.arange(len(raw), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
        terms = powers(int(lengths.max()))[place]
        terms *= raw.astype(np.uint64) + np.uint64(1)
        h = mix64(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))
        distinct, one, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self._known) + len(distinct) > CACHE_PIECES:
            self._forget()
        at = np.searchsorted(self._known, distinct)
        new = at == len(self._known)
        new[~new] = self._known[at[~new]] != distinct[~new]
        if new.any():
            ends = starts + lengths
            data = raw.tobytes()
            begin, size = self._encode_new([data[starts[i]:ends[i]].decode("utf-8", "replace") for i in one[new]])
            self._known = np.insert(self._known, at[new], distinct[new])
            self._begin = np.insert(self._begin, at[new], begin)
            self._size = np.insert(self._size, at[new], size)
            at = np.searchsorted(self._known, distinct)
        return self._begin[at][back], self._size[at][back]

    def encode_column(self, column: pa.Array, end: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of its rows one after the other, offsets) for the pieces of a string column.

        Null is the empty text. ``end`` is put after each text.
        """
        whole = self._with_added(column)
        at = np.flatnonzero(whole)
        a = 0
        for i in [*at.tolist(), len(column)]:
            if i > a:
                for b, ids, tokens in self._encode_plain(column.slice(a, i - a)):
                    yield a + b, *_ended(ids, tokens, end)
            if i < len(column):
                ids = np.array(self._library.encode(column[i].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
                yield i, *_ended(ids, np.array([0, len(ids)]), end)
            a = i + 1

    def _with_added(self, column: pa.Array) -> np.ndarray:
        """Which texts hold an added token's string."""
        found = np.zeros(len(column), dtype=bool)
        for token in self._added:
            found |= pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        return found

    def _encode_plain(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        data, offsets = utf8(column)
        for a, b in chunks(offsets, CHUNK):
            lo, hi = int(offsets[a]), int(offsets[b])
            edges = offsets[a:b + 1] - lo
            raw = data[lo:hi]
            if len(raw):
                starts = _pieces(raw, edges[:-1])
                begin, size = self._look_up(raw, starts)
                before = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
                tokens = before[np.searchsorted(starts, edges)]
                place = np.arange(before[-1]) + np.repeat(begin - before[:-1], size)
                ids = self._ids[place].astype(np.uint32)
            else:
                ids, tokens = np.zeros(0, np.uint32), np.zeros(len(edges), np.int64)
            yield a, ids, tokens


def _ended(ids: np.ndarray, tokens: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text, and the offsets."""
    if end is None:
        return ids, tokens
    return np.insert(ids, tokens[1:], np.uint32(end)), tokens + np.arange(len(tokens))


def encoder(path: str) -> Encoder:
    """The worker's encoder of this vocabulary file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, added=True)
    return _ENCODERS[path]

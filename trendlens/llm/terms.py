"""Terms of Arrow string columns: their places and 64-bit hashes (numpy, inside tasks).

A term is a maximal run of solid bytes. ASCII marks, blanks and controls are
not solid; all bytes from 128 up are, so in UTF-8 a run of solid bytes is a run
of solid code points. Only ``A-Z`` are lower-cased. Work goes over pieces of
about ``PIECE`` bytes, so memory doesn't grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .text_kernels import chunks, mix64, powers, utf8

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _solid(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for a, b in ((128, 255), *ranges):
        table[a:b + 1] = True
    return table


#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]`` of bytes: letters.
LETTERS = _solid((65, 90), (97, 122))
#: Letters and digits.
WORDS = _solid((48, 57), (65, 90), (97, 122))


class Terms(NamedTuple):
    """The terms of some rows: ``first[r]`` to ``first[r + 1]`` are row ``r``'s."""

    row: int
    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, i: int, j: int) -> str:
        """Terms ``i`` to ``j`` (without), lower-cased, with blanks between them."""
        return b" ".join(self.raw[a:b].tobytes() for a, b in zip(self.starts[i:j], self.ends[i:j])).decode()

    def texts(self, at: np.ndarray) -> pa.Array:
        """Single terms as a string column."""
        starts, size = self.starts[at], self.ends[at] - self.starts[at]
        edges = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(edges[-1]) + np.repeat(starts - edges[:-1], size)
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(self.raw[place].tobytes())])


def _terms(row: int, data: np.ndarray, offsets: np.ndarray, solid: np.ndarray) -> Terms:
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = _LOWER[data[lo:hi]]
    offsets = offsets - lo
    none = np.zeros(0, np.int64)
    on = solid[raw]
    # runs also end where a row does
    begins = np.zeros(len(raw) + 1, dtype=bool)
    begins[offsets] = True
    start, end = on.copy(), on.copy()
    start[1:] &= ~on[:-1] | begins[1:-1]
    end[:-1] &= ~on[1:] | begins[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if not len(starts):
        return Terms(row, raw, none, none, none.view(np.uint64), np.zeros(len(offsets), np.int64))
    size = ends - starts
    at = np.flatnonzero(on)
    edges = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(edges, size)
    h = np.add.reduceat((raw[at].astype(np.uint64) + np.uint64(1)) * powers(int(size.max()))[place], edges)
    return Terms(row, raw, starts, ends, mix64(h + size.astype(np.uint64) * _BASE), np.searchsorted(starts, offsets))


def terms_of(column: pa.Array, solid: np.ndarray) -> Iterator[Terms]:
    """The terms of a string column, piece by piece; null is empty."""
    data, offsets = utf8(column)
    for a, b in chunks(offsets, PIECE):
        yield _terms(a, data, offsets[a:b + 1], solid)


def run_hashes(t: Terms, k: int) -> np.ndarray:
    """The hash of the ``k`` terms from each term on (meaningless near the end of all terms)."""
    padded = np.concatenate([t.hashes, np.zeros(k, np.uint64)])
    h = np.full(len(t.hashes), k, dtype=np.uint64)
    factors = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    for j in range(k):
        h += padded[j:j + len(h)] * factors[j]
    return mix64(h)


def room(t: Terms) -> np.ndarray:
    """How many terms there are from each term to its row's end, itself included."""
    n = np.diff(t.first)
    return np.repeat(t.first[1:], n) - np.arange(int(n.sum()))

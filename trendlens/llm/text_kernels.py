"""Vectorised word and shingle hashing over Arrow string columns (numpy, inside tasks).

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``; in UTF-8 these
bytes never occur inside another character, so bytes and code points agree.
Only ``A-Z`` are lower-cased. A word's hash is a polynomial over its bytes
modulo 2^64, mixed; a shingle's hash combines the hashes of its words. Work
goes over pieces of about ``CHUNK`` bytes, so its memory doesn't grow with the
batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
CHUNK = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
#: Odd 64-bit constants of the hash functions.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_COMBINE = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_POWERS = np.ones(1, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first ``n`` (or more) powers of the hash base modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, _BASE, dtype=np.uint64))])
    return _POWERS


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes (one row at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, b
        a = b


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the first word's index of each row (with the end)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = data[lo:hi]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~_BREAK[raw]
    begins = np.zeros(len(raw) + 1, dtype=bool)
    begins[offsets[:-1] - lo] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | begins[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | begins[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = ends - starts
    at = np.flatnonzero(solid)
    place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = (_LOWER[raw[at]].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    h = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return mix64(h + lengths.astype(np.uint64) * _BASE), np.searchsorted(starts, offsets - lo)


def shingles(words: np.ndarray, first: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in text order and each row's first index (with the end).

    Rows of fewer than ``k`` words have one shingle of all their words; rows
    without words have none.
    """
    n = np.diff(first)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    edges = np.concatenate([[0], np.cumsum(counts)])
    if not edges[-1]:
        return np.zeros(0, np.uint64), edges
    at = np.arange(edges[-1]) - np.repeat(edges[:-1] - first[:-1], counts)
    size = np.repeat(np.minimum(n, k), counts)
    h = size.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for j in range(k):
        h = h + np.where(size > j, padded[at + j], np.uint64(0)) * _COMBINE[j % len(_COMBINE)]
    return mix64(h), edges


def shingle_chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes, row edges) for the pieces (of about ``size`` bytes) of a string column."""
    data, offsets = utf8(column)
    for a, b in chunks(offsets, size):
        h, edges = shingles(*word_hashes(data, offsets[a:b + 1]))
        yield a, h, edges

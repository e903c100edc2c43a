"""Document fingerprints by one-permutation MinHash.

Every 5-word shingle is hashed once; its top bits choose one of ``BINS`` bins,
the rest is its value, and a bin keeps its least value. Empty bins are filled
by optimal densification: each bin has a fixed random order of the bins and
copies the first that isn't empty. Of each bin's value the low ``BITS`` bits
are kept, packed as hexadecimal digits. Two fingerprints that agree in a share
``m`` of the bins have likeness ``(m - c) / (1 - c)``, ``c = 2^-BITS`` being the
share that agrees by chance, and not below 0.

Defined results: null text is empty; a text without words has the fingerprint
``""``, whose likeness is 1 to itself and 0 to any other; texts of fewer than
five words have one shingle. Equal texts have equal fingerprints.

``edited_pairs`` also needs each document's successor in descending ``doc_id``
order. Rows are dealt to buckets of consecutive ids (bounds from approximate
quantiles of the ids), each bucket also getting a copy of the next bucket's
first document. Texts are shuffled once; tasks stream over their sorted rows
and hold one pending row. Rows that share a ``doc_id`` are ordered by their
text, a null ``doc_id`` comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text_kernels import mix64, shingle_chunks

BINS = 512
BITS = 4
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)
_ORDER: np.ndarray | None = None


def _order() -> np.ndarray:
    """``[step, bin]``: the bin that ``bin`` looks at in this step; a fixed random order for each bin."""
    global _ORDER
    if _ORDER is None:
        keys = mix64(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(0x1234567)).reshape(BINS, BINS)
        np.fill_diagonal(keys, 0)
        _ORDER = np.argsort(keys, axis=0)
    return _ORDER


def _densify(mins: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row (rows without any shingle stay empty)."""
    full = mins != _EMPTY
    filled = full.sum(axis=1)
    out = mins.copy()
    one = filled == 1
    out[one] = mins[one].min(axis=1, keepdims=True)
    row, bin_ = np.nonzero(~full & (filled > 1)[:, None])
    for step in range(1, BINS):
        if not len(row):
            break
        from_ = _order()[step, bin_]
        got = full[row, from_]
        out[row[got], bin_[got]] = mins[row[got], from_[got]]
        row, bin_ = row[~got], bin_[~got]
    return out


def digits(texts: pa.Array) -> np.ndarray:
    """``[row, bin]``: the low bits of every bin; 255 in rows without shingles."""
    found = []
    for _, h, edges in shingle_chunks(texts):
        n = len(edges) - 1
        mins = np.full(n * BINS, _EMPTY, dtype=np.uint64)
        row = np.repeat(np.arange(n), np.diff(edges))
        value = h & ((np.uint64(1) << _SHIFT) - np.uint64(1))
        np.minimum.at(mins, row * BINS + (h >> _SHIFT).astype(np.int64), value)
        mins = mins.reshape(n, BINS)
        low = (mix64(_densify(mins)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
        low[np.diff(edges) == 0] = 255
        found.append(low)
    return np.concatenate(found) if found else np.zeros((0, BINS), np.uint8)


def as_text(low: np.ndarray) -> list[str]:
    return ["" if row[0] == 255 else _HEX[row].tobytes().decode() for row in low]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the rows of two digit tables."""
    chance = 2.0 ** -BITS
    return np.maximum(0.0, ((a == b).mean(axis=1) - chance) / (1 - chance))


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with its fingerprints (no shuffle)."""
    def of(text: pd.Series) -> pd.Series:
        return pd.Series(as_text(digits(pa.array(text, type=pa.large_string()))))
    return docs.withColumn(out_col, F.pandas_udf(of, "string")(F.col(text_col)))


#: Stands for a null id: it comes after all others.
_NO_ID = -(1 << 63)


def _bounds(ids: DataFrame, buckets: int) -> np.ndarray:
    """Ascending ids that part the documents into about equal buckets."""
    if buckets < 2:
        return np.zeros(0, np.int64)
    cuts = ids.filter(F.col("id") != _NO_ID).approxQuantile("id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    return np.array(sorted({int(x) for x in cuts}), dtype=np.int64)


def _with_successors(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, copy, id, text``: bucket 0 has the largest ids; copies open the next bucket."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), "text")
    bounds = _bounds(rows, buckets)

    def bucket_of(ids: pd.Series) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, ids.to_numpy(), side="left")

    bucket = F.pandas_udf(lambda ids: pd.Series(bucket_of(ids)), "int")
    first = {r[0]: r[1] for r in rows.select(bucket("id").alias("b"), "id").groupBy("b").agg(F.max("id")).collect()}
    present = sorted(first)
    before = {b: present[i - 1] for i, b in enumerate(present)}  # of the first one: the last, where the order begins anew

    def targets(ids: pd.Series) -> pd.Series:
        return pd.Series([[2 * b, 2 * before[b] + 1] if i == first[b] else [2 * b]
                          for b, i in zip(bucket_of(ids).tolist(), ids.tolist(), strict=True)])

    to = F.pandas_udf(targets, "array<int>")
    dealt = rows.select("id", "text", F.explode(to("id")).alias("to"))
    return dealt.select(F.shiftright("to", 1).alias("bucket"), F.col("to").bitwiseAND(F.lit(1)).alias("copy"), "id", "text")


_PAIR_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")


def _edited(own: list[tuple[int, str]], nexts: list[str]) -> pd.DataFrame:
    texts = [t for _, t in own]
    edited = [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for t, n in zip(texts, nexts, strict=True)]
    a, b, c = (digits(pa.array(x, type=pa.large_string())) for x in (texts, edited, nexts))
    return pd.DataFrame({
        "doc_id": pd.array([i for i, _ in own], dtype="Int64"), "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": as_text(a), "edited_fingerprint": as_text(b), "near_edited": likeness(a, b), "near_next": likeness(a, c)})


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows in, one row for each own document out; holds about 4 MB of texts."""
    own, nexts, size = [], [], 0
    pending = None  # (bucket, id, text) whose successor is still to come
    for pdf in batches:
        for bucket, copy, i, text in zip(pdf["bucket"].tolist(), pdf["copy"].tolist(), pdf["id"].tolist(), pdf["text"], strict=True):
            text = text or ""
            if pending is not None and pending[0] == bucket:
                own.append(pending[1:])
                nexts.append(text)
                size += len(text)
            pending = None if copy else (bucket, None if i == _NO_ID else i, text)
            if size > 4 << 20:
                yield _edited(own, nexts)
                own, nexts, size = [], [], 0
    if own:
        yield _edited(own, nexts)


def edited_pairs(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likenesses.

    The edited text has the last third of the code points (rounded down)
    replaced by as many first ones of the next document, or by all it has.
    A single document is its own successor.
    """
    d = docs.select("doc_id", "text")
    n = buckets or 4 * int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _with_successors(d, n).repartition("bucket")
    return (dealt.sortWithinPartitions("bucket", "copy", F.col("id").desc(), F.col("text").asc_nulls_first())
            .mapInPandas(_stream, _PAIR_SCHEMA))

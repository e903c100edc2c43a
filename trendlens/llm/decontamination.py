"""Benchmark decontamination by winnowing: which words of a document stand in a shared run of ``WINDOW`` item words.

Winnowing: every run of ``GRAM`` words has a hash, and each window of
``WINDOW`` words keeps the least (the rightmost of equals) of its
``WINDOW - GRAM + 1`` hashes. Equal windows keep equal hashes at equal places,
so two texts that share ``WINDOW`` words in a row share a fingerprint inside
them. Steps:

1. The items' windows with their fingerprints; from these a filter, a bitmap
   of at most ``FILTER_BITS`` bits.
2. One scan of the documents: counts of words, and the fingerprints that the
   filter lets through, each with the words of all windows that keep it.
3. The documents' fingerprints are joined with the items' fingerprints, which
   removes what the filter let through by chance.
4. Hits are extended: the windows around each hit are compared with the items'
   windows as text, so hashes decide nothing.
5. Windows that lie in a document are united to spans of words; the items come
   from the matched windows.

An item of fewer than ``WINDOW`` words is one window of its own size, which is
its own fingerprint (runs of that size keep all their hashes).

Defined results: words are lower-cased (``A-Z``) runs of ASCII letters, digits
and all code points from 128 up; null and empty texts have no words, and an
item without words occurs nowhere; rows that share an ``item_id`` are one item,
a null id counts as the id ``''``; documents that share a ``doc_id`` are judged
by their own text, repeated ones alike; a null ``doc_id`` is kept; other columns
don't matter; an empty table gives an empty one, an empty benchmark no hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .terms import WORDS, Terms, room, run_hashes, terms_of

WINDOW = 10
GRAM = 5
#: Bits of the filter for each of the items' fingerprints, and at most (16 MB).
BITS_EACH = 32
FILTER_BITS = 1 << 27


def kept_hashes(t: Terms) -> tuple[np.ndarray, np.ndarray]:
    """For the window from each word on: the hash that it keeps, and that run's place."""
    grams = np.concatenate([run_hashes(t, GRAM), np.full(WINDOW, np.uint64(0xFFFFFFFFFFFFFFFF))])
    n = len(t.hashes)
    least, place = grams[:n].copy(), np.arange(n)
    for j in range(1, WINDOW - GRAM + 1):
        other = grams[j:j + n]
        closer = other <= least
        least[closer] = other[closer]
        place[closer] = np.flatnonzero(closer) + j
    return least, place


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``item_id, size, fingerprint, words`` of every window of the items."""
    for batch in batches:
        for t in terms_of(batch.column(1), WORDS):
            n, left = np.diff(t.first), room(t)
            least, _ = kept_hashes(t)
            starts, sizes, prints = [np.flatnonzero(left >= WINDOW)], [], []
            sizes.append(np.full(len(starts[0]), WINDOW))
            prints.append(least[starts[0]])
            for size in np.unique(n[(n > 0) & (n < WINDOW)]).tolist():
                at = t.first[:-1][n == size]
                starts.append(at)
                sizes.append(np.full(len(at), size))
                prints.append(run_hashes(t, size)[at])
            at, size = np.concatenate(starts), np.concatenate(sizes)
            rows = t.row + np.searchsorted(t.first, at, side="right") - 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows)), pa.array(size.astype(np.int32)), pa.array(np.concatenate(prints).view(np.int64)),
                pa.array([t.text(a, a + s) for a, s in zip(at.tolist(), size.tolist())], type=pa.string())],
                names=["item_id", "size", "fingerprint", "words"])


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id`` (text), ``size, fingerprint, words``: the distinct windows of each item."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_item_windows, "item_id string, size int, fingerprint long, words string").distinct()


def _cell(fingerprint: Column, bits: int) -> Column:
    return F.pmod(fingerprint, F.lit(bits))


def _bitmaps(windows: DataFrame) -> dict[int, np.ndarray]:
    """For each size of windows a bitmap of its fingerprints; together at most ``FILTER_BITS`` bits."""
    counts = {r["size"]: r["n"] for r in windows.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most WINDOW rows
    limit = FILTER_BITS // WINDOW
    out = {}
    for size, n in counts.items():
        bits = 1 << max(10, min((BITS_EACH * n).bit_length(), limit.bit_length() - 1))
        cell = _cell(F.col("fingerprint"), bits)
        # 64 cells a row: a bitmap of b bits comes as at most b / 64 numbers
        found = (windows.filter(F.col("size") == size).groupBy(F.shiftright(cell, 6).alias("w"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))).alias("bits")).toArrow())
        words = np.zeros(bits // 64, dtype=np.uint64)
        words[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        out[size] = np.unpackbits(words.view(np.uint8), bitorder="little").view(bool) if bits <= 1 << 23 else words
    return out


def _passes(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    if bitmap.dtype == bool:
        return bitmap[(hashes & np.uint64(len(bitmap) - 1)).astype(np.int64)]
    cell = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _fingerprints(sent) -> Callable:
    """Rows of documents (``n_words``) and rows of the fingerprints that the filter lets through (``first, windows, size, words``)."""
    names = ["doc_id", "text_hash", "n_words", "fingerprint", "first", "windows", "size", "words"]

    def of(t: Terms, bitmaps: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        left = room(t)
        for size, bitmap in bitmaps.items():
            if size == WINDOW:
                prints, place = kept_hashes(t)
            else:
                prints, place = run_hashes(t, size), np.arange(len(t.hashes))
            at = np.flatnonzero((left >= size) & _passes(prints, bitmap))
            if len(at):
                # neighbouring windows that keep the same run are one row
                new = np.ones(len(at), dtype=bool)
                new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)
                head = np.flatnonzero(new)
                yield prints[at[head]], at[head], np.diff(np.append(head, len(at))), size

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = sent.value
        for batch in batches:
            for t in terms_of(batch.column(2), WORDS):
                n = len(t.first) - 1
                ids, hashes = batch.column(0).slice(t.row, n), batch.column(1).slice(t.row, n)
                none = [pa.nulls(n, kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())]
                yield pa.RecordBatch.from_arrays([ids, hashes, pa.array(np.diff(t.first)), *none], names=names)
                for prints, at, windows, size in of(t, bitmaps):
                    row = np.searchsorted(t.first, at, side="right") - 1
                    words = [t.text(a, a + w + size - 1) for a, w in zip(at.tolist(), windows.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(row)), hashes.take(pa.array(row)), pa.nulls(len(at), pa.int64()), pa.array(prints.view(np.int64)),
                        pa.array(at - t.first[row]), pa.array(windows.astype(np.int32)), pa.array(np.full(len(at), size, np.int32)),
                        pa.array(words, type=pa.string())], names=names)
    return emit


def _scan(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Counts and let-through fingerprints of all documents, written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"),
                       F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(_bitmaps(windows))
    found = rows.mapInArrow(_fingerprints(sent), "doc_id long, text_hash long, n_words long, fingerprint long, first long, windows int, size int, words string")
    found = materialize(found, "fingerprints")
    sent.destroy()
    return found


def _matched(found: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, size, words``: each place of a document where an item's window stands."""
    hits = found.filter("n_words is null").join(windows.select("fingerprint").distinct(), "fingerprint", "left_semi")
    words = F.split("words", " ")
    run = lambda i: F.struct((F.col("first") + i).alias("start"), F.array_join(F.slice(words, i + 1, F.col("size")), " ").alias("words"))
    each = hits.select("doc_id", "text_hash", "size", F.explode(F.transform(F.sequence(F.lit(0), F.col("windows") - 1), run)).alias("w"))
    # repeated documents give the same places
    places = each.select("doc_id", "text_hash", F.col("w.start").alias("start"), "size", F.col("w.words").alias("words"))
    return places.join(windows.select("words").distinct(), "words", "left_semi").distinct()


def _hit_words(places: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_hit``: the words that lie in any of the document's places."""
    w = Window.partitionBy("doc_id", "text_hash").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = end - F.greatest("start", F.least(end, F.coalesce(F.max(end).over(w), F.lit(0))))
    return places.select("doc_id", "text_hash", fresh.alias("fresh")).groupBy("doc_id", "text_hash").agg(F.sum("fresh").alias("n_hit"))


def contaminated_places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, start, size, item_id``: where each item's windows stand in the documents (words from 0)."""
    windows = materialize(item_windows(items), "windows")
    places = _matched(_scan(docs, windows), windows)
    return places.join(windows.select("words", "item_id"), "words").select("doc_id", "start", "size", "item_id")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted ids as text) of every document (``doc_id, text``)."""
    windows = materialize(item_windows(items), "windows")
    found = _scan(docs, windows)
    places = materialize(_matched(found, windows), "places")
    ids = (places.select("doc_id", "text_hash", "words").distinct().join(windows.select("words", "item_id"), "words")
           .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    marks = _hit_words(places).withColumnsRenamed({"doc_id": "h_id", "text_hash": "h_hash"})
    ids = ids.withColumnsRenamed({"doc_id": "i_id", "text_hash": "i_hash"})
    hit = marks.join(ids, F.col("h_id").eqNullSafe(F.col("i_id")) & (F.col("h_hash") == F.col("i_hash")))
    base = found.filter("n_words is not null").select("doc_id", "text_hash", "n_words")
    out = base.join(hit, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    """The result of :func:`contamination` with the items as count and checksum."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

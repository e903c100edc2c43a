"""N-gram Jaccard self-join of documents: which have 5-word shingle sets with Jaccard similarity of 0.75 or more.

Exact up to 64-bit hashes of shingles and sets. Documents with equal sets are
one node. Steps:

1. One scan gives each document's set size and key, and the shingles that tasks
   meet repeatedly. From these a table of cells, sized by their number, holds how
   frequent the shingles of a cell are, on a logarithmic scale.
2. A second scan emits every set's prefix: its rarest shingles, by this scale
   and then by hash. Sets of similarity ``t`` share a shingle of their prefixes
   of ``n - ceil(t n) + 1`` shingles under any common order; the scale only keeps
   frequent shingles out of prefixes. A pair that needs an overlap of ``o`` shares
   one within its first ``n - o + 1`` shingles each, so places count as well: the
   place says how large a partner can be.
3. The sets of a shingle form a tile; those of a hot shingle are dealt to parts of
   about ``PART`` sets. First only the pairs of each set with its part's most typical
   one (the most frequent shingles on average: an original among its copies), and
   of these with the tile's, are candidates: their number is linear in the rows.
4. Candidates are checked: sizes, then hashed bitmaps whose length depends on
   the size band (bits of one that the other lacks bound the overlap from
   above), then the intersection of the sorted arrays.
5. Components of the links. Tiles that still hold several components are cut by
   size bands (each with the next smaller band's sets as guests). A set's place
   says how large a partner can be, so sets whose tile holds none small enough
   leave it: sets of one template that differ in more than the similarity allows
   don't meet. In what is left, all pairs across components are candidates, except
   those within the largest: these are linked already, directly or not. They are
   checked the same way.
6. Components of all links; each document gets its component's least id.

A large group of near copies becomes one component in step 5 without all of
its pairs; :func:`jaccard_links` gives the links themselves, all of them.
Candidates are checked from the texts: a bitmap, sized by their number, says
which sets are needed, so only their bitmaps and arrays move.

Defined results: words are lower-cased (``A-Z``) runs of anything but
``\\x20 \\x09-\\x0D``; a text of fewer than five words is one shingle; null, empty
and blank texts have an empty set and are linked with nothing; rows that share
an id are separate documents of the same name; a null id is never a
component's least id unless it has no other; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .blocks import text_offsets
from .components import components
from .memory import give_back, tidy
from .text_kernels import chunks, mix64, shingle_chunks

#: Similarity as a fraction.
NUMERATOR, DENOMINATOR = 3, 4
#: Cells of the frequency table (of four shingles, eight bytes) for each frequent shingle, and at most (32 MB).
CELLS_EACH = 8
MOST_CELLS = 1 << 22
#: Bits of the filter of needed sets for each of them, and at most (16 MB).
BITS_EACH = 32
FILTER_BITS = 1 << 27
#: Sets of a part of a hot shingle's tile.
PART = 1 << 13
#: Shingles found at least so often are frequent.
FREQUENT = 8
#: Shingles that a task counts at a time, and bytes of text that it works through at a time.
COUNTED = 2 << 20
PIECE = 1 << 20


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes sorted and distinct within each row, row edges)."""
    # slice by slice, so that no copy of a whole batch is made
    for start, stop in chunks(text_offsets(column), PIECE):
        for first, h, edges in shingle_chunks(column.slice(start, stop - start), PIECE):
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                h[a:b].sort()
            keep = np.ones(len(h), dtype=bool)
            keep[1:] = h[1:] != h[:-1]
            keep[edges[:-1][np.diff(edges) > 0]] = True
            yield start + first, h[keep], np.concatenate([[0], np.cumsum(keep)])[edges]


def _keys(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row's set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h ^ np.uint64(0x5851F42D4C957F2D)))])
    return mix64(sums[edges[1:]] - sums[edges[:-1]] + np.diff(edges).astype(np.uint64)).view(np.int64)


def _first_of_task(keys: np.ndarray, n: np.ndarray, seen: set) -> np.ndarray:
    """Rows with a set that this task hasn't had."""
    rows = []
    for i, (k, size) in enumerate(zip(keys.tolist(), n.tolist(), strict=True)):
        if size and k not in seen:
            seen.add(k)
            rows.append(i)
    return np.array(rows, dtype=np.int64)


def _of_rows(h: np.ndarray, edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of some rows, and how many each has."""
    n = edges[rows + 1] - edges[rows]
    at = np.arange(int(n.sum())) + np.repeat(edges[rows] - (np.cumsum(n) - n), n)
    return h[at], n


def _sizes_and_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``doc_id, n, key`` of the documents, and rows ``shingle, times`` of what this task meets twice or more."""
    names = ["doc_id", "n", "key", "shingle", "times"]
    seen: set = set()
    held: list[np.ndarray] = []

    def repeats():
        s, times = np.unique(np.concatenate(held), return_counts=True)
        s, times = s[times > 1], times[times > 1]
        none = pa.nulls(len(s), pa.int64())
        held.clear()
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(s.view(np.int64)), pa.array(times)], names=names)

    for batch in batches:
        for first, h, edges in _sets(batch.column(1)):
            n, keys = np.diff(edges), _keys(h, edges)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(n), pa.array(keys, mask=n == 0), none, none], names=names)
            held.append(_of_rows(h, edges, _first_of_task(keys, n, seen))[0])
            if sum(map(len, held)) > COUNTED:
                yield repeats()
    if held:
        yield repeats()


def _frequency_table(repeats: DataFrame) -> np.ndarray:
    """How frequent shingles are: a cell holds, for its four most frequent shingles, the binary logarithm and eight bits of the shingle.

    At most ``MOST_CELLS`` cells. A frequent shingle that finds no room counts as a rare one, and a rare one
    with a frequent one's cell and bits as frequent; both only cost candidates.
    """
    often = materialize(repeats.groupBy("shingle").agg(F.sum("times").alias("times")).filter(F.col("times") >= FREQUENT), "frequent")
    cells = 1 << max(10, min((CELLS_EACH * often.count()).bit_length(), MOST_CELLS.bit_length() - 1))
    check = F.shiftright("shingle", 40).bitwiseAND(F.lit(255))
    first = F.slice(F.sort_array(F.collect_list(F.struct("times", check.alias("check"))), False), 1, 4)
    entry = lambda x, i: F.call_function("shiftleft", x["check"] * 256 + F.floor(F.log2(x["times"])).cast("long"), (16 * i).cast("int"))
    word = F.aggregate(F.transform(first, entry), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)).alias("word")
    found = often.groupBy(F.pmod("shingle", F.lit(cells)).alias("cell")).agg(word).toArrow()
    table = np.zeros(cells, dtype=np.int64)
    table[found["cell"].to_numpy()] = found["word"].to_numpy()
    return table.view(np.uint64)


def _scales(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The logarithms of how frequent the shingles are, 0 for rare ones."""
    cells = table[(s & np.uint64(len(table) - 1)).astype(np.int64)]
    out, at = np.zeros(len(s), dtype=np.int64), np.flatnonzero(cells)
    cells, check = cells[at], (s[at] >> np.uint64(40)) & np.uint64(255)
    for i in range(4):
        entry = (cells >> np.uint64(16 * i)) & np.uint64(0xFFFF)
        out[at] = np.maximum(out[at], np.where(entry >> np.uint64(8) == check, entry & np.uint64(255), 0).astype(np.int64))
    return out


def _prefixes(table) -> Callable:
    """Rows ``shingle, key, n, place, typical, parts`` of each set's prefix; ``parts`` is how many its tile is dealt to."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, seen = table.value, set()
        for batch in batches:
            for _, h, edges in _sets(batch.column(1)):
                n_all, keys = np.diff(edges), _keys(h, edges)
                rows = _first_of_task(keys, n_all, seen)
                s, n = _of_rows(h, edges, rows)
                set_ = np.repeat(np.arange(len(rows)), n)
                frequent = _scales(s, scale)
                order = np.argsort(set_ * 64 + frequent, kind="stable")
                typical = 1000 * np.bincount(set_, weights=frequent, minlength=len(rows)) // np.maximum(n, 1)
                length = n - -(-n * NUMERATOR // DENOMINATOR) + 1
                place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                at = order[place + np.repeat(np.cumsum(n) - n, length)]
                parts = np.maximum(1, (1 << frequent[at]) // PART).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(s[at].view(np.int64)), pa.array(np.repeat(keys[rows], length)), pa.array(np.repeat(n, length).astype(np.int32)),
                    pa.array(place.astype(np.int32)), pa.array(np.repeat(typical, length).astype(np.int32)), pa.array(parts)],
                    names=["shingle", "key", "n", "place", "typical", "parts"])
    return emit


def _may_link(n: Column, place: Column, m: Column, other: Column) -> Column:
    """Sizes ``n`` and ``m`` allow a link, and a shared shingle at these places can be the first one of the two."""
    need = F.ceil(NUMERATOR * (n + m) / (NUMERATOR + DENOMINATOR))
    return (DENOMINATOR * F.least(n, m) >= NUMERATOR * F.greatest(n, m)) & (place <= n - need) & (other <= m - need)


def _with_typical(prefixes: DataFrame) -> DataFrame:
    """The rows of shingles with several sets, with the most typical set of their part (``t_key``, ``t_n``, ``t_place``, ``t_typical``).

    A part of a hot tile stays even with one set, as the other parts hold others.
    """
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("key"), F.col("parts"))).otherwise(F.lit(0)).alias("part")
    rows = prefixes.select("*", part)
    w = Window.partitionBy("shingle", "part").orderBy(F.desc("typical"), "n", "key")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (rows.select("shingle", "key", "n", "place", "parts", *[F.first(c).over(w).alias(f"t_{c}") for c in ("key", "n", "place", "typical")],
                        F.min("key").over(whole).alias("least"), F.max("key").over(whole).alias("most"))
            .filter((F.col("least") != F.col("most")) | (F.col("parts") > 1)).drop("least", "most"))


def _star(tiles: DataFrame) -> DataFrame:
    """Pairs ``a < b`` (with sizes): each set with its part's most typical one, and these with their tile's."""
    near = tiles.select("t_key", "t_n", "t_place", "key", "n", "place")
    parts = tiles.filter("parts > 1").select("shingle", "t_key", "t_n", "t_place", "t_typical").distinct()
    first = F.min_by(F.struct("t_key", "t_n", "t_place"), F.struct((-F.col("t_typical")).alias("x"), "t_n", "t_key")).alias("f")
    top = parts.groupBy(F.col("shingle").alias("s")).agg(first).select("s", F.col("f.t_key").alias("f_key"), F.col("f.t_n").alias("f_n"), F.col("f.t_place").alias("f_place"))
    far = parts.join(top, F.col("shingle") == F.col("s")).select(F.col("f_key").alias("t_key"), F.col("f_n").alias("t_n"), F.col("f_place").alias("t_place"),
                                                                 F.col("t_key").alias("key"), F.col("t_n").alias("n"), F.col("t_place").alias("place"))
    pairs = near.unionAll(far).filter((F.col("key") != F.col("t_key")) & _may_link(F.col("n"), F.col("place"), F.col("t_n"), F.col("t_place")))
    return _oriented(pairs, "t_key", "t_n", "key", "n")


def _band(n: Column) -> Column:
    """Sizes of one band differ by less than the similarity allows; linked sets are at most one band apart."""
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(DENOMINATOR / NUMERATOR))) + 1e-9).cast("int")


def _by_size(rows: DataFrame) -> DataFrame:
    """Each row in the tile (shingle, band) of its own size and, as a guest, in the next; ``most`` is the largest partner that its place allows.

    A shingle at ``place`` can be the first that a set of size ``n`` shares with one of size ``m``
    only if ``3 (n + m) <= 7 (n - place)``.
    """
    band, n = _band(F.col("n")), F.col("n")
    most = F.floor(((NUMERATOR + DENOMINATOR) * (n - F.col("place")) - NUMERATOR * n) / NUMERATOR).cast("int")
    tile = F.explode(F.array(F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home"))))
    return rows.withColumn("most", most).withColumn("t", tile).select(*rows.columns, "most", "t.band", "t.home")


def _meet(x: DataFrame, y: DataFrame, also: Column) -> DataFrame:
    """Pairs ``a < b`` (with sizes) of rows of one tile that may link, ``x``'s columns prefixed with ``x_``."""
    pairs = x.join(y, (F.col("x_shingle") == F.col("shingle")) & (F.col("x_band") == F.col("band")) & (F.col("x_home") | F.col("home")) & also
                   & _may_link(F.col("x_n"), F.col("x_place"), F.col("n"), F.col("place")))
    return _oriented(pairs, "x_key", "x_n", "key", "n")


_TILE = ["shingle", "band", "home", "key", "n", "place"]


def _across(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``a < b`` (with sizes) of different components that share a tile, except those within its largest."""
    rows = rows.join(roots.select(F.col("node").alias("of"), "root"), F.col("key") == F.col("of"), "left")
    tiles = _by_size(rows.select("shingle", "key", "n", "place", F.coalesce("root", "key").alias("root"))).distinct()
    sizes = tiles.groupBy("shingle", "band", "root").agg(F.count("*").alias("rows"), F.max("home").alias("home"), F.min("n").alias("least"), F.max("most").alias("most"))
    several = (sizes.groupBy(F.col("shingle").alias("s"), F.col("band").alias("b"))
               .agg(F.max_by("root", F.struct("rows", "root")).alias("largest"), F.count("*").alias("roots"), F.max("home").alias("any_home"),
                    F.min("least").alias("t_least"), F.max("most").alias("t_most"))
               .filter("roots > 1 and any_home"))
    # a set stays if its tile holds one that it may take, and one that may take it
    left = materialize(tiles.join(several, (F.col("shingle") == F.col("s")) & (F.col("band") == F.col("b"))).filter("most >= t_least and n <= t_most").select(
        *_TILE, "root", "largest"), "tiles")
    x = left.filter("root <> largest").select(*[F.col(c).alias(f"x_{c}") for c in [*_TILE, "root"]])
    return _meet(x, left, (F.col("x_root") != F.col("root")) & ((F.col("root") == F.col("largest")) | (F.col("x_key") < F.col("key"))))


def _oriented(pairs: DataFrame, a: str, na: str, b: str, nb: str) -> DataFrame:
    """Distinct pairs ``a < b`` with their sizes."""
    swap = F.col(a) > F.col(b)
    return pairs.select(F.least(a, b).alias("a"), F.when(swap, F.col(nb)).otherwise(F.col(na)).alias("a_n"),
                        F.greatest(a, b).alias("b"), F.when(swap, F.col(na)).otherwise(F.col(nb)).alias("b_n")).distinct()


def _bits(n: int) -> int:
    """Bits of the bitmap of sets of this size: a power of two, twice the size or more."""
    return max(64, 1 << (2 * n - 1).bit_length())


def _bitmap(hashes: np.ndarray) -> bytes:
    m = _bits(len(hashes))
    on = np.zeros(m, dtype=bool)
    on[(hashes & np.uint64(m - 1)).astype(np.int64)] = True
    return np.packbits(on, bitorder="little").tobytes()


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    """The bitmap at a smaller power of two of bytes."""
    return np.bitwise_or.reduce(np.frombuffer(bitmap, dtype=np.uint8).reshape(-1, size), axis=0)


def overlap_bound(a: bytes, a_n: int, b: bytes, b_n: int) -> int:
    """The overlap of two sets is at most this: bits that the other lacks are elements that it lacks."""
    size = min(len(a), len(b))
    x, y = _folded(a, size), _folded(b, size)
    both = int(np.bitwise_count(x & y).sum())
    return min(a_n - (int(np.bitwise_count(x).sum()) - both), b_n - (int(np.bitwise_count(y).sum()) - both))


def _enough(overlap: int, a_n: int, b_n: int) -> bool:
    return (NUMERATOR + DENOMINATOR) * overlap >= NUMERATOR * (a_n + b_n)


def _needed(pairs: DataFrame) -> np.ndarray:
    """A bitmap in 64-bit words, at most ``FILTER_BITS`` bits: which sets stand in pairs (others may pass, too)."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    bits = 1 << max(10, min((BITS_EACH * keys.count()).bit_length(), FILTER_BITS.bit_length() - 1))
    cell = F.pmod("key", F.lit(bits))
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))).alias("word")
    found = keys.groupBy(F.shiftright(cell, 6).alias("at")).agg(word).toArrow()
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return table


def _is_needed(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    cell = keys.view(np.uint64) & np.uint64(64 * len(table) - 1)
    return (table[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _content(docs: DataFrame, sent, whole: bool) -> DataFrame:
    """``set_key, content`` of the sets that pass the filter: their bitmaps, or whole sorted arrays."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = sent.value, set()
        for batch in batches:
            for _, h, edges in _sets(batch.column(1)):
                n, keys = np.diff(edges), _keys(h, edges)
                rows = _first_of_task(keys, np.where(_is_needed(keys, wanted), n, 0), seen)
                values = [h[edges[i]:edges[i + 1]].tobytes() if whole else _bitmap(h[edges[i]:edges[i + 1]]) for i in rows]
                yield pa.RecordBatch.from_arrays([pa.array(keys[rows]), pa.array(values, type=pa.binary())], names=["set_key", "content"])

    found = docs.mapInArrow(tidy(emit), "set_key long, content binary")
    return found.groupBy("set_key").agg(F.min("content").alias("content"))  # equal sets of several tasks


def _tested(pairs: DataFrame, content: DataFrame, test: Callable[[bytes, int, bytes, int], bool]) -> DataFrame:
    """The pairs whose contents pass the test."""
    c = content.select("set_key", "content")
    p = pairs.join(c.withColumnsRenamed({"set_key": "ka", "content": "ca"}), F.col("a") == F.col("ka")).drop("ka")
    p = p.join(c.withColumnsRenamed({"set_key": "kb", "content": "cb"}), F.col("b") == F.col("kb")).drop("kb")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_n, b_n = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            ok = [test(x.as_py(), m, y.as_py(), n) for x, m, y, n in zip(batch.column(4), a_n, batch.column(5), b_n, strict=True)]
            yield batch.select([0, 1, 2, 3]).filter(pa.array(ok, type=pa.bool_()))
    return p.select("a", "a_n", "b", "b_n", "ca", "cb").mapInArrow(keep, "a long, a_n int, b long, b_n int")


def _bitmaps_allow(a: bytes, a_n: int, b: bytes, b_n: int) -> bool:
    return _enough(overlap_bound(a, a_n, b, b_n), a_n, b_n)


def _arrays_link(a: bytes, a_n: int, b: bytes, b_n: int) -> bool:
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    at = np.searchsorted(y, x)
    return _enough(int((y[np.minimum(at, len(y) - 1)] == x).sum()), a_n, b_n)


def _verified(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs that are links: bitmaps first, arrays for what they leave."""
    left = materialize(pairs, f"{name}-pairs")
    for test, whole, step in ((_bitmaps_allow, False, "maybe"), (_arrays_link, True, "links")):
        if left.isEmpty():
            break
        sent = docs.sparkSession.sparkContext.broadcast(_needed(left))
        left = materialize(_tested(left, _content(docs, sent, whole), test), f"{name}-{step}")
        sent.destroy()
    return left


def _tiles(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, key`` of every document, and the tiles' rows with their most typical sets."""
    first = materialize(d.mapInArrow(tidy(_sizes_and_repeats), "doc_id long, n long, key long, shingle long, times long"), "sizes")
    sets = first.filter("n is not null").select("doc_id", "n", "key")
    table = d.sparkSession.sparkContext.broadcast(_frequency_table(first.filter("shingle is not null").select("shingle", "times")))
    prefixes = d.mapInArrow(tidy(_prefixes(table)), "shingle long, key long, n int, place int, typical int, parts int")
    tiles = materialize(_with_typical(prefixes), "prefixes")
    table.destroy()
    return sets, tiles


def _classes(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, key`` of every document, and ``of, least, root`` of every set key (its least id and class)."""
    sets, tiles = _tiles(d)
    links = _verified(d, _star(tiles), "star")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    more = _verified(d, _across(tiles.select("shingle", "key", "n", "place"), roots), "across")
    roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(more.select("a", "b")))
    ids = sets.filter("key is not null").groupBy(F.col("key").alias("of")).agg(F.min("doc_id").alias("least"))
    named = ids.join(roots, F.col("of") == F.col("node"), "left").select("of", "least", F.coalesce("root", "of").alias("root"))
    return sets, materialize(named, "classes")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document (``doc_id, text``)."""
    sets, named = _classes(_texts(docs))
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    of_key = materialize(named.join(least, F.col("root") == F.col("r")).select("of", "component_id"), "components")
    return sets.join(of_key, F.col("key") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links: ``a, b`` (``a < b``) between the distinct sets that link, and ``doc_id, n_shingles, set`` of every document.

    Documents of one set are linked with each other and with all of the sets linked with theirs.
    """
    d = _texts(docs)
    sets, tiles = _tiles(d)
    rows = _by_size(tiles.select("shingle", "key", "n", "place"))
    size = rows.groupBy(F.col("shingle").alias("s"), F.col("band").alias("b")).agg(F.min("n").alias("t_least"), F.max("most").alias("t_most"))
    rows = materialize(rows.join(size, (F.col("shingle") == F.col("s")) & (F.col("band") == F.col("b"))).filter("most >= t_least and n <= t_most").select(*_TILE), "sized")
    x = rows.select(*[F.col(c).alias(f"x_{c}") for c in rows.columns])
    return _verified(d, _meet(x, rows, F.col("x_key") < F.col("key")), "all").select("a", "b"), sets.select("doc_id", F.col("n").alias("n_shingles"), F.col("key").alias("set"))


def link_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, n_links``: how many other documents each document is linked with."""
    links, sets = jaccard_links(docs)
    sets = materialize(sets, "sets")
    copies = sets.filter("set is not null").groupBy(F.col("set").alias("of")).agg(F.count("*").alias("copies"))
    both = links.select("a", "b").unionAll(links.select("b", "a")).toDF("a", "b")
    others = both.join(copies, F.col("b") == F.col("of")).groupBy(F.col("a").alias("linked")).agg(F.sum("copies").alias("others"))
    each = copies.join(others, F.col("of") == F.col("linked"), "left").select("of", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return sets.join(each, F.col("set") == F.col("of"), "left").select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def set_key(text: Column) -> Column:
    """The key of a text's shingle set; null if that is empty."""
    def of(texts: pa.Array) -> pa.Array:
        found = [pa.array(_keys(h, edges), mask=np.diff(edges) == 0) for _, h, edges in _sets(texts)]
        give_back()
        return pa.concat_arrays(found) if found else pa.nulls(0, pa.int64())
    of.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, "long")(text)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, with the columns of ``docs``: that of the least id.

    Of equal rows one stays; rows without any shingle stay all. Texts are
    shuffled once, by set key and id, so many copies of one text don't meet.
    """
    sets, named = _classes(_texts(docs))
    # the winner of each class: its least id, by set key among several; null ids come last
    order = F.struct(F.col("least").isNull(), "least", "of")
    best = named.groupBy("root").agg(F.min(order).alias("w")).select(F.col("w.of").alias("best_key"), F.col("w.least").alias("best_id"))
    best = materialize(best.select("*", F.lit(True).alias("best")), "kept")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("id"), set_key(F.col("text").cast("string")).alias("key"))
    keyed = keyed.withColumn("spread", F.coalesce("key", F.xxhash64("id")))  # rows without a key aren't one hot key
    kept = keyed.join(best, (F.col("spread") == F.col("best_key")) & F.col("id").eqNullSafe(F.col("best_id")), "left").filter("best or key is null")
    repeated = materialize(sets.filter("key is not null").groupBy("key", "doc_id").count().filter("count > 1").select(
        F.col("key").alias("r_key"), F.col("doc_id").alias("r_id")), "repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    again = (F.col("key") == F.col("r_key")) & F.col("id").eqNullSafe(F.col("r_id"))
    one = kept.join(repeated, again, "left_semi").dropDuplicates(["key", "id"])
    return kept.join(repeated, again, "left_anti").select("row").unionAll(one.select("row")).select("row.*")

"""Source divergence audit: how far each source's term shares are from the other sources' and from its language's.

Late string materialization: terms are counted, shuffled and compared as 64-bit
digests. Their text is needed in two places only: to find digests that stand
for several terms, and to name the terms of the result. Steps:

1. One scan of the texts. Tasks count occurrences and documents by (language,
   source, digest) before the shuffle. Aside, not shuffled with the counts,
   each task lists the text of every digest that it meets, and every further
   text that the same digest stands for (occurrences are compared byte by byte).
2. Digests in ``LEAST_DOCS`` documents of a language are kept. Of these the
   least and the greatest text are taken; where they differ, the digest is
   split: a second scan counts its terms by their text, and they take its place.
   (A digest of several terms has at least as many documents as each of them, so
   none is lost before.)
3. Shares ``p`` and divergences ``f`` are exact integers. The sum over all kept
   terms for two sources is put together from the terms that both have (blocks
   of terms, a small matrix each), those that one has (a histogram of its
   counts) and those that neither has (a number times one value).
4. Each group's leading terms are ranked by value with all ties; the text is
   joined to these only, and decides between ties.

Defined results: terms are lower-cased (``A-Z``) runs of letters and all code
points from 128 up; null texts, languages and sources are ``''``; a group without
terms still has pairs, a language without kept terms pairs of value 0 and no
terms; repeated rows count as often as they stand; other columns don't matter;
an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .terms import LETTERS, Terms, terms_of
from .text_kernels import mix64

#: A language keeps the terms of so many of its documents.
LEAST_DOCS = 10
SCALE = 1_000_000_000
#: Terms listed of each group.
TOP = 10
DIGEST_BITS = 64
#: Counts and texts that a task holds before it hands them on.
HELD = 1 << 19
#: Rows of a block of terms; a quarter of the elements of its matrix.
BLOCK = 1 << 16
#: Bits of the filter of split digests.
SPLIT_CELLS = 1 << 20

_COUNTS = "lang string, source string, digest long, n long, docs long, term string"


def _digests(t: Terms, bits: int) -> np.ndarray:
    return (t.hashes & np.uint64((1 << bits) - 1)).view(np.int64)


class _Groups:
    """Numbers of the (language, source) pairs that a task meets."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}

    def of(self, langs: pa.Array, sources: pa.Array) -> np.ndarray:
        return np.array([self.number.setdefault(x, len(self.number)) for x in zip(langs.to_pylist(), sources.to_pylist())], dtype=np.int64)

    def columns(self, at: np.ndarray) -> list[pa.Array]:
        names = list(self.number)
        return [pa.DictionaryArray.from_arrays(pa.array(at.astype(np.int32)), pa.array([x[i] for x in names], type=pa.string())).cast(pa.string()) for i in (0, 1)]


def _tally(group: np.ndarray, row: np.ndarray, digest: np.ndarray) -> pd.DataFrame:
    """``group, digest, n, docs`` of terms with their rows and the rows' groups."""
    code, digests = pd.factorize(digest)
    # once for each row and term, then for each group and term
    pair, pairs = pd.factorize(row * len(digests) + code)
    both, found = pd.factorize(group[pairs // len(digests)] * len(digests) + pairs % len(digests))
    n = np.bincount(both, weights=np.bincount(pair)).astype(np.int64)
    return pd.DataFrame({"group": found // len(digests), "digest": digests[found % len(digests)], "n": n, "docs": np.bincount(both)})


def _others(t: Terms, code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The terms whose bytes differ from the first term of the same digest."""
    size = t.ends - t.starts
    like = first[code]
    same = size == size[like]
    at = np.flatnonzero(same)
    edges = np.cumsum(size[at]) - size[at]
    place = np.arange(int(size[at].sum())) - np.repeat(edges, size[at])
    equal = t.raw[np.repeat(t.starts[at], size[at]) + place] == t.raw[np.repeat(t.starts[like[at]], size[at]) + place]
    same[at] = np.logical_and.reduceat(equal, edges) if len(at) else True
    return np.flatnonzero(~same)


def _second_hashes(t: Terms, at: np.ndarray) -> np.ndarray:
    """Of some terms, a hash that has nothing to do with the digest."""
    size = t.ends[at] - t.starts[at]
    edges = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(edges, size)
    symbol = mix64(place.astype(np.uint64) * np.uint64(257) + t.raw[np.repeat(t.starts[at], size) + place])
    return np.add.reduceat(symbol, edges).view(np.int64)


class _Texts:
    """The distinct (digest, text) pairs of a task; texts are told apart by a second hash."""

    def __init__(self):
        self.keys, self.texts = [], []

    def add(self, t: Terms, at: np.ndarray, digest: np.ndarray) -> None:
        if len(at):
            self.keys.append(pd.DataFrame({"digest": digest[at], "second": _second_hashes(t, at)}))
            self.texts.append(t.texts(at))

    def __len__(self) -> int:
        return sum(map(len, self.keys))

    def merge(self) -> None:
        keys = pd.concat(self.keys, ignore_index=True)
        first = np.flatnonzero(~keys.duplicated().to_numpy())
        self.keys, self.texts = [keys.iloc[first]], [pa.concat_arrays(self.texts).take(pa.array(first))]

    def rows(self) -> list[pa.Array]:
        self.merge()
        digest, texts = self.keys[0]["digest"].to_numpy(), self.texts[0].cast(pa.string())
        self.keys, self.texts = [], []
        none, zero = pa.nulls(len(digest), pa.string()), pa.nulls(len(digest), pa.int64())
        return [none, none, pa.array(digest), zero, zero, texts]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of 64k rows, as the JVM holds a whole one."""
    for a in range(0, len(batch), 1 << 16):
        yield batch.slice(a, 1 << 16)


def _scan(bits: int) -> Callable:
    """Rows of counts (without ``term``) and rows of texts (``digest, term`` alone)."""
    names = ["lang", "source", "digest", "n", "docs", "term"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, texts = _Groups(), [], _Texts()

        def merged():
            sums = pd.concat(held).groupby(["group", "digest"], sort=False).sum().reset_index()
            held[:] = [sums]
            return sums

        def counts():
            sums = merged()
            held.clear()
            return pa.RecordBatch.from_arrays([*groups.columns(sums["group"].to_numpy()), *(pa.array(sums[c].to_numpy()) for c in ("digest", "n", "docs")),
                                               pa.nulls(len(sums), pa.string())], names=names)

        for batch in batches:
            of_row = groups.of(batch.column(0), batch.column(1))
            for t in terms_of(batch.column(2), LETTERS):
                if not len(t.hashes):
                    continue
                digest = _digests(t, bits)
                row = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
                held.append(_tally(of_row[t.row:t.row + len(t.first) - 1], row, digest))
                code, digests = pd.factorize(digest)
                first = np.zeros(len(digests), np.int64)
                first[code[::-1]] = np.arange(len(code))[::-1]
                texts.add(t, first, digest)
                texts.add(t, _others(t, code, first), digest)
                if len(texts) > 2 * HELD:
                    texts.merge()
                    if len(texts) > HELD:
                        yield from _slices(pa.RecordBatch.from_arrays(texts.rows(), names=names))
                if sum(map(len, held)) > 2 * HELD and len(merged()) > HELD:
                    yield from _slices(counts())
        if held:
            yield from _slices(counts())
        if len(texts):
            yield from _slices(pa.RecordBatch.from_arrays(texts.rows(), names=names))
    return emit


def _rows(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text"))


def _kept(counts: DataFrame, term: list[str]) -> DataFrame:
    """``lang, source, term..., n, lang_n``: the counts of the terms that the language keeps.

    Rows are dealt by language and term once; sums by source and by language both follow from that.
    """
    dealt = counts.repartition("lang", *term).groupBy("lang", *term, "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    lang = Window.partitionBy("lang", *term)
    sums = dealt.withColumns({"lang_n": F.sum("n").over(lang), "lang_docs": F.sum("docs").over(lang)})
    return sums.filter(F.col("lang_docs") >= LEAST_DOCS).select("lang", "source", *term, "n", "lang_n")


def _split_counts(rows: DataFrame, several: DataFrame, bits: int) -> DataFrame:
    """``lang, source, digest, split, n, docs``: the terms of the digests in ``several``, by their text."""
    cells = several.select(F.pmod("digest", F.lit(SPLIT_CELLS)).cast("int").alias("cell")).distinct().toArrow()["cell"].to_numpy()
    wanted = np.zeros(SPLIT_CELLS, dtype=bool)
    wanted[cells] = True
    sent = rows.sparkSession.sparkContext.broadcast(wanted)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in terms_of(batch.column(2), LETTERS):
                digest = _digests(t, bits)
                at = np.flatnonzero(sent.value[digest % SPLIT_CELLS])
                if not len(at):
                    continue
                row = np.searchsorted(t.first, at, side="right") - 1
                found = pd.DataFrame({"row": row, "digest": digest[at], "split": t.texts(at).to_pylist()}).groupby(["row", "digest", "split"]).size().reset_index(name="n")
                where = pa.array(t.row + found["row"].to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), pa.array(found["digest"].to_numpy()),
                                                  pa.array(found["split"], type=pa.string()), pa.array(found["n"].to_numpy())], names=["lang", "source", "digest", "split", "n"])

    found = rows.mapInArrow(emit, "lang string, source string, digest long, split string, n long")
    found = found.groupBy("lang", "source", "digest", "split").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))  # one row a document
    counted = materialize(found.join(several.select("digest"), "digest", "left_semi").select("lang", "source", "digest", "split", "n", "docs"), "split")
    sent.destroy()
    return counted


def term_counts(docs: DataFrame, bits: int = DIGEST_BITS) -> tuple[DataFrame, DataFrame]:
    """The kept terms' counts ``lang, source, digest, split, n, lang_n``, and ``digest, name``.

    ``split`` is the text of a term that shares its digest, and ``''`` for all others, whose text is ``name``.
    """
    rows = _rows(docs)
    found = materialize(rows.mapInArrow(_scan(bits), _COUNTS), "terms")
    kept = materialize(_kept(found.filter("term is null"), ["digest"]), "kept")
    texts = found.filter("term is not null").select("digest", "term").join(kept.select("digest").distinct(), "digest", "left_semi")
    names = materialize(texts.groupBy("digest").agg(F.min("term").alias("name"), F.max("term").alias("last")), "names")
    several = names.filter(F.col("name") != F.col("last"))
    kept = kept.select("lang", "source", "digest", F.lit("").alias("split"), "n", "lang_n")
    if not several.isEmpty():
        split = _kept(_split_counts(rows, several, bits), ["digest", "split"])
        kept = materialize(kept.join(several.select("digest"), "digest", "left_anti").select(kept.columns).unionAll(split.select(kept.columns)), "kept-split")
    return kept, names.select("digest", "name")


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * terms))``, exactly; null without terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    size = F.nullif(total + 2 * terms, F.lit(0))
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 2), wide(size))


def apart(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, terms, zero`` of every group; ``zero`` is the share of a term that it hasn't."""
    groups = _rows(docs).select("lang", "source").distinct()
    of_group = kept.groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).agg(F.sum("n").alias("total"))
    terms = kept.select("lang", "digest", "split", "lang_n").distinct().groupBy(F.col("lang").alias("t_lang")).agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    g = groups.join(of_group, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")), "left").join(terms, F.col("lang") == F.col("t_lang"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    g = g.select("lang", "source", zero("total"), zero("lang_total"), zero("terms"))
    return materialize(g.withColumn("zero", share(F.lit(0), F.col("total"), F.col("terms"))), "groups")


def _leading_terms(kept: DataFrame, names: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "total", "lang_total", "terms")
    shares = kept.join(g, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source"))).select(
        "lang", "source", "digest", "split", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    valued = shares.filter("p > q").select("lang", "source", "digest", "split", apart(F.col("p"), F.col("q")).alias("value"))
    group = Window.partitionBy("lang", "source")
    first = valued.withColumn("at", F.rank().over(group.orderBy(F.desc("value")))).filter(F.col("at") <= TOP).drop("at")
    named = first.join(names, "digest").withColumn("item", F.when(F.col("split") == "", F.col("name")).otherwise(F.col("split")))
    rank = F.row_number().over(group.orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank.alias("rank")).filter(F.col("rank") <= TOP)


def _shared(block: pd.DataFrame) -> pd.DataFrame:
    """``lang, a, b, value``: for two sources, what the terms that both have add to the sum over others."""
    f = lambda p, q: (p - q) * (p - q) // (p + q)
    source, sources = pd.factorize(block["source"], sort=True)
    term = block.groupby(["digest", "split"], sort=False).ngroup().to_numpy()
    zero = np.zeros(len(sources), np.int64)
    zero[source] = block["zero"].to_numpy()
    sums = np.zeros((len(sources), len(sources)), np.int64)
    order, p = np.argsort(term, kind="stable"), block["p"].to_numpy()
    step = max(1, (4 * BLOCK) // len(sources))
    edges = np.searchsorted(term[order], np.arange(0, term.max() + 1 + step, step))
    for k, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if i == j:
            continue
        rows = order[i:j]
        grid = np.zeros((int(term[rows].max()) - k * step + 1, len(sources)), np.int64)
        grid[term[rows] - k * step, source[rows]] = p[rows]
        for a in range(len(sources) - 1):
            have = grid[:, a] > 0
            x, y, zx, zy = grid[have, a, None], grid[have, a + 1:], zero[a], zero[None, a + 1:]
            sums[a, a + 1:] += np.where(y > 0, f(x, y) - f(x, zy) - f(zx, np.maximum(y, 1)) + f(zx, zy), 0).sum(axis=0)
    a, b = np.triu_indices(len(sources), 1)
    return pd.DataFrame({"lang": block["lang"].iloc[0], "a": sources.to_numpy()[a], "b": sources.to_numpy()[b], "value": sums[a, b]})


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("a_total"), F.col("zero").alias("a_zero"), "terms")
    b = groups.select(F.col("lang").alias("b_lang"), F.col("source").alias("b"), F.col("zero").alias("b_zero"))
    # the terms that both have, in blocks
    blocks = max(1, -(-kept.count() // BLOCK))
    g = a.withColumnsRenamed({"lang": "g_lang"})
    with_share = kept.join(g, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("a"))).select(
        "lang", F.pmod(F.xxhash64("digest", "split"), F.lit(blocks)).alias("block"), "source", "digest", "split",
        share(F.col("n"), F.col("a_total"), F.col("terms")).alias("p"), F.col("a_zero").alias("zero"))
    both = with_share.groupBy("lang", "block").applyInPandas(_shared, "lang string, a string, b string, value long")
    # the terms that one has, by its counts
    has = kept.groupBy(F.col("lang").alias("h_lang"), F.col("source").alias("h_source"), "n").agg(F.count("*").alias("times"))
    has = has.join(a, (F.col("h_lang") == F.col("lang")) & (F.col("h_source") == F.col("a"))).select(
        "lang", "a", "a_zero", "times", share(F.col("n"), F.col("a_total"), F.col("terms")).alias("p"))
    one = has.join(b, (F.col("lang") == F.col("b_lang")) & (F.col("a") != F.col("b"))).select(
        "lang", "a", "b", (F.col("times") * (apart(F.col("p"), F.col("b_zero")) - apart(F.col("a_zero"), F.col("b_zero")))).alias("value"))
    none = a.join(b, (F.col("lang") == F.col("b_lang")) & (F.col("a") < F.col("b"))).select(
        "lang", "a", "b", F.coalesce(F.col("terms") * apart(F.col("a_zero"), F.col("b_zero")), F.lit(0)).alias("value"))
    parts = both.unionAll(one.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))).unionAll(none)
    sums = parts.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("value"))
    either = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return either.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value").withColumn("rank", rank)


def divergence(docs: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """``lang, source, part, item, value, rank``: every group's other sources (``pair``) and leading terms (``term``)."""
    kept, names = term_counts(docs, bits)
    groups = _groups(docs, kept)
    return _pairs(kept, groups).unionAll(_leading_terms(kept, names, groups))

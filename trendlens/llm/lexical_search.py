"""Ranked lexical search: the best ``TOP`` documents of every item, by a hybrid of term- and document-at-a-time.

1. One scan of the texts writes a forward index: each document's length and its
   terms (64-bit hashes) with their counts, as far as a filter of the items'
   terms lets them through (a bitmap of at most ``FILTER_BITS`` bits).
2. The collection's figures come from the index: documents, lengths, and how
   many documents hold each of the items' terms.
3. Items are worked through in blocks of about ``BLOCK_TERMS`` terms, each a
   stated set of queries against all documents. Tasks read the index, invert some
   documents at a time (a shard of about ``SHARD_POSTINGS`` postings) and answer
   every item of the block:

   * term at a time: the postings of its short lists are summed to accumulators,
     which from then on are one more list with a bound, its greatest sum;
   * document at a time: spans of ``SPAN`` documents whose lists' greatest impacts
     together can't reach the ``TOP``-th best score are skipped. In the others,
     lists are taken in descending order of their bounds until the rest can't
     lift a document alone; only documents of these are completed by search in
     the rest, and dropped as soon as their bound falls below that score.

   A task keeps the best of all its shards, so its bound rises as it goes on.
4. The tasks' best are merged in two steps, by (item, part) and by item.

Defined results: terms are lower-cased (``A-Z``) runs of ASCII letters, digits
and all code points from 128 up; texts that are null or without terms are found
by nothing, items without terms find nothing; rows that share an ``item_id`` are
one item with all their terms, a null id is one; documents that share a
``doc_id`` are ranked each, a null ``doc_id`` after others of equal score;
repeated rows are repeated documents; other columns don't matter; an empty table
gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .terms import WORDS, terms_of

TOP = 50
BLOCK_TERMS = 1 << 20
SHARD_POSTINGS = 1 << 21
SPAN = 256
#: Spans that are worked through before the bound is looked at again.
SPANS_AT_ONCE = 8
#: A list is short if at most one document in so many of the shard is in it.
SHORT = 64
BITS_EACH = 32
FILTER_BITS = 1 << 27
#: Parts of an item's results in the first merging step.
PARTS = 64


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, digest``: the distinct terms of each item."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in terms_of(batch.column(1), WORDS):
                row = np.repeat(np.arange(len(t.first) - 1) + t.row, np.diff(t.first))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(t.hashes.view(np.int64))], names=["item_id", "digest"])

    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(emit, f"item_id {rows.schema['item_id'].dataType.simpleString()}, digest long").distinct()


def _bitmap(digests: DataFrame) -> np.ndarray:
    """A bitmap of the digests in 64-bit words; at most ``FILTER_BITS`` bits."""
    bits = 1 << max(10, min((BITS_EACH * digests.count()).bit_length(), FILTER_BITS.bit_length() - 1))
    cell = F.pmod("digest", F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))
    found = digests.groupBy(F.shiftright(cell, 6).alias("w")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def _passes(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    cell = hashes & np.uint64(64 * len(words) - 1)
    return (words[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def forward_index(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document, written once; ``terms`` are those that may be in ``digests``."""
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(digests))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in terms_of(batch.column(1), WORDS):
                rows = len(t.first) - 1
                at = np.flatnonzero(_passes(t.hashes, sent.value))
                row = np.searchsorted(t.first, at, side="right") - 1
                code, found = pd.factorize(t.hashes[at].view(np.int64))
                pair, times = np.unique(row * max(1, len(found)) + code, return_counts=True)
                edges = pa.array(np.searchsorted(pair, np.arange(rows + 1) * max(1, len(found))).astype(np.int32))
                terms = found[pair % len(found)] if len(found) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.row, rows), pa.array(np.diff(t.first)), pa.ListArray.from_arrays(edges, pa.array(terms)),
                                                  pa.ListArray.from_arrays(edges, pa.array(times))], names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = materialize(rows.mapInArrow(emit, "doc_id long, n long, terms array<long>, counts array<long>"), "index")
    sent.destroy()
    return index


@dataclass
class Block:
    """A block of items: their terms as numbers of ``digests`` (sorted), the terms' weights, and the collection's figures."""

    items: pa.Array
    edges: np.ndarray
    terms: np.ndarray
    digests: np.ndarray
    weights: np.ndarray
    docs: int
    length: int


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def _block(rows: pa.Table, docs: int, length: int) -> Block:
    """From ``item_id, digest, holding`` (null: no document holds the term)."""
    rows = rows.filter(pc.is_valid(rows["holding"]))
    coded = rows["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    digests, holding = rows["digest"].to_numpy(), rows["holding"].to_numpy()
    known, first, term = np.unique(digests, return_index=True, return_inverse=True)
    weights = {n: weight(docs, n) for n in np.unique(holding).tolist()}
    item = coded.indices.to_numpy()
    order = np.lexsort((term, item))
    return Block(coded.dictionary, np.searchsorted(item[order], np.arange(len(coded.dictionary) + 1)), term[order], known,
                 np.array([weights[n] for n in holding[first].tolist()], dtype=np.int64), docs, length)


class Best:
    """The ``TOP`` best of an item so far: descending score, then ascending id."""

    def __init__(self):
        self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """Scores below this can't get in."""
        return int(self.score[-1]) if len(self.score) == TOP else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:TOP]
        self.score, self.doc = score[order], doc[order]


@dataclass
class _List:
    """Places of documents in the shard (ascending), impacts, the greatest one, and the greatest of each span."""

    docs: np.ndarray
    impacts: np.ndarray
    bound: int
    spans: np.ndarray

    def of(self, docs: np.ndarray) -> np.ndarray:
        """The impacts of these documents, 0 where they aren't in the list."""
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[at] == docs, self.impacts[at], 0)


def _span_bounds(docs: np.ndarray, impacts: np.ndarray, spans: int) -> np.ndarray:
    out = np.zeros(spans, np.int64)
    of = docs // SPAN
    head = np.flatnonzero(np.diff(of, prepend=-1))
    out[of[head]] = np.maximum.reduceat(impacts, head)
    return out


class Shard:
    """The inverted lists of some documents for a block's terms."""

    def __init__(self, block: Block, ids: np.ndarray, n: np.ndarray, edges: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.spans = ids[order], -(-len(ids) // SPAN)
        doc = np.repeat(place, np.diff(edges))
        term = np.minimum(np.searchsorted(block.digests, terms), len(block.digests) - 1)
        known = (block.digests[term] == terms) & (block.weights[term] > 0)
        doc, term, counts = doc[known], term[known], counts[known]
        length, of = np.unique(n[order], return_inverse=True)
        # in Python's numbers: 50 * n * N may need more than 64 bits
        m = np.array([50 + 50 * x * block.docs // max(1, block.length) for x in length.tolist()], dtype=np.int64)[of]
        impact = block.weights[term] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m[doc]))
        order = np.lexsort((doc, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.found, self.starts = np.unique(term[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.short = max(1, len(ids) // SHORT)
        self.long: dict[int, _List] = {}

    def _list(self, i: int) -> _List:
        if i not in self.long:
            docs, impacts = self.docs[self.starts[i]:self.ends[i]], self.impacts[self.starts[i]:self.ends[i]]
            self.long[i] = _List(docs, impacts, int(impacts.max()), _span_bounds(docs, impacts, self.spans))
        return self.long[i]

    def _accumulated(self, which: np.ndarray) -> _List | None:
        """Term at a time: the sums of these lists, as one list."""
        if not len(which):
            return None
        docs = np.concatenate([self.docs[self.starts[i]:self.ends[i]] for i in which])
        impacts = np.concatenate([self.impacts[self.starts[i]:self.ends[i]] for i in which])
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        head = np.flatnonzero(np.diff(docs, prepend=-1))
        docs, sums = docs[head], np.add.reduceat(impacts[order], head)
        return _List(docs, sums, int(sums.max()), _span_bounds(docs, sums, self.spans))

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Add the shard's documents that belong to the best for an item of these terms."""
        at = np.searchsorted(self.found, terms)
        inside = at < len(self.found)
        which = at[inside][self.found[at[inside]] == terms[inside]]
        if not len(which):
            return
        short = self.ends[which] - self.starts[which] <= self.short
        sums = self._accumulated(which[short])
        lists = [self._list(i) for i in which[~short].tolist()]
        least = best.least()
        if sums is not None:
            if lists:
                # whole scores of the best sums: as many documents reach the least of them
                lead = np.argsort(-sums.impacts, kind="stable")[:TOP]
                scores = np.concatenate([best.score, sums.impacts[lead] + sum(x.of(sums.docs[lead]) for x in lists)])
                if len(scores) >= TOP:
                    least = max(least, int(np.partition(scores, len(scores) - TOP)[len(scores) - TOP]))
            lists.append(sums)
        lists.sort(key=lambda x: x.bound)
        below = np.cumsum([x.bound for x in lists])  # what the lists up to each can add together
        live = np.flatnonzero(sum(x.spans for x in lists) >= least)
        k = 0
        while k < len(live):
            group = live[k:k + SPANS_AT_ONCE]
            group = group[group < group[0] + SPANS_AT_ONCE]
            k += len(group)
            lo, hi = int(group[0]) * SPAN, (int(group[-1]) + 1) * SPAN
            rest = int(np.searchsorted(below, least))  # the lists before this can't reach the bound without others
            total = np.zeros(hi - lo, np.int64)
            for x in lists[rest:]:
                i, j = np.searchsorted(x.docs, (lo, hi))
                total[x.docs[i:j] - lo] += x.impacts[i:j]
            docs = np.flatnonzero(total)
            score = total[docs]
            docs += lo
            for i in range(rest - 1, -1, -1):
                able = score + below[i] >= least
                docs, score = docs[able], score[able]
                score = score + lists[i].of(docs)
            good = score >= least
            if good.any():
                best.add(score[good], self.ids[docs[good]])
                least = max(least, best.least())


#: Stands for a null id: it comes after all others.
_NO_ID = (1 << 63) - 1


def _answer(sent) -> Callable:
    """``item_id, doc_id, score``: a task's best of each item of the block."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = sent.value
        best = [Best() for _ in block.items]
        held: list[tuple] = []

        def run():
            ids, n, sizes, terms, counts = (np.concatenate(x) for x in zip(*held))
            held.clear()
            shard = Shard(block, ids, n, np.concatenate([[0], np.cumsum(sizes)]), terms, counts)
            for i, b in enumerate(best):
                shard.search(block.terms[block.edges[i]:block.edges[i + 1]], b)

        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            terms, counts = batch.column(2), batch.column(3)
            held.append((ids, batch.column(1).to_numpy(), np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), counts.flatten().to_numpy()))
            if sum(len(x[3]) for x in held) > SHARD_POSTINGS:
                run()
        if held:
            run()
        item = np.repeat(np.arange(len(best)), [len(b.doc) for b in best])
        if len(item):
            doc = np.concatenate([b.doc for b in best])
            yield pa.RecordBatch.from_arrays([block.items.take(pa.array(item)), pa.array(doc, mask=doc == _NO_ID), pa.array(np.concatenate([b.score for b in best]))],
                                             names=["item_id", "doc_id", "score"])
    return emit


def _merged(found: DataFrame) -> DataFrame:
    best = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*best))).filter(F.col("rank") <= TOP)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*best))
    return first.select("item_id", rank.alias("rank"), "doc_id", "score").filter(F.col("rank") <= TOP)


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents (``doc_id, text``) of each item (``item_id, text``)."""
    spark = docs.sparkSession
    terms = materialize(item_terms(items), "item-terms")
    index = forward_index(docs, terms.select("digest").distinct())
    docs_n, length = index.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = index.select(F.explode("terms").alias("h_digest")).groupBy("h_digest").agg(F.count("*").alias("holding"))
    known = materialize(terms.join(holding, F.col("digest") == F.col("h_digest"), "left").select("item_id", "digest", "holding"), "item-weights")
    blocks = max(1, -(-known.count() // BLOCK_TERMS))
    kind = f"item_id {known.schema['item_id'].dataType.simpleString()}, doc_id long, score long"
    found = []
    for b in range(blocks):
        mine = known.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        block = _block(mine, docs_n, length)
        if not len(block.digests):
            continue
        sent = spark.sparkContext.broadcast(block)
        found.append(materialize(index.mapInArrow(_answer(sent), kind), "best"))
        sent.destroy()
    return _merged(reduce(DataFrame.unionAll, found, spark.createDataFrame([], kind)))

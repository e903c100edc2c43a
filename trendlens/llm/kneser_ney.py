"""Quality classifier: interpolated modified Kneser-Ney model of code-point n-grams of trusted text, one for each language.

The vocabulary is open: symbols are the code points themselves, n-grams of
``ORDER`` of them, so the model's tables grow with the trusted text. They are
sharded DataFrames throughout; nothing of the model goes to the driver or whole
to a task.

1. Texts are packed into blocks (:mod:`blocks`), written once.
2. Trusted documents are found by id. ``1 / HELD_OUT`` of them are held out for
   the thresholds; the others' n-grams are counted, in the tasks first.
3. Lower orders are continuation counts of the order above. Absolute discounts
   for counts 1, 2 and 3+ come from the counts of counts of each order.
4. Each block lists its distinct n-grams. The distinct ones of all blocks are
   joined with the counts of their order and of their context, from the lowest
   order up, which gives each n-gram's bits. The lowest order is interpolated
   with a uniform distribution over the known symbols and one unknown.
5. The bits are joined back to the blocks' n-grams and meet the texts there,
   where they are summed by document.

A score is bits per symbol, drawn to the language's mean as if ``PRIOR_SYMBOLS``
symbols of mean text were added, so that short texts aren't rejected by chance.
The threshold of a language comes from its held-out documents: the quantile
``QUANTILE``, ``SLACK`` times its distance from the median, and ``WIDEN`` bits
divided by the root of their number, as few documents say little.

Defined results: null and empty texts have no score and are kept; a null
language is one, named ``''``; a language without trusted text has no model and
no score, one without held-out documents no threshold, and their documents are
kept; repeated rows are judged alike, conflicting labels make a document
untrusted, a null ``doc_id`` is never trusted; very long texts are read in pieces
that overlap by a context; the code point 0 counts as U+FFFD; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .blocks import blocks, positions, text_offsets, unpacked
from .memory import give_back, tidy
from .text_kernels import chunks, mix64

ORDER = 4
#: One in so many trusted documents is held out from training.
HELD_OUT = 5
PRIOR_SYMBOLS = 30
QUANTILE = 0.99
SLACK = 0.5
WIDEN = 1.0
#: What stands before a text.
_START = "\n" * (ORDER - 1)
#: Symbols that are worked through at a time, and n-grams that are held before they are merged.
PIECE = 1 << 18
HELD = 1 << 18
_FACTORS = mix64(np.arange(1, ORDER + 1, dtype=np.uint64)) | np.uint64(1)


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers of texts and their symbols with the context before; long texts come in several pieces."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        padded = _START + text
        for a in range(0, len(text), PIECE):
            rows.append(i)
            parts.append(padded[a:a + PIECE + ORDER - 1])
            size += len(parts[-1])
            if size > PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def _hashes(window: np.ndarray, n: int) -> np.ndarray:
    """Of ``n`` n-grams whose symbols are ``window[0:n]``, ``window[1:n + 1]`` and so on."""
    h = np.zeros(n, np.uint64)
    for j in range(ORDER):
        h += window[j:j + n] * _FACTORS[j]
    return mix64(h).view(np.int64)


def _grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points; hash and place of every n-gram; and how many n-grams each part has (one for each symbol of its own)."""
    cp = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    cp[cp == 0] = 0xFFFD
    size = np.array([len(p) for p in parts])
    own = np.ones(len(cp), dtype=bool)
    own[(np.cumsum(size)[:, None] - np.arange(1, ORDER)).ravel()] = False  # these would reach into the next part
    at = np.flatnonzero(own)
    padded = np.concatenate([cp, np.zeros(ORDER, np.uint64)])
    return cp, _hashes(padded, len(cp))[at], at, size - (ORDER - 1)


class Tally:
    """Distinct n-grams with counts; merged whenever ``HELD`` are held."""

    def __init__(self):
        self.hash, self.symbols, self.n = [np.zeros(0, np.int64)], [np.zeros((0, ORDER), np.uint32)], [np.zeros(0, np.int64)]

    def add(self, parts: list[str]) -> None:
        cp, h, at, _ = _grams(parts)
        code, found = pd.factorize(h)
        first = np.zeros(len(found), np.int64)
        first[code[::-1]] = at[::-1]
        self.hash.append(found)
        self.n.append(np.bincount(code, minlength=len(found)))
        self.symbols.append(cp[first[:, None] + np.arange(ORDER)].astype(np.uint32))
        if sum(map(len, self.hash)) > HELD:
            self.merge()

    def merge(self) -> None:
        code, found = pd.factorize(np.concatenate(self.hash))
        first = np.zeros(len(found), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        n = np.bincount(code, weights=np.concatenate(self.n), minlength=len(found)).astype(np.int64)
        self.hash, self.symbols, self.n = [found], [np.concatenate(self.symbols)[first]], [n]

    def result(self) -> tuple[pa.Array, np.ndarray]:
        """The n-grams as strings, and their counts."""
        self.merge()
        text = np.ascontiguousarray(self.symbols[0]).view(f"<U{ORDER}").ravel()
        return pa.array(text, type=pa.string()), self.n[0]


def _by_language(rows: pa.Table) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """Row numbers and texts of one language after the other, for about ``PIECE`` bytes of a block's rows at a time."""
    done = 0
    for batch in rows.select(["lang", "text"]).to_batches():
        for a, b in chunks(text_offsets(batch.column(1)), PIECE):
            part = batch.slice(a, b - a)
            code, names = pd.factorize(part.column(0).to_pandas())
            texts = part.column(1).to_pylist()
            for k, name in enumerate(names):
                at = np.flatnonzero(code == k)
                yield name, done + a + at, [texts[i] or "" for i in at.tolist()]
        done += len(batch)


def _count(rows: pa.Table, block: int) -> pa.Table | None:
    """``block, lang, gram, n`` of the distinct n-grams of some documents."""
    tallies: dict[str, Tally] = {}
    for name, _, texts in _by_language(rows):
        tally = tallies.setdefault(name, Tally())
        for _, parts in _pieces(texts):
            tally.add(parts)
    found = []
    for name, tally in tallies.items():
        gram, n = tally.result()
        found.append(pa.table({"block": pa.array(np.full(len(n), block)), "lang": pa.array([name] * len(n), type=pa.string()), "gram": gram, "n": n}))
    return pa.concat_tables(found) if found else None


_COUNTED = "block long, lang string, gram string, n long"


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the documents whose labels all say good and not toxic."""
    return (labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("trusted_id"))
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
            .filter("q = 1 and t = 0").select("trusted_id"))


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(HELD_OUT)) == 0


def count_grams(table: DataFrame, labels: DataFrame) -> DataFrame:
    """``lang, gram, n`` over the trusted documents of the blocks that aren't held out."""
    # labels grow with the documents: the join is the same at every size
    mine = positions(table).join(trusted_ids(labels).hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi").filter(~_held_out(F.col("doc_id")))

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"block": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "gram": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        if not len(left) or not len(right):
            return empty
        rows = unpacked(left).take(right["pos"])
        found = _count(rows, left["block"][0].as_py()) or empty
        del rows
        give_back()
        return found

    counted = table.select("block", "first", "blob").groupBy("block").cogroup(mine.select(F.col("block").alias("of"), "pos").groupBy("of")).applyInArrow(count, _COUNTED)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def orders(counts: DataFrame) -> list[DataFrame]:
    """``lang, gram, n`` of each order from 1 to ``ORDER``: the counts, and below them how many symbols stand before."""
    found = [materialize(counts, f"order-{ORDER}")]
    for k in range(ORDER - 1, 0, -1):
        found.insert(0, materialize(found[0].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")), f"order-{k}"))
    return found


def _discounts(counts: DataFrame, k: int) -> DataFrame:
    """``d_lang, k, d1, d2, d3``: each language's discounts of the counts 1, 2 and 3+ of an order."""
    c = counts.groupBy(F.col("lang").alias("d_lang")).agg(*[F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    out = [F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")).otherwise(0.5 * i) for i in (1, 2, 3)]
    # within (0, count), so that no probability is negative or lost
    return c.select("d_lang", F.lit(k).alias("k"), *[F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), x)).alias(f"d{i}") for i, x in enumerate(out, 1)])


def _level(want: DataFrame, counts: DataFrame, discounts: DataFrame, below: DataFrame | None, k: int) -> DataFrame:
    """``lang, gram, p`` of the wanted n-grams of order ``k``, from those of the order below."""
    ctx = counts.groupBy(F.col("lang").alias("c_lang"), F.substring("gram", 1, k - 1).alias("c_ctx")).agg(
        F.sum("n").alias("total"), *[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2)], F.count_if(F.col("n") >= 3).alias("n3"))
    own = counts.select(F.col("lang").alias("o_lang"), F.col("gram").alias("o_gram"), "n")
    t = want.join(own, (F.col("lang") == F.col("o_lang")) & (F.col("gram") == F.col("o_gram")), "left")
    t = t.join(ctx, (F.col("lang") == F.col("c_lang")) & (F.substring("gram", 1, k - 1) == F.col("c_ctx")), "left")
    t = t.join(discounts.filter(F.col("k") == k), F.col("lang") == F.col("d_lang"))
    if below is None:
        lower = 1.0 / (F.col("n1") + F.col("n2") + F.col("n3") + 1)
    else:
        t = t.join(below.select(F.col("lang").alias("b_lang"), F.col("gram").alias("b_gram"), F.col("p").alias("lower")),
                   (F.col("lang") == F.col("b_lang")) & (F.substring("gram", 2, k) == F.col("b_gram")))
        lower = F.col("lower")
    cut = F.when(F.col("n") >= 3, F.col("d3")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d1"))
    share = F.coalesce((F.col("n") - cut) / F.col("total"), F.lit(0.0))
    back = F.coalesce((F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total"), F.lit(1.0))
    return t.select("lang", "gram", (share + back * lower).alias("p"))


def probabilities(grams: DataFrame, counted: list[DataFrame]) -> DataFrame:
    """``lang, gram, p``: the probability of each n-gram's last symbol after the others, under its language's model.

    ``grams`` holds ``lang, gram``; languages without a model are left out.
    """
    discounts = _discounts(counted[0], 1)
    for k in range(2, ORDER + 1):
        discounts = discounts.unionAll(_discounts(counted[k - 1], k))
    discounts = materialize(discounts, "discounts")
    known = discounts.filter("k = 1").select("d_lang")
    want = materialize(grams.select("lang", "gram").distinct().join(known, F.col("lang") == F.col("d_lang"), "left_semi"), "wanted")
    p = None
    for k in range(1, ORDER + 1):
        wanted = want if k == ORDER else want.select("lang", F.substring("gram", ORDER - k + 1, k).alias("gram")).distinct()
        p = materialize(_level(wanted, counted[k - 1], discounts, p, k), f"p-{k}")
    return p


def _block_grams(table: DataFrame) -> DataFrame:
    """``block, lang, gram``: the distinct n-grams of each block."""
    def of(rows: pa.Table) -> pa.Table:
        give_back()  # what the last block left
        found = _count(unpacked(rows), rows["block"][0].as_py())
        give_back()
        kinds = [("block", pa.int64()), ("lang", pa.string()), ("gram", pa.string())]
        return found.select([c for c, _ in kinds]) if found is not None else pa.schema(kinds).empty_table()
    return table.select("block", "first", "blob").groupBy("block").applyInArrow(of, "block long, lang string, gram string")


def _symbols_of(grams: pa.Array) -> np.ndarray:
    """The hashes of n-grams that are given as strings."""
    text = grams.to_numpy(zero_copy_only=False).astype(f"<U{ORDER}")
    symbols = np.ascontiguousarray(text).view(np.uint32).reshape(-1, ORDER).astype(np.uint64)
    return mix64((symbols * _FACTORS).sum(axis=1, dtype=np.uint64)).view(np.int64)


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """``block, pos, doc_id, lang, bits, symbols`` of a block's documents from the bits of its n-grams; no bits without a model."""
    rows = unpacked(left)
    n = len(rows)
    bits, symbols, modelled = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, dtype=bool)
    lang, codes, costs = right["lang"].to_pandas().to_numpy(), _symbols_of(right["gram"].combine_chunks()), right["bits"].to_numpy()
    models = {name: (pd.Index(codes[lang == name]), costs[lang == name]) for name in set(lang)}
    for name, at, texts in _by_language(rows):
        symbols[at] = [len(t) for t in texts]
        if name not in models:
            continue
        modelled[at] = True
        index, cost = models[name]
        for of, parts in _pieces(texts):
            _, h, _, sizes = _grams(parts)
            where = index.get_indexer(h)
            if (where < 0).any():
                raise ValueError("a block's n-grams changed between two reads")
            edges = np.concatenate([[0], np.cumsum(sizes)])
            np.add.at(bits, at[np.array(of)], np.add.reduceat(cost[where], edges[:-1]))
    return pa.table({"block": pa.array(np.full(n, left["block"][0].as_py())), "pos": pa.array(np.arange(n, dtype=np.int32)), "doc_id": rows["id"].combine_chunks(),
                     "lang": rows["lang"].combine_chunks(), "bits": pa.array(bits, mask=~modelled), "symbols": pa.array(symbols)})


_SCORES = "block long, pos int, doc_id long, lang string, bits double, symbols long"


def score(table: DataFrame, counted: list[DataFrame]) -> DataFrame:
    """``block, pos, doc_id, lang, bits, symbols`` of every document of the blocks, written once."""
    grams = materialize(_block_grams(table), "block-grams")
    p = probabilities(grams, counted).select(F.col("lang").alias("p_lang"), F.col("gram").alias("p_gram"), (-F.log2("p")).alias("bits"))
    mine = grams.join(p, (F.col("lang") == F.col("p_lang")) & (F.col("gram") == F.col("p_gram"))).select(F.col("block").alias("of"), "lang", "gram", "bits")

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _score(left, right)
        give_back()
        return found

    return materialize(table.select("block", "first", "blob").groupBy("block").cogroup(mine.groupBy("of")).applyInArrow(of, _SCORES), "scores")


def smoothed(mean: Column) -> Column:
    """Bits per symbol with the prior's symbols."""
    return (F.col("bits") + PRIOR_SYMBOLS * mean) / (F.col("symbols") + PRIOR_SYMBOLS)


def thresholds(scored: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """Per language ``of, mean, limit`` in bits per symbol, from its held-out trusted documents."""
    held = (scored.filter((F.col("symbols") > 0) & F.col("bits").isNotNull() & _held_out(F.col("doc_id")))
            .join(trusted_ids(labels).hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi").select("lang", "bits", "symbols"))
    held = materialize(held, "held-out")
    mean = materialize(held.groupBy(F.col("lang").alias("of")).agg((F.sum("bits") / F.sum("symbols")).alias("mean"), F.count("*").alias("documents")), "means")
    q = F.percentile_approx(smoothed(F.col("mean")), [0.5, quantile], 10_000)
    each = held.join(mean, F.col("lang") == F.col("of")).groupBy("of", "mean", "documents").agg(q.alias("q"))
    return materialize(each.select("of", "mean", (F.col("q")[1] + slack * (F.col("q")[1] - F.col("q")[0]) + WIDEN / F.sqrt("documents")).alias("limit")), "limits")


def judge(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with ``model``, ``perplexity``, ``threshold`` and ``kept``; without a threshold the perplexity is the text's alone."""
    rate = F.when(F.col("symbols") > 0, F.coalesce(smoothed(F.col("mean")), F.col("bits") / F.col("symbols")))
    found = scored.join(limits, F.col("lang") == F.col("of"), "left")
    return found.select(*scored.columns, F.when(F.col("bits").isNotNull(), F.col("lang")).alias("model"), F.pow(F.lit(2.0), rate).alias("perplexity"),
                        F.pow(F.lit(2.0), F.col("limit")).alias("threshold"), F.coalesce(rate <= F.col("limit"), F.lit(True)).alias("kept"))


def verdicts(docs: DataFrame, labels: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The documents' blocks, and ``block, pos, doc_id`` with scores and ``kept`` of every document."""
    table = blocks(docs, keep)
    scored = score(table, orders(count_grams(table, labels)))
    return table, judge(scored, thresholds(scored, labels))


def _with_rows(docs: DataFrame, keep: list[str], table: DataFrame, judged: DataFrame) -> DataFrame:
    """``row`` (the kept columns) and the other columns of ``judged``, by block and place; tasks hold one row of a block at a time."""
    rest = [c for c in judged.columns if c not in ("block", "pos", "doc_id")]
    # a block's documents are bounded by its size
    found = judged.groupBy(F.col("block").alias("of")).agg(F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("found"))
    joined = table.select("block", "first", "blob").join(found, F.col("block") == F.col("of")).select("first", "blob", "found")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, blob, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                rows, wanted = pa.ipc.open_stream(blob.as_py()).read_all(), wanted.values
                pos = wanted.field("pos").to_numpy()
                a, b = np.searchsorted(pos, [first, first + len(rows)])
                if a == b:
                    continue
                some = rows.take(pa.array(pos[a:b] - first)).combine_chunks()
                row = some["row"].combine_chunks()
                columns = [some["text"].combine_chunks() if c == "text" else row.field(c) for c in keep]
                yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, names=keep), *(wanted.field(c).slice(a, b - a) for c in rest)], names=["row", *rest])

    schema = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")).schema
    for c in rest:
        schema = schema.add(judged.schema[c])
    return joined.mapInArrow(tidy(emit), schema)


def classify(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``), ``lang``, the scores and ``kept`` of every document."""
    names = docs.columns if keep is None else keep
    table, judged = verdicts(docs, labels, names)
    if names == ["doc_id"]:
        return judged.select(F.struct("doc_id").alias("row"), *[c for c in judged.columns if c not in ("block", "pos", "doc_id")])
    return _with_rows(docs, names, table, judged)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept documents, with the columns of ``docs``."""
    table, judged = verdicts(docs, labels, docs.columns)
    return _with_rows(docs, docs.columns, table, judged.filter("kept").select("block", "pos", "doc_id", "kept")).select("row.*")

"""Ranked lexical search against brute force over whole strings."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trendlens.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_all = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    holding = Counter(t for _, b in bags for t in b)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in queries.items():
        found = []
        for i, b in bags:
            m = 50 + (50 * sum(b.values()) * n_all) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * holding[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 20 * m)) for t in ts if b[t])
            if score > 0:
                found.append((score, i))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        out += [(item, rank, i, score) for rank, (score, i) in enumerate(found[:50], 1)]
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = ["the", "of", "and"] * 40 + [f"t{i}" for i in range(60)] * 3 + ["Ñandú", "Straße", "7", "été"] + [f"rare{i}" for i in range(300)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    docs = [(i, say(r.choice([0, 1, 3, 20, 20, 60]))) for i in range(900)]
    docs += [(2000, None), (2001, ""), (2002, "?!"), (None, "the rare5 rare5"), (7, docs[7][1]), (7, docs[8][1]), (2003, say(30000))] + [(3000 + i, "t1 rare7 the") for i in range(120)]
    items = [(i, say(r.choice([1, 4, 12, 40]))) for i in range(30)] + [(50, None), (51, "--"), (52, "unknown terms only zzz"), (3, "rare9"), (None, "rare7 t1"), (53, "the the of and")]
    return docs, items


@pytest.mark.parametrize("seed,span,postings,terms_", [(1, 256, 1 << 21, 1 << 20), (2, 8, 500, 60), (3, 16, 3000, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, seed, span, postings, terms_):
    monkeypatch.setattr(ls, "SPAN", span)
    monkeypatch.setattr(ls, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ls, "BLOCK_TERMS", terms_)
    docs, items = corpus(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "terms": F.lit("x")}).repartition(3)
    b = spark.createDataFrame(items, "item_id int, text string").withColumn("digest", F.lit(1))
    got = ls.search(d, b)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs, items), key=str)


def test_shard_skips_and_agrees():
    """The kernel alone, with its constants as they are, on a shard of many spans."""
    import numpy as np
    r = np.random.default_rng(4)
    n_docs, n_terms = 20_000, 40
    rate = np.where(np.arange(n_terms) < 20, 0.3, 0.002)
    has = r.random((n_docs, n_terms)) < rate
    doc, term = np.nonzero(has)
    counts = r.integers(1, 6, len(doc))
    digests = np.sort(r.integers(-2 ** 62, 2 ** 62, n_terms))
    weights = r.integers(1, 4000, n_terms)
    n = has.sum(axis=1) * 10 + 1
    block = ls.Block(None, None, None, digests, weights, n_docs, int(n.sum()))
    ids = r.permutation(n_docs).astype(np.int64)
    shard = ls.Shard(block, ids, n, np.concatenate([[0], np.cumsum(has.sum(axis=1))]), digests[term], counts)
    m = 50 + 50 * n * n_docs // int(n.sum())
    impact = np.zeros((n_docs, n_terms), np.int64)
    impact[doc, term] = weights[term] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m[doc]))
    for _ in range(40):
        q = np.sort(r.choice(n_terms, r.integers(1, 15), replace=False))
        best = ls.Best()
        shard.search(q, best)
        score = impact[:, q].sum(axis=1)
        order = np.lexsort((ids, -score))[:50]
        order = order[score[order] > 0]
        assert best.doc.tolist() == ids[order].tolist() and best.score.tolist() == score[order].tolist()


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([("q", "a")], "item_id string, text string")
    assert ls.search(d, b).collect() == [("q", 1, 1, ls.weight(1, 1) * (1_000_000_000 // (1000 + 20 * 100)))] if ls.weight(1, 1) else True
    assert ls.search(d.limit(0), b).collect() == []
    assert ls.search(d, b.limit(0)).collect() == []

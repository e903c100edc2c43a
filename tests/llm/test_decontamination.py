"""Benchmark decontamination against brute force over words."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendlens.llm import decontamination as leaks
from trendlens.llm.terms import WORDS, terms_of

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        iw = words(body)
        k = min(10, len(iw))
        wins = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i:i + k]) in wins:
                hit |= set(range(i, i + k))
                found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def corpus():
    r = random.Random(3)
    vocab = ["the", "of", "a", "in", "ñandú", "Straße", "x1", "42", "É", "Über"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, say(r.choice([10, 12, 25]))) for i in range(20)]
    items += [(100, "Short one"), (101, "a"), (102, "!!"), (103, None), (104, ""), (7, "the same id, other words: x1 x1 x1 x1 x1 x1 x1 x1"),
              (None, "an item without id has these ten words or more here"), (105, items[0][1]), (106, "of of of of of of of of of")]
    docs = []
    for i in range(120):
        parts = [say(r.randrange(30))]
        for _ in range(r.randrange(3)):
            body = words(r.choice(items)[1] or "")
            a = r.randrange(max(1, len(body) - 3))
            parts += [", ".join(body[a:a + r.choice([4, 9, 10, 11, 30])]).upper(), say(r.randrange(8))]
        docs.append((i, "\n".join(parts)))
    docs += [(200, None), (201, ""), (202, "... !"), (None, items[3][1]), (203, items[4][1]), (203, items[4][1]), (203, "another text of this id"),
             (204, say(60000) + " " + items[5][1] + " " + say(20)), (205, "of " * 30), (206, "x\x00" + items[6][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"start": F.lit(1), "words": F.lit("x"), "item_id": F.lit(2)}).repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted(map(tuple, leaks.digest(leaks.contamination(d, b)).collect()), key=str)
    assert got == sorted([(i, *brute(t, items)) for i, t in docs], key=str)
    assert sum(r[-1] for r in got) > 40


def test_places_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "zero one two three four five six seven eight nine ten")], "doc_id long, text string")
    b = spark.createDataFrame([("q", "One two three, four five six seven eight nine ten!")], "item_id string, text string")
    assert leaks.contaminated_places(d, b).collect() == [(1, 1, 10, "q")]
    assert leaks.contamination(d, b.limit(0)).collect() == [(1, 11, 0, [])]
    assert leaks.contamination(d.limit(0), b).collect() == []


def test_every_shared_window_keeps_the_same_run():
    r = np.random.default_rng(1)
    for _ in range(50):
        shared = " ".join(r.choice(list("abcd"), 10))
        kept = []
        for _ in range(2):
            before = " ".join(r.choice(list("abcd"), r.integers(0, 9)))
            t = next(terms_of(pa.array([f"{before} {shared} {' '.join(r.choice(list('abcd'), 5))}"]), WORDS))
            at = len(before.split())
            least, place = leaks.kept_hashes(t)
            kept.append((least[at], place[at] - at))
        assert kept[0] == kept[1]


@pytest.mark.parametrize("bits", [1 << 12, 1 << 25])
def test_filter_lets_no_fingerprint_down(spark, monkeypatch, bits):
    monkeypatch.setattr(leaks, "BITS_EACH", bits // 64)
    windows = leaks.item_windows(spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(200)))], "item_id long, text string"))
    prints = np.array([r[0] for r in windows.select("fingerprint").collect()], dtype=np.int64).view(np.uint64)
    bitmap = leaks._bitmaps(windows)[10]
    assert leaks._passes(prints, bitmap).all()
    assert leaks._passes(np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), bitmap).mean() < 0.1

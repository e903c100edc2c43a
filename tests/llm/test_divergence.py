"""Source divergence against brute force over whole strings."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trendlens.llm import divergence as audit

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs):
    counts, total, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        total[lang].update(terms)
        seen[lang].update(set(terms))
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= 10]

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        q, p = shares(total[lang]), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(-f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(found, 1) if part == "pair" or i <= 10]
    return sorted(out)


def corpus():
    r = random.Random(5)
    vocab = [f"{a}{b}" for a in ("Ax", "ñu", "Øre", "be", "日本") for b in "abcdefghijkl"]
    docs = []
    for i in range(300):
        s = r.choice(["s0"] * 5 + ["s1", "s2", None, "ß"])
        own = vocab[len(s or "") * 7:][:30]
        docs.append((" ".join(r.choice(own) + r.choice([" ", "7", "-", ", "]) for _ in range(r.randrange(40))), r.choice(["en", "en", "de", None]), s))
    docs += [(None, "en", "empty"), ("", "de", "empty"), ("12 34", "xx", "a"), ("few words", "xx", "b"), ("only one", "yy", "lone"), (" ".join(vocab * 300), "en", "s1")]
    return docs + docs[:20]


@pytest.mark.parametrize("bits", [64, 5, 1])
def test_equals_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(audit, "HELD", 100)
    monkeypatch.setattr(audit, "BLOCK", 50)
    docs = corpus()
    df = spark.createDataFrame(docs, "text string, lang string, source string").withColumns({"term": F.lit("x"), "digest": F.lit(1), "n": F.lit(1)}).repartition(4)
    assert sorted(map(tuple, audit.divergence(df, bits).collect())) == brute(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert audit.divergence(df).collect() == []


def test_share_is_exact_for_large_counts(spark):
    n = 40_000_000_000
    got = spark.createDataFrame([(n, 3 * n, 7)], "n long, total long, terms long").select(audit.share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 2) // (3 * n + 14)

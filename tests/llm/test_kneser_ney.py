"""The quality classifier: its n-grams, model, scores, thresholds and verdicts against plain Python."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendlens.llm import kneser_ney as kn
from trendlens.llm.blocks import blocks, positions, unpacked

ORDER = kn.ORDER


def ngrams(text):
    s = "\n" * (ORDER - 1) + (text or "").replace("\0", "�")
    return [s[i:i + ORDER] for i in range(len(s) - ORDER + 1)]


def brute_model(texts):
    """p(n-gram's last symbol | those before), over plain dictionaries."""
    counts = {ORDER: Counter(g for t in texts for g in ngrams(t))}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = [sum(v == i for v in c.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        d = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else 0.5 * i for i in (1, 2, 3)]
        return [0.0] + [max(0.05, min(i - 0.05, x)) for i, x in enumerate(d, 1)]

    cut = {k: discounts(c) for k, c in counts.items()}
    total, back = defaultdict(int), defaultdict(float)
    for k, c in counts.items():
        for g, n in c.items():
            total[k, g[:-1]] += n
            back[k, g[:-1]] += cut[k][min(n, 3)]

    def p(g, k=ORDER):
        if not k:
            return 1 / (len(counts[1]) + 1)
        g = g[-k:]
        lower = p(g, k - 1)
        if (k, g[:-1]) not in total:
            return lower
        n = counts[k][g]
        return ((n - cut[k][min(n, 3)] if n else 0) + back[k, g[:-1]] * lower) / total[k, g[:-1]]
    return p


def sample(n, seed, words="the of and Lorem ipsum dolor sit amet é über 42 x-y,".split()):
    r = random.Random(seed)
    return [" ".join(r.choices(words, k=r.randint(1, 30))) + "." for _ in range(n)]


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_ngrams_equal_brute_force(monkeypatch, piece):
    monkeypatch.setattr(kn, "PIECE", piece)
    texts = ["", "a", "AB c", "É日\n9!", *sample(20, 1), "\U0001f600 Z", "nul\0nul"]
    tally, sizes = kn.Tally(), Counter()
    for rows, parts in kn._pieces(texts):
        tally.add(parts)
        for r, n in zip(rows, kn._grams(parts)[3].tolist(), strict=True):
            sizes[r] += n
    grams, n = tally.result()
    assert dict(zip(grams.to_pylist(), n.tolist(), strict=True)) == Counter(g for t in texts for g in ngrams(t))
    assert [sizes[i] for i in range(len(texts))] == [len(t) for t in texts]


@pytest.mark.parametrize("size", [1, 40])
def test_model_equals_brute_force(spark, size):
    texts = sample(size, 2)
    counts = spark.createDataFrame([("xx", g, n) for g, n in Counter(g for t in texts for g in ngrams(t)).items()], "lang string, gram string, n long")
    p = brute_model(texts)
    known = sorted({c for t in texts for c in t})
    want = {g for t in texts for g in ngrams(t)} | {g[-ORDER:] for g in ("\n\n\n\nZ", "日本語です", "the o", "\n\n\n\n\n")}
    contexts = {g[:-1] for g in want}
    want |= {c + x for c in sorted(contexts)[:60] for x in [*known, "☃"]}
    grams = spark.createDataFrame([("xx", g) for g in want] + [("other", "abcde"[:ORDER])], "lang string, gram string")
    got = {(r.lang, r.gram): r.p for r in kn.probabilities(grams, kn.orders(counts)).collect()}
    assert set(got) == {("xx", g) for g in want}
    for g in want:
        assert math.isclose(got["xx", g], p(g), rel_tol=1e-9)
    for c in sorted(contexts)[:60]:  # the known symbols and one unknown make up everything
        assert math.isclose(sum(got["xx", c + x] for x in [*known, "☃"]), 1.0, rel_tol=1e-9)


@pytest.fixture(scope="module")
def corpus():
    good = sample(600, 3)
    bad = ["".join(random.Random(i).choices("zqxj#*%$!~^", k=200)) for i in range(60)]
    rows = [(i, t, "en" if i % 3 else None) for i, t in enumerate(good)] + [(10_000 + i, t, "en") for i, t in enumerate(bad)]
    labels = [(i, 1, 0) for i in range(300)] + [(10_000 + i, 0, 0) for i in range(20)] + [(None, 1, 0), (5, 1, 0), (6, 0, 0), (7, None, None)]
    return rows, labels


def test_bad_text_goes_and_clean_text_stays(spark, corpus):
    rows, labels = corpus
    extra = [(20_000, None, "en"), (20_001, "", "en"), (None, "the of and", "de"), (20_002, "the of and " * 20_000, "en"), (3, rows[3][1], rows[3][2])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows + extra], "doc_id long, text string, lang string, kept int, model string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judged = kn.classify(docs, lab, keep=["doc_id", "text"]).collect()
    assert len(judged) == len(rows) + len(extra)
    good = [r for r in judged if r.row.doc_id is not None and r.row.doc_id < 10_000]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert not any(r.kept for r in judged if r.row.doc_id is not None and 10_000 <= r.row.doc_id < 20_000)
    by = {r.row.doc_id: r for r in judged}
    assert by[20_000].kept and by[20_001].kept and by[20_000].perplexity is None and by[20_002].symbols == 220_000
    assert by[20_000].row.text is None and by[20_002].row.text == "the of and " * 20_000
    kept = kn.keep_good(docs, lab)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.select("doc_id", "text", "model").collect()), key=str) == sorted(((r.row.doc_id, r.row.text, "x") for r in judged if r.kept), key=str)


def test_scores_thresholds_and_verdicts_equal_brute_force(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    hashed = {r[0]: r[1] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(kn.HELD_OUT)) == 0).collect()}
    trusted = set(range(300)) - {6, 7}
    by_lang = defaultdict(list)
    for i, t, lang in rows:
        by_lang[lang or ""].append((i, t))
    want = {}
    for lang, of in by_lang.items():
        p = brute_model([t for i, t in of if i in trusted and not hashed[i]])
        bits = {i: -sum(math.log2(p(g)) for g in ngrams(t)) for i, t in of}
        held = [(bits[i], len(t)) for i, t in of if i in trusted and hashed[i]]
        mean = sum(b for b, _ in held) / sum(n for _, n in held)
        rate = {i: (bits[i] + kn.PRIOR_SYMBOLS * mean) / (len(t) + kn.PRIOR_SYMBOLS) for i, t in of}
        q = sorted(rate[i] for i, _ in of if i in trusted and hashed[i])
        at = lambda x: q[max(0, math.ceil(x * len(q)) - 1)]
        limit = at(kn.QUANTILE) + kn.SLACK * (at(kn.QUANTILE) - at(0.5)) + kn.WIDEN / math.sqrt(len(q))
        want |= {i: (lang, 2 ** rate[i], 2 ** limit, rate[i] <= limit) for i, _ in of}
    for r in kn.classify(docs, lab, keep=["doc_id"]).collect():
        lang, perplexity, threshold, kept = want[r.row.doc_id]
        assert (r.lang, r.model, r.kept) == (lang, lang, kept)
        assert math.isclose(r.perplexity, perplexity, rel_tol=1e-9) and math.isclose(r.threshold, threshold, rel_tol=1e-9)


def test_no_labels_or_no_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:5], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept and r.perplexity is None and r.model is None for r in kn.classify(docs, none).collect())
    assert kn.classify(docs.limit(0), none).collect() == []
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert kn.classify(docs.limit(0), one).collect() == []
    assert kn.classify(docs, one).count() == 5


FOREIGN = "der die und nicht über Straße gewöhnlich vielleicht zwölf Jahre später".split()
UNLIKE = "żółć wykrzyknąć chrząszcz źdźbło gżegżółka Szczebrzeszyn pchła jaźń mgła krzywy".split()


def test_languages_are_held_to_their_own_models_and_limits(spark):
    junk = "".join(random.Random(1).choices("zqxj#*%$!~^", k=400))
    rows = [(i, t, "en") for i, t in enumerate(sample(400, 5, "the of and with some other words here to say".split()))]
    rows += [(1000 + i, t, "de") for i, t in enumerate(sample(60, 6, UNLIKE))]      # no document is trusted
    rows += [(2000 + i, t, "nl") for i, t in enumerate(sample(80, 7, FOREIGN))]
    rows += [(4000 + i, t, f"l{i}") for i, t in enumerate(sample(80, 8, FOREIGN))]  # many languages of one trusted document
    rows += [(3000, junk, "nl"), (3001, junk, "en"), (3002, junk, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(300), *range(2000, 2040), *range(4000, 4080)]], "doc_id long, quality int, toxic int")
    by = {r.row.doc_id: r for r in kn.classify(docs, labels, keep=["doc_id"]).collect()}
    assert len(by) == len(rows)
    assert all(r.kept and r.threshold is None and r.perplexity is None and r.model is None for r in by.values() if r.lang == "de")
    assert sum(by[i].kept for i in range(2000, 2080)) >= 78 and not by[3000].kept and not by[3001].kept
    assert len({r.threshold for r in by.values() if r.lang == "nl"}) == 1
    assert all(by[i].kept for i in range(4000, 4080))


def test_blocks_give_their_rows_back(spark):
    rows = [(i, f"text {i}" * (i % 7), None if i % 5 else "en", float(i)) for i in range(500)] + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, x double").repartition(3)
    table = blocks(docs, docs.columns, size=1000, row_size=300)
    by_block = {}
    for r in table.collect():
        by_block.setdefault(r.block, []).append({"first": r.first, "blob": bytes(r.blob), "ids": r.ids})
    found = {b: unpacked(pa.Table.from_pylist(rows)).to_pylist() for b, rows in by_block.items()}
    assert table.count() > len(by_block) > 6
    assert sorted(((x["id"], x["text"], x["row"]["lang"], x["row"]["x"]) for rows_ in found.values() for x in rows_), key=str) == sorted(rows, key=str)
    assert all(found[r.block][r.pos]["id"] == r.doc_id for r in positions(table).collect()) and positions(table).count() == len(rows)

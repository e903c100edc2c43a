import random

import numpy as np
import pytest

from test_fingerprints import shingle_set
from trendlens.llm import ngram_join as nj
from trendlens.llm.components import components


def brute(rows):
    """Component id and set size of every row, from all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(i)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(i, len(s), least[find(k)] if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


def family(n, seed):
    """Texts of several sizes, each with copies and copies of copies edited more and more, and shared passages."""
    r = random.Random(seed)
    word = lambda: "w%d" % r.randrange(2000)
    passage = " ".join(word() for _ in range(30))
    out = []
    while len(out) < n:
        base = [word() for _ in range(r.choice([3, 4, 5, 6, 8, 12, 30, 80, 200]))]
        if r.random() < 0.3:
            base += passage.split()
        out.append(" ".join(base))
        copy = list(base)
        for _ in range(r.randrange(5)):
            for _ in range(max(1, len(copy) // 90)):
                k = r.randrange(len(copy))
                copy[k:k + r.randrange(3)] = [word()] * r.randrange(1, 3)
            out.append(" ".join(copy) if r.random() < 0.8 else " ".join(copy).upper())
    r.shuffle(out)
    return out[:n]


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)


@pytest.mark.parametrize("frequent", [8, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(family(260, seed))]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n int, key string").repartition(6)
    assert sorted(map(tuple, nj.jaccard_classes(df).collect()), key=key) == sorted(brute(rows), key=key)


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three four five"), (8, "One two three four FIVE"),
         (9, "x " * 20_000), (10, "x x x x x x"), (None, "one two"), (None, "no id at all"), (11, "same id text"), (11, "same id text"), (11, "other text of that id")]


@pytest.mark.parametrize("rows", [EDGES, [(1, "only one")], [(3, None)], []])
def test_edges(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, nj.jaccard_classes(df).collect()), key=key) == sorted(brute(rows), key=key)


def test_one_of_each_stays(spark):
    rows = [(i, t) for i, t in enumerate(family(80, 5))]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, best string").repartition(4)
    kept = nj.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for i, n, c in brute(rows)})
    got = sorted([tuple(r) for r in nj.keep_one_of_each(spark.createDataFrame(EDGES, "doc_id long, text string")).collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    assert got == [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (6, "one two"), (7, "one two three four five"), (9, "x " * 20_000),
                   (11, "other text of that id"), (11, "same id text"), (None, "no id at all")]


def test_bound_is_above_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(300):
        pool = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
        a = np.sort(rng.choice(pool, rng.integers(1, 300), replace=False))
        b = np.sort(np.unique(np.concatenate([rng.choice(a, rng.integers(1, len(a) + 1), replace=False), rng.choice(pool, rng.integers(1, 60), replace=False)])))
        overlap = len(np.intersect1d(a, b))
        assert nj.overlap_bound(nj._bitmap(a), len(a), nj._bitmap(b), len(b)) >= overlap
        assert nj._arrays_link(a.tobytes(), len(a), b.tobytes(), len(b)) == (100 * overlap >= 75 * len(np.union1d(a, b)))


def test_large_group_of_near_copies_is_one_class(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:i % 100] + [f"edit{i}"] + base[i % 100:])) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = nj.jaccard_classes(df).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 1500


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 102), (5, 5), (7, 3)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_sets_of_one_template_do_not_meet(spark, monkeypatch):
    # 60 of 71 shingles are shared: similarity below 0.75, so there is no link, and pairs would be quadratic.
    made = []
    verified = nj._verified
    monkeypatch.setattr(nj, "_verified", lambda d, pairs, name: made.append(pairs.count()) or verified(d, pairs, name))
    template = [f"t{i}" for i in range(64)]
    rows = [(i, " ".join(template + [f"own{i}x{j}" for j in range(11)])) for i in range(5000)]
    got = nj.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(r.component_id for r in got) == list(range(5000))
    assert sum(made) <= 5000


@pytest.mark.parametrize("part", [1 << 13, 4])
def test_links_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(nj, "PART", part)
    rows = [(i, t) for i, t in enumerate(family(160, 9))] + [(500, None), (501, "a b"), (502, "A b")]
    rows += [(600 + i, " ".join([f"z{j}" for j in range(90)] + [f"e{i}"])) for i in range(40)]
    sets = [shingle_set(t) for _, t in rows]
    want = {i: sum(k != j and bool(sets[j]) and 100 * len(sets[k] & sets[j]) >= 75 * len(sets[k] | sets[j]) for j in range(len(rows))) if sets[k] else 0
            for k, (i, _) in enumerate(rows)}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.n_links for r in nj.link_counts(df).collect()} == want
    assert sorted(map(tuple, nj.jaccard_classes(df).collect()), key=key) == sorted(brute(rows), key=key)

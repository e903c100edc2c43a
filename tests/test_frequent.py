"""The bounded table of frequent names: bounds hold for every name, however the rows are dealt."""

import random
from collections import Counter

import pytest

from trendlens.operators import frequent
from trendlens.operators.frequent import frequent_names


@pytest.mark.parametrize("seed,counters,parts", [(1, 10, 1), (2, 10, 7), (3, 3, 70), (4, 500, 4)])
def test_bounds_hold(spark, seed, counters, parts):
    r = random.Random(seed)
    names = [f"n{min(int(r.paretovariate(0.8)), 400)}" for _ in range(6000)] + [None] * 50
    df = spark.createDataFrame([(x,) for x in names], "name string").repartition(parts)
    got = {x["name"]: (x["count"], x["bound"]) for x in frequent_names(df, counters).collect()}
    true = Counter(x for x in names if x)
    bound = next(iter(got.values()))[1]
    assert len(got) <= counters and bound <= 6000 // (counters + 1)
    for name, n in true.items():
        low = got.get(name, (0, bound))[0]
        assert low <= n <= low + bound
    assert all(n <= 6000 // (counters + 1) for name, n in true.items() if name not in got)
    if counters == 500:
        assert {k: v[0] for k, v in got.items()} == dict(true) and bound == 0


def test_summaries_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(frequent, "FAN", 2)
    df = spark.createDataFrame([("a",)] * 900 + [(f"x{i}",) for i in range(300)], "name string").repartition(9)
    got = {x["name"]: (x["count"], x["bound"]) for x in frequent_names(df, 4).collect()}
    assert got["a"][0] <= 900 <= sum(got["a"]) and got["a"][1] <= 1200 // 5


def test_empty(spark):
    assert frequent_names(spark.createDataFrame([], "name string"), 4).collect() == []

"""Property tests for the daily top-k and the top-N deltas."""

import datetime as dt
from collections import Counter
from functools import reduce

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from trendlens.operators.clean import clean_mentions
from trendlens.operators.daily import daily_counts, top_k_daily
from trendlens.operators.topn import fold_changelog, top_n, top_n_delta

DAYS = [dt.date(2015, 2, 18), dt.date(2015, 2, 19)]
NAMES = ["A", "B", "C", "D", "E", "F", "G"]

mentions_st = st.lists(st.tuples(st.integers(0, 12), st.sampled_from(DAYS), st.sampled_from(NAMES)),
                       min_size=1, max_size=80)


def mentions_df(spark, rows, parts):
    df = spark.createDataFrame(rows, "record_id int, day date, name string")
    return df.repartition(parts)


def brute_counts(rows):
    # One count per (record, name); a record lives on one day.
    day_of = {}
    for rid, day, _ in rows:
        day_of.setdefault(rid, day)
    pairs = {(rid, name) for rid, _, name in rows}
    return Counter((day_of[rid], name) for rid, name in pairs)


@settings(max_examples=6, deadline=None)
@given(mentions_st, st.integers(1, 5), st.integers(1, 4))
def test_daily_topk_properties(spark, rows, parts, k):
    # A record keeps the day of its first row, as the record source does.
    first_day = {}
    rows = [(rid, first_day.setdefault(rid, day), name) for rid, day, name in rows]
    names = clean_mentions(mentions_df(spark, rows, parts), per_record="distinct")
    counts = daily_counts(names, "day")
    got = {(r["day"], r["name"]): r["count"] for r in counts.collect()}
    # Shuffling the input (any partitioning) leaves the daily counts unchanged.
    assert got == dict(brute_counts(rows))
    ranked = {(r["day"], r["name"]) for r in top_k_daily(counts, k, "rank", "day").collect()}
    exact = top_k_daily(counts, k, "row_number", "day").collect()
    # ties="rank" ⊇ ties="row_number"; row_number keeps at most k per day.
    assert {(r["day"], r["name"]) for r in exact} <= ranked
    per_day = Counter(r["day"] for r in exact)
    assert all(v <= k for v in per_day.values())
    # rank keeps exactly the names whose count reaches the day's k-th largest count.
    for day in {d for d, _ in got}:
        cs = sorted((c for (d, _), c in got.items() if d == day), reverse=True)
        kth = cs[min(k, len(cs)) - 1]
        assert {n for (d, n) in ranked if d == day} == {n for (d, n), c in got.items() if d == day and c >= kth}


hist_st = st.lists(st.dictionaries(st.sampled_from(NAMES), st.integers(1, 9), max_size=len(NAMES)),
                   min_size=1, max_size=4)


@settings(max_examples=6, deadline=None)
@given(hist_st, st.integers(1, 4))
def test_applying_all_deltas_gives_the_last_top_n(spark, hists, n):
    schema = "name string, count bigint"
    tops = [top_n(spark.createDataFrame(sorted(h.items()), schema), n) for h in hists]
    empty = spark.createDataFrame([], schema)
    deltas = [top_n_delta(prev, cur).withColumn("batch", F.lit(i))
              for i, (prev, cur) in enumerate(zip([empty] + tops[:-1], tops))]
    folded = fold_changelog(reduce(lambda a, b: a.unionByName(b), deltas), order_cols=("batch",))
    assert sorted(tuple(r) for r in folded.collect()) == sorted(tuple(r) for r in tops[-1].collect())

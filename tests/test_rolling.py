"""Rolling-horizon counts (W4, T7) and the skew-safe running sum, against brute force."""

import datetime as dt
import random

import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from trendlens.operators.prefix import running_sum
from trendlens.operators.rolling import HOUR_US, rolling_changelog, rolling_counts, sliding_counts
from trendlens.operators.topn import fold_changelog

T0 = dt.datetime(2024, 1, 1)


def mentions_df(spark, rows):
    pdf = pd.DataFrame(rows, columns=["id", "name", "ts"])
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def brute_counts(rows, h):
    out = {}
    for i, n, t in rows:
        out[i] = sum(1 for _, n2, t2 in rows if n2 == n and t - h < t2 <= t)
    return out


def brute_changelog(rows, h):
    deltas = {}
    for _, n, t in rows:
        deltas[(n, t)] = deltas.get((n, t), 0) + 1
        deltas[(n, t + h)] = deltas.get((n, t + h), 0) - 1
    out, run = {}, {}
    for (n, t) in sorted(deltas):
        run[n] = run.get(n, 0) + deltas[(n, t)]
        if deltas[(n, t)] != 0:
            out[(n, t)] = run[n]
    return out


def test_hot_name_over_many_partitions(spark):
    rnd = random.Random(7)
    h = dt.timedelta(minutes=30)
    rows = []
    for i in range(3000):
        # One name holds ~60 % of the mentions; many share exact timestamps.
        name = "hot" if rnd.random() < 0.6 else f"n{rnd.randint(0, 40)}"
        rows.append((i, name, T0 + dt.timedelta(seconds=rnd.randint(0, 6 * 3600) // 7 * 7)))
    df = mentions_df(spark, rows)
    got = {r["id"]: r["count"] for r in rolling_counts(df, h, partitions=16).collect()}
    assert got == brute_counts(rows, h)
    cl = {(r["name"], r["ts"]): r["count"] for r in rolling_changelog(df, h, partitions=16).collect()}
    assert cl == brute_changelog(rows, h)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "a|b"]), st.integers(0, 400)), min_size=1, max_size=60),
       st.integers(1, 9))
def test_rolling_properties(spark, pairs, parts):
    h = dt.timedelta(seconds=60)
    rows = [(i, n, T0 + dt.timedelta(seconds=s)) for i, (n, s) in enumerate(pairs)]
    df = mentions_df(spark, rows)
    cl = rolling_changelog(df, h, partitions=parts).collect()
    assert {(r["name"], r["ts"]): r["count"] for r in cl} == brute_changelog(rows, h)
    assert min(r["count"] for r in cl) >= 0                      # never negative
    last = fold_changelog(spark.createDataFrame(cl), order_cols=("ts",), keep_zero=True).collect()
    assert all(r["count"] == 0 for r in last)                    # all expire in the end


def test_f12_horizon_one_vs_two_hours(spark):
    rows = [(0, "a", T0), (1, "a", T0 + dt.timedelta(minutes=90))]
    df = mentions_df(spark, rows)
    one = {r["id"]: r["count"] for r in rolling_counts(df, HOUR_US).collect()}
    two = {r["id"]: r["count"] for r in rolling_counts(df, 2 * HOUR_US).collect()}
    assert one[1] == 1 and two[1] == 2


def test_f18_exactly_one_horizon_apart(spark):
    rows = [(0, "a", T0), (1, "a", T0 + dt.timedelta(hours=1))]
    got = {r["id"]: r["count"] for r in rolling_counts(mentions_df(spark, rows), HOUR_US).collect()}
    assert got == {0: 1, 1: 1}


def test_f13_f14_changelog_rows(spark):
    rows = [(0, "a", T0), (1, "b", T0 + dt.timedelta(minutes=10)),
            (2, "b", T0 + dt.timedelta(minutes=70))]
    cl = sorted((r["ts"], r["name"], r["count"]) for r in
                rolling_changelog(mentions_df(spark, rows), HOUR_US).collect())
    # b: −1 at 70 (from 10) and +1 at 70 cancel, so no row then (F13); each
    # name's count reaching 0 is emitted once.
    assert cl == [(T0, "a", 1), (T0 + dt.timedelta(minutes=10), "b", 1),
                  (T0 + dt.timedelta(minutes=60), "a", 0), (T0 + dt.timedelta(minutes=130), "b", 0)]


def test_f16_one_global_count(spark):
    rows = [(i, "a", T0 + dt.timedelta(seconds=i)) for i in range(20)]
    df = mentions_df(spark, rows).repartition(5)
    got = rolling_counts(df, HOUR_US, partitions=4).agg(F.max("count")).first()[0]
    assert got == 20


def test_running_sum_matches_cumsum(spark):
    rnd = random.Random(3)
    pdf = pd.DataFrame({"g": [rnd.choice("xyz") for _ in range(500)], "o": range(500),
                        "v": [rnd.randint(-3, 5) for _ in range(500)]})
    out = running_sum(spark.createDataFrame(pdf), "g", "o", "v", partitions=7).toPandas()
    pdf["exp"] = pdf.sort_values("o").groupby("g")["v"].cumsum()
    m = out.merge(pdf, on=["g", "o"])
    assert len(m) == 500 and (m["running"] == m["exp"]).all()


def test_sliding_counts_cover_each_mention_four_times(spark):
    rows = [(0, "a", T0 + dt.timedelta(minutes=7))]
    got = sliding_counts(mentions_df(spark, rows), "1 hour", "15 minutes").collect()
    assert len(got) == 4 and all(r["count"] == 1 for r in got)


def test_null_names_and_times(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(1, None, t), (2, None, t + dt.timedelta(minutes=10)), (3, "a", t), (4, "a", None), (5, None, t + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, "id int, name string, ts timestamp_ntz").repartition(3)
    got = {r["id"]: r["count"] for r in rolling_counts(df, 3_600_000_000).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 5: 1}
    changes = sorted((r["name"] or "", r["ts"], r["count"]) for r in rolling_changelog(df, 3_600_000_000).collect())
    assert [c for n, _, c in changes if n == ""] == [1, 2, 1, 0, 1, 0]


def test_many_range_partitions_with_a_null_group(spark):
    from trendlens.operators.prefix import running_sum
    rows = [(g, i, 1) for g in (None, "a", "b") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r["g"], r["o"]): r["running"] for r in running_sum(df, "g", "o", "v", partitions=17).collect()}
    assert got == {(g, i): i + 1 for g, i, _ in rows}

"""Running sums that carry their rows: against brute force, over partitions, batches and open units."""

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendlens.operators import carried
from trendlens.operators.carried import carried_sums
from trendlens.operators.rolling import rolling_counts
from trendlens.operators.timegrid import spread_event_time


def rows_of(seed, n=900):
    r = random.Random(seed)
    hot = ["hot"] * 6 + [None, "a", "b"] + [f"n{i}" for i in range(20)]
    return [(i, r.choice(hot), r.choice([5, 5, 5, r.randrange(60)]), r.choice([1, 1, -1, 3])) for i in range(n)]


def brute(rows, whole):
    out = {}
    for i, g, o, _ in rows:
        out[i] = sum(v for _, h, p, v in rows if h == g and (whole or p <= o))
    return out


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_sums_equal_brute_force(spark, whole, partitions):
    rows = rows_of(partitions)
    df = spark.createDataFrame(rows, "id long, g string, o int, v int").repartition(5)
    got = carried_sums(df, ["id", "v"], F.col("g"), F.col("o"), F.col("v"), whole_groups=whole, spread=F.col("id"), partitions=partitions)
    assert got.columns == ["id", "v", "_cs_cum", "_cs_end"]
    assert {r["id"]: r["_cs_end"] for r in got.collect()} == brute(rows, whole)


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("wait", [0, 3, 10_000])
@pytest.mark.parametrize("batch", [1, 7, 5000])
def test_one_partition_in_batches(whole, wait, batch):
    rows = sorted(rows_of(7, 300), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
    schema = pa.schema([("id", pa.int64()), (carried._G, pa.string()), (carried._O, pa.int64()), (carried._V, pa.int64()), (carried._KEEP, pa.bool_()), ("_cs_at", pa.int32())])
    table = pa.Table.from_pylist([{"id": i, carried._G: g, carried._O: o, carried._V: v, carried._KEEP: v > 0, "_cs_at": 4} for i, g, o, v in rows], schema=schema)
    out = [x for b in carried._kernel(["id", carried._G, carried._O], whole, wait)(table.to_batches(max_chunksize=batch)) for x in b.to_pylist()]
    want = brute(rows, whole)
    ends = {(x[carried._G], None if whole else x[carried._O]): x["_cs_end"] for x in out if x["_cs_kind"] == carried.UNIT}
    found = {x["id"]: x["_cs_end"] if x["_cs_end"] is not None else ends[x[carried._G], None if whole else x[carried._O]] for x in out if x["_cs_kind"] == carried.ROW}
    assert found == {i: want[i] for i, _, _, v in rows if v > 0}
    groups = [x for x in out if x["_cs_kind"] == carried.GROUP]
    assert {x[carried._G] for x in groups} == {rows[0][1], rows[-1][1]}
    assert all(x["_cs_sum"] == sum(v for _, g, _, v in rows if g == x[carried._G]) for x in groups)
    units = [x for x in out if x["_cs_kind"] == carried.UNIT]
    assert len({(x[carried._G], x[carried._O]) for x in units}) == len(units)
    for x in units:
        assert x["_cs_sum"] == sum(v for _, g, o, v in rows if g == x[carried._G] and (whole or o == x[carried._O]))


def test_a_time_that_holds_most_rows_is_cut(spark):
    # one (name, time) over all partitions: every mention of it has the whole count
    t = dt.datetime(2024, 1, 1)
    rows = [(i, "hot", t) for i in range(3000)] + [(3000 + i, "hot", t + dt.timedelta(minutes=40 + i)) for i in range(30)] + [(4000, None, t), (4001, "x", None)]
    df = spark.createDataFrame(rows, "id long, name string, ts timestamp_ntz")
    got = {r["id"]: r["count"] for r in rolling_counts(df, dt.timedelta(hours=1), partitions=8).collect()}
    assert all(got[i] == 3000 for i in range(3000)) and got[4000] == 1 and 4001 not in got
    assert [got[3000 + i] for i in range(30)] == [(3000 if 40 + i < 60 else 0) + i + 1 for i in range(30)]


def test_plans_have_no_join_back(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, f"n{i % 9}", t + dt.timedelta(seconds=i)) for i in range(500)], "id long, name string, ts timestamp_ntz")
    lines = spark.createDataFrame([(f"s{i % 4}", i, 0) for i in range(100)], "seg string, line long, start long")
    for out in (rolling_counts(df, dt.timedelta(hours=1)), spread_event_time(lines, "seg", "line", "start")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_empty(spark):
    df = spark.createDataFrame([], "id long, name string, ts timestamp_ntz")
    assert rolling_counts(df, dt.timedelta(hours=1)).collect() == []

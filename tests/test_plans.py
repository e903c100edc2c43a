"""Physical plan shapes the scale design relies on (checked on sf0.001)."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()  # a write would plan a copy of its own
    plan = plan_of(df)
    assert "isFinalPlan=true" in plan
    return plan


def test_flagship_limits_top_k_on_both_sides_of_the_day_exchange(spark):
    plan = plan_of(Q["topk_daily_json"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and ", Partial" in plan and ", Final" in plan
    # Only the needed columns are read from the fact and dimension tables.
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_dedupe_reuses_the_join_partitioning_without_broadcast(spark):
    # With tables too large to broadcast, the (record, name) dedupe needs no
    # exchange of its own: the sort-merge join on the order key provides it.
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(Q["daily_counts"](spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    exchanges = re.findall(r"Exchange (\w+)partitioning\(([^)]*)\)", plan)
    keys = sorted(k.split(",")[0].split("#")[0] for _, k in exchanges)
    # lineitem by partkey, part by partkey, lineitem⋈part by orderkey, orders
    # by orderkey, then only (day, name) for the count.
    assert keys == ["day", "l_orderkey", "l_partkey", "o_orderkey", "p_partkey"]


def test_top_n_is_a_bounded_sort(spark):
    plan = plan_of(Q["top100_users"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=100" in plan


def test_timestamp_filter_is_pushed_to_the_scan(spark):
    plan = plan_of(Q["readings_at"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), EqualTo\(ts,", plan)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_rolling_counts_have_no_window_over_names(spark):
    # The count per name is a distributed prefix sum, never a window
    # partitioned by name over the mentions (a hot name would land in one
    # task); the only window runs over ≤ 2 edge rows per range partition.
    plan = final_plan(Q["rolling_changelog_1h"](spark, SF_SMALL))
    assert not re.search(r"Window \[[^\]]*windowspecdefinition\(name", plan)


def test_top_n_delta_scans_once(spark):
    assert plan_of(Q["top_n_delta"](spark, SF_SMALL)).count("Scan parquet") == 1

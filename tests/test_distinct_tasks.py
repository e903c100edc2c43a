"""The mentions that one task makes distinct are bounded, whatever the table's size."""

from pyspark.sql import functions as F

from trendlens.operators import clean
from trendlens.plans import daily_plans

SF = "/root/testdata/sf0.001"


def test_tasks_grow_with_the_table(spark, monkeypatch):
    before = sorted(map(tuple, daily_plans._names(spark, SF).collect()))
    monkeypatch.setattr(clean, "TASK_ROWS", 100)
    names = daily_plans._names(spark, SF)
    per_task = names.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 40 and max(r["count"] for r in per_task) < 300
    assert sorted(map(tuple, names.collect())) == before


def test_no_aggregate_before_the_rows_are_dealt(spark):
    plan = daily_plans._names(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("REPARTITION_BY_NUM")  # above it: after it


def test_orders_are_not_broadcast(spark):
    for per_record in ("distinct", "mentions"):
        names = daily_plans._names(spark, SF, per_record)
        names.count()
        plan = names._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [l_orderkey" in plan


def test_tasks_for():
    assert [clean.tasks_for(n, 8) for n in (0, 1, 8_000_000, 8_000_001)] == [8, 8, 8, 9]

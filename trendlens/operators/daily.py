"""Daily counts and daily top-k (A1–A4, W1, W2, O1, O2, P10, F-17, F-18).

Plan shape (see ``explain``): partial hash aggregate per (day, name) →
exchange on (day, name) → final aggregate → partial window-group-limit
(top-k per day inside each partition) → exchange on day → final limit and
rank. A day holding a large share of all rows is spread over the first
exchange by name, and only ≤ k (+ ties) rows per day and partition reach
the second one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import RESULT_LIST_TYPE


def daily_counts(names: DataFrame, date_col: str = "DATE", name_col: str = "name") -> DataFrame:
    """Mentions per (day, name): ``groupBy.count`` with map-side combine."""
    return names.groupBy(date_col, name_col).agg(F.count(F.lit(1)).alias("count"))


def top_k_daily(counts: DataFrame, k: int = 10, ties: str = "rank", date_col: str = "DATE",
                name_col: str = "name", count_col: str = "count") -> DataFrame:
    """Keep the k most frequent names per day, with a ``rank`` column (bigint).

    ``ties="rank"`` keeps every name tied at rank ≤ k (may exceed k rows);
    ``ties="row_number"`` keeps exactly k, ties broken by name ascending.
    Catalyst turns the ``rank <= k`` filter into a window-group-limit on both
    sides of the day exchange.
    """
    if ties == "rank":
        w = Window.partitionBy(date_col).orderBy(F.col(count_col).desc())
        r = F.rank().over(w)
    elif ties == "row_number":
        w = Window.partitionBy(date_col).orderBy(F.col(count_col).desc(), F.col(name_col).asc())
        r = F.row_number().over(w)
    else:
        raise ValueError("ties must be 'rank' or 'row_number'")
    return counts.withColumn("rank", r).filter(F.col("rank") <= k) \
                 .withColumn("rank", F.col("rank").cast("bigint"))


def daily_lists(ranked: DataFrame, date_col: str = "DATE", name_col: str = "name",
                count_col: str = "count") -> DataFrame:
    """One row per day: ``day_list`` = list of (topic, count), count desc, then topic.

    The input is already partitioned by day (window exchange), so the
    aggregate adds no exchange; the list length is bounded by k plus ties.
    """
    items = F.sort_array(F.collect_list(F.struct((-F.col(count_col)).alias("neg"),
                                                 F.col(name_col).alias("topic"))))
    lst = F.transform(items, lambda s: F.struct(s["topic"].alias("topic"),
                                                (-s["neg"]).cast("bigint").alias("count")))
    return ranked.groupBy(date_col).agg(lst.alias("day_list"))


def to_result_schema(lists: DataFrame, date_col: str = "DATE") -> DataFrame:
    """Rename/cast to ``data date, result array<struct<topic,count>>`` (P10)."""
    return lists.select(F.col(date_col).cast("date").alias("data"),
                        F.col("day_list").cast(RESULT_LIST_TYPE).alias("result"))


def result_json(results: DataFrame, keep=()) -> DataFrame:
    """``{"data": …, "result": [{"topic": …, "count": …}, …]}`` per row (F-18)."""
    return results.select(*keep, F.to_json(F.struct("data", "result")).alias("value"))


def daily_result(names: DataFrame, k: int = 10, ties: str = "rank", date_col: str = "DATE",
                 ordered: bool = True) -> DataFrame:
    """Full batch query: counts → top-k → lists → result schema (→ days ascending)."""
    out = to_result_schema(daily_lists(top_k_daily(daily_counts(names, date_col), k, ties, date_col),
                                       date_col), date_col)
    return out.orderBy("data") if ordered else out

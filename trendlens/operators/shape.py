"""Result shaping for display and messages (A7, W6, O3, K6, K7, F-21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F



def extent(df: DataFrame, count_col: str = "count", date_col: str = "data") -> DataFrame:
    """Axis domains — max count and first/last day."""
    return df.agg(F.max(count_col).alias("max_count"), F.min(date_col).alias("first_day"),
                  F.max(date_col).alias("last_day"))


def timeline_grid(results: DataFrame, k: int = 10) -> DataFrame:
    """One row per day, columns p0 … p{k-1} = topic at that list position.

    ``results`` is the daily result shape (``data``, ``result`` list sorted by
    count desc, topic). The positions come from ``getItem`` on the already
    sorted list, so no pivot shuffle is needed.
    """
    return results.select("data", *[F.get(F.col("result"), i)["topic"].alias(f"p{i}") for i in range(k)])


def sorted_histogram(hist: DataFrame, by: str = "count", ascending: bool = False,
                     name_col: str = "name", count_col: str = "count") -> DataFrame:
    """O3: order by name or count, ascending or descending (ties by name)."""
    if by not in ("name", "count"):
        raise ValueError("by must be 'name' or 'count'")
    first = F.col(count_col if by == "count" else name_col)
    first = first.asc() if ascending else first.desc()
    return hist.orderBy(first, F.col(name_col).asc())


def delta_message(changes: DataFrame, name_col: str = "name", count_col: str = "count") -> DataFrame:
    """K6/K7: one JSON array ``[{"name": …, "count": …}, …]`` of the given rows.

    Use on a bounded table (top-n deltas or the top-n snapshot): the rows are
    collected into a single message, ordered by name.
    """
    items = F.sort_array(F.collect_list(F.struct(F.col(name_col).alias("name"),
                                                 F.col(count_col).cast("bigint").alias("count"))))
    return changes.agg(F.to_json(items).alias("message")).filter(F.col("message") != "[]")


def daily_text(results: DataFrame) -> DataFrame:
    """K2/F-21: ``(yyyy-MM-dd,List((topic,count), …))`` per day, like tuple text."""
    pairs = F.transform("result", lambda s: F.format_string("(%s,%d)", s["topic"], s["count"]))
    return results.select(F.format_string("(%s,List(%s))", F.date_format("data", "yyyy-MM-dd"),
                                          F.array_join(pairs, ",")).alias("value"))

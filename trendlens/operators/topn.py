"""Top-N tables, folding of changelogs and deltas.

The reference keeps an approximate, order-dependent bounded table of 100
names (insert while not full, replace the minimum when strictly greater).
Here top-N is exact: ``orderBy(count desc, name).limit(n)``, which Spark
runs as a per-partition top-n followed by one merge of n × partitions rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def fold_changelog(changes: DataFrame, order_cols: Sequence[str] = ("batch", "seq"),
                   keep_zero: bool = False, name_col: str = "name",
                   count_col: str = "count", part_col: str = "salt") -> DataFrame:
    """Latest count per name; a 0 removes the name unless ``keep_zero``.

    ``order_cols`` say which row is latest (default: stream batch, then the
    per-name sequence). One aggregation with map-side ``max_by`` partials.
    When the changelog has a ``part_col`` column (salted histogram), the rows
    are partial counts: the latest of each (name, part) is taken, then the
    parts are summed per name.
    """
    missing = [c for c in order_cols if c not in changes.columns]
    if missing:
        raise ValueError(f"the changelog has no {', '.join(missing)} to order its rows by")
    key = F.struct(*[F.col(c) for c in order_cols])
    latest = F.max_by(F.col(count_col), key)
    if part_col in changes.columns:
        parts = changes.groupBy(name_col, part_col).agg(latest.alias(count_col))
        out = parts.groupBy(name_col).agg(F.sum(count_col).cast("bigint").alias(count_col))
    else:
        out = changes.groupBy(name_col).agg(latest.alias(count_col))
    return out if keep_zero else out.filter(F.col(count_col) != 0)


def fold_increments(increments: DataFrame, name_col: str = "name",
                    inc_col: str = "increment") -> DataFrame:
    """Running total per name from +/− increments."""
    return increments.groupBy(name_col).agg(F.sum(F.col(inc_col).cast("bigint")).alias("count"))


def top_n(hist: DataFrame, n: int = 100, name_col: str = "name", count_col: str = "count") -> DataFrame:
    """Exact top-n by count, ties broken by name (deterministic)."""
    return hist.orderBy(F.col(count_col).desc(), F.col(name_col).asc()).limit(n)


def candidate_top_n(hist: DataFrame, n: int = 100, candidates: int = 1000,
                    name_col: str = "name", count_col: str = "count") -> DataFrame:
    """Top ``n`` taken from a candidate table of the top ``candidates``."""
    return top_n(top_n(hist, candidates, name_col, count_col), n, name_col, count_col)


def top_n_delta(prev: DataFrame, cur: DataFrame, name_col: str = "name",
                count_col: str = "count") -> DataFrame:
    """Rows that changed between two top-n tables; leavers get count 0.

    Both sides are bounded by n, so the full outer join is small.
    """
    p = prev.select(F.col(name_col).alias("name"), F.col(count_col).alias("_p"))
    c = cur.select(F.col(name_col).alias("name"), F.col(count_col).alias("_c"))
    j = p.join(c, "name", "full_outer")
    changed = F.col("_p").isNull() | F.col("_c").isNull() | (F.col("_p") != F.col("_c"))
    return j.filter(changed).select(F.col("name").alias(name_col),
                                    F.coalesce(F.col("_c"), F.lit(0)).cast("bigint").alias(count_col))


def lowest(hist: DataFrame, name_col: str = "name", count_col: str = "count") -> DataFrame:
    """The (name, count) with the lowest count (ties: smallest name)."""
    return hist.agg(F.min_by(F.struct(F.col(count_col), F.col(name_col)),
                             F.struct(F.col(count_col), F.col(name_col))).alias("m")) \
               .select(F.col("m")[name_col].alias(name_col), F.col("m")[count_col].alias(count_col))

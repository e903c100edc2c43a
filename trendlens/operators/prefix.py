"""Skew-safe running sums per group (the core of W3, W4 and T7).

``running_sum(df, group, order, value)`` returns, for every row, the sum of
``value`` over the rows of its group with ``order`` ≤ its own. A
``Window.partitionBy(group)`` would put a hot group into one task; here:

1. rows are range-partitioned on (group, order), so a hot group is split over
   many partitions in order;
2. each partition, sorted, computes local running sums in one pass
   (``mapInPandas``, O(1) memory) and, at its end, the partition totals of its
   first and last group — the only groups that can continue from or into a
   neighbouring partition;
3. that output is written once to the shared checkpoint folder; the carry-in
   offsets are a window over the ≤ 2·P edge rows and are joined to the local
   sums.

(group, order) must be unique: pre-aggregate duplicates first (which also
turns a hot (group, order) into one row). A null group is a group like any
other. Writing the table once makes the
rows and the edge totals agree by construction — a range partitioner's
sampled bounds may differ between two executions — and cuts lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import scratch_path


def _is(groups: pd.Series, key) -> np.ndarray:
    """Which rows are of this group; null is a group like any other."""
    return (groups.isna() if pd.isna(key) else groups == key).to_numpy()


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pid = None
    first_key, first_tot = None, 0
    carry_key, carry, begun = None, 0, False
    for pdf in batches:
        if pdf.empty:
            continue
        pid = int(pdf["pid"].iloc[0])
        cum = pdf.groupby("g", sort=False, dropna=False)["v"].cumsum()
        if begun:
            cum = cum + _is(pdf["g"], carry_key) * carry
        out = pdf.assign(cum=cum.astype("int64"), edge=False)
        if not begun:
            first_key, begun = out["g"].iloc[0], True
        is_first = _is(out["g"], first_key)
        if is_first.any():
            first_tot = int(out["cum"].to_numpy()[is_first][-1])
        carry_key, carry = out["g"].iloc[-1], int(out["cum"].iloc[-1])
        yield out[["pid", "g", "o", "v", "cum", "edge"]]
    if pid is None:
        return
    keys, tots = [first_key], [first_tot]
    if not (carry_key == first_key or (pd.isna(carry_key) and pd.isna(first_key))):
        keys.append(carry_key)
        tots.append(carry)
    edge = pd.DataFrame({"g": keys, "cum": pd.Series(tots, dtype="int64")})
    edge["pid"] = pd.Series([pid] * len(keys), dtype="int32")
    edge["o"] = None
    edge["v"] = pd.Series([0] * len(keys), dtype="int64")
    edge["edge"] = True
    yield edge[["pid", "g", "o", "v", "cum", "edge"]]


def _partition_count(df: DataFrame) -> int:
    """Range partitions for ``df``: enough for the advisory size per partition.

    AQE can coalesce small range partitions but cannot split large ones, so
    the count is sized up front from Catalyst's size estimate (no job), and
    is never below ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    target_bytes = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(target))
    try:
        est = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable: keep the default
        return base
    if est >= 1 << 60:  # Catalyst's stand-in for an unknown size
        return base
    return max(base, -(-est // max(target_bytes, 1)))


def running_sum(df: DataFrame, group_col: str, order_col: str, value_col: str,
                out_col: str = "running", partitions: int | None = None) -> DataFrame:
    """Rows ``group_col, order_col, value_col, out_col`` (one per input row).

    Runs one job eagerly (the write of the partition-local sums).
    """
    spark = df.sparkSession
    gt = df.schema[group_col].dataType
    ot = df.schema[order_col].dataType
    local_schema = T.StructType([
        T.StructField("pid", T.IntegerType()),
        T.StructField("g", gt),
        T.StructField("o", ot),
        T.StructField("v", T.LongType()),
        T.StructField("cum", T.LongType()),
        T.StructField("edge", T.BooleanType()),
    ])
    p = partitions or _partition_count(df)
    local = (df.select(F.col(group_col).alias("g"), F.col(order_col).alias("o"),
                       F.col(value_col).cast("bigint").alias("v"))
             .repartitionByRange(p, "g", "o")
             .withColumn("pid", F.spark_partition_id())
             .sortWithinPartitions("g", "o")
             .select("pid", "g", "o", "v")
             .mapInPandas(_local, local_schema))
    path = scratch_path(spark, "running-sum")
    local.write.partitionBy("edge").parquet(path)
    body = T.StructType([f for f in local_schema.fields if f.name != "edge"])
    edges = spark.read.schema(body).parquet(f"{path}/edge=true")
    rows = spark.read.schema(body).parquet(f"{path}/edge=false")
    w = Window.partitionBy("g").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (edges.select(F.col("pid").alias("_pid"), F.col("g").alias("_g"), F.sum("cum").over(w).alias("offset"))
               .filter(F.col("offset").isNotNull()))
    # two rows per partition at most; the planner measures them and chooses the join
    return (rows.join(offsets, (F.col("pid") == F.col("_pid")) & F.col("g").eqNullSafe(F.col("_g")), "left")
            .select(F.col("g").alias(group_col), F.col("o").alias(order_col),
                    F.col("v").alias(value_col),
                    (F.col("cum") + F.coalesce(F.col("offset"), F.lit(0))).alias(out_col)))

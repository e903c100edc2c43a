"""Rolling-horizon name counts: W4 (count at each mention), T7 (changelog),
and the sliding-window approximation.

Semantics: a mention at time t is counted at times x with t ≤ x < t + h,
i.e. the count at x covers the half-open range (x − h, x] (fork F18).

Scale design. A ``Window.partitionBy(name)`` would send every mention of a
hot name to one task. Instead the count is a running sum of ±1 deltas
(+1 at t, −1 at t + h) computed as a distributed prefix sum:

1. deltas are pre-aggregated per (name, time) with a map-side combine, so
   one (name, time) holding a large share of rows becomes one row;
2. the running sum per name in time order is :func:`prefix.running_sum`:
   range-partitioned, partition-local sums plus ≤ 2·P carry-in offsets, so a
   hot name is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timefns import micros_of, ntz_from_micros
from .carried import carried_sums
from .prefix import running_sum

HOUR_US = 3_600_000_000


def _horizon_us(horizon) -> int:
    if isinstance(horizon, (int, float)):
        return int(horizon)
    import datetime as dt
    if isinstance(horizon, dt.timedelta):
        return int(horizon.total_seconds() * 1_000_000)
    raise TypeError("horizon: microseconds (int) or datetime.timedelta")


def prefix_counts(mentions: DataFrame, horizon, name_col: str = "name", ts_col: str = "ts",
                  partitions: int | None = None) -> DataFrame:
    """Every (name, t) where a delta occurs: ``name, t (µs), net, count``.

    ``count`` is the number of mentions of ``name`` in (t − h, t]. Deltas are
    pre-aggregated per (name, t) (map-side), then summed in time order by the
    skew-safe :func:`~trendlens.operators.prefix.running_sum` (one eager job).
    """
    h = _horizon_us(horizon)
    us = micros_of(mentions, ts_col)
    deltas = (mentions.select(F.col(name_col).alias("name"), us.alias("t0")).filter("t0 is not null")
              .select("name", F.explode(F.array(
                  F.struct(F.col("t0").alias("t"), F.lit(1).cast("bigint").alias("d")),
                  F.struct((F.col("t0") + F.lit(h)).alias("t"), F.lit(-1).cast("bigint").alias("d")),
              )).alias("x"))
              .groupBy("name", F.col("x.t").alias("t"))
              .agg(F.sum("x.d").alias("net")))
    return running_sum(deltas, "name", "t", "net", "count", partitions)


def rolling_changelog(mentions: DataFrame, horizon, name_col: str = "name", ts_col: str = "ts",
                      partitions: int | None = None) -> DataFrame:
    """Complete changelog (T7): ``name, ts, count`` at each time the count changes.

    The batch twin of the streaming histogram; the latest row per name is its
    current count, and after the last mention + horizon every name ends at 0.
    ``ts`` is ``TIMESTAMP_NTZ`` (wall clock, UTC).
    """
    pc = prefix_counts(mentions, horizon, name_col, ts_col, partitions)
    return pc.filter(F.col("net") != 0).select(
        F.col("name"), ntz_from_micros(F.col("t")).alias("ts"), F.col("count").cast("bigint").alias("count"))


def rolling_counts(mentions: DataFrame, horizon, name_col: str = "name", ts_col: str = "ts",
                   partitions: int | None = None) -> DataFrame:
    """Every mention row with ``count`` = mentions of its name in (ts − h, ts].

    Mentions sharing (name, ts) get the same count (range-frame peers). Each
    mention goes through the running sum as +1 at t with its row, and as −1 at
    t + h without; see :mod:`carried`. Mentions without a name are counted as
    one name, those without a time have no count and are left out.
    """
    h = _horizon_us(horizon)
    m = mentions.withColumn("_t", micros_of(mentions, ts_col)).filter("_t is not null")
    step = F.explode(F.array(F.struct(F.lit(0).cast("long").alias("after"), F.lit(1).alias("d")), F.struct(F.lit(h).cast("long").alias("after"), F.lit(-1).alias("d"))))
    steps = m.withColumn("_step", step)
    comes = F.col("_step.d") == 1
    # what has left carries nothing
    rows = steps.select(*[F.when(comes, F.col(f"`{c}`")).alias(c) for c in mentions.columns], F.col(f"`{name_col}`").alias("_name"), "_t", "_step")
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in mentions.columns])
    sums = carried_sums(rows, mentions.columns, F.col("_name"), F.col("_t") + F.col("_step.after"), F.col("_step.d"), comes, spread=spread, partitions=partitions)
    return sums.withColumnRenamed("_cs_end", "count").drop("_cs_cum")


def sliding_counts(mentions: DataFrame, horizon: str = "1 hour", slide: str = "1 minute",
                   name_col: str = "name", ts_col: str = "ts") -> DataFrame:
    """Approximate variant: counts per (sliding window, name).

    ``horizon/slide`` windows are open per name; good when minute-level
    granularity suffices. Works on batch and (with a watermark) streaming.
    """
    return (mentions.groupBy(F.window(ts_col, horizon, slide).alias("window"), F.col(name_col))
            .agg(F.count(F.lit(1)).alias("count")))

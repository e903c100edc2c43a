"""Segment raster and event-time spreading (S7, S8, W3, F-10…F-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timefns import (SEGMENT_MINUTES, floor_to_interval_us, micros_of, next_boundary_us,
                                 ntz_from_micros)
from .carried import carried_sums

# Fixed value: file-name suffix of a news segment.
SEGMENT_SUFFIX = ".gkg.csv.zip"


def segment_name(bucket_us, suffix: str = SEGMENT_SUFFIX) -> "F.Column":
    """``yyyyMMddHHmm00<suffix>`` of a raster start (UTC wall clock)."""
    # date_format would read the wall clock as an instant of the session zone
    minute = F.substring(ntz_from_micros(bucket_us).cast("string"), 1, 16)
    return F.concat(F.translate(minute, "-: ", ""), F.lit("00"), F.lit(suffix))


def next_quarter(df: DataFrame, ts_col: str = "ts", minutes: int = SEGMENT_MINUTES) -> "F.Column":
    """F-11: next raster boundary strictly after the minute of ``ts``."""
    return ntz_from_micros(next_boundary_us(micros_of(df, ts_col), minutes))


def expected_segments(df: DataFrame, ts_col: str = "ts", minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """Every raster start between the first and last time of ``df``.

    The grid is generated from the two bounds with ``sequence`` (one value
    per raster step, bounded by the time span, not by the data volume).
    """
    us = micros_of(df, ts_col)
    step = minutes * 60_000_000
    b = df.agg(F.min(floor_to_interval_us(us, minutes)).alias("lo"),
               F.max(floor_to_interval_us(us, minutes)).alias("hi"))
    return b.select(F.explode(F.sequence(F.col("lo").cast("bigint"), F.col("hi").cast("bigint"),
                                         F.lit(step).cast("bigint"))).alias("bucket"))


def segment_coverage(df: DataFrame, listing: DataFrame, ts_col: str = "ts",
                     minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """S7 re-aimed: which expected segments are present in a listing.

    ``listing`` has a ``segment`` column of file names. Output: ``segment``
    and ``present``; the anti-join (``present = false``) lists the gaps.
    """
    grid = expected_segments(df, ts_col, minutes).select(segment_name(F.col("bucket")).alias("segment"))
    have = listing.select("segment").distinct().withColumn("present", F.lit(True))
    return grid.join(have, "segment", "left").select(
        "segment", F.coalesce(F.col("present"), F.lit(False)).alias("present"))


def spread_event_time(lines: DataFrame, segment_col: str, line_col: str, start_us_col: str,
                      minutes: int = SEGMENT_MINUTES, partitions: int | None = None) -> DataFrame:
    """Line i (0-based, by ``line_col``) of a segment of n lines gets
    ``start + i · ⌊interval / n⌋`` (milliseconds), as the producer did.

    Position and size come from one pass in order that carries the rows
    (:mod:`carried`), so a segment holding a large share of lines is cut over
    tasks. Output: input columns + ``event_ts`` (NTZ).
    """
    ms = minutes * 60_000
    placed = carried_sums(lines, lines.columns, F.col(segment_col), F.col(line_col), F.lit(1), whole_groups=True, partitions=partitions)
    step = F.floor(F.lit(ms) / F.col("_cs_end"))
    event_us = F.col(start_us_col) + (F.col("_cs_cum") - 1) * step * 1000
    return placed.withColumn("event_ts", ntz_from_micros(event_us)).drop("_cs_cum", "_cs_end")


def segment_window(spark, now_us: int, window: int = 60, minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """Names of the segments in the last ``window`` minutes, one interval
    behind ``now`` (60 minutes at 12:07 → 11:00, 11:15, 11:30, 11:45)."""
    step = minutes * 60_000_000
    last = (now_us // step) * step - step
    first = last + step - window * 60_000_000
    return (spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(step))).alias("b"))
            .select(segment_name(F.col("b")).alias("segment")))

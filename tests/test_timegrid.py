"""Segment raster, record ids and event-time spreading (S7, W3, F-10…F-15)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendlens.functions.timefns import first_field, ntz_micros, parse_record_id, stamp_micros
from trendlens.operators.rolling import rolling_counts
from trendlens.operators.timegrid import (next_quarter, segment_coverage, segment_name,
                                          segment_window, spread_event_time)


def test_next_quarter(spark):
    # Minute 0 → 15, 14 → 15, 15 → 30, 59 → next hour 0 (strictly later).
    rows = [(dt.datetime(2024, 1, 1, 10, m, s),) for m, s in ((0, 0), (14, 59), (15, 0), (59, 30))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(next_quarter(df, "ts")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 15), dt.datetime(2024, 1, 1, 10, 15),
                   dt.datetime(2024, 1, 1, 10, 30), dt.datetime(2024, 1, 1, 11, 0)]


def test_segment_window(spark):
    now = int(dt.datetime(2024, 1, 1, 12, 7, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    got = [r[0] for r in segment_window(spark, now, 60).collect()]
    assert got == ["20240101110000.gkg.csv.zip", "20240101111500.gkg.csv.zip",
                   "20240101113000.gkg.csv.zip", "20240101114500.gkg.csv.zip"]


def test_segment_coverage_finds_gaps(spark):
    times = [dt.datetime(2024, 1, 1, 10, 3), dt.datetime(2024, 1, 1, 10, 40), dt.datetime(2024, 1, 1, 11, 1)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    listing = spark.createDataFrame([("20240101100000.gkg.csv.zip",), ("20240101110000.gkg.csv.zip",)],
                                    "segment string")
    got = {r["segment"]: r["present"] for r in segment_coverage(df, listing).collect()}
    assert got == {"20240101100000.gkg.csv.zip": True, "20240101101500.gkg.csv.zip": False,
                   "20240101103000.gkg.csv.zip": False, "20240101104500.gkg.csv.zip": False,
                   "20240101110000.gkg.csv.zip": True}


def test_record_id_helpers(spark):
    df = spark.createDataFrame([("20150218230000-7\tx",), ("junk\ty",), ("2015-x\tz",)], "v string")
    ids = df.select(first_field("v").alias("id"))
    got = [tuple(r[0]) for r in ids.select(parse_record_id("id")).collect()]
    assert got == [(20150218230000, 7), (0, 0), (0, 0)]
    us = ids.select(stamp_micros("id")).first()[0]
    assert us == int(dt.datetime(2015, 2, 18, 23, 0, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def test_spread_event_time_batch_matches_rule(spark):
    # W3 on the batch side: positions come from the skew-safe running count.
    start = int(dt.datetime(2015, 2, 18, 23, 0, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    rows = [("s1", i, start) for i in (10, 20, 30, 40)] + [("s2", 5, start + 900_000_000)]
    df = spark.createDataFrame(rows, "seg string, line long, start long")
    got = {(r["seg"], r["line"]): r["event_ts"].strftime("%H:%M:%S")
           for r in spread_event_time(df, "seg", "line", "start").collect()}
    assert got == {("s1", 10): "23:00:00", ("s1", 20): "23:03:45", ("s1", 30): "23:07:30",
                   ("s1", 40): "23:11:15", ("s2", 5): "23:15:00"}


def test_segment_name_format(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 9, 1, 0, 15),)], "ts timestamp_ntz")
    got = df.select(segment_name(ntz_micros(F.col("ts")))).first()[0]
    assert got == "20190901001500.gkg.csv.zip"


def test_stamp_ignores_the_session_zone(spark):
    # 02:30 on 29 March 2015 doesn't exist in Amsterdam.
    df = spark.createDataFrame([("20150329023000-0",), ("2015032902",), ("20150230023000",), ("x",), (None,)], "id string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
        got = [r[0] for r in df.select(stamp_micros("id")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1427596200000000, None, None, None, None]


@pytest.fixture(params=["UTC", "Europe/Amsterdam", "America/New_York"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


#: Hours that Amsterdam skips (29 March 2015) and has twice (25 October 2015), and New York's (8 March, 1 November).
CHANGES = [dt.datetime(2015, 3, 29, 1, 45), dt.datetime(2015, 10, 25, 1, 45), dt.datetime(2015, 3, 8, 1, 45), dt.datetime(2015, 11, 1, 0, 45)]


@pytest.mark.parametrize("first", CHANGES)
def test_rolling_counts_over_a_change_of_the_clock(spark, zone, first):
    times = [first + dt.timedelta(minutes=m) for m in (0, 45, 75, 105)]
    df = spark.createDataFrame([("a", t) for t in times], "name string, ts timestamp_ntz")
    got = [r[0] for r in rolling_counts(df, dt.timedelta(hours=1)).orderBy("ts").select("count").collect()]
    assert got == [1, 2, 2, 2]


@pytest.mark.parametrize("first", CHANGES)
def test_grid_over_a_change_of_the_clock(spark, zone, first):
    times = [first + dt.timedelta(minutes=15 * i) for i in range(8)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    after = [r[0] for r in df.orderBy("ts").select(next_quarter(df, "ts")).collect()]
    assert after == [t + dt.timedelta(minutes=15) for t in times]
    rows = df.select("ts", segment_name(ntz_micros("ts")).alias("segment"))
    assert rows.orderBy("ts").collect() == [(t, t.strftime("%Y%m%d%H%M%S") + ".gkg.csv.zip") for t in times]
    assert all(r["present"] for r in segment_coverage(df, rows).collect())

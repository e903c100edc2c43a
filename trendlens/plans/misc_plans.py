"""Time grid, event-time spreading, stream volume, sliding windows, sensor filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefns import floor_to_interval_us, micros_of
from ..operators.metrics import stream_volume
from ..operators.rolling import sliding_counts
from ..operators.sensor import readings_at, readings_at_sql
from ..operators.timegrid import next_quarter, segment_coverage, segment_name, spread_event_time
from ..sources.tables import event_mentions, event_readings, table
from .catalog import register

_SQL_BUCKET = "CAST(floor(epoch_us(ts) / 900000000) AS BIGINT) * 900000000"


@register("next_quarter", f"""
SELECT event_id, make_timestamp({_SQL_BUCKET} + 900000000) AS next_quarter FROM events
""")
def q_next_quarter(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", next_quarter(ev, "ts").alias("next_quarter"))


# The listing of available segments is derived from the events: a segment is
# present when at least one event falls in its 15-minute slot.
@register("segment_coverage", f"""
WITH b AS (SELECT DISTINCT {_SQL_BUCKET} AS bucket FROM events),
g AS (SELECT unnest(generate_series((SELECT min(bucket) FROM b), (SELECT max(bucket) FROM b),
                                    900000000)) AS bucket)
SELECT strftime(make_timestamp(g.bucket), '%Y%m%d%H%M00') || '.gkg.csv.zip' AS segment,
       g.bucket IN (SELECT bucket FROM b) AS present
FROM g
""")
def q_segment_coverage(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    listing = ev.select(segment_name(floor_to_interval_us(micros_of(ev, "ts"))).alias("segment"))
    return segment_coverage(ev, listing, "ts")


@register("spread_event_time", f"""
WITH b AS (SELECT event_id, {_SQL_BUCKET} AS bucket FROM events)
SELECT event_id,
       make_timestamp(bucket + (row_number() OVER (PARTITION BY bucket ORDER BY event_id) - 1)
                      * (900000 // count(*) OVER (PARTITION BY bucket)) * 1000) AS event_ts
FROM b
""")
def q_spread_event_time(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    lines = ev.select("event_id", floor_to_interval_us(micros_of(ev, "ts")).cast("bigint").alias("bucket"))
    return spread_event_time(lines, "bucket", "event_id", "bucket").select("event_id", "event_ts")


@register("stream_volume", """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS records,
       CAST(sum(strlen(CAST(user_id AS VARCHAR)) + 8) AS BIGINT) AS bytes_out,
       CAST(sum(strlen(props)) AS BIGINT) AS bytes_in
FROM events GROUP BY 1
""")
def q_stream_volume(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("name"), "ts", "props")
    return stream_volume(ev, "1 hour", value_col="props")


@register("sliding_counts_1h", f"""
WITH e AS (SELECT event_type AS name, {_SQL_BUCKET} AS bucket FROM events)
SELECT make_timestamp(bucket - k * 900000000) AS window_start, name, count(*) AS "count"
FROM e, (SELECT unnest(generate_series(0, 3)) AS k) s
GROUP BY 1, 2
""")
def q_sliding_counts_1h(spark, sf_dir):
    m = event_mentions(spark, sf_dir, "event_type")
    return sliding_counts(m, "1 hour", "15 minutes").select(
        F.col("window.start").alias("window_start"), "name", "count")


_SQL_READINGS = """
SELECT event_type AS sensorname, ts AS "timestamp", value AS numA, event_id AS numC
FROM events WHERE ts = (SELECT min(ts) FROM events)
"""


def _first_ts(spark, sf_dir):
    # One scalar to the driver: the parameter of the equality filter.
    return table(spark, sf_dir, "events").agg(F.min("ts")).first()[0]


@register("readings_at", _SQL_READINGS)
def q_readings_at(spark, sf_dir):
    return readings_at(event_readings(spark, sf_dir), _first_ts(spark, sf_dir))


@register("readings_at_sql", _SQL_READINGS)
def q_readings_at_sql(spark, sf_dir):
    return readings_at_sql(spark, event_readings(spark, sf_dir), _first_ts(spark, sf_dir))

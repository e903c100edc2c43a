"""Streaming queries over the test tables (events as a file stream)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefns import as_event_time, micros_of, ntz_from_micros
from ..operators.rolling import sliding_counts
from ..operators.topn import fold_changelog
from ..sources.tables import table
from ..sinks.writers import publish_records
from ..sources.tables import event_records
from ..operators.metrics import observed, reject_measures, volume_measures
from ..streaming.histogram import HOUR_MS, changes_only, late_counts, rolling_histogram, salt_plan, stream_mentions
from ..streaming.state import live_histogram
from ..session import scratch_path
from ..streaming.runner import await_done, published_changelog, run_available, stream_records, stream_table_files, write_batches
from ..streaming.topn import apply_messages, join_at, read_messages, read_snapshot, read_top, snapshots, top_n_stream
from .catalog import register
from .rolling_plans import _sql_changelog

# The streaming queries read events in SLICES time-ordered parts, one
# micro-batch each, of FILES files (tasks) a part.
SLICES = 4
FILES = 4


def _histogram(mentions, hot):
    return rolling_histogram(mentions, HOUR_MS, hot=hot)


def _hot(spark, sf_dir, name_col="user_id"):
    """Names with more than their share of the table's rows, and how many state keys each gets."""
    return salt_plan(table(spark, sf_dir, "events").select(F.col(name_col).cast("string").alias("name")))


def _sliced(df, ts_col, write):
    """Write the rows in SLICES parts of equal time spans, in time order."""
    us = micros_of(df, ts_col)
    lo, hi = df.agg(F.min(us), F.max(us)).first()
    part = F.least(F.floor((us - lo) * SLICES / F.lit(hi - lo + 1)), F.lit(SLICES - 1))
    for i in range(SLICES):
        write(df.filter(part == i).repartition(FILES))


def _events_stream(spark, sf_dir):
    """``events`` as a stream of several micro-batches."""
    ev = table(spark, sf_dir, "events")
    log = scratch_path(spark, "event-log")
    _sliced(ev, "ts", lambda df: df.write.mode("append").parquet(log))
    return stream_table_files(spark, log, "*.parquet", ev.schema, FILES)


# After availableNow the watermark is the last event time (delay 0), and
# every mention whose expiry ms + 1 h is at or before it has left the count.
@register("rolling_stream_1h", """
SELECT CAST(user_id AS VARCHAR) AS name,
       CAST(count(*) FILTER (WHERE epoch_ms(ts) + 3600000 > (SELECT epoch_ms(max(ts)) FROM events))
            AS BIGINT) AS "count"
FROM events GROUP BY user_id
""")
def q_rolling_stream_1h(spark, sf_dir):
    ev = _events_stream(spark, sf_dir)
    mentions = ev.select(F.col("user_id").cast("string").alias("name"), "ts")
    changes = run_available(_histogram(mentions, _hot(spark, sf_dir)), "rolling-stream")
    return fold_changelog(changes, keep_zero=True).select("name", "count")


# Row for row the batch changelog (T7) up to the last event time, although the
# stream sees the events in several micro-batches. Its clock has milliseconds.
@register("rolling_stream_changelog_1h", f"""
SELECT name, ts, "count"
FROM ({_sql_changelog("user_id", 1).replace("FROM events", "FROM (SELECT user_id, date_trunc('milliseconds', ts) AS ts FROM events)")}) c
WHERE ts <= (SELECT max(ts) FROM events)
""")
def q_rolling_stream_changelog_1h(spark, sf_dir):
    mentions = _events_stream(spark, sf_dir).select(F.col("user_id").cast("string").alias("name"), "ts")
    changes = run_available(rolling_histogram(mentions, HOUR_MS), "stream-changelog")
    return changes.select("name", ntz_from_micros(F.unix_micros("ts")).alias("ts"), "count")


def _run_top(spark, sf_dir, n: int = 100) -> str:
    """Transformer and consumer: the published changelog is read in several micro-batches of its own."""
    mentions = _events_stream(spark, sf_dir).select(F.col("user_id").cast("string").alias("name"), "ts")
    base = scratch_path(spark, "rolling-top")
    q = write_batches(_histogram(mentions, _hot(spark, sf_dir)), f"{base}/changes", f"{base}/transformer")
    await_done(q, "rolling-changes")
    files = len(spark.read.parquet(f"{base}/changes").inputFiles())
    q = top_n_stream(published_changelog(spark, f"{base}/changes", max(1, files // 3)), f"{base}/out", f"{base}/consumer", n)
    await_done(q, "rolling-top")
    return f"{base}/out"


# The exact top-100 of the rolling histogram at the final watermark.
_SQL_TOP_STREAM = """
SELECT name, "count" FROM (
  SELECT CAST(user_id AS VARCHAR) AS name,
         CAST(count(*) FILTER (WHERE epoch_ms(ts) + 3600000 > (SELECT epoch_ms(max(ts)) FROM events))
              AS BIGINT) AS "count"
  FROM events GROUP BY user_id
) h WHERE "count" > 0 ORDER BY "count" DESC, name LIMIT 100
"""


@register("rolling_top100_stream", _SQL_TOP_STREAM)
def q_rolling_top100_stream(spark, sf_dir):
    return read_top(spark, _run_top(spark, sf_dir)).select("name", "count")


# Applying every delta message, in batch order, to an empty table gives the
# last top-100 table.
@register("rolling_top100_messages", _SQL_TOP_STREAM)
def q_rolling_top100_messages(spark, sf_dir):
    return apply_messages(read_messages(spark, _run_top(spark, sf_dir))).select("name", "count")


# The snapshot is what a reader that joins after the last batch gets (K7).
@register("rolling_top100_snapshot", _SQL_TOP_STREAM)
def q_rolling_top100_snapshot(spark, sf_dir):
    return read_snapshot(spark, _run_top(spark, sf_dir)).select("name", "count")


# The windowed approximation as a stream: 1-hour windows sliding by 15
# minutes, watermark at the last event time; append mode emits each window
# once the watermark reaches its end.
@register("sliding_stream_1h", """
WITH e AS (SELECT event_type AS name,
                  CAST(floor(epoch_us(ts) / 900000000) AS BIGINT) * 900000000 AS bucket FROM events),
c AS (
  SELECT make_timestamp(bucket - k * 900000000) AS window_start, name, count(*) AS "count"
  FROM e, (SELECT unnest(generate_series(0, 3)) AS k) s
  GROUP BY 1, 2
)
SELECT * FROM c WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)
""")
def q_sliding_stream_1h(spark, sf_dir):
    ev = _events_stream(spark, sf_dir)
    m = (ev.select(F.col("event_type").alias("name"), as_event_time(ev, "ts").alias("ts"))
         .withWatermark("ts", "0 seconds"))
    out = run_available(sliding_counts(m, "1 hour", "15 minutes"), "sliding-stream")
    start = ntz_from_micros(F.unix_micros(F.col("window.start")))  # UTC wall clock, any session zone
    return out.select(start.alias("window_start"), "name", "count")


# The whole record path: events as record lines → published log (K5) →
# record stream (S10) → mentions (T1: every mention, no noise filter) →
# salted rolling histogram → latest count per name at the final watermark.
@register("rolling_records_stream_1h", """
WITH m AS (
  SELECT 'user ' || translate(CAST(user_id AS VARCHAR), '0123456789', 'abcdefghij') AS name, ts FROM events
  UNION ALL
  SELECT event_type AS name, ts FROM events
)
SELECT name, CAST(count(*) FILTER (WHERE epoch_ms(ts) + 3600000 > (SELECT epoch_ms(max(ts)) FROM events))
                  AS BIGINT) AS "count"
FROM m GROUP BY name
""")
def q_rolling_records_stream_1h(spark, sf_dir):
    log = scratch_path(spark, "record-log")
    _sliced(event_records(spark, sf_dir), "timestamp", lambda df: publish_records(df, log))
    mentions = stream_mentions(stream_records(spark, log, max_files_per_trigger=FILES))
    hot = salt_plan(stream_mentions(spark.read.parquet(log)))
    changes = run_available(_histogram(mentions, hot), "records-stream")
    return fold_changelog(changes, keep_zero=True).select("name", "count")


# events fed out of order. Every tenth event comes a slice later; it is late if
# its time is before the watermark, the last time of all slices before (delay 0).
_LATE_EVERY = 10
_SQL_DELIVERED = f"""
b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
d AS (SELECT *, least(least((epoch_us(ts) - lo) * {SLICES} // (hi - lo + 1), {SLICES - 1}) + CASE WHEN event_id % {_LATE_EVERY} = 0 THEN 1 ELSE 0 END, {SLICES - 1}) AS slice FROM events, b),
w AS (SELECT slice, max(max(epoch_ms(ts))) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM d GROUP BY slice)
"""


def _delivered_late(spark, sf_dir):
    """``events`` as a stream of SLICES micro-batches, every tenth event one slice late."""
    ev = table(spark, sf_dir, "events")
    us = micros_of(ev, "ts")
    lo, hi = ev.agg(F.min(us), F.max(us)).first()
    slice_ = F.least(F.floor((us - lo) * SLICES / F.lit(hi - lo + 1)), F.lit(SLICES - 1)) + F.when(F.col("event_id") % _LATE_EVERY == 0, 1).otherwise(0)
    log = scratch_path(spark, "late-log")
    for i in range(SLICES):
        ev.filter(F.least(slice_, F.lit(SLICES - 1)) == i).repartition(FILES).write.mode("append").parquet(log)
    return stream_table_files(spark, log, "*.parquet", ev.schema, FILES)


@register("late_rows_stream", f"""
WITH {_SQL_DELIVERED}
SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS late FROM d JOIN w USING (slice) WHERE epoch_ms(ts) < watermark GROUP BY user_id
""")
def q_late_rows_stream(spark, sf_dir):
    mentions = _delivered_late(spark, sf_dir).select(F.col("user_id").cast("string").alias("name"), "ts")
    rows = run_available(rolling_histogram(mentions, HOUR_MS, count_late=True), "late-rows")
    return late_counts(rows, "name")


# The same stream's changes: counts of the mentions that weren't late, at the last time.
@register("late_rows_histogram", f"""
WITH {_SQL_DELIVERED}
SELECT CAST(user_id AS VARCHAR) AS name,
       CAST(count(*) FILTER (WHERE epoch_ms(ts) + 3600000 > (SELECT epoch_ms(max(ts)) FROM events)) AS BIGINT) AS "count"
FROM d JOIN w USING (slice) WHERE watermark IS NULL OR epoch_ms(ts) >= watermark GROUP BY user_id
""")
def q_late_rows_histogram(spark, sf_dir):
    mentions = _delivered_late(spark, sf_dir).select(F.col("user_id").cast("string").alias("name"), "ts")
    rows = run_available(rolling_histogram(mentions, HOUR_MS, count_late=True), "late-histogram")
    return fold_changelog(changes_only(rows), keep_zero=True).select("name", "count")


# K7/A9 from the transformer's state store, without a consumer: names that have
# live mentions at the last watermark.
@register("histogram_from_state_1h", """
SELECT name, "count" FROM (
  SELECT CAST(user_id AS VARCHAR) AS name,
         CAST(count(*) FILTER (WHERE epoch_ms(ts) + 3600000 > (SELECT epoch_ms(max(ts)) FROM events)) AS BIGINT) AS "count"
  FROM events GROUP BY user_id) h WHERE "count" > 0
""")
def q_histogram_from_state_1h(spark, sf_dir):
    mentions = _events_stream(spark, sf_dir).select(F.col("user_id").cast("string").alias("name"), "ts")
    base = scratch_path(spark, "from-state")
    await_done(write_batches(_histogram(mentions, _hot(spark, sf_dir)), f"{base}/changes", f"{base}/checkpoint"), "from-state")
    return live_histogram(spark, f"{base}/checkpoint")


# A reader that joins at any batch, without history before it, ends with the same top-100.
@register("late_join_top100", f"""
SELECT name, "count", true AS at_every_point FROM ({_SQL_TOP_STREAM}) t
""")
def q_late_join_top100(spark, sf_dir):
    path = _run_top(spark, sf_dir)
    points = snapshots(spark, path)
    tables = None
    for batch in points:
        rows = join_at(spark, path, batch).select("name", "count")
        tables = rows if tables is None else tables.unionByName(rows)
    seen = tables.groupBy("name", "count").agg(F.count("*").alias("points"))
    return seen.select("name", "count", (F.col("points") == len(points)).alias("at_every_point"))


# A10 as the stream runs: the volume measured by the query that publishes the
# records, not by a second scan.
@register("stream_volume_observed", """
SELECT count(*) AS records, CAST(sum(strlen(CAST(user_id AS VARCHAR)) + 8) AS BIGINT) AS bytes_out, CAST(sum(strlen(props)) AS BIGINT) AS bytes_in FROM events
""")
def q_stream_volume_observed(spark, sf_dir):
    ev = _events_stream(spark, sf_dir).select(F.col("user_id").cast("string").alias("name"), "ts", "props")
    base = scratch_path(spark, "observed")
    q = write_batches(ev.observe("volume", *volume_measures(value_col="props")), f"{base}/out", f"{base}/checkpoint")
    await_done(q, "observed")
    return observed(spark, q, "volume")


# Hot names found as the stream runs, without a table made beforehand: five
# names hold all rows, so each is spread over several state keys.
@register("rolling_stream_spread_1h", """
SELECT event_type AS name,
       CAST(count(*) FILTER (WHERE epoch_ms(ts) + 3600000 > (SELECT epoch_ms(max(ts)) FROM events)) AS BIGINT) AS "count", true AS spread
FROM events GROUP BY event_type
""")
def q_rolling_stream_spread_1h(spark, sf_dir):
    mentions = _events_stream(spark, sf_dir).select(F.col("event_type").alias("name"), "ts")
    changes = run_available(rolling_histogram(mentions, HOUR_MS, spread_above=1 / 64, spread_least=4), "spread-stream")
    keys = changes.groupBy(F.col("name").alias("of")).agg((F.countDistinct("salt") > 1).alias("spread"))
    return fold_changelog(changes, keep_zero=True).join(keys, F.col("name") == F.col("of")).select("name", "count", "spread")

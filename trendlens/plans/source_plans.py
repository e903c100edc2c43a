"""Sources and sinks over the test tables: what is written in their formats is read back and compared."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.timefns import first_field, floor_to_interval_us, micros_of, ntz_from_micros, ntz_micros, parse_record_id, stamp_micros
from ..operators.daily import daily_counts, daily_lists, to_result_schema, top_k_daily
from ..operators.frequent import frequent_names
from ..operators.sensor import readings_at_expression, readings_at_text
from ..operators.shape import sorted_histogram
from ..operators.timegrid import segment_name, segment_window
from ..operators.topn import fold_increments
from ..session import scratch_path
from ..sinks.writers import publish_records, read_key, write_daily, write_daily_text
from ..sources.records import read_daily, segment_records, segments_from_index
from ..sources.segments import follow_segments, read_segments, write_segments
from ..sources.sensor import read_sensor, read_sensor_text
from ..sources.tables import event_mentions, event_records, table
from ..streaming.runner import await_done, write_batches
from .catalog import register
from .daily_plans import _names, _sql_counts
from .misc_plans import _SQL_BUCKET


def _stamp_text(ts):
    """A wall-clock time as the sensor files write it: ``M/d/yy:H:mm``."""
    parts = [F.month(ts), F.dayofmonth(ts), F.year(ts) % 100, F.hour(ts), F.minute(ts)]
    return F.format_string("%d/%d/%02d:%d:%02d", *parts)


def _sensor_files(spark, sf_dir) -> str:
    """Every event as a sensor reading, in CSV files."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "sensor")
    ev.select("event_type", _stamp_text(F.col("ts")), "value", "value", "event_id", "value", "user_id", "value").repartition(4).write.csv(path)
    return path


_SQL_SENSOR = """
SELECT event_type AS sensorname, date_trunc('minute', ts) AS "timestamp", value AS "numA", event_id AS "numC", user_id AS "numE" FROM events
"""


# S3: the example's CSV with its own time format.
@register("sensor_readings", _SQL_SENSOR)
def q_sensor_readings(spark, sf_dir):
    got = read_sensor(spark, _sensor_files(spark, sf_dir))
    return got.select("sensorname", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "numA", "numC", "numE")


# The same files as lines, several paths at once.
@register("sensor_lines", 'SELECT event_type AS sensorname, 2 * count(*) AS "lines" FROM events GROUP BY 1')
def q_sensor_lines(spark, sf_dir):
    lines = read_sensor_text(spark, _sensor_files(spark, sf_dir), _sensor_files(spark, sf_dir))
    return lines.groupBy(F.substring_index("value", ",", 1).alias("sensorname")).agg(F.count("*").alias("lines"))


_SQL_FIRST_MINUTE = """
SELECT event_id FROM events WHERE date_trunc('minute', ts) = (SELECT date_trunc('minute', min(ts)) FROM events)
"""


# The timestamp filter on a field of the text lines.
@register("readings_at_text", _SQL_FIRST_MINUTE)
def q_readings_at_text(spark, sf_dir):
    first = table(spark, sf_dir, "events").agg(F.min("ts").alias("ts")).select(_stamp_text(F.col("ts"))).first()[0]
    lines = readings_at_text(spark.read.text(_sensor_files(spark, sf_dir)), first)
    return lines.select(F.split("value", ",")[4].cast("bigint").alias("event_id"))


# The filter as an expression string.
@register("readings_at_expression", _SQL_FIRST_MINUTE)
def q_readings_at_expression(spark, sf_dir):
    readings = read_sensor(spark, _sensor_files(spark, sf_dir)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return readings_at_expression(readings, readings.agg(F.min("timestamp")).first()[0]).select(F.col("numC").alias("event_id"))


_INDEX_FROM, _INDEX_TO = "20240110000000", "20240120234500"


# S8, F-16: an index of segment paths, cut to a range of stamps.
@register("segments_from_index", f"""
WITH b AS (SELECT DISTINCT strftime(make_timestamp({_SQL_BUCKET}), '%Y%m%d%H%M00') AS stamp FROM events)
SELECT stamp, stamp || '.gkg.csv.zip' AS file FROM b WHERE stamp BETWEEN '{_INDEX_FROM}' AND '{_INDEX_TO}'
""")
def q_segments_from_index(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "index")
    name = segment_name(floor_to_interval_us(micros_of(ev, "ts")))
    paths = ev.select(name.alias("file")).distinct().select(F.concat(F.lit("12345 0a1b2c http://feed.example/v2/gkg/"), "file").alias("value"))
    paths.unionByName(paths.select(F.replace("value", F.lit("/gkg/"), F.lit("/events/")).alias("value"))).write.text(path)
    return segments_from_index(spark, path, _INDEX_FROM, _INDEX_TO)


def _daily(spark, sf_dir):
    ranked = top_k_daily(daily_counts(_names(spark, sf_dir), "day"), 10, "row_number", "day")
    return to_result_schema(daily_lists(ranked, "day"), "day")


_SQL_DAILY_ROWS = f"""
SELECT day AS data, name AS topic, cnt AS "count" FROM ({_sql_counts(True)}) c
QUALIFY row_number() OVER (PARTITION BY day ORDER BY cnt DESC, name) <= 10
"""


# The daily results written as JSON lines and read back.
@register("daily_read_back", _SQL_DAILY_ROWS)
def q_daily_read_back(spark, sf_dir):
    path = scratch_path(spark, "daily")
    write_daily(_daily(spark, sf_dir), path)
    return read_daily(spark, path).select("data", F.inline("result"))


# K3: one file or parallel files, with the same lines.
@register("daily_single_file", f"""
SELECT count(DISTINCT day) AS "lines", 1 AS files, true AS same_lines FROM ({_sql_counts(True)}) c
""")
def q_daily_single_file(spark, sf_dir):
    one, many = scratch_path(spark, "daily-one"), scratch_path(spark, "daily-many")
    daily = _daily(spark, sf_dir)
    write_daily_text(daily, one, single_file=True)
    write_daily_text(daily.repartition(5), many)
    lines = spark.read.text(one).select("value", F.input_file_name().alias("file"))
    both = lines.select("value", F.lit(1).alias("side")).unionByName(spark.read.text(many).select("value", F.lit(-1).alias("side")))
    differ = both.groupBy("value").agg(F.sum("side").alias("d")).agg(F.count_if(F.col("d") != 0).alias("differ"))
    return lines.agg(F.count("*").alias("lines"), F.countDistinct("file").cast("int").alias("files")).join(differ).select("lines", "files", (F.col("differ") == 0).alias("same_lines"))


# S7, F-12: the names of the last two hours' segments, one interval behind now.
@register("segment_window", """
WITH n AS (SELECT CAST(floor(epoch_us(max(ts)) / 900000000) AS BIGINT) * 900000000 AS now FROM events)
SELECT strftime(make_timestamp(now - k * 900000000), '%Y%m%d%H%M00') || '.gkg.csv.zip' AS segment
FROM n, (SELECT unnest(generate_series(1, 8)) AS k) s
""")
def q_segment_window(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return segment_window(spark, ev.agg(F.max(ntz_micros("ts"))).first()[0], 120)


# F-13, F-14, F-15: the id, its parts and its time from a record line.
@register("record_ids", """
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS stamp, CASE WHEN event_id % 7 = 3 THEN 0 ELSE event_id END AS seq, date_trunc('minute', ts) AS minute
FROM events WHERE event_id % 7 <> 3
UNION ALL SELECT event_id, 0, 0, date_trunc('minute', ts) FROM events WHERE event_id % 7 = 3
""")
def q_record_ids(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    stamp = F.translate(F.substring(F.col("ts").cast("string"), 1, 19), "-: ", "")
    malformed = F.col("event_id") % 7 == 3
    key = F.concat(stamp, F.when(malformed, F.lit("-x-")).otherwise(F.lit("-")), F.col("event_id").cast("string"))
    lines = ev.select("event_id", F.concat_ws("\t", key, F.lit("a"), F.lit("b")).alias("value"))
    key = first_field("value")
    return lines.select("event_id", parse_record_id(key).alias("id"), ntz_from_micros(stamp_micros(key)).alias("minute")).select("event_id", "id.stamp", "id.seq", "minute")


# O3: the four display orders; ``position`` is the row's place in the order.
@register("histogram_orders", """
WITH h AS (SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS "count" FROM events GROUP BY user_id)
SELECT * FROM (
  SELECT 'count desc' AS "order", row_number() OVER (ORDER BY "count" DESC, name) AS position, name, "count" FROM h
  UNION ALL SELECT 'count asc', row_number() OVER (ORDER BY "count", name), name, "count" FROM h
  UNION ALL SELECT 'name desc', row_number() OVER (ORDER BY name DESC), name, "count" FROM h
  UNION ALL SELECT 'name asc', row_number() OVER (ORDER BY name), name, "count" FROM h)
WHERE position <= 100
""")
def q_histogram_orders(spark, sf_dir):
    hist = fold_increments(event_mentions(spark, sf_dir, "user_id").withColumn("increment", F.lit(1)))
    out = None
    for by in ("count", "name"):
        for ascending in (False, True):
            # the first 100 rows as they come; their ids ascend with their places
            first = sorted_histogram(hist, by, ascending).limit(100).withColumn("at", F.monotonically_increasing_id())
            label = F.lit(f"{by} {'asc' if ascending else 'desc'}")
            rows = first.select(label.alias("order"), F.row_number().over(Window.orderBy("at")).cast("bigint").alias("position"), "name", "count")
            out = rows if out is None else out.unionByName(rows)
    return out


# K5: the log laid out by key; one key's records are read in order, from its bucket alone.
@register("keyed_log_read", """
SELECT CAST(user_id AS VARCHAR) AS key, ts AS "timestamp", row_number() OVER (ORDER BY ts) AS position
FROM events WHERE user_id = (SELECT min(user_id) FROM events)
""")
def q_keyed_log_read(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "keyed-log")
    records = event_records(spark, sf_dir).withColumnRenamed("key", "id").join(ev.select(F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("key")), "id")
    publish_records(records, path, buckets=16)
    key = str(ev.agg(F.min("user_id")).first()[0])
    rows = read_key(spark, path, key, buckets=16)
    at = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return rows.select("key", ntz_from_micros(F.unix_micros("timestamp")).alias("timestamp"), at.cast("bigint").alias("position"))


_COUNTERS = 100


# Every name with more than rows / (counters + 1) mentions is in the bounded
# table, and no true count lies outside its bound.
@register("frequent_names", f"""
WITH m AS (SELECT CAST(user_id AS VARCHAR) AS name FROM events UNION ALL SELECT event_type FROM events)
SELECT name, count(*) AS "count", true AS within, CAST(0 AS BIGINT) AS violations FROM m GROUP BY name
HAVING count(*) * {_COUNTERS + 1} > (SELECT count(*) FROM m)
""")
def q_frequent_names(spark, sf_dir):
    m = event_mentions(spark, sf_dir, "user_id").select("name").unionByName(event_mentions(spark, sf_dir, "event_type").select("name"))
    found = frequent_names(m, _COUNTERS).select(F.col("name").alias("f_name"), F.col("count").alias("low"), (F.col("count") + F.col("bound")).alias("high"))
    true = m.groupBy("name").agg(F.count("*").alias("count"))
    both = true.join(found, F.col("name") == F.col("f_name"), "full_outer").withColumn("within", F.coalesce(F.col("count").between(F.col("low"), F.col("high")), F.lit(False)))
    wrong = both.agg(F.count_if(F.col("f_name").isNotNull() & ~F.col("within")).alias("violations"))
    rows = m.agg(F.count("*").alias("rows"))
    return both.join(rows).join(wrong).filter(F.col("count") * (_COUNTERS + 1) > F.col("rows")).select("name", "count", "within", "violations")


def _segment_lines(spark, sf_dir):
    """Every event as a line of its 15-minute segment: ``segment, event_id, value``."""
    ev = table(spark, sf_dir, "events")
    segment = segment_name(floor_to_interval_us(micros_of(ev, "ts")), ".gkg.csv")
    lines = ev.select(segment.alias("segment"), "event_id", "event_type")
    key = F.concat(F.substring("segment", 1, 14), F.lit("-"), F.col("event_id").cast("string"))
    return lines.select("segment", "event_id", F.concat_ws("\t", key, F.substring("segment", 1, 14), "event_type").alias("value"))


def _written(spark, lines, path):
    # one row a segment: the write runs in the tasks
    write_segments(lines, path, order_col="event_id").write.format("noop").mode("overwrite").save()
    return path


_SQL_SEGMENT_LINES = f"""
SELECT strftime(make_timestamp({_SQL_BUCKET}), '%Y%m%d%H%M00') AS stamp, event_id, event_type, {_SQL_BUCKET} AS bucket,
       row_number() OVER (PARTITION BY {_SQL_BUCKET} ORDER BY event_id) - 1 AS line_no, count(*) OVER (PARTITION BY {_SQL_BUCKET}) AS n_lines,
       min(event_id) OVER (PARTITION BY {_SQL_BUCKET}) AS first_event
FROM events
"""


# Segments as zips, read back by the data source with their layout; the stamp
# range cuts the listing.
@register("zipped_segments", f"""
SELECT stamp || '.gkg.csv.zip' AS segment, line_no, stamp || '-' || event_id || chr(9) || stamp || chr(9) || event_type AS value, n_lines, stamp || '-' || first_event AS first_id
FROM ({_SQL_SEGMENT_LINES}) WHERE stamp BETWEEN '{_INDEX_FROM}' AND '{_INDEX_TO}'
""")
def q_zipped_segments(spark, sf_dir):
    path = _written(spark, _segment_lines(spark, sf_dir), scratch_path(spark, "segments"))
    lines = read_segments(spark, path, layout=True, start=_INDEX_FROM, end=_INDEX_TO)
    return lines.select(F.substring_index("path", "/", -1).alias("segment"), "line_no", "value", "n_lines", "first_id")


# The same segments as a stream, the second half written after the first has
# been read: each line comes once, with its event time.
@register("followed_segments", f"""
SELECT stamp || '-' || event_id AS key, make_timestamp(bucket + line_no * (900000 // n_lines) * 1000) AS "timestamp", CAST(CASE WHEN stamp < '{_INDEX_FROM}' THEN 0 ELSE 1 END AS BIGINT) AS run
FROM ({_SQL_SEGMENT_LINES})
""")
def q_followed_segments(spark, sf_dir):
    lines, base = _segment_lines(spark, sf_dir), scratch_path(spark, "followed")
    early = F.substring("segment", 1, 14) < _INDEX_FROM
    for run, half in enumerate((early, ~early)):
        _written(spark, lines.filter(half), f"{base}/segments")
        records = segment_records(follow_segments(spark, f"{base}/segments")).withColumn("run", F.lit(run))
        await_done(write_batches(records, f"{base}/out", f"{base}/checkpoint"), "followed-segments")
    got = spark.read.parquet(f"{base}/out")
    return got.select("key", ntz_from_micros(F.unix_micros("timestamp")).alias("timestamp"), F.col("run").cast("bigint").alias("run"))

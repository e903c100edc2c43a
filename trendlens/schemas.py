"""Fixed schemas of the inputs and outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the news-record format and the reference's
# outputs for results to match. Column names of the 27-field tab-separated
# news record, in file order (position 1 is the date, 23 the name list).
RECORD_COLUMNS = [
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName",
    "DocumentIdentifier", "Counts", "V2Counts", "Themes", "V2Themes",
    "Locations", "V2Locations", "Persons", "V2Persons", "Organizations",
    "V2Organizations", "V2Tone", "Dates", "GCAM", "SharingImage",
    "RelatedImages", "SocialImageEmbeds", "SocialVideoEmbeds", "Quotations",
    "AllNames", "Amounts", "TranslationInfo", "Extras",
]
RECORD_DATE_FORMAT = "yyyyMMddHHmmss"
DATE_POS = 1
NAMES_POS = 23
# Sensor example: columns and the timestamp pattern (as read by Spark 4;
# the 2.x pattern MM/dd/yy:hh:mm yields null for 3/10/14:1:01).
SENSOR_COLUMNS = ["sensorname", "timestamp", "numA", "numB", "numC", "numD", "numE", "numF"]
SENSOR_TIMESTAMP_FORMAT = "M/d/yy:H:mm"
# Daily result: top-level key is literally "data", list items topic/count.
RESULT_LIST_TYPE = "array<struct<topic:string,count:bigint>>"
# ---------------------------------------------------------------------------

_RECORD_TYPES = {"DATE": T.DateType(), "SourceCollectionIdentifier": T.IntegerType()}

RECORD_SCHEMA = T.StructType([
    T.StructField(c, _RECORD_TYPES.get(c, T.StringType()), True) for c in RECORD_COLUMNS
])

SENSOR_SCHEMA = T.StructType([
    T.StructField("sensorname", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("numA", T.DoubleType(), True),
    T.StructField("numB", T.DoubleType(), True),
    T.StructField("numC", T.LongType(), True),
    T.StructField("numD", T.DoubleType(), True),
    T.StructField("numE", T.LongType(), True),
    T.StructField("numF", T.DoubleType(), True),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("data", T.DateType(), True),
    T.StructField("result", T.ArrayType(T.StructType([
        T.StructField("topic", T.StringType(), True),
        T.StructField("count", T.LongType(), True),
    ])), True),
])

# Record stream as published: key = record id, value = whole line,
# timestamp = event time given by the publisher.
RECORD_STREAM_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

MENTION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), True),
])

# Histogram changelog: latest row per (name, salt) wins; ``salt`` is 0 unless
# hot names are spread over several state keys (then counts are partial and
# are summed per name); ts is the event time of the change, seq orders
# changes of one key.
CHANGELOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("salt", T.IntegerType(), True),
    T.StructField("count", T.LongType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("seq", T.LongType(), True),
])

# The changelog as it is published and consumed: each row with the id of the
# micro-batch that emitted it, because ``seq`` starts anew when a key's state
# is cleared; readers order a key's rows by (batch, seq).
PUBLISHED_CHANGELOG_SCHEMA = T.StructType([*CHANGELOG_SCHEMA.fields, T.StructField("batch", T.LongType(), True)])

# A changelog that counts late mentions has this column: a number in rows that
# say how many were dropped (with no count, time and seq), null in changes.
LATE_FIELD = T.StructField("late", T.LongType(), True)

"""Batch sinks (K1–K3, K5); streaming sinks live in ``streaming.runner``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.daily import result_json
from ..operators.shape import daily_text
from ..schemas import RECORD_STREAM_SCHEMA


def _text(df: DataFrame, path: str, single_file: bool, mode: str) -> None:
    # K3: one file (one writer task) only when asked; the default writes in
    # parallel, one file per partition.
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).text(path)


def write_daily(results: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """K1: daily results as JSON lines ``{"data": …, "result": [...]}``."""
    _text(result_json(results), path, single_file, mode)


def write_daily_text(results: DataFrame, path: str, single_file: bool = False,
                     mode: str = "overwrite") -> None:
    """K2: daily results as tuple text lines."""
    _text(daily_text(results), path, single_file, mode)


def publish_records(records: DataFrame, path: str, key_col: str = "key", value_col: str = "value",
                    ts_col: str = "timestamp", buckets: int | None = None) -> None:
    """K5: keyed, timestamped records appended to a parquet log.

    Stands in for a topic: a file-stream reader of ``path`` sees each append
    once. With ``buckets`` the log is laid out by a hash of the key, as a
    topic by its partitions: a bucket holds all records of its keys, each
    file of an append in order of key and time; :func:`read_key` reads one key
    from its bucket. A key's records of one append lie in one file, a hot key's
    too, as their order says.
    """
    rows = records.select(F.col(key_col).alias("key"), F.col(value_col).alias("value"), F.col(ts_col).alias("timestamp"))
    if buckets is None:
        rows.write.mode("append").parquet(path)
        return
    rows = rows.withColumn("bucket", key_bucket(F.col("key"), buckets))
    rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "key", "timestamp").write.mode("append").partitionBy("bucket").parquet(path)


def key_bucket(key: Column, buckets: int) -> Column:
    """The bucket of a keyed log that a key lies in; null is a key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_key(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The records of one key of a log with ``buckets``, in order of time: one bucket's files, pruned by key."""
    bucket = spark.range(1).select(key_bucket(F.lit(key), buckets)).first()[0]
    log = spark.read.schema(T.StructType([*RECORD_STREAM_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)
    return log.filter((F.col("bucket") == bucket) & (F.col("key") == key)).drop("bucket").orderBy("timestamp")

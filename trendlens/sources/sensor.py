"""Sensor example sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import SENSOR_SCHEMA, SENSOR_TIMESTAMP_FORMAT


def read_sensor(spark: SparkSession, path) -> DataFrame:
    """S3: comma-separated readings with a fixed schema and ``M/d/yy:H:mm`` times."""
    return (spark.read.schema(SENSOR_SCHEMA)
            .option("timestampFormat", SENSOR_TIMESTAMP_FORMAT).csv(path))


def read_sensor_text(spark: SparkSession, *paths) -> DataFrame:
    """The same files as raw lines, many paths at once."""
    return spark.read.text(list(paths))


def numbered_letters(spark: SparkSession, n: int, slices: int) -> DataFrame:
    """``(i, letter)`` for i in 1..n with letters a–z repeating, in ``slices`` partitions."""
    ids = spark.range(1, n + 1, numPartitions=slices)
    return ids.select(F.col("id").alias("i"),
                      F.char(F.lit(97) + (F.col("id") - 1) % 26).alias("letter"))

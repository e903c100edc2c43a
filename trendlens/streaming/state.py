"""The live histogram from the transformer's state store (K7, A9), without a consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def live_histogram(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``name, count`` of the names with live mentions, as of ``batch`` (default: the last committed one).

    Reads the state of :func:`~trendlens.streaming.histogram.rolling_histogram`
    from its checkpoint: one value for each group of (name, salt), the salts summed.
    """
    reader = spark.read.format("statestore").option("stateVarName", "keys")
    if batch is not None:
        reader = reader.option("batchId", batch)
    keys = reader.load(checkpoint).select(F.explode("value.keys").alias("key")).select("key.name", "key.count")
    return keys.groupBy("name").agg(F.sum("count").cast("bigint").alias("count")).filter(F.col("count") > 0)

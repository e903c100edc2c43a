"""Sources and sinks for the streaming side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import LATE_FIELD, PUBLISHED_CHANGELOG_SCHEMA, RECORD_STREAM_SCHEMA
from ..session import scratch_path


def stream_table_files(spark: SparkSession, directory: str, file_glob: str, schema,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """S9/S10 on files: new parquet files under ``directory`` as a stream.

    The checkpoint's processed-file log guarantees every file is read once
    and never twice; ``max_files_per_trigger`` paces the feed.
    """
    reader = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
              .option("latestFirst", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(directory)


def stream_records_kafka(spark: SparkSession, servers: str, topic: str = "records",
                         starting_offsets: str = "earliest") -> DataFrame:
    """S10/S11 with a Kafka broker: ``key, value, timestamp`` as strings.

    Needs the Kafka connector on the classpath (not installed here).
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp"))


def stream_records(spark: SparkSession, path: str | None = None, servers: str | None = None,
                   topic: str = "records", starting_offsets: str = "earliest",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The record stream ``key, value, timestamp``.

    From a Kafka topic when ``servers`` is given, otherwise from the parquet
    log that :func:`trendlens.sinks.writers.publish_records` appends to.
    """
    if servers:
        return stream_records_kafka(spark, servers, topic, starting_offsets)
    return stream_table_files(spark, path, "*.parquet", RECORD_STREAM_SCHEMA, max_files_per_trigger)


def changelog_messages(changes: DataFrame) -> DataFrame:
    """K4: published changelog rows as messages: key = name, value = the whole row as JSON."""
    return changes.select(F.col("name").alias("key"), F.to_json(F.struct(*[f.name for f in PUBLISHED_CHANGELOG_SCHEMA.fields])).alias("value"))


def changelog_from_messages(messages: DataFrame) -> DataFrame:
    """The rows of such messages again, with the columns the consumer reads."""
    return messages.select(F.from_json(F.col("value"), PUBLISHED_CHANGELOG_SCHEMA).alias("row")).select("row.*")


def stream_histogram(spark: SparkSession, servers: str, topic: str = "histogram") -> DataFrame:
    """The histogram changelog from the latest offset (history skipped).

    A fresh checkpoint folder per start wipes the consumer's state (T10).
    """
    return changelog_from_messages(stream_records_kafka(spark, servers, topic, "latest"))


def write_kafka(changes: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict | None = None):
    """K4: publish a changelog stream to a topic, each row with its batch.

    Needs the Kafka connector on the classpath (not installed here); the
    file-based equivalent is :func:`write_batches`.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        (changelog_messages(df.withColumn("batch", F.lit(batch_id).cast("long"))).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic).save())

    w = changes.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def published_changelog(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The changelog that :func:`write_batches` wrote to ``path``, as a stream with its ``batch`` column; without rows that count late mentions."""
    schema = T.StructType([*PUBLISHED_CHANGELOG_SCHEMA.fields, LATE_FIELD])
    return stream_table_files(spark, path, "*.parquet", schema, max_files_per_trigger).filter("late is null").drop("late")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def running_query(spark: SparkSession) -> str | None:
    """The id of the streaming query whose micro-batch is being worked on; it stays the same over restarts from a checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _own(spark: SparkSession, path: str) -> None:
    """Mark ``path`` as this query's, or fail if it is another's: batch numbers of two queries would mix."""
    fs, mark = _fs(spark, f"{path}/.query")
    query = running_query(spark) or ""
    if fs.exists(mark):
        stream = fs.open(mark)
        owner = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if owner != query:
            raise ValueError(f"{path} holds the batches of another query")
        return
    out = fs.create(mark, False)
    out.write(bytearray(query.encode()))
    out.close()


def publish_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write a micro-batch as ``path/batch=<id>``: complete by a rename, once.

    A batch that is run again finds its folder complete and leaves it, so a
    reader that has listed it never loses or doubles a file.
    """
    spark = df.sparkSession
    fs, done = _fs(spark, f"{path}/batch={batch}")
    if fs.exists(done):
        return
    draft = f"{path}/.draft-{batch}"
    df.write.mode("overwrite").parquet(draft)
    if not fs.rename(_fs(spark, draft)[1], done):
        raise OSError(f"batch {batch} could not be published to {path}")


def write_batches(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  query_name: str | None = None):
    """K4/K5: publish each micro-batch as ``path/batch=<id>`` (exactly once, together with the checkpoint)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        _own(df.sparkSession, path)
        publish_batch(df, path, batch_id)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def run_available(stream: DataFrame, name: str, timeout_s: float | None = None) -> DataFrame:
    """Run ``stream`` on everything available now, return what it emitted.

    A fresh checkpoint folder under ``spark.checkpoint.dir`` wipes state at
    start (T10); the output is read back as a batch DataFrame with the
    ``batch`` id of each row.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    await_done(write_batches(stream, f"{base}/out", f"{base}/checkpoint"), name, timeout_s)
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{base}/out")


def await_done(q, name: str, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query and raise if it fails.

    It ends by itself, after a time that grows with what is available: only a
    caller who knows how much that is can set a limit, after which it is stopped.
    """
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise q.exception()

"""Runnable jobs: the batch daily top-k and the three streaming stages.

Each job is the library's operators wired from a source to a sink, so a
deployment can run the same work as the original programs:

* ``daily_top_k``   records (CSV, text or zipped segments) → daily top-k → JSON lines or tuple text;
* ``producer``      new zipped segments → records with spread event times → record log;
* ``transformer``   record log → mentions → rolling histogram → changelog log;
* ``consumer``      changelog log → exact top-N → delta messages.

Streaming jobs use file logs under shared storage (the Kafka forms need the
connector, see ``streaming.runner``). ``trigger`` defaults to processing
what is available now; pass e.g. ``{"processingTime": "1 second"}`` to run
continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from .operators.clean import clean_names
from .operators.daily import daily_result
from .operators.metrics import reject_measures
from .session import build_session
from .sinks.writers import write_daily, write_daily_text
from .sources.records import read_records, read_records_text, read_zipped_segments, segment_records, \
    split_record_lines, stream_segments
from .streaming.histogram import HOUR_MS, rolling_histogram, stream_mentions
from .streaming.runner import published_changelog, stream_records, write_batches
from .streaming.topn import top_n_stream

READERS = ("csv", "text", "zip")


def read_any(spark: SparkSession, path: str, reader: str = "csv") -> DataFrame:
    """Records ``DATE, AllNames`` (+ id) from TSV (S1), raw lines (S2) or zips."""
    if reader == "csv":
        return read_records(spark, path)
    if reader == "text":
        return read_records_text(spark, path)
    if reader == "zip":
        return split_record_lines(read_zipped_segments(spark, path))
    raise ValueError(f"reader must be one of {READERS}")


def daily_top_k(spark: SparkSession, input_path: str, output_path: str, k: int = 10,
                ties: str = "rank", per_record: str = "distinct", reader: str = "csv",
                output: str = "json", single_file: bool = False) -> dict[str, int]:
    """The batch job: top-k names per day, days ascending, written as JSON or text.

    Returns the records read and those dropped (F8), measured by the same run.
    """
    seen = Observation()
    records = read_any(spark, input_path, reader).observe(seen, *reject_measures())
    names = clean_names(records, per_record=per_record)
    result = daily_result(names, k, ties)
    if output == "json":
        write_daily(result, output_path, single_file=single_file)
    elif output == "text":
        write_daily_text(result, output_path, single_file=single_file)
    else:
        raise ValueError("output must be 'json' or 'text'")
    return seen.get


def _start(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None):
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def producer(spark: SparkSession, segments_dir: str, log_dir: str, checkpoint: str,
             files_per_trigger: int | None = None, trigger: dict | None = None):
    """New segments → records ``key, value, timestamp`` appended to a log.

    A micro-batch takes all new segments, one task for each; ``files_per_trigger`` paces a replay.
    """
    records = segment_records(stream_segments(spark, segments_dir, max_files_per_trigger=files_per_trigger))
    return _start(records, log_dir, checkpoint, trigger)


#: A name with more than this share of a task's rows is spread over several state keys.
SPREAD_ABOVE = 1 / 64


def transformer(spark: SparkSession, log_dir: str, changelog_dir: str, checkpoint: str,
                horizon_ms: int = HOUR_MS, watermark: str = "0 seconds", salts: int = 1,
                hot=None, trigger: dict | None = None, count_late: bool = True):
    """Record log → rolling-histogram changelog, by micro-batch (S10, T1–T6, K4 file form).

    Hot names are found as the stream runs, unless a table ``hot`` or a number of
    salts for every name is given. Late mentions are counted in the changelog's
    ``late`` rows (F17), which its readers skip.
    """
    mentions = stream_mentions(stream_records(spark, log_dir))
    spread = SPREAD_ABOVE if hot is None and salts == 1 else None
    changes = rolling_histogram(mentions, horizon_ms, watermark, salts=salts, hot=hot, count_late=count_late, spread_above=spread)
    return write_batches(changes, changelog_dir, checkpoint, trigger)


def consumer(spark: SparkSession, changelog_dir: str, out_dir: str, checkpoint: str, n: int = 100,
             trigger: dict | None = None, retain: int | None = None):
    """Changelog log → exact top-N, one delta message and snapshot per micro-batch."""
    return top_n_stream(published_changelog(spark, changelog_dir), out_dir, checkpoint, n, trigger, retain=retain)


def main(argv=None) -> None:
    import argparse
    ap = argparse.ArgumentParser(prog="trendlens")
    sub = ap.add_subparsers(dest="job", required=True)
    d = sub.add_parser("daily", help="daily top-k of a record file set")
    d.add_argument("input")
    d.add_argument("output")
    d.add_argument("--k", type=int, default=10)
    d.add_argument("--ties", choices=("rank", "row_number"), default="rank")
    d.add_argument("--per-record", choices=("distinct", "mentions"), default="distinct")
    d.add_argument("--reader", choices=READERS, default="csv")
    d.add_argument("--output-format", choices=("json", "text"), default="json")
    d.add_argument("--single-file", action="store_true")
    for name in ("producer", "transformer", "consumer"):
        p = sub.add_parser(name)
        p.add_argument("source")
        p.add_argument("sink")
        p.add_argument("checkpoint")
        p.add_argument("--processing-time", default=None, help="e.g. '1 second'; default: available now")
        if name == "producer":
            p.add_argument("--files-per-trigger", type=int, default=None)
        if name == "transformer":
            p.add_argument("--salts", type=int, default=1, help="state keys that each name is spread over (default: as the stream needs)")
            p.add_argument("--hot", default=None, help="parquet table name, salts: only these names are spread")
        if name == "consumer":
            p.add_argument("--n", type=int, default=100)
            p.add_argument("--retain", type=int, default=None, help="keep so many delta messages")
    a = ap.parse_args(argv)
    spark = build_session(app_name=f"trendlens-{a.job}")
    if a.job == "daily":
        daily_top_k(spark, a.input, a.output, a.k, a.ties, a.per_record, a.reader, a.output_format,
                    a.single_file)
        return
    trigger = {"processingTime": a.processing_time} if a.processing_time else None
    if a.job == "producer":
        q = producer(spark, a.source, a.sink, a.checkpoint, a.files_per_trigger, trigger)
    elif a.job == "transformer":
        hot = spark.read.parquet(a.hot) if a.hot else None
        q = transformer(spark, a.source, a.sink, a.checkpoint, salts=a.salts, hot=hot, trigger=trigger)
    else:
        q = consumer(spark, a.source, a.sink, a.checkpoint, a.n, trigger, a.retain)
    q.awaitTermination()


__all__ = ["daily_top_k", "producer", "transformer", "consumer", "read_any", "main"]

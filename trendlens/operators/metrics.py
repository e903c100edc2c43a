"""Stream volume and reject counts (A10, F8), by a query of their own or as another one runs.

``volume_measures`` and ``reject_measures`` are aggregates for ``DataFrame.observe``:
the job that writes a result also delivers them, without a second scan. Late
rows (F17) are counted where they are dropped, see ``streaming.histogram``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: bytes of a long count in a changelog message.
COUNT_BYTES = 8


def stream_volume(df: DataFrame, every: str = "1 hour", ts_col: str = "ts", name_col: str = "name",
                  value_col: str | None = None) -> DataFrame:
    """A10: per tumbling window, records in, bytes in, bytes out.

    bytes out = Σ (UTF-8 length of the name + 8), the size of a changelog
    row; bytes in = Σ length of ``value_col`` when given. Divide by the
    window length for per-second rates. Works on streams with a watermark.
    """
    aggs = [F.count(F.lit(1)).alias("records"),
            F.sum(F.octet_length(F.col(name_col)) + F.lit(COUNT_BYTES)).cast("bigint").alias("bytes_out")]
    if value_col:
        aggs.append(F.sum(F.octet_length(F.col(value_col))).cast("bigint").alias("bytes_in"))
    cols = ["records", "bytes_out"] + (["bytes_in"] if value_col else [])
    return (df.groupBy(F.window(ts_col, every).alias("w")).agg(*aggs)
            .select(F.col("w.start").alias("window_start"), *cols))


def volume_measures(name_col: str = "name", value_col: str | None = None) -> list[Column]:
    """A10 without windows, to be observed: records, bytes out and, with ``value_col``, bytes in."""
    out = [F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.octet_length(F.col(name_col)) + F.lit(COUNT_BYTES)), F.lit(0)).cast("bigint").alias("bytes_out")]
    if value_col:
        out.append(F.coalesce(F.sum(F.octet_length(F.col(value_col))), F.lit(0)).cast("bigint").alias("bytes_in"))
    return out


def reject_measures(date_col: str = "DATE", names_col: str = "AllNames") -> list[Column]:
    """F8, as aggregates: the records that the batch job reads, and those it drops, by reason."""
    missing = lambda c: F.count_if(F.col(c).isNull())
    return [F.count(F.lit(1)).alias("records"), missing(date_col).alias("null_date"), missing(names_col).alias("null_names")]


def reject_counts(records: DataFrame, date_col: str = "DATE", names_col: str = "AllNames") -> DataFrame:
    """F8: how many records the batch job drops, and why (one row)."""
    return records.agg(*reject_measures(date_col, names_col))


def observed(spark: SparkSession, query, name: str) -> DataFrame:
    """The sums over all micro-batches of what a finished streaming query observed under ``name`` (one row).

    Progress reports are kept for the last batches only (``spark.sql.streaming.numRecentProgressUpdates``);
    a query that runs longer needs a listener that adds them up.
    """
    rows = [p.observedMetrics[name].asDict() for p in query.recentProgress if name in p.observedMetrics]
    if not rows:
        raise ValueError(f"the query observed nothing as {name}")
    sums = {k: sum(r[k] or 0 for r in rows) for k in rows[0]}
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in sums.items()])

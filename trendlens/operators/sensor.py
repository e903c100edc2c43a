"""Sensor example filters (P6–P9): equality on a timestamp.

Column predicates (not Python lambdas) so the filter reaches the scan
(``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F


def _is_ntz(df: DataFrame, ts_col: str) -> bool:
    return df.schema[ts_col].dataType.typeName() == "timestamp_ntz"


def _param(ts: dt.datetime, ntz: bool):
    # Wall-clock columns compare with the wall-clock text (no zone involved);
    # instant columns with an aware instant (a naive value is read as UTC).
    if ntz:
        return ts.replace(tzinfo=None).isoformat(sep=" ")
    return ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc)


def readings_at(df: DataFrame, ts: dt.datetime, ts_col: str = "timestamp") -> DataFrame:
    """Rows whose timestamp equals ``ts``, independent of the session zone."""
    ntz = _is_ntz(df, ts_col)
    lit = F.lit(_param(ts, ntz))
    return df.filter(F.col(ts_col) == (lit.cast("timestamp_ntz") if ntz else lit))


def readings_at_sql(spark: SparkSession, df: DataFrame, ts: dt.datetime, view: str = "sensor",
                    ts_col: str = "timestamp") -> DataFrame:
    """The same filter as SQL text over a temporary view, parameterised."""
    df.createOrReplaceTempView(view)
    ntz = _is_ntz(df, ts_col)
    cond = f"`{ts_col}` = CAST(:ts AS TIMESTAMP_NTZ)" if ntz else f"`{ts_col}` = :ts"
    return spark.sql(f"SELECT * FROM {view} WHERE {cond}", args={"ts": _param(ts, ntz)})


def readings_at_expression(df: DataFrame, ts: dt.datetime, ts_col: str = "timestamp") -> DataFrame:
    """The same filter as an expression string."""
    kind = "TIMESTAMP_NTZ" if _is_ntz(df, ts_col) else "TIMESTAMP"
    value = _param(ts, kind == "TIMESTAMP_NTZ")
    text = value if isinstance(value, str) else value.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
    return df.filter(f"`{ts_col}` = {kind} '{text}'")


def readings_at_text(lines: DataFrame, stamp: str, field: int = 1, sep: str = ",") -> DataFrame:
    """The filter on raw text lines, comparing one split field."""
    return lines.filter(F.split(F.col("value"), sep).getItem(field) == F.lit(stamp))

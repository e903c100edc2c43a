"""Cleaning and exploding of name lists (P1–P5, F-1…F-6, A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.names import NOISE_SUBSTRINGS, STRIP_PATTERN, keep_name, name_list, strip_chars

#: Mentions that a task makes distinct, about; some 250 bytes each are held.
TASK_ROWS = 1_000_000


def clean_names(records: DataFrame, names_col: str = "AllNames", date_col: str | None = "DATE",
                per_record: str = "distinct", stop_substrings: Sequence[str] = NOISE_SUBSTRINGS,
                pattern: str = STRIP_PATTERN, trim: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """Record rows → one row per (record, name) mention.

    Works on batch and streaming frames. Null dates/name lists are dropped
    (P2), the list is cleaned inside the row (:func:`name_list`) and exploded;
    the output has ``date_col`` (if given), ``keep`` columns and ``name``.
    No shuffle is introduced.
    """
    cond = F.col(names_col).isNotNull()
    if date_col:
        cond = cond & F.col(date_col).isNotNull()
    cols = ([date_col] if date_col else []) + list(keep)
    return (records.filter(cond)
                   .select(*cols, F.explode(name_list(names_col, per_record, stop_substrings,
                                                      pattern, trim)).alias("name")))


def clean_mentions(mentions: DataFrame, name_col: str = "name", record_col: str | None = "record_id",
                   per_record: str = "distinct", stop_substrings: Sequence[str] = NOISE_SUBSTRINGS,
                   pattern: str = STRIP_PATTERN, trim: bool = False,
                   names_cleaned: bool = False) -> DataFrame:
    """Same rules as :func:`clean_names` on rows that are already one per mention.

    ``names_cleaned=True`` skips the per-name rules (already applied with
    :func:`clean_name_table`) and only applies the per-record rule.

    With ``per_record="distinct"`` a name counts once per record: a
    ``dropDuplicates`` on (record, name), which Spark runs as a partial
    (map-side) aggregate before the shuffle, so a record or name repeated
    many times is reduced where it is read. Where few repeat, that aggregate
    holds about all rows of its task, however many: deal the rows by record
    to :func:`tasks_for` tasks before.
    """
    out = mentions if names_cleaned else clean_name_table(mentions, name_col, stop_substrings,
                                                           pattern, trim)
    if per_record == "distinct":
        if record_col is None:
            raise ValueError("per_record='distinct' needs record_col")
        out = out.dropDuplicates([record_col, name_col])
    elif per_record != "mentions":
        raise ValueError("per_record must be 'distinct' or 'mentions'")
    return out


def tasks_for(rows: int, least: int) -> int:
    """So many tasks that each gets about ``TASK_ROWS`` of the rows at most, and ``least`` of them."""
    return max(least, -(-rows // TASK_ROWS))


def clean_name_table(df: DataFrame, name_col: str = "name",
                     stop_substrings: Sequence[str] = NOISE_SUBSTRINGS,
                     pattern: str = STRIP_PATTERN, trim: bool = False) -> DataFrame:
    """Per-name rules on any table with a name column: strip, trim, drop blank/noise."""
    name = strip_chars(name_col, pattern)
    if trim:
        name = F.trim(name)
    return df.withColumn(name_col, name).filter(keep_name(name_col, stop_substrings))

"""Column functions for multi-valued name fields (all JVM built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's cleaning rules):
# characters removed from the name list before splitting, the list separator,
# and the substring that marks category noise names.
STRIP_PATTERN = "[,0-9]"
NAME_SEPARATOR = ";"
NOISE_SUBSTRINGS = ("Type ParentCategory",)
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_chars(col, pattern: str = STRIP_PATTERN) -> Column:
    """Remove every match of ``pattern`` (default: digits and commas)."""
    return F.regexp_replace(_c(col), pattern, "")


def split_names(col, sep: str = NAME_SEPARATOR) -> Column:
    """Split on the separator, keeping trailing empty items (SQL ``split``)."""
    return F.split(_c(col), sep, -1)


def is_blank(col) -> Column:
    return F.trim(_c(col)) == F.lit("")


def is_noise(col, substrings: Sequence[str] = NOISE_SUBSTRINGS) -> Column:
    """True when the name contains any of ``substrings``."""
    cond = F.lit(False)
    for s in substrings:
        cond = cond | _c(col).contains(s)
    return cond


def keep_name(col, substrings: Sequence[str] = NOISE_SUBSTRINGS) -> Column:
    """Predicate for names to keep: not blank, not noise."""
    return ~is_blank(col) & ~is_noise(col, substrings)


def name_list(col, per_record: str = "distinct", stop_substrings: Sequence[str] = NOISE_SUBSTRINGS,
              pattern: str = STRIP_PATTERN, trim: bool = False) -> Column:
    """``name,offset;name,offset;…`` → cleaned ``array<string>`` of names.

    Everything stays inside the row (no shuffle): strip, split, optional trim,
    drop blank and noise items, and with ``per_record="distinct"`` keep each
    name once per record.
    """
    if per_record not in ("distinct", "mentions"):
        raise ValueError("per_record must be 'distinct' or 'mentions'")
    arr = split_names(strip_chars(col, pattern))
    if trim:
        arr = F.transform(arr, lambda x: F.trim(x))
    arr = F.filter(arr, lambda x: keep_name(x, stop_substrings))
    if per_record == "distinct":
        arr = F.array_distinct(arr)
    return arr

"""Column helpers of the operators that use DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once however often it is used."""
    return F.transform(F.array(value), use)[0]

"""Registered queries: name → (Spark plan over the test tables, DuckDB oracle SQL).

Every query reads the warehouse tables of one scale-factor directory and
runs on all of their rows. Column names are identical on both sides so the
correctness check can hash values order-insensitively.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None  # None: no SQL equivalent, rows-only check


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco

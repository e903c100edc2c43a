"""Access to the registered queries (filled by importing the plan modules)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog


def _load():
    # Importing the plan modules registers their queries in catalog.REGISTRY.
    from . import daily_plans, rolling_plans, topn_plans, misc_plans, source_plans, stream_plans  # noqa: F401
    return catalog.REGISTRY


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.build for k, q in _load().items()}


def all_sql() -> dict[str, str]:
    return {k: q.sql for k, q in _load().items() if q.sql is not None}

"""Bounded table of frequent names with an error bound (W5): a mergeable Misra-Gries summary.

A summary holds at most ``counters`` names. When it has more, the count of the
(counters + 1)-th largest is taken off all of them, and names at 0 leave; what was
taken off in all is the bound. So for every name

    count <= true count <= count + bound        (count 0 for a name that isn't there)

and the bound is at most rows / (counters + 1): a name with more rows than that is
in the table, whatever the order of the rows. Tasks summarise their rows; summaries
are merged ``FAN`` at a time, so a task never holds more than ``FAN`` of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

FAN = 64
_SCHEMA = "part long, name string, count long, off long"


def _cut(counts: pd.Series, counters: int) -> tuple[pd.Series, int]:
    """At most ``counters`` names, and what was taken off each."""
    if len(counts) <= counters:
        return counts, 0
    off = int(counts.nlargest(counters + 1).iloc[-1])
    left = counts - off
    return left[left > 0], off


def _rows(part: int, counts: pd.Series, off: int) -> pd.DataFrame:
    """A summary as rows: its names, and one row without a name that carries the bound."""
    names = pd.DataFrame({"part": part, "name": counts.index.astype(object), "count": counts.to_numpy(), "off": 0})
    return pd.concat([names, pd.DataFrame({"part": [part], "name": [None], "count": [0], "off": [off]})], ignore_index=True)


def _summarise(counters: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, off = pd.Series([], dtype="int64"), 0
        for batch in batches:
            counts = counts.add(batch.column(0).to_pandas().value_counts(), fill_value=0).astype("int64")
            if len(counts) > 4 * counters:
                counts, more = _cut(counts, counters)
                off += more
        counts, more = _cut(counts, counters)
        yield pa.RecordBatch.from_pandas(_rows(TaskContext.get().partitionId(), counts, off + more), schema=pa.schema(
            [("part", pa.int64()), ("name", pa.string()), ("count", pa.int64()), ("off", pa.int64())]), preserve_index=False)
    return emit


def _merge(counters: int) -> Callable:
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        counts, off = _cut(rows.dropna(subset=["name"]).groupby("name")["count"].sum(), counters)
        return _rows(int(rows["part"].iloc[0]), counts, off + int(rows["off"].sum()))
    return merge


def frequent_names(mentions: DataFrame, counters: int = 1000, name_col: str = "name") -> DataFrame:
    """``name, count, bound`` of the frequent names; mentions without a name are left out."""
    names = mentions.select(F.col(name_col).cast("string").alias("name")).filter("name is not null")
    parts, found = names.rdd.getNumPartitions(), names.mapInArrow(_summarise(counters), _SCHEMA)
    while True:
        parts = -(-parts // FAN)
        found = found.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInPandas(_merge(counters), _SCHEMA)
        if parts <= 1:
            break
    bound = found.agg(F.max("off").alias("bound"))
    return found.filter("name is not null").select("name", "count").crossJoin(F.broadcast(bound))

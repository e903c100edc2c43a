"""Running sums that carry their rows (W3, W4): one pass in order, no join back to the rows.

``carried_sums(df, group, order, value)`` gives every row the sum of ``value``
over its group up to itself (``cum``) and up to the end of its unit (``end``).
A unit is the rows of one (group, order), so that equal times count alike, or
with ``whole_groups`` the whole group, so that every row knows its group's total.

1. Rows are range-partitioned on (group, order, spread), so a hot group, and
   even a hot (group, order), is cut over many partitions, in order.
2. Each sorted partition is read once (``mapInArrow``). A unit's rows wait until
   it ends, ``WAIT`` rows at most; a larger unit, and the partition's last one,
   stay open: their rows go out without an end.
3. Aside go the sums of the partition's first and last group and of its first,
   last and open units: a few rows a partition. What earlier partitions add to a
   group, and later ones to a unit, are windows over these.
4. Rows and sums are written once, and the rows joined with the few sums, which
   the planner measures and broadcasts.

The rows' other columns pass through untouched. A null group is a group like
any other; rows without an order are not allowed. Writing once makes rows and
sums agree, as sampled range bounds may differ between two executions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import scratch_path
from .prefix import _partition_count

#: Rows of a unit that wait for its end.
WAIT = 1 << 18
_G, _O, _V, _KEEP = "_cs_group", "_cs_order", "_cs_value", "_cs_keep"
_STATE = ["_cs_pid", "_cs_cum", "_cs_end", "_cs_sum", "_cs_kind"]
ROW, GROUP, UNIT = "row", "group", "unit"


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; null is a value. The first row doesn't count."""
    codes, _ = pd.factorize(column.to_pandas(), use_na_sentinel=False)
    new = np.zeros(len(codes), dtype=bool)
    new[1:] = codes[1:] != codes[:-1]
    return new


def _same(a, b) -> bool:
    return a is None and b is None or a is not None and b is not None and a == b


class _Pass:
    """One partition, read in order. ``held`` are the rows of the unit that hasn't ended."""

    def __init__(self, names: list[str], whole_groups: bool, wait: int):
        self.names, self.whole, self.wait = names, whole_groups, wait
        self.held: list[pa.RecordBatch] = []
        self.waiting = 0
        self.pid = self.g = self.o = None  # partition, and key of the last row that went out
        self.sum = 0                       # of that row's group up to it
        self.open, self.open_sum = False, 0
        self.first_group = self.first_unit = True
        self.begun = False

    def _emit(self, rows: pa.Table, cum: np.ndarray, end: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(rows[_KEEP].to_numpy())
        if not len(at):
            return
        n, some = len(at), rows.take(pa.array(at)) if len(at) < len(rows) else rows
        sums = {"_cs_pid": pa.array(np.full(n, self.pid, np.int32)), "_cs_cum": pa.array(cum[at]), "_cs_end": pa.nulls(n, pa.int64()) if end is None else pa.array(end[at]),
                "_cs_sum": pa.nulls(n, pa.int64()), "_cs_kind": pa.array([ROW] * n)}
        yield from pa.table({**{c: some[c] for c in self.names}, **sums}).to_batches(max_chunksize=1 << 16)

    def _edge(self, kind: str, schema: pa.Schema, total: int, end: int) -> pa.RecordBatch:
        key = {_G: self.g, _O: self.o}
        cells = [pa.array([key.get(c)], type=schema.field(c).type) for c in self.names]
        return pa.RecordBatch.from_arrays([*cells, pa.array([self.pid], pa.int32()), pa.nulls(1, pa.int64()), pa.array([end], pa.int64()), pa.array([total], pa.int64()), pa.array([kind])],
                                          names=[*self.names, *_STATE])

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.held.append(batch)
        self.waiting += len(batch)
        yield from self._work(False)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.begun:
            yield from self._work(True)

    def _work(self, final: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(self.held)
        n = len(rows)
        if not n:
            if final:
                yield self._edge(UNIT, rows.schema, self.open_sum, self.sum)
                yield self._edge(GROUP, rows.schema, self.sum, self.sum)
            return
        g, o = rows[_G].combine_chunks(), rows[_O].combine_chunks()
        new_group = _changes(g)
        new_unit = new_group if self.whole else new_group | _changes(o)
        goes_on = self.begun and _same(g[0].as_py(), self.g)
        if not self.begun:
            self.pid, self.begun = rows["_cs_at"][0].as_py(), True
        elif not goes_on:
            # the group that went out before these rows has ended
            if self.open:
                yield self._edge(UNIT, rows.schema, self.open_sum, self.sum)
                self.open, self.first_unit = False, False
            if self.first_group:
                yield self._edge(GROUP, rows.schema, self.sum, self.sum)
                self.first_group = False
        if self.open and not self.whole and not _same(o[0].as_py(), self.o):
            yield self._edge(UNIT, rows.schema, self.open_sum, self.sum)
            self.open, self.first_unit = False, False
        v = rows[_V].to_numpy()
        total = np.cumsum(v)
        groups = np.flatnonzero(new_group)
        before = np.full(n, -self.sum if goes_on else 0, dtype=np.int64)  # what to take off the sum over all rows
        if len(groups):
            before[groups[0]:] = np.repeat(total[groups] - v[groups], np.diff(np.append(groups, n)))
        cum = total - before
        starts = np.concatenate([[0], np.flatnonzero(new_unit)])
        ends = np.append(starts[1:], n)
        last = int(starts[-1])
        head = 0
        if self.open:  # the first unit here is the rest of one whose rows have gone out
            head = int(ends[0])
            yield from self._emit(rows.slice(0, head), cum[:head], None)
            self.open_sum += int(v[:head].sum())
            self._went(g, o, cum, head - 1)
            if len(starts) > 1:
                yield self._edge(UNIT, rows.schema, self.open_sum, self.sum)
                self.open, self.first_unit = False, False
        if len(groups) and self.first_group:
            at = int(groups[0]) - 1
            self.g, self.o = g[at].as_py(), o[at].as_py()
            yield self._edge(GROUP, rows.schema, int(cum[at]), int(cum[at]))
            self.first_group = False
        if self.first_unit and head < last:
            at = int(ends[0]) - 1
            self.g, self.o = g[at].as_py(), o[at].as_py()
            yield self._edge(UNIT, rows.schema, int(v[:at + 1].sum()), int(cum[at]))
            self.first_unit = False
        if head < last:
            of = np.searchsorted(starts, np.arange(head, last), side="right") - 1
            yield from self._emit(rows.slice(head, last - head), cum[head:last], cum[ends[of] - 1])
            self._went(g, o, cum, last - 1)
        rest = rows.slice(max(head, last))
        if final or len(rest) > self.wait:
            if len(rest):
                if not self.open:
                    self.open_sum = 0
                yield from self._emit(rest, cum[n - len(rest):], None)
                self.open, self.open_sum = True, self.open_sum + int(v[n - len(rest):].sum())
                self._went(g, o, cum, n - 1)
            self.held, self.waiting = [pa.RecordBatch.from_pylist([], schema=rest.schema)], 0
            if final:
                yield self._edge(UNIT, rows.schema, self.open_sum, self.sum)
                yield self._edge(GROUP, rows.schema, self.sum, self.sum)
        else:
            self.held = rest.combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], schema=rest.schema)]
            self.waiting = len(rest)

    def _went(self, g: pa.Array, o: pa.Array, cum: np.ndarray, at: int) -> None:
        self.g, self.o, self.sum = g[at].as_py(), o[at].as_py(), int(cum[at])


def _kernel(names: list[str], whole_groups: bool, wait: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _Pass(names, whole_groups, wait)
        for batch in batches:
            if len(batch):
                yield from one.add(batch)
        yield from one.finish()
    return emit


def carried_sums(df: DataFrame, columns: list[str], group: Column, order: Column, value: Column, keep: Column | None = None,
                 whole_groups: bool = False, spread: Column | None = None, partitions: int | None = None) -> DataFrame:
    """``columns`` of the rows of ``df`` with ``keep``, with ``_cs_cum`` and ``_cs_end``.

    ``spread`` tells rows of one (group, order) apart, so that these can be cut over
    partitions too. Runs one job eagerly.
    """
    spark = df.sparkSession
    src = df.select(*[F.col(f"`{c}`") for c in columns], group.alias(_G), order.cast("long").alias(_O), value.cast("long").alias(_V), (F.lit(True) if keep is None else keep).alias(_KEEP),
                    (F.lit(0) if spread is None else spread).cast("long").alias("_cs_spread"))
    names = [*columns, _G, _O]
    sums = [T.StructField(c, T.LongType()) for c in _STATE[1:4]]
    body = T.StructType([*(T.StructField(f.name, f.dataType) for f in src.schema if f.name in names), T.StructField("_cs_pid", T.IntegerType()), *sums])
    dealt = (src.repartitionByRange(partitions or _partition_count(src), _G, _O, "_cs_spread").withColumn("_cs_at", F.spark_partition_id())
             .sortWithinPartitions(_G, _O, "_cs_spread"))
    path = scratch_path(spark, "carried-sums")
    (dealt.select(*[F.col(f"`{c}`") for c in names], _V, _KEEP, "_cs_at").mapInArrow(_kernel(names, whole_groups, WAIT), T.StructType([*body.fields, T.StructField("_cs_kind", T.StringType())]))
     .write.partitionBy("_cs_kind").parquet(path))

    def read(kind):
        return spark.read.schema(body).parquet(f"{path}/_cs_kind={kind}") if _exists(spark, f"{path}/_cs_kind={kind}") else spark.createDataFrame([], body)

    rows, groups, units = read(ROW), read(GROUP), read(UNIT)
    unit = [_G] if whole_groups else [_G, _O]
    earlier = Window.partitionBy(_G).orderBy("_cs_pid").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*unit).orderBy("_cs_pid").rowsBetween(1, Window.unboundedFollowing)
    # a few rows for each partition; the planner measures them and chooses the join
    before = groups.select(F.col("_cs_pid").alias("b_pid"), F.col(_G).alias("b_g"), F.sum("_cs_sum").over(earlier).alias("before")).filter("before is not null")
    after = units.select(F.col("_cs_pid").alias("u_pid"), F.col(_G).alias("u_g"), F.col(_O).alias("u_o"), (F.col("_cs_end") + F.coalesce(F.sum("_cs_sum").over(later), F.lit(0))).alias("ended"))
    same_unit = (F.col("_cs_pid") == F.col("u_pid")) & F.col(_G).eqNullSafe(F.col("u_g"))
    if not whole_groups:
        same_unit = same_unit & (F.col(_O) == F.col("u_o"))
    out = rows.join(before, (F.col("_cs_pid") == F.col("b_pid")) & F.col(_G).eqNullSafe(F.col("b_g")), "left").join(after, same_unit & F.col("_cs_end").isNull(), "left")
    carry = F.coalesce("before", F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in columns], (F.col("_cs_cum") + carry).alias("_cs_cum"), (F.coalesce("_cs_end", "ended") + carry).alias("_cs_end"))


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

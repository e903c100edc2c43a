"""Streaming rolling histogram (T1–T6, T10): per-name count over a trailing
horizon, published as a changelog.

``rolling_histogram`` keys the mention stream by name (and salt) and deals the
keys by hash to ``GROUPS`` groups. One ``StatefulProcessor`` per group
(``transformWithState``, RocksDB state, event-time timers) works through its keys:
each call of the state store is a message to the JVM, which costs more than the
counting of a key with few mentions, so a group reads and writes its keys' state
at once and has one timer, at the first of theirs. Only keys with live mentions
have state. Rows of Python cost more still, so the mentions reach the step packed,
a key's in one row (or one for each ``PACK_BYTES`` of a task), and a key's changes
of a batch leave it in one row (or one for each ``ROW_CHANGES``) and become rows of
the changelog in the JVM. A key's state:

* ``meta`` (value): the live count, the time up to which changes are emitted,
  the emitted-row sequence, the registered timer; and the live mentions
  themselves (sorted ms and multiplicities, packed int64) while there are at
  most ``INLINE``, so that a batch reads and writes one value for such a key;
* ``buckets`` (map: bucket id → the same for one ``BUCKET_MS`` of event time): the
  mentions of a key that has more; ``meta`` then holds the first and last ms and
  the size of every bucket. A value never has more than ``BUCKET_MS`` entries, and
  a batch reads and writes only the buckets that its mentions, and the expiries
  due with them, fall into. A key that shrinks to a quarter goes back to ``meta``.
  Mentions are typed numbers, never packed into strings (fork F15).

The changelog is the batch changelog (T7) of the key's mentions, row for row,
however the rows fall into files and micro-batches: changes are emitted in
time order, each as the number of mentions in (t − horizon, t]. At a time t
all mentions at t are added and all that expire at t leave; a row is emitted
if the two don't cancel. With no watermark delay rows arrive in time order (older
ones are dropped), so a batch emits everything up to its key's last mention;
with a delay, changes are held until the watermark has passed them. A timer
at the next pending time emits the rest as the watermark advances: a batch reads
the groups that its mentions and due changes fall into, never the whole store.

Rows are ``name, salt, count, ts, seq``; ``seq`` increases while a key has
state. A count that reaches 0 is emitted once and the key's state is cleared
(F14), after which ``seq`` starts anew: readers order by (batch, seq).

Mentions behind the watermark are dropped (F17). With ``count_late`` they are
counted where they are dropped: the changelog then also holds rows with a
number in ``late`` and nothing in ``count``, one for each key and batch that
dropped any. :func:`changes_only` and :func:`late_counts` tell the two kinds
apart; readers of the published changelog never see late rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.timefns import as_event_time
from ..operators.clean import clean_names
from ..schemas import LATE_FIELD, NAMES_POS
from ..session import materialize

HOUR_MS = 3_600_000
#: Event time that one state bucket covers.
BUCKET_MS = 60_000
#: Distinct times that a key keeps in one value.
INLINE = 1024
#: Groups that the keys are dealt to.
GROUPS = 8192
#: Bytes of mentions that a task packs at once.
PACK_BYTES = 1 << 24
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state(spark) -> None:
    """``transformWithState`` needs the RocksDB state store; switch to it when
    the session still has the default provider (a new query's checkpoint then
    records it)."""
    current = spark.conf.get(STATE_PROVIDER_KEY, None)
    if not current or "RocksDB" not in current:
        spark.conf.set(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)


#: Changes in one row that leaves the state step.
ROW_CHANGES = 10_000
_STEP = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("salt", T.IntegerType()),
    T.StructField("seq", T.LongType()),  # of the first change
    T.StructField("counts", T.ArrayType(T.LongType())),
    T.StructField("times", T.ArrayType(T.LongType())),  # ms
    LATE_FIELD,
])
_StepRow = Row(*_STEP.names)

_META = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("done", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("timer", T.LongType()),
    T.StructField("index", T.BinaryType()),
    T.StructField("inline", T.BinaryType()),
])
_BUCKET_KEY = T.StructType([T.StructField("id", T.LongType())])
_KEY = [T.StructField("name", T.StringType()), T.StructField("salt", T.IntegerType())]
_GROUP = T.StructType([
    T.StructField("timer", T.LongType()),
    T.StructField("keys", T.ArrayType(T.StructType([*_KEY, *_META.fields]))),
])
_GROUP_BUCKET_KEY = T.StructType([*_KEY, *_BUCKET_KEY.fields])
_BUCKET = T.StructType([
    T.StructField("ms", T.BinaryType()),
    T.StructField("n", T.BinaryType()),
])

_I64 = np.dtype("<i8")
_NEVER = -(1 << 62)


def _arr(b) -> np.ndarray:
    return np.frombuffer(bytes(b), dtype=_I64)


def _merge(ms: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ms in order, multiplicities added."""
    order = ms.argsort(kind="stable")
    ms, n = ms[order], n[order]
    new = np.empty(len(ms), dtype=bool)
    new[:1] = True
    np.not_equal(ms[1:], ms[:-1], out=new[1:])
    if new.all():
        return ms, n
    first = new.nonzero()[0]
    return ms[first], np.add.reduceat(n, first)


#: The one bucket of a key whose mentions are in ``meta``.
_ALL = 0


class _Key:
    """One key's state: ``meta`` at once, buckets as they are needed.

    While the mentions are in ``meta`` they are one bucket, whatever times they are of.
    """

    def __init__(self, meta, buckets, bucket_ms: int, most: int = INLINE):
        self._meta, self._buckets, self._bucket_ms, self._most = meta, buckets, bucket_ms, most
        self._held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._changed: set[int] = set()
        v = meta.get()
        self.exists = v is not None
        self.count, self.done, self.seq, self.timer = (int(x) for x in v[:4]) if v else (0, _NEVER, 0, -1)
        self.index: dict[int, tuple[int, int]] = {}  # bucket id: first ms, last ms
        self._sizes: dict[int, int] = {}
        self.inline = v is None or v[5] is not None
        if v is None:
            return
        if self.inline:
            self._place(_ALL, *_arr(v[5]).reshape(2, -1))
        else:
            for i, a, b, size in _arr(v[4]).reshape(-1, 4).tolist():
                self.index[i], self._sizes[i] = (a, b), size

    def _place(self, i: int, ms: np.ndarray, n: np.ndarray) -> None:
        self._held[i], self.index[i], self._sizes[i] = (ms, n), (int(ms[0]), int(ms[-1])), len(ms)

    def bucket(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self._held:
            v = self._buckets.getValue((i,)) if i in self.index and not self.inline else None
            self._held[i] = (_arr(v[0]), _arr(v[1])) if v is not None else (np.empty(0, _I64), np.empty(0, _I64))
        return self._held[i]

    def put(self, i: int, ms: np.ndarray, n: np.ndarray) -> None:
        self._changed.add(i)
        if len(ms):
            self._place(i, ms, n)
        else:
            self._held[i] = (ms, n)
            self.index.pop(i, None)
            self._sizes.pop(i, None)

    def between(self, after: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """The mentions with ``after < ms <= upto``."""
        found = [self.bucket(i) for i in sorted(i for i, (a, b) in self.index.items() if a <= upto and b > after)]
        if not found:
            return np.empty(0, _I64), np.empty(0, _I64)
        ms, n = found[0] if len(found) == 1 else map(np.concatenate, zip(*found))
        a, b = ms.searchsorted((after, upto), side="right")
        return ms[a:b], n[a:b]

    def first_after(self, t: int) -> int | None:
        """The first mention after ``t``."""
        later = [i for i, (_, b) in self.index.items() if b > t]
        if not later:
            return None
        ms, _ = self.bucket(min(later))
        return int(ms[np.searchsorted(ms, t, side="right")])

    def add(self, ms: np.ndarray) -> None:
        """Hold these mentions too."""
        ms, n = _merge(ms, np.ones(len(ms), dtype=_I64))
        for i, a, b in [(_ALL, 0, len(ms))] if self.inline else self._ranges(ms):
            old_ms, old_n = self.bucket(i)
            if len(old_ms):
                self.put(i, *_merge(np.concatenate([old_ms, ms[a:b]]), np.concatenate([old_n, n[a:b]])))
            else:
                self.put(i, ms[a:b], n[a:b])

    def _ranges(self, ms: np.ndarray) -> list[tuple[int, int, int]]:
        """Each bucket of these times, and where its times are."""
        ids, starts = np.unique(ms // self._bucket_ms, return_index=True)
        starts = starts.tolist()
        return list(zip(ids.tolist(), starts, [*starts[1:], len(ms)]))

    def save(self) -> None:
        was, total = self.inline, sum(self._sizes.values())
        self.inline = total <= (self._most if was else self._most // 4)
        if was and not self.inline:      # all of it moves to the map
            ms, n = self._held.pop(_ALL)
            self.index, self._sizes = {}, {}
            for i, a, b in self._ranges(ms):
                self._place(i, ms[a:b], n[a:b])
            touched = set(self.index)
        elif was:
            touched = set()
        elif self.inline:                # all of it leaves the map
            for i in self.index:
                self.bucket(i)
            touched = self._changed | set(self.index)
        else:
            touched = self._changed
        for i in touched:
            ms, n = self._held[i]
            if len(ms) and not self.inline:
                self._buckets.updateValue((i,), (ms.tobytes(), n.tobytes()))
            elif self._buckets.containsKey((i,)):
                self._buckets.removeKey((i,))
        if not self.index:
            if self.exists:
                self._meta.clear()
            return
        ids = sorted(self.index)
        index, inline = b"", None
        if self.inline:
            inline = np.concatenate([self._held[i][k] for k in (0, 1) for i in ids]).tobytes()
        else:
            index = np.array([(i, *self.index[i], self._sizes[i]) for i in ids], dtype=_I64).tobytes()
        self._meta.update((self.count, self.done, self.seq, self.timer, index, inline))


class RollingCountProcessor(StatefulProcessor):
    """Count of mentions of one key in (t − horizon, t], at every t where it changes."""

    def __init__(self, horizon_ms: int = HOUR_MS, in_order: bool = True, bucket_ms: int = BUCKET_MS, count_late: bool = False, inline: int = INLINE):
        self.horizon_ms = int(horizon_ms)
        self.in_order = bool(in_order)
        self.bucket_ms = int(bucket_ms)
        self.count_late = bool(count_late)
        self.inline = int(inline)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", _META)
        self.buckets = handle.getMapState("buckets", _BUCKET_KEY, _BUCKET)

    def _advance(self, k: _Key, limit: int, late: int = 0) -> tuple[np.ndarray, np.ndarray] | None:
        """Emit the changes in (done, limit]; ``late`` mentions are of a time already emitted."""
        h = self.horizon_ms
        if limit <= k.done and not late:
            return None
        add_ms, add_n = k.between(k.done, limit)
        out_ms, out_n = k.between(k.done - h if k.done > _NEVER else _NEVER, limit - h)
        times = np.concatenate([add_ms, out_ms + h])
        net = np.concatenate([add_n, -out_n])
        if late:
            times, net = np.append(times, k.done), np.append(net, late)
        t, d = _merge(times, net)
        counts = k.count + d.cumsum()
        if len(counts):
            k.count = int(counts[-1])
        k.done = max(k.done, limit)
        for i in [i for i, (a, _) in k.index.items() if a + h <= k.done]:
            ms, n = k.bucket(i)
            cut = int(ms.searchsorted(k.done - h, side="right"))
            k.put(i, ms[cut:], n[cut:])
        changed = d != 0
        return t[changed], counts[changed]

    def _schedule(self, k: _Key, fired: int | None = None) -> None:
        """One timer at the next pending time: a held mention, or the first expiry."""
        firsts = [a for a, _ in k.index.values()]
        pending = k.first_after(k.done)
        want = min([min(firsts) + self.horizon_ms] + ([pending] if pending is not None else [])) if firsts else -1
        if k.timer == want:
            return
        if k.timer >= 0 and k.timer != fired:
            self.handle.deleteTimer(k.timer)
        if want >= 0:
            self.handle.registerTimer(want)
        k.timer = want

    def _finish(self, key, k: _Key, changes, fired: int | None = None) -> Iterator[Row]:
        self._schedule(k, fired)
        first = k.seq + 1
        if changes is not None:
            k.seq += len(changes[0])
        k.save()
        for a in range(0, k.seq + 1 - first, ROW_CHANGES):
            times, counts = (x[a:a + ROW_CHANGES].tolist() for x in changes)
            yield _StepRow(key[0], key[1], first + a, counts, times, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self.add(key, np.fromiter((r["ms"] for r in rows), dtype=_I64), timerValues)

    def add(self, key, ms: np.ndarray, timerValues) -> Iterator[Row]:
        """Count the mentions of a key that a batch brings."""
        if ms.size == 0:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        late = int((ms < watermark).sum())
        if late and self.count_late:
            yield _StepRow(key[0], key[1], None, None, None, late)
        ms = ms[ms >= watermark]  # Spark's own filter of late rows lags one batch behind
        if ms.size == 0:
            return
        k = _Key(self.meta, self.buckets, self.bucket_ms, self.inline)
        late = int((ms <= k.done).sum())  # the emitted time itself: several rows of one ms in two batches
        k.add(ms)
        limit = int(ms.max()) if self.in_order else watermark
        yield from self._finish(key, k, self._advance(k, limit, late))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.expire(key, expiredTimerInfo.getExpiryTimeInMs(), timerValues)

    def expire(self, key, fired: int, timerValues) -> Iterator[Row]:
        """Emit what is due at the key's timer."""
        k = _Key(self.meta, self.buckets, self.bucket_ms, self.inline)
        if not k.exists:
            return
        if k.timer == fired:
            k.timer = -1
        limit = max(fired, timerValues.getCurrentWatermarkInMs())
        yield from self._finish(key, k, self._advance(k, limit), fired)

    def close(self) -> None:
        pass


class _Part:
    """A key's part of its group's state: the value, the map and the timers of its processor."""

    def __init__(self, buckets):
        self._buckets = buckets
        self.key, self.values = None, {}

    def get(self):
        return self.values.get(self.key)

    def update(self, value) -> None:
        self.values[self.key] = value

    def clear(self) -> None:
        self.values.pop(self.key, None)

    def getValue(self, k):
        return self._buckets.getValue((*self.key, *k))

    def updateValue(self, k, value) -> None:
        self._buckets.updateValue((*self.key, *k), value)

    def containsKey(self, k) -> bool:
        return self._buckets.containsKey((*self.key, *k))

    def removeKey(self, k) -> None:
        self._buckets.removeKey((*self.key, *k))

    def registerTimer(self, t: int) -> None:
        """The key's value holds its timer; the group has one for all."""

    deleteTimer = registerTimer


_TIMER = _META.names.index("timer")


class GroupProcessor(StatefulProcessor):
    """Runs the processor of one key for each key of a group, on rows ``group, name, salt, ms`` (packed)."""

    def __init__(self, each: RollingCountProcessor):
        self.each = each

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = handle.getValueState("keys", _GROUP)
        self.use(handle.getMapState("buckets", _GROUP_BUCKET_KEY, _BUCKET))

    def use(self, buckets) -> None:
        self.part = self.each.meta = self.each.buckets = self.each.handle = _Part(buckets)

    def _load(self) -> int:
        """Read the group's state; its timer."""
        v = self.keys.get()
        self.exists = v is not None
        self.part.values = {(x[0], x[1]): tuple(x[2:]) for x in v[1]} if v else {}
        return int(v[0]) if v else -1

    def _due(self, timerValues) -> Iterator[Row]:
        """The changes of the keys whose timers the watermark has reached."""
        watermark = timerValues.getCurrentWatermarkInMs()
        for key, t in [(k, x[_TIMER]) for k, x in self.part.values.items() if 0 <= x[_TIMER] <= watermark]:
            self.part.key = key
            yield from self.each.expire(key, t, timerValues)

    def _save(self, timer: int, fired: int | None = None) -> None:
        values = self.part.values
        want = min((x[_TIMER] for x in values.values() if x[_TIMER] >= 0), default=-1)
        if want != timer:
            if timer >= 0 and timer != fired:
                self.handle.deleteTimer(timer)
            if want >= 0:
                self.handle.registerTimer(want)
        if values:
            self.keys.update((want, [(*k, *x) for k, x in values.items()]))
        elif self.exists:
            self.keys.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mentions: dict[tuple, list[bytes]] = {}
        for _, name, salt, ms in rows:
            mentions.setdefault((name, salt), []).append(ms)
        timer = self._load()
        for k, ms in mentions.items():
            self.part.key = k
            yield from self.each.add(k, _arr(b"".join(ms)), timerValues)
        yield from self._due(timerValues)
        self._save(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timer = self._load()
        yield from self._due(timerValues)
        self._save(timer, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def stream_mentions(records: DataFrame, value_col: str = "value", ts_col: str = "timestamp",
                    per_record: str = "mentions", stop_substrings: Sequence[str] = ()) -> DataFrame:
    """Record stream (key, value, timestamp) → mention stream (name, ts).

    Splits the line on tabs, keeps records with more than 23 fields (P3),
    and cleans the name list with the stream's defaults: every mention counts
    (F1) and no noise filter (F9). Blank names are dropped (F4, F5).
    """
    fields = F.split(F.col(value_col), "\t", -1)
    # JVM split drops trailing empty fields: a line has more than NAMES_POS
    # fields exactly when one from there on isn't empty.
    shaped = (records.select(fields.alias("f"), F.col(ts_col).alias("ts"))
              .filter(F.exists(F.slice("f", NAMES_POS + 1, F.greatest(F.size("f") - NAMES_POS, F.lit(0))), lambda x: x != ""))
              .select(F.col("f").getItem(NAMES_POS).alias("AllNames"), "ts"))
    return clean_names(shaped, "AllNames", None, per_record, stop_substrings, keep=("ts",))


def salt_plan(names: DataFrame, share: float = 1 / 64, name_col: str = "name") -> DataFrame:
    """``name, salts`` of the names that hold more than ``share`` of all rows.

    A name gets as many salts as shares it holds, so no state key has much more
    than ``share`` of the rows. At most ``1 / share`` names qualify, however large
    the table is. ``names`` is read once, here: a stream joins the plan in each
    micro-batch, and its written size tells the planner to broadcast it.
    """
    counts = materialize(names.groupBy(F.col(name_col).alias("name")).agg(F.count(F.lit(1)).alias("n")), "name-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    plan = counts.filter(F.col("n") > share * total).select("name", F.ceil(F.col("n") / (share * max(total, 1))).cast("int").alias("salts"))
    return materialize(plan.coalesce(1), "salt-plan")


def _local_salts(share: float, least: int):
    """Salts of the rows of names that hold much of an Arrow batch; all others have 0."""
    most = max(1, int(1 / share))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            code, names = pd.factorize(batch.column(0).to_pandas(), use_na_sentinel=False)
            n = np.bincount(code, minlength=len(names))
            limit = max(least, int(share * len(batch)))
            salts = np.where(n > limit, np.minimum(most, -(-n // limit)), 1)
            ms = batch.column(2).to_numpy()
            # equal (name, ms) stay together; where a name's salts begin differs from batch to batch
            salt = np.where(salts[code] > 1, (ms % salts[code] + task + 7 * number) % most, 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(salt.astype(np.int32))], names=[*batch.schema.names, "salt"])
    return emit


def _packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row for each key: its ms as int64 in one binary value."""
    keys = pa.Table.from_batches(held).group_by(["group", "name", "salt"], use_threads=False).aggregate([("ms", "list")]).combine_chunks()
    lists = keys["ms_list"].chunk(0)
    ends = pa.py_buffer(lists.offsets.to_numpy() * np.int32(_I64.itemsize))
    values = pa.py_buffer(np.ascontiguousarray(lists.values.to_numpy(), dtype=_I64))
    ms = pa.Array.from_buffers(pa.binary(), len(lists), [None, ends, values])
    return pa.RecordBatch.from_arrays([*(keys[c].chunk(0) for c in ("group", "name", "salt")), ms], names=["group", "name", "salt", "ms"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PACK_BYTES:
            yield _packed(held)
            held, size = [], 0
    if held:
        yield _packed(held)


def rolling_histogram(mentions: DataFrame, horizon_ms: int = HOUR_MS, watermark: str = "0 seconds",
                      name_col: str = "name", ts_col: str = "ts", salts: int = 1,
                      hot: DataFrame | Sequence[str] | None = None, bucket_ms: int = BUCKET_MS,
                      inline: int = INLINE, count_late: bool = False, spread_above: float | None = None, spread_least: int = 100,
                      groups: int = GROUPS) -> DataFrame:
    """Changelog ``name, salt, count, ts, seq`` of the per-name rolling count.

    ``mentions`` may be streaming or batch; ``ts`` of any timestamp type
    (converted to an instant through UTC epoch values); a mention without a time is
    in no window. Mentions are shuffled by the group of their state key and packed,
    and the packed rows, far fewer, are shuffled to the state step. ``groups`` trades
    calls of the state store against what a call reads and writes; it is fixed for
    the life of a checkpoint.

    Hot names: a name with ``S`` salts is spread over S state keys (and tasks)
    by hash(name, ms) mod S; equal (name, ms) mentions stay together and collapse
    into one multiplicity entry. Without ``hot`` every name has ``salts``. ``hot``
    is a table ``name, salts`` (see :func:`salt_plan`; without a ``salts`` column,
    or as a list of names, each has ``salts``); names that aren't in it keep one key. It is
    joined to the stream as a table, whatever its size. Each row's ``count`` is the
    partial count of its (name, salt);
    :func:`trendlens.operators.topn.fold_changelog` and the top-N consumer
    sum the latest partial of every salt. Without salting every row carries
    the name's total.

    Without a table, ``spread_above`` finds hot names as they come: in each Arrow batch
    of a task, a name with more than this share of its rows (``spread_least`` at
    least) gets as many salts as shares. No table, version or agreement between
    tasks is needed, since the sum of the partial counts is right however the
    mentions are dealt: when a name cools down, its other keys drain as their
    mentions expire. A key gets about ``spread_above`` of the rows, or twice that.

    ``count_late`` adds the column ``late`` and the rows that count dropped
    mentions. The state step sees every row and drops the late ones itself: Spark's
    own filter, which lags a batch behind and doesn't say what it drops, has no
    event-time column to work on.
    """
    spark = mentions.sparkSession
    if spread_above and (hot is not None or salts != 1):
        raise ValueError("give either spread_above, or salts and hot")
    ensure_rocksdb_state(spark)
    ev = as_event_time(mentions, ts_col)
    src = mentions.select(F.col(name_col).alias("name"), ev.alias("event_time")).withColumn("ms", F.unix_millis("event_time"))
    if spread_above:
        src = src.mapInArrow(_local_salts(spread_above, spread_least), "name string, event_time timestamp, ms long, salt int")
    src = src.withWatermark("event_time", watermark)
    parts = F.lit(int(salts))
    if hot is not None:
        if not isinstance(hot, DataFrame):
            hot = spark.createDataFrame([(x,) for x in hot], "name string")
        if "salts" not in hot.columns:
            hot = hot.select("name", F.lit(int(salts)).alias("salts"))
        plan = hot.groupBy(F.col("name").alias("hot_name")).agg(F.max("salts").alias("salts"))
        src = src.join(plan, F.col("name") == F.col("hot_name"), "left")
        parts = F.coalesce(F.col("salts"), F.lit(1))
    salt = F.col("salt") if spread_above else F.pmod(F.xxhash64(F.col("name"), F.col("ms")), parts).cast("int")
    in_order = not re.search(r"[1-9]", watermark)  # no delay: every row is after what has been emitted
    keyed = src.filter("ms is not null").select("name", salt.alias("salt"), "ms")
    group = F.pmod(F.xxhash64("name", "salt"), F.lit(int(groups))).cast("int")
    packed = (keyed.select(group.alias("group"), "name", "salt", "ms").repartition("group")
              .mapInArrow(_pack, "group int, name string, salt int, ms binary"))
    step = packed.groupBy("group").transformWithState(
        statefulProcessor=GroupProcessor(RollingCountProcessor(horizon_ms, in_order, bucket_ms, count_late, inline)),
        outputStructType=_STEP,
        outputMode="Append",
        timeMode="EventTime")
    # a row that counts late mentions has no changes
    changes = step.select("name", "salt", "seq", "late", F.posexplode_outer(F.arrays_zip("counts", "times")).alias("at", "change"))
    return changes.select("name", "salt", F.col("change.counts").alias("count"), F.timestamp_millis("change.times").alias("ts"),
                          (F.col("seq") + F.col("at")).alias("seq"), *(["late"] if count_late else []))


def changes_only(rows: DataFrame) -> DataFrame:
    """The changes of a changelog that also counts late mentions."""
    return rows.filter("late is null").drop("late")


def late_counts(rows: DataFrame, *by: str) -> DataFrame:
    """``by, late``: the dropped mentions of a changelog with ``count_late``, say by ``batch`` or ``name``."""
    return rows.filter("late is not null").groupBy(*by).agg(F.sum("late").alias("late"))

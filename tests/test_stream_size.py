"""What grows with a stream's size: the wait for its end, calls of the state store, rows of Python, readings of the log."""

import numpy as np
import pyarrow as pa
import pytest
from test_state_step import HOUR, Map, Now, Timers, Value, brute
from test_streaming import brute_changelog, emitted, histogram_of, write_files

from trendlens.operators.topn import fold_changelog
from trendlens.schemas import MENTION_SCHEMA
from trendlens.streaming import histogram
from trendlens.streaming.histogram import GroupProcessor, RollingCountProcessor, rolling_histogram, salt_plan
from trendlens.streaming.runner import await_done, stream_table_files, write_batches
from trendlens.streaming.state import live_histogram


class LongQuery:
    """Works for an hour; a wait with a limit ends before."""

    def __init__(self):
        self.isActive, self.stopped = True, False

    def awaitTermination(self, timeout=None):
        self.isActive = timeout is not None and timeout < 3600

    def stop(self):
        self.isActive, self.stopped = False, True

    def exception(self):
        return None


def test_a_stream_that_still_works_is_waited_for():
    q = LongQuery()
    await_done(q, "long")
    assert not q.stopped and not q.isActive
    q = LongQuery()
    with pytest.raises(TimeoutError):
        await_done(q, "long", 5)
    assert q.stopped


def pack(*ms):
    return np.array(ms, dtype="<i8").tobytes()


def changes(rows, into):
    for r in rows:
        into.setdefault((r.name, r.salt), []).extend(zip(r.times, r.counts))


@pytest.mark.parametrize("inline", [1024, 8, 0])
def test_a_group_calls_the_store_once_for_all_its_keys(inline):
    rng = np.random.default_rng(3)
    keys = [(f"n{i}", i % 3) for i in range(200)] + [(None, 0)]
    ms = {k: np.sort(rng.integers(0, 6 * HOUR, 30)) for k in keys}
    p = GroupProcessor(RollingCountProcessor(HOUR, inline=inline))
    p.keys, p.handle = Value(), Timers()
    p.use(buckets := Map())
    got, watermark = {}, 0
    for a in range(0, 6 * HOUR, 3 * HOUR):
        part = {k: x[(x >= a) & (x < a + 3 * HOUR)] for k, x in ms.items()}
        rows = [(7, *k, pack(*half)) for k, x in part.items() for half in (x[::2], x[1::2]) if len(half)]
        reads, writes = p.keys.reads, p.keys.writes
        changes(p.handleInputRows((7,), iter(rows), Now(watermark)), got)
        assert (p.keys.reads - reads, p.keys.writes - writes, len(p.handle.at)) == (1, 1, 1)
        watermark = max(int(x.max()) for x in part.values() if len(x))
    end = 8 * HOUR
    while p.handle.at:
        t = min(p.handle.at)
        p.handle.at.discard(t)
        changes(p.handleExpiredTimer((7,), Now(end), Now(t)), got)
    assert got == {k: brute(x.tolist()) for k, x in ms.items()}
    assert p.keys.value is None and not buckets


def test_a_key_reaches_the_step_in_one_row():
    names = ["a", "b", None, "a", "hot", "hot", "hot"]
    schema = pa.schema([("group", pa.int32()), ("name", pa.string()), ("salt", pa.int32()), ("ms", pa.int64())])
    batches = [pa.record_batch([[1] * 7, names, [0, 0, 0, 1, 0, 0, 0], list(range(t, t + 7))], schema=schema) for t in (0, 100)] + [pa.record_batch([[], [], [], []], schema=schema)]
    (out,) = histogram._pack(iter(batches))
    got = {(r["group"], r["name"], r["salt"]): np.frombuffer(r["ms"], "<i8").tolist() for r in out.to_pylist()}
    assert out.num_rows == 5
    assert got == {(1, "a", 0): [0, 100], (1, "b", 0): [1, 101], (1, None, 0): [2, 102], (1, "a", 1): [3, 103], (1, "hot", 0): [4, 5, 6, 104, 105, 106]}
    assert list(histogram._pack(iter(batches[2:]))) == []


def test_packing_is_bounded(monkeypatch):
    monkeypatch.setattr(histogram, "PACK_BYTES", 1)
    schema = pa.schema([("group", pa.int32()), ("name", pa.string()), ("salt", pa.int32()), ("ms", pa.int64())])
    out = list(histogram._pack(iter([pa.record_batch([[1], ["a"], [0], [t]], schema=schema) for t in range(5)])))
    assert [np.frombuffer(r["ms"], "<i8").tolist() for b in out for r in b.to_pylist()] == [[t] for t in range(5)]


def test_few_groups_hold_many_names(spark, tmp_path):
    # 60 names in 4 groups over 3 batches, one of them with more mentions than a value holds
    rows = sorted([(f"n{i % 60}", 37 * i) for i in range(240)] + [("hot", 5 * i) for i in range(1800)], key=lambda r: r[1])
    d = str(tmp_path / "in")
    write_files(d, [[r for r in rows if r[1] // 3000 == k] for k in range(3)])
    ch = histogram_of(spark, d, groups=4, inline=8)
    last = max(s for _, s in rows)
    assert emitted(ch) == brute_changelog(rows, 3600, last)
    ck = str(tmp_path / "ck")
    write_batches(rolling_histogram(stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1), groups=4, inline=8), str(tmp_path / "out"), ck).awaitTermination(300)
    state = spark.read.format("statestore").option("stateVarName", "keys").load(ck)
    assert state.count() <= 4
    want = {r["name"]: r["count"] for r in fold_changelog(ch).collect()}
    assert {r["name"]: r["count"] for r in live_histogram(spark, ck).collect()} == want


def test_the_salt_plan_does_not_read_the_log_again(spark, tmp_path):
    log = str(tmp_path / "log")
    spark.createDataFrame([("a",)] * 90 + [(f"n{i}",) for i in range(10)], "name string").write.parquet(log)
    plan = salt_plan(spark.read.parquet(log), 1 / 4)
    assert plan.inputFiles() and not [f for f in plan.inputFiles() if log in f]
    assert [tuple(r) for r in plan.collect()] == [("a", 4)]

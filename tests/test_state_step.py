"""The state step by itself: what a key costs, and its changes against brute force."""

import numpy as np
import pytest

from trendlens.streaming.histogram import RollingCountProcessor

HOUR = 3_600_000


class Value:
    value = None
    reads = writes = 0

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.writes += 1
        self.value = value

    def clear(self):
        self.value = None


class Map(dict):
    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def containsKey(self, key):
        return key in self

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class Timers:
    def __init__(self):
        self.at = set()

    def registerTimer(self, t):
        self.at.add(t)

    def deleteTimer(self, t):
        self.at.discard(t)


class Now:
    def __init__(self, t):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: t


def processor(**kw):
    p = RollingCountProcessor(HOUR, **kw)
    p.meta, p.buckets, p.handle = Value(), Map(), Timers()
    return p


def feed(p, batches, end):
    """(time, count, seq) of the changes of one key."""
    got, watermark = [], 0
    for ms in batches:
        out = list(p.handleInputRows(("a", 0), iter([{"ms": int(x)} for x in ms]), Now(watermark)))
        for t in sorted(t for t in p.handle.at if t <= watermark):
            p.handle.at.discard(t)
            out += p.handleExpiredTimer(("a", 0), Now(watermark), Now(t))
        got += [x for r in out for x in zip(r.times, r.counts, range(r.seq, r.seq + len(r.times)))]
        watermark = max(watermark, int(max(ms)))
    for _ in range(10_000):
        due = sorted(t for t in p.handle.at if t <= end)
        if not due:
            return got
        p.handle.at.discard(due[0])
        for r in p.handleExpiredTimer(("a", 0), Now(end), Now(due[0])):
            got += zip(r.times, r.counts, range(r.seq, r.seq + len(r.times)))


def brute(ms):
    net = {}
    for x in ms:
        net[x] = net.get(x, 0) + 1
        net[x + HOUR] = net.get(x + HOUR, 0) - 1
    count, out = 0, []
    for t in sorted(net):
        count += net[t]
        if net[t]:
            out.append((t, count))
    return out


def test_a_batch_of_a_key_is_one_row_and_one_value():
    p = processor()
    rows = [{"ms": 60_000 * i} for i in range(30)]
    (out,) = p.handleInputRows(("a", 0), iter(rows), Now(0))
    assert out.times == [60_000 * i for i in range(30)] and out.counts == list(range(1, 31)) and out.seq == 1 and out.late is None
    assert (p.meta.reads, p.meta.writes, p.buckets.calls) == (1, 1, 0)


@pytest.mark.parametrize("inline, bucket_ms", [(1024, 60_000), (8, 60_000), (8, 1), (40, 7_200_000), (0, 60_000)])
@pytest.mark.parametrize("span", [200, 4 * HOUR, 400 * HOUR])
def test_changes_equal_brute_force(inline, bucket_ms, span):
    rng = np.random.default_rng(span + inline)
    ms = np.sort(rng.integers(0, span, 240))
    cuts = [np.searchsorted(ms, span * i // 4) for i in range(5)]
    p = processor(inline=inline, bucket_ms=bucket_ms)
    got = feed(p, [ms[a:b].tolist() for a, b in zip(cuts, cuts[1:])], 500 * HOUR)
    assert [x[:2] for x in got] == brute(ms.tolist())
    assert p.meta.value is None and not p.buckets


def test_many_changes_leave_in_several_rows(monkeypatch):
    from trendlens.streaming import histogram
    monkeypatch.setattr(histogram, "ROW_CHANGES", 7)
    out = list(processor().handleInputRows(("a", 0), iter([{"ms": i} for i in range(30)]), Now(0)))
    assert [len(r.times) for r in out] == [7, 7, 7, 7, 2] and [r.seq for r in out] == [1, 8, 15, 22, 29]

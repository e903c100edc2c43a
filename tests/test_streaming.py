"""Streaming rolling histogram (T1–T6, T10, F14, F15, F17) on file streams."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from conftest import record_line
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from trendlens.operators.topn import fold_changelog
from trendlens.schemas import MENTION_SCHEMA
from trendlens.streaming import topn
from trendlens.streaming.histogram import BUCKET_MS, HOUR_MS, changes_only, late_counts, rolling_histogram, salt_plan, stream_mentions
from trendlens.streaming.runner import (changelog_from_messages, changelog_messages, publish_batch, published_changelog, run_available,
                                        stream_table_files, write_batches)
from trendlens.streaming.state import live_histogram
from trendlens.streaming.topn import apply_messages, join_at, read_messages, read_snapshot, read_top, snapshots, top_n_sink, top_n_stream

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def write_files(directory, batches):
    """One parquet file per batch of (name, seconds); file times increase."""
    os.makedirs(directory, exist_ok=True)
    for i, rows in enumerate(batches):
        pdf = pd.DataFrame({"name": [n for n, _ in rows],
                            "ts": pd.to_datetime([at(s) for _, s in rows], utc=True)})
        path = os.path.join(directory, f"part-{i:04d}.parquet")
        pdf.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def histogram_of(spark, directory, horizon_ms=HOUR_MS, per_trigger=1, salts=1, hot=None, watermark="0 seconds",
                 bucket_ms=BUCKET_MS, **more):
    stream = stream_table_files(spark, directory, "*.parquet", MENTION_SCHEMA, per_trigger)
    return run_available(rolling_histogram(stream, horizon_ms, watermark, salts=salts, hot=hot,
                                           bucket_ms=bucket_ms, **more), "test-hist")


def brute_changelog(rows, horizon_s, upto_s):
    """T7 by hand: the count in (t - h, t] at every t where adds and expiries don't cancel."""
    out = set()
    for name in {n for n, _ in rows}:
        mine = [s for n, s in rows if n == name]
        for t in sorted({x for s in mine for x in (s, s + horizon_s)}):
            if t <= upto_s and mine.count(t) != mine.count(t - horizon_s):
                out.add((name, t, sum(t - horizon_s < s <= t for s in mine)))
    return out


def emitted(changes):
    rows = [(r["name"], (r["ts"].replace(tzinfo=None) - T0.replace(tzinfo=None)).total_seconds(), r["count"])
            for r in changes.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sequences(changes):
    rows = changes.orderBy("name", "batch", "seq").collect()
    out = {}
    for r in rows:
        out.setdefault(r["name"], []).append(r["count"])
    return out


def test_golden_single_batch(spark, tmp_path):
    # SURVEY §4.4: a@0, b@0, a@1s, a@30m, c@1h0.5s, a@1h0.4s, c@2h, c@4h in one file.
    d = str(tmp_path / "in")
    write_files(d, [[("a", 0), ("b", 0), ("a", 1), ("a", 1800), ("c", 3600.5), ("a", 3600.4),
                     ("c", 7200), ("c", 14400)]])
    seq = sequences(histogram_of(spark, d))
    assert seq == {"a": [1, 2, 3, 2, 3, 2, 1, 0], "b": [1, 0], "c": [1, 2, 1, 0, 1]}


def test_expired_before_added_across_batches(spark, tmp_path):
    # At a@1h45m the watermark (1h30m) has expired a@0 and a@30m: they leave
    # first, so the addition is emitted with the count of (45m, 1h45m].
    d = str(tmp_path / "in")
    write_files(d, [[("a", 0)], [("a", 1800)], [("b", 5400)], [("a", 6300)]])
    ch = histogram_of(spark, d)
    assert sequences(ch) == {"a": [1, 2, 1, 0, 1], "b": [1]}
    exp = ch.filter(F.col("name") == "a").orderBy("batch", "seq").select("ts").collect()
    assert [r[0].replace(tzinfo=None) - T0.replace(tzinfo=None) for r in exp] == [
        dt.timedelta(0), dt.timedelta(minutes=30), dt.timedelta(hours=1),
        dt.timedelta(minutes=90), dt.timedelta(minutes=105)]


def brute_final(rows, horizon_s, watermark_s):
    live = {}
    for n, s in rows:
        live.setdefault(n, 0)
        if s + horizon_s > watermark_s:
            live[n] += 1
    return live


@pytest.mark.parametrize("files, bucket_ms, inline", [(1, BUCKET_MS, 1024), (8, BUCKET_MS, 0), (8, 1000, 8), (3, 10_000_000, 0), (8, BUCKET_MS, 40)])
def test_changelog_equals_batch_for_any_batching(spark, tmp_path, files, bucket_ms, inline):
    rnd = random.Random(7)
    names = ["n0", "n1", "n2", "hot"]
    rows = sorted(((rnd.choice(names + ["hot"] * 4), rnd.randrange(0, 4 * 3600)) for _ in range(400)),
                  key=lambda r: r[1])
    size = -(-len(rows) // files)
    cuts = [rows[i:i + size] for i in range(0, len(rows), size)]
    for a, b in zip(cuts[:-1], cuts[1:]):  # rows of a batch's last time belong to that batch
        while b and b[0][1] == a[-1][1]:
            a.append(b.pop(0))
    d = str(tmp_path / "in")
    write_files(d, cuts)
    ch = histogram_of(spark, d, horizon_ms=600_000, bucket_ms=bucket_ms, inline=inline)
    last = max(s for _, s in rows)
    assert emitted(ch) == brute_changelog(rows, 600, last)
    final = {r["name"]: r["count"] for r in fold_changelog(ch, keep_zero=True).collect()}
    assert final == brute_final(rows, 600, last)


def test_changelog_with_a_delay_holds_back_until_the_watermark(spark, tmp_path):
    # Rows come up to 10 minutes out of order; what is emitted is final: T7 up to the watermark.
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), s) for s in range(0, 7200, 40)]
    mixed = sorted(rows, key=lambda r: r[1] + rnd.randrange(0, 500))
    d = str(tmp_path / "in")
    write_files(d, [mixed[i:i + 30] for i in range(0, len(mixed), 30)])
    ch = histogram_of(spark, d, horizon_ms=900_000, watermark="10 minutes")
    last = max(s for _, s in rows) - 600
    assert emitted(ch) == brute_changelog(rows, 900, last)


def test_salted_hot_name_sums_to_the_same_counts(spark, tmp_path):
    # A name with most of the mentions is spread over 4 state keys; the
    # folded totals equal the unsalted ones.
    rnd = random.Random(11)
    rows = sorted(((("hot" if rnd.random() < 0.7 else f"n{rnd.randrange(5)}"), rnd.randrange(0, 3 * 3600))
                   for _ in range(300)), key=lambda r: r[1])
    d = str(tmp_path / "in")
    write_files(d, [rows[i:i + 100] for i in range(0, len(rows), 100)])
    expected = brute_final(rows, 900, max(s for _, s in rows))
    ch = histogram_of(spark, d, horizon_ms=900_000, salts=4)
    assert ch.filter(F.col("name") == "hot").select("salt").distinct().count() == 4
    final = {r["name"]: r["count"] for r in fold_changelog(ch, keep_zero=True).collect()}
    assert final == expected
    # Only the listed hot names are spread; the others keep salt 0.
    hot = spark.createDataFrame([("hot",)], "name string")
    ch = histogram_of(spark, d, horizon_ms=900_000, salts=4, hot=hot)
    salts = {(r["name"], r["salt"]) for r in ch.select("name", "salt").distinct().collect()}
    assert {s for n, s in salts if n == "hot"} == {0, 1, 2, 3}
    assert {s for n, s in salts if n != "hot"} == {0}
    final = {r["name"]: r["count"] for r in fold_changelog(ch, keep_zero=True).collect()}
    assert final == expected


def test_every_hot_name_is_spread(spark, tmp_path):
    # Sixty hot names, more than any list bound: each is spread over all of its salts, the cold one isn't.
    rows = sorted([(f"h{k}", 60 * i + k) for k in range(60) for i in range(90)] + [("cold", 7000 + i) for i in range(20)], key=lambda r: r[1])
    d = str(tmp_path / "in")
    write_files(d, [rows])
    hot = spark.createDataFrame([(f"h{k}", 2 + k % 3) for k in range(60)], "name string, salts int")
    ch = histogram_of(spark, d, hot=hot)
    got = {}
    for r in ch.select("name", "salt").distinct().collect():
        got.setdefault(r["name"], set()).add(r["salt"])
    assert got == {f"h{k}": set(range(2 + k % 3)) for k in range(60)} | {"cold": {0}}


def test_salt_plan_bounds_each_key(spark):
    names = spark.createDataFrame([("a",)] * 500 + [("b",)] * 100 + [(f"n{i}",) for i in range(400)], "name string")
    plan = {r["name"]: r["salts"] for r in salt_plan(names, 1 / 20).collect()}
    assert plan == {"a": 10, "b": 2}
    assert salt_plan(names.limit(0)).collect() == []


def test_late_rows_are_dropped(spark, tmp_path):
    # after a batch at 2h the watermark is 2h; a@0 arrives later and is dropped.
    d = str(tmp_path / "in")
    write_files(d, [[("a", 7200)], [("a", 0), ("b", 7300)]])
    stream = stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1)
    out = str(tmp_path / "out")
    q = write_batches(rolling_histogram(stream, HOUR_MS), out, str(tmp_path / "ck"))
    q.awaitTermination(300)
    assert q.exception() is None
    final = {r["name"]: r["count"] for r in fold_changelog(spark.read.parquet(out), keep_zero=True).collect()}
    assert final == {"a": 1, "b": 1}


def test_pipe_in_name_is_its_own_key(spark, tmp_path):
    # a name containing "|" is counted and expired under its own key.
    d = str(tmp_path / "in")
    write_files(d, [[("a|b", 0), ("a", 10), ("a|b", 20)], [("x", 4000)]])
    seq = sequences(histogram_of(spark, d))
    assert seq["a|b"] == [1, 2, 1, 0]
    assert seq["a"] == [1, 0]


def test_restart_from_checkpoint(spark, tmp_path):
    rows = [("a", 0), ("b", 60), ("a", 1200), ("b", 3000), ("a", 4000), ("c", 4100), ("a", 5000)]
    d = str(tmp_path / "in")
    write_files(d, [rows[:3], rows[3:5]])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1)
        q = write_batches(rolling_histogram(stream, HOUR_MS), out, ck)
        q.awaitTermination(300)

    run()
    pdf = pd.DataFrame({"name": [n for n, _ in rows[5:]],
                        "ts": pd.to_datetime([at(s) for _, s in rows[5:]], utc=True)})
    path = os.path.join(d, "part-0002.parquet")
    pdf.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    os.utime(path, (1_700_000_100, 1_700_000_100))
    run()
    ch = spark.read.parquet(out)
    final = {r["name"]: r["count"] for r in fold_changelog(ch, keep_zero=True).collect()}
    assert final == brute_final(rows, 3600, 5000)


def test_stream_mentions_keeps_every_mention(spark):
    lines = [record_line(names="A,5;B,7;A,9;Type ParentCategory,3;"),
             record_line(names="C,1", fields=20)]
    recs = spark.createDataFrame([(str(i), v, at(i)) for i, v in enumerate(lines)],
                                 "key string, value string, timestamp timestamp")
    got = sorted(r["name"] for r in stream_mentions(recs).collect())
    # No per-record distinct (F1), no noise filter (F9), short records dropped.
    assert got == ["A", "A", "B", "Type ParentCategory"]


def test_top_n_delta_messages(spark, tmp_path):
    # Top-2 per batch; leavers get 0; a batch without change sends nothing.
    d = str(tmp_path / "in")
    write_files(d, [[("a", 0), ("a", 10), ("b", 20)], [("c", 30), ("c", 40), ("c", 50)], [("x", 7200)]])
    stream = stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1)
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    write_batches(rolling_histogram(stream, HOUR_MS), log, str(tmp_path / "ck1")).awaitTermination(300)
    for batch in sorted(os.listdir(log)):  # the consumer's batches are the transformer's
        if batch.startswith("batch="):
            b = int(batch.split("=")[1])
            top_n_sink(out, 2)(spark.read.parquet(log).filter(F.col("batch") == b), b)
    msgs = spark.read.text(f"{out}/messages").orderBy("batch").collect()
    assert [(r["batch"], r["value"]) for r in msgs] == [
        (0, '[{"name":"a","count":2},{"name":"b","count":1}]'),
        (1, '[{"name":"b","count":0},{"name":"c","count":3}]'),
        (3, '[{"name":"a","count":0},{"name":"c","count":0},{"name":"x","count":1}]'),
    ]
    assert [tuple(r) for r in read_top(spark, out).collect()] == [("x", 1)]
    assert [tuple(r) for r in apply_messages(read_messages(spark, out)).collect()] == [("x", 1)]
    assert [tuple(r) for r in read_snapshot(spark, out).collect()] == [(3, "x", 1)]


def _changes(spark, rows):
    return spark.createDataFrame([(n, 0, c, T0, q, b) for n, c, q, b in rows],
                                 "name string, salt int, count long, ts timestamp, seq long, batch long")


def versions(out):
    return {int(x.split("=")[1]) for x in os.listdir(f"{out}/hist") if x.startswith("v=")}


def test_replayed_batch_gives_the_same_table(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 10)
    sink(_changes(spark, [("a", 5, 1, 0)]), 0)
    for _ in range(3):  # the engine may run a batch again before it is committed
        sink(_changes(spark, [("b", 4, 1, 1)]), 1)
        assert sorted(tuple(r) for r in read_top(spark, out).collect()) == [("a", 5), ("b", 4)]
    sink(_changes(spark, [("a", 0, 2, 2)]), 2)
    assert [tuple(r) for r in read_top(spark, out).collect()] == [("b", 4)]
    assert versions(out) == {0, 1, 2}  # those of the last two manifests
    sink(_changes(spark, [("c", 1, 1, 3)]), 3)
    assert versions(out) == {1, 2, 3}


def test_a_name_that_comes_back_counts(spark, tmp_path):
    # seq starts anew after a 0: the batch says which row is the latest.
    out = str(tmp_path / "out")
    top_n_sink(out, 10)(_changes(spark, [("a", 1, 1, 0), ("a", 2, 2, 0), ("a", 0, 3, 1), ("a", 1, 1, 2)]), 0)
    assert [tuple(r) for r in read_top(spark, out).collect()] == [("a", 1)]


def test_fold_needs_its_order_columns(spark):
    with pytest.raises(ValueError, match="batch"):
        fold_changelog(_changes(spark, [("a", 1, 1, 0)]).drop("batch"))


def test_messages_carry_what_the_consumer_reads(spark, tmp_path):
    # K4 → S11 → T8: salted partial counts, as messages and back.
    rows = spark.createDataFrame([("a", s, c, T0, 1, 0) for s, c in ((0, 2), (1, 3))] + [("b", 0, 4, T0, 1, 0)],
                                 "name string, salt int, count long, ts timestamp, seq long, batch long")
    messages = changelog_messages(rows)
    assert messages.columns == ["key", "value"]
    back = changelog_from_messages(messages)
    assert sorted(back.collect()) == sorted(rows.select(*back.columns).collect())
    out = str(tmp_path / "out")
    top_n_sink(out, 5)(back, 0)
    assert [tuple(r) for r in read_top(spark, out).orderBy("name").collect()] == [("a", 5), ("b", 4)]


def test_retained_messages_and_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 5, retain=2)
    for b in range(4):
        sink(_changes(spark, [(f"n{b}", b + 1, 1, b)]), b)
    assert sorted(x for x in os.listdir(f"{out}/messages") if x.startswith("batch=")) == ["batch=2", "batch=3"]
    assert {(r["name"], r["count"]) for r in read_snapshot(spark, out).collect()} == {(f"n{b}", b + 1) for b in range(4)}


def fold(batches, upto, n):
    """The exact top n after the batches so far: the newest row of each (name, salt), salts summed."""
    last = {}
    for b in batches[:upto + 1]:
        for name, salt, count, seq, batch in b:
            if (name, salt) not in last or (batch, seq) >= last[name, salt][0]:
                last[name, salt] = ((batch, seq), count)
    total = {}
    for (name, _), (_, count) in last.items():
        total[name] = total.get(name, 0) + count
    return sorted(((n, c) for n, c in total.items() if c), key=lambda x: (-x[1], x[0]))[:n]


def random_batches(seed, names=60, batches=12):
    r = random.Random(seed)
    out, seq = [], 0
    for b in range(batches):
        rows = []
        for _ in range(r.choice([0, 3, 25])):
            seq += 1
            decay = b > batches // 2  # most names shrink: the candidates run out
            rows.append((f"n{r.randrange(names)}", r.randrange(2), 0 if r.random() < (0.6 if decay else 0.1) else r.randrange(1, 5 if decay else 30), seq, b))
        out.append(rows)
    # some rows come a batch late, after newer ones of their key
    for b in range(1, batches):
        if out[b - 1] and r.random() < 0.5:
            out[b].append(out[b - 1].pop(0))
    return out


def _published(spark, rows):
    return spark.createDataFrame([(n, s, c, T0, q, b) for n, s, c, q, b in rows], "name string, salt int, count long, ts timestamp, seq long, batch long")


@pytest.mark.parametrize("seed", [1, 2])
def test_candidates_give_the_exact_top_after_every_batch(spark, tmp_path, seed):
    out, n = str(tmp_path / "out"), 5
    sink = top_n_sink(out, n, candidates=8, buckets=8, refresh_every=100)
    batches = random_batches(seed)
    for b, rows in enumerate(batches):
        sink(_published(spark, rows), b)
        assert sorted(map(tuple, read_top(spark, out).collect())) == sorted(fold(batches, b, n))
    manifest = topn._manifest(spark, out, len(batches) - 1)
    assert (seed != 1 or manifest["refreshes"]) and manifest["refreshes"] < len(batches) // 2  # only when the candidates can't decide
    assert [tuple(r) for r in join_at(spark, out).orderBy(F.desc("count"), "name").collect()] == fold(batches, len(batches) - 1, n)


def test_every_join_point_ends_alike(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 4, buckets=4)
    batches = random_batches(7, names=12, batches=6)
    for b, rows in enumerate(batches):
        sink(_published(spark, rows), b)
    want = sorted(fold(batches, 5, 4))
    assert snapshots(spark, out) == list(range(6))
    for b in range(6):
        assert sorted(map(tuple, join_at(spark, out, b).collect())) == want


def test_a_refresh_on_its_interval(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 1, candidates=2, buckets=4, refresh_every=3)
    for b in range(8):
        sink(_published(spark, [(f"n{i}", 0, 10 + i + b, b + 1, b) for i in range(6)]), b)
    assert topn._manifest(spark, out, 7)["refreshes"] >= 2


def bucket_files(out):
    return {os.path.relpath(d, out) for d, _, names in os.walk(f"{out}/hist") if any(x.endswith(".parquet") for x in names)}


def test_a_batch_writes_the_changed_buckets_only(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 5, buckets=32)
    sink(_published(spark, [(f"n{i}", 0, 1 + i % 7, 1, 0) for i in range(2000)]), 0)
    assert len(bucket_files(out)) == 32
    sink(_published(spark, [("n5", 0, 50, 2, 1)]), 1)
    new = {x for x in bucket_files(out) if x.startswith("hist/v=1")}
    assert len(new) == 1 and ("n5", 50) in set(map(tuple, read_top(spark, out).collect()))
    size = lambda v: sum(os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(f"{out}/hist/v={v}") for x in names)
    assert size(1) < size(0) / 10


def test_a_batch_that_fails_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 5, buckets=4)
    sink(_changes(spark, [("a", 5, 1, 0)]), 0)
    commit = topn._commit
    monkeypatch.setattr(topn, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sink(_changes(spark, [("b", 9, 1, 1)]), 1)
    assert [tuple(r) for r in read_top(spark, out).collect()] == [("a", 5)]
    assert {tuple(r) for r in apply_messages(read_messages(spark, out)).collect()} == {("a", 5)}
    monkeypatch.setattr(topn, "_commit", commit)
    sink(_changes(spark, [("b", 9, 1, 1)]), 1)
    assert sorted(tuple(r) for r in read_top(spark, out).collect()) == [("a", 5), ("b", 9)]


def test_an_older_row_in_a_later_batch_loses(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = top_n_sink(out, 5)
    sink(_changes(spark, [("a", 7, 4, 3), ("b", 0, 2, 3)]), 0)
    sink(_changes(spark, [("a", 2, 9, 1), ("b", 5, 1, 2)]), 1)
    assert [tuple(r) for r in read_top(spark, out).collect()] == [("a", 7)]


def test_late_rows_are_counted(spark, tmp_path):
    # after a batch at 2h the watermark is 2h; two mentions of a and one of b come too late.
    d = str(tmp_path / "in")
    write_files(d, [[("a", 7200)], [("a", 0), ("a", 10), ("b", 20), ("b", 7300)], [("c", 7250), ("a", 7400)]])
    stream = stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1)
    out = str(tmp_path / "out")
    write_batches(rolling_histogram(stream, HOUR_MS, count_late=True), out, str(tmp_path / "ck")).awaitTermination(300)
    rows = spark.read.parquet(out)
    assert sorted(map(tuple, late_counts(rows, "batch", "name").collect())) == [(1, "a", 2), (1, "b", 1), (2, "c", 1)]
    final = {r["name"]: r["count"] for r in fold_changelog(changes_only(rows), keep_zero=True).collect()}
    assert final == {"a": 2, "b": 1}
    # readers of the published changelog don't see the late rows
    top = str(tmp_path / "top")
    top_n_stream(published_changelog(spark, out), top, str(tmp_path / "ck2"), 5).awaitTermination(300)
    assert sorted(map(tuple, read_top(spark, top).collect())) == [("a", 2), ("b", 1)]


def test_hot_names_are_spread_as_they_come(spark, tmp_path):
    # hot in the first files, cold in the last: its keys drain, and the counts are those of the batch changelog.
    rows = [("hot", i) for i in range(0, 1500)] + [(f"c{i % 40}", i) for i in range(0, 1500, 5)]
    later = [("hot", 1500 + 40 * i) for i in range(60)] + [(f"c{i % 40}", 1500 + i) for i in range(0, 2400, 6)]
    rows, later = sorted(rows, key=lambda r: r[1]), sorted(later, key=lambda r: r[1])
    d = str(tmp_path / "in")
    write_files(d, [rows, later, [("x", 9000)]])
    ch = histogram_of(spark, d, spread_above=1 / 8, spread_least=50)
    salts = {}
    for r in ch.select("name", "salt").distinct().collect():
        salts.setdefault(r["name"], set()).add(r["salt"])
    assert len(salts["hot"]) > 3 and all(s == {0} for n, s in salts.items() if n != "hot")
    # the sum of the partial counts at every time equals the batch changelog
    want = {(t, c) for n, t, c in brute_changelog(rows + later + [("x", 9000)], 3600, 9000) if n == "hot"}
    partial, got = {}, {}
    for r in ch.filter("name = 'hot'").withColumn("ms", F.unix_millis("ts")).orderBy("ms", "batch", "seq").collect():
        partial[r["salt"]] = r["count"]
        got[(r["ts"].replace(tzinfo=None) - T0.replace(tzinfo=None)).total_seconds()] = sum(partial.values())
    assert all(got[t] == c for t, c in want) and len(want) > 1500


def test_live_histogram_from_the_state_store(spark, tmp_path):
    d = str(tmp_path / "in")
    write_files(d, [[("a", 0), ("a", 10), ("b", 20)], [("c", 3500), ("a", 3601)], [("d", 3605)]])
    stream = stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1)
    write_batches(rolling_histogram(stream, HOUR_MS), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(300)
    want = {r["name"]: r["count"] for r in fold_changelog(spark.read.parquet(str(tmp_path / "out"))).collect()}
    assert {r["name"]: r["count"] for r in live_histogram(spark, str(tmp_path / "ck")).collect()} == want == {"a": 2, "b": 1, "c": 1, "d": 1}


def test_batches_of_two_queries_do_not_mix(spark, tmp_path):
    d, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(d, [[("a", 0)]])
    stream = stream_table_files(spark, d, "*.parquet", MENTION_SCHEMA, 1)
    write_batches(stream, out, str(tmp_path / "ck1")).awaitTermination(300)
    q = write_batches(stream, out, str(tmp_path / "ck2"))
    with pytest.raises(StreamingQueryException, match="another query"):
        q.awaitTermination(300)
    assert spark.read.parquet(out).count() == 1


def test_a_published_batch_is_left_alone(spark, tmp_path):
    out = str(tmp_path / "log")
    publish_batch(spark.range(3), out, 0)
    files = sorted(os.listdir(f"{out}/batch=0"))
    publish_batch(spark.range(3), out, 0)
    assert sorted(os.listdir(f"{out}/batch=0")) == files and spark.read.parquet(out).count() == 3

"""The runnable jobs end to end: batch daily top-k, and producer → transformer → consumer."""

import glob
import io
import os
import zipfile

from conftest import record_line

from trendlens.jobs import consumer, daily_top_k, producer, transformer
from trendlens.streaming.topn import apply_messages, read_messages, read_top


def test_daily_job_json_and_text(spark, tmp_path, write_lines):
    src = write_lines("records.tsv", [
        record_line(date="20150218230000", names="A,1;B,2;A,3"),
        record_line(date="20150218231500", names="A,1;C,2"),
        record_line(date="20150219000000", names="C,5"),
        record_line(date="bad", names="A,1"),
    ])
    out = str(tmp_path / "json")
    daily_top_k(spark, src, out, k=1, single_file=True)
    (part,) = glob.glob(f"{out}/part-*")
    assert open(part).read().splitlines() == [
        '{"data":"2015-02-18","result":[{"topic":"A","count":2}]}',
        '{"data":"2015-02-19","result":[{"topic":"C","count":1}]}']
    txt = str(tmp_path / "text")
    daily_top_k(spark, src, txt, k=2, ties="row_number", reader="text", output="text", single_file=True)
    (part,) = glob.glob(f"{txt}/part-*")
    assert open(part).read().splitlines() == ["(2015-02-18,List((A,2),(B,1)))", "(2015-02-19,List((C,1)))"]


def _segment(directory, stamp, names):
    lines = [record_line(date=stamp, names=n, rid=f"{stamp}-{i}") for i, n in enumerate(names)]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr(f"{stamp}.gkg.csv", "\n".join(lines) + "\n")
    path = os.path.join(directory, f"{stamp}.gkg.csv.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_producer_transformer_consumer_chain(spark, tmp_path):
    seg = str(tmp_path / "segments")
    os.makedirs(seg)
    _segment(seg, "20150218230000", ["A,1;B,2", "A,3", "C,4", "A,5;C,6"])
    _segment(seg, "20150218231500", ["B,1", "A,2"])
    log, changes, out = (str(tmp_path / d) for d in ("log", "changes", "out"))
    # Each stage runs on what the previous one has written.
    for start in (lambda: producer(spark, seg, log, str(tmp_path / "ck1")),
                  lambda: transformer(spark, log, changes, str(tmp_path / "ck2")),
                  lambda: consumer(spark, changes, out, str(tmp_path / "ck3"), n=2)):
        q = start()
        q.awaitTermination(300)
        assert q.exception() is None
    # All six records lie within one hour: A 4, B 2, C 2; top-2 breaks the tie by name.
    assert sorted(tuple(r) for r in read_top(spark, out).collect()) == [("A", 4), ("B", 2)]
    assert sorted(tuple(r) for r in apply_messages(read_messages(spark, out)).collect()) == [("A", 4), ("B", 2)]


def test_a_name_that_left_and_came_back_is_in_the_top(spark, tmp_path):
    # A@01:00, A@01:01, then B@04:00, then A@05:00 and B@05:00; one consumer run over all of it.
    seg = str(tmp_path / "segments")
    os.makedirs(seg)
    log, changes, out = (str(tmp_path / d) for d in ("log", "changes", "out"))
    for stamp, names in (("20150218010000", ["A,1", "A,1"]), ("20150218040000", ["B,1"]), ("20150218050000", ["A,1", "B,1"])):
        _segment(seg, stamp, names)
        producer(spark, seg, log, str(tmp_path / "ck1")).awaitTermination(300)
        transformer(spark, log, changes, str(tmp_path / "ck2")).awaitTermination(300)
    q = consumer(spark, changes, out, str(tmp_path / "ck3"))
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted(tuple(r) for r in read_top(spark, out).collect()) == [("A", 1), ("B", 1)]

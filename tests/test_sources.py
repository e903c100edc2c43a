"""Sources and sinks: S3–S6, S8–S10, S12, K1–K3, K5, P6–P9, A2."""

import datetime as dt
import glob
import io
import os
import tracemalloc
import zipfile

from pyspark.sql import functions as F

from trendlens.operators.daily import daily_result
from trendlens.operators.sensor import readings_at, readings_at_sql, readings_at_text
from trendlens.sinks.writers import publish_records, read_key, write_daily, write_daily_text
from trendlens.sources.records import (read_daily, read_zipped_segments, segment_records,
                                       segments_from_index, stream_segments)
from trendlens.sources.segments import follow_segments, listing, read_segments, segment_batches, write_segments
from trendlens.sources.sensor import numbered_letters, read_sensor, read_sensor_text
from trendlens.streaming.runner import run_available, stream_records, write_batches

UTC = dt.timezone.utc

# Typed in from the handout: the first ten readings of the sensor file and the
# other nine sensors' readings at 3/10/14:1:01.
SENSOR_LINES = """\
COHUTTA,3/10/14:1:01,10.27,1.73,881,1.56,85,1.94
COHUTTA,3/10/14:1:02,9.67,1.731,882,0.52,87,1.79
COHUTTA,3/10/14:1:03,10.47,1.732,882,1.7,92,0.66
COHUTTA,3/10/14:1:05,9.56,1.734,883,1.35,99,0.68
COHUTTA,3/10/14:1:06,9.74,1.736,884,1.27,92,0.73
COHUTTA,3/10/14:1:08,10.44,1.737,885,1.34,93,1.54
COHUTTA,3/10/14:1:09,9.83,1.738,885,0.06,76,1.44
COHUTTA,3/10/14:1:11,10.49,1.739,886,1.51,81,1.83
COHUTTA,3/10/14:1:12,9.79,1.739,886,1.74,82,1.91
COHUTTA,3/10/14:1:13,10.02,1.739,886,1.24,86,1.79
LAGNAPPE,3/10/14:1:01,9.59,1.602,777,0.09,88,1.78
NANTAHALLA,3/10/14:1:01,10.47,1.712,778,1.96,76,0.78
CHER,3/10/14:1:01,10.17,1.653,777,1.89,96,1.57
THERMALITO,3/10/14:1:01,10.24,1.75,777,1.25,80,0.89
ANDOUILLE,3/10/14:1:01,10.26,1.048,777,1.88,94,1.66
BUTTE,3/10/14:1:01,10.12,1.379,777,1.58,83,0.67
MOJO,3/10/14:1:01,10.47,1.828,967,0.36,77,1.75
CARGO,3/10/14:1:01,9.93,1.903,778,0.55,76,1.44
BBKING,3/10/14:1:01,10.03,0.839,967,1.17,80,1.28
"""
AT_0101 = {("COHUTTA", 10.27, 881), ("LAGNAPPE", 9.59, 777), ("NANTAHALLA", 10.47, 778),
           ("CHER", 10.17, 777), ("THERMALITO", 10.24, 777), ("ANDOUILLE", 10.26, 777),
           ("BUTTE", 10.12, 777), ("MOJO", 10.47, 967), ("CARGO", 9.93, 778), ("BBKING", 10.03, 967)}
TS = dt.datetime(2014, 3, 10, 1, 1, tzinfo=UTC)


def test_sensor_csv_and_timestamp_filters(spark, tmp_path):
    path = tmp_path / "sensordata.csv"
    path.write_text(SENSOR_LINES)
    df = read_sensor(spark, str(path))
    assert df.count() == 19 and df.filter(F.col("timestamp").isNull()).count() == 0
    for hit in (readings_at(df, TS), readings_at_sql(spark, df, TS),
                df.filter("timestamp = TIMESTAMP '2014-03-10 01:01:00'")):
        assert {(r["sensorname"], r["numA"], r["numC"]) for r in hit.collect()} == AT_0101
    # P6 is a column predicate, so it reaches the scan.
    plan = readings_at(df, TS)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), EqualTo(timestamp" in plan
    # The same filter on raw lines, reading several files at once.
    other = tmp_path / "more.csv"
    other.write_text("ZZZ,3/10/14:1:01,1,1,1,1,1,1\n")
    lines = read_sensor_text(spark, str(path), str(other))
    assert readings_at_text(lines, "3/10/14:1:01").count() == 11


def test_letter_sums(spark):
    # S5 + A2: i = 1..200000 in 4 slices, letters a..z repeating; sum per letter.
    # Fixed values from the handout's output.
    expected = {"a": 769276921, "b": 769284614, "c": 769292307, "d": 769300000, "e": 769307693,
                "f": 769315386, "g": 769323079, "h": 769330772, "i": 769138464, "j": 769146156,
                "k": 769153848, "l": 769161540, "m": 769169232, "n": 769176924, "o": 769184616,
                "p": 769192308, "q": 769200000, "r": 769207692, "s": 769215384, "t": 769223076,
                "u": 769230768, "v": 769238460, "w": 769246152, "x": 769253844, "y": 769261536,
                "z": 769269228}
    df = numbered_letters(spark, 200_000, 4)
    assert df.rdd.getNumPartitions() == 4
    got = {r["letter"]: r["s"] for r in df.groupBy("letter").agg(F.sum("i").alias("s")).collect()}
    assert got == expected


def _zip_segment(directory, stamp, lines, junk=b""):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr(f"{stamp}.gkg.csv", "\n".join(lines).encode() + junk + b"\n")
    path = os.path.join(directory, f"{stamp}.gkg.csv.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    return path


def _segment_lines(stamp, n):
    return [f"{stamp}-{i}\t{stamp}\tx" for i in range(n)]


def test_zipped_segments_and_event_time_spread(spark, tmp_path):
    d = str(tmp_path / "seg")
    os.makedirs(d)
    _zip_segment(d, "20150218230000", _segment_lines("20150218230000", 4), junk=b"\xff\xfe")
    # A line separator inside a field does not end a line; \r\n does.
    _zip_segment(d, "20150218231500", ["20150218231500-0\t20150218231500\tx\u2028y\r",
                                        "20150218231500-1\t20150218231500\tx"])
    lines = read_zipped_segments(spark, f"{d}/*.zip", layout=True)
    assert lines.count() == 6
    recs = {r["key"]: r["timestamp"].astimezone(UTC).strftime("%H:%M:%S")
            for r in segment_records(lines).collect()}
    # 4 lines starting 23:00 → 23:00:00, 23:03:45, 23:07:30, 23:11:15.
    assert recs == {"20150218230000-0": "23:00:00", "20150218230000-1": "23:03:45",
                    "20150218230000-2": "23:07:30", "20150218230000-3": "23:11:15",
                    "20150218231500-0": "23:15:00", "20150218231500-1": "23:22:30"}
    # The same segments as a stream, one file per micro-batch.
    out = run_available(segment_records(stream_segments(spark, d)), "segments")
    assert out.select("batch").distinct().count() == 2
    assert {r["key"] for r in out.collect()} == set(recs)


def test_segments_from_index(spark, tmp_path):
    idx = tmp_path / "index.txt"
    idx.write_text("\n".join([
        "s3://archive/v2/gkg/20150218230000.gkg.csv",
        "s3://archive/v2/gkg/20150218231500.gkg.csv",
        "s3://archive/v2/events/20150218231500.export.csv",
        "s3://archive/v2/gkg/20150218233000.gkg.csv",
    ]) + "\n")
    got = segments_from_index(spark, str(idx), end="20150218231500").orderBy("stamp").collect()
    assert [(r["stamp"], r["file"]) for r in got] == [
        ("20150218230000", "20150218230000.gkg.csv"), ("20150218231500", "20150218231500.gkg.csv")]


def test_daily_json_and_text_round_trip(spark, tmp_path):
    names = spark.createDataFrame(
        [(dt.date(2015, 2, 18), "A"), (dt.date(2015, 2, 18), "A"), (dt.date(2015, 2, 18), "B"),
         (dt.date(2015, 2, 19), "C")], "DATE date, name string")
    res = daily_result(names)
    out = str(tmp_path / "json")
    write_daily(res, out, single_file=True)
    files = glob.glob(f"{out}/part-*")
    assert len(files) == 1
    text = sorted(open(files[0]).read().splitlines())
    assert text == ['{"data":"2015-02-18","result":[{"topic":"A","count":2},{"topic":"B","count":1}]}',
                    '{"data":"2015-02-19","result":[{"topic":"C","count":1}]}']
    back = read_daily(spark, out).orderBy("data").collect()
    assert [(r["data"], [tuple(x) for x in r["result"]]) for r in back] == [
        (dt.date(2015, 2, 18), [("A", 2), ("B", 1)]), (dt.date(2015, 2, 19), [("C", 1)])]
    txt = str(tmp_path / "text")
    write_daily_text(res, txt)
    lines = sorted(r["value"] for r in spark.read.text(txt).collect())
    assert lines == ["(2015-02-18,List((A,2),(B,1)))", "(2015-02-19,List((C,1)))"]


def test_publish_then_stream_records(spark, tmp_path):
    log = str(tmp_path / "log")
    t = dt.datetime(2015, 2, 18, 23, 0, tzinfo=UTC)
    for i in range(2):
        df = spark.createDataFrame([(f"r{i}", f"line {i}", t + dt.timedelta(minutes=i))],
                                   "key string, value string, timestamp timestamp")
        publish_records(df, log)
    got = run_available(stream_records(spark, log), "records")
    assert sorted(r["key"] for r in got.collect()) == ["r0", "r1"]


def _zip_lines(directory, name, lines):
    with zipfile.ZipFile(os.path.join(directory, f"{name}.gkg.csv.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        with z.open(f"{name}.gkg.csv", "w") as f:
            for line in lines:
                f.write(line if isinstance(line, bytes) else f"{line}\n".encode())


def test_data_source_gives_the_lines_of_the_whole_files(spark, tmp_path):
    d = str(tmp_path)
    _zip_lines(d, "20150218230000", ["a\tb", "c\rd", "é x", b"bad \xff\xfe byte\r\n", "", "last"])
    _zip_lines(d, "20150218231500", [])
    _zip_lines(d, "20150218233000", [f"{i}\tx" for i in range(1000)])
    with zipfile.ZipFile(os.path.join(d, "20150218234500.gkg.csv.zip"), "w"):
        pass  # a zip without entries
    want = read_zipped_segments(spark, f"{d}/*.zip", layout=True, whole_files=True)
    got = read_segments(spark, d, layout=True, partition_bytes=1)
    name = F.substring_index("path", "/", -1).alias("segment")
    rows = lambda df: sorted(map(tuple, df.select(name, "line_no", "value", "n_lines", "first_id").collect()))
    assert rows(got) == rows(want) and got.rdd.getNumPartitions() == 4
    cut = read_segments(spark, d, start="20150218231500", end="20150218233000")
    assert {r[0] for r in cut.select(name).distinct().collect()} == {"20150218233000.gkg.csv.zip"}


def test_segments_are_read_in_bounded_batches(tmp_path):
    # 40 MB of lines: no batch is much larger than its bound, and the reader holds one at a time
    d = str(tmp_path)
    _zip_lines(d, "20150218230000", [f"{i}\t" + "x" * 400 for i in range(100_000)])
    path = listing(d)[0][0]
    tracemalloc.start()
    n = chars = 0
    for batch in segment_batches(path, True):
        n += len(batch)
        chars = max(chars, sum(map(len, batch.column(2).to_pylist())))
        assert batch.column(3)[0].as_py() == 100_000 and batch.column(4)[0].as_py() == "0"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 100_000 and chars < 2 << 20 and peak < 24 << 20


def test_stream_follows_the_last_name(spark, tmp_path):
    d, out, ck = str(tmp_path / "seg"), str(tmp_path / "out"), str(tmp_path / "ck")
    os.makedirs(d)

    def run():
        write_batches(segment_records(follow_segments(spark, d)), out, ck).awaitTermination(300)
        return sorted(r["key"] for r in spark.read.parquet(out).collect())

    _zip_segment(d, "20150218230000", _segment_lines("20150218230000", 2))
    assert run() == ["20150218230000-0", "20150218230000-1"]
    _zip_segment(d, "20150218231500", _segment_lines("20150218231500", 1))
    _zip_segment(d, "20150218224500", _segment_lines("20150218224500", 1))  # named before the last one: not new
    assert run() == ["20150218230000-0", "20150218230000-1", "20150218231500-0"]
    assert len(run()) == 3


def test_written_segments_are_read_back(spark, tmp_path):
    rows = spark.createDataFrame([(f"2015021823{m}00.gkg.csv", i, f"{m}-{i}\té") for m in ("00", "15") for i in range(50)], "segment string, line_no long, value string")
    assert {r["lines"] for r in write_segments(rows.repartition(4), str(tmp_path / "z")).collect()} == {50}
    got = read_segments(spark, str(tmp_path / "z"))
    assert sorted(r["value"] for r in got.collect()) == sorted(r["value"] for r in rows.collect())
    assert got.filter("path like '%2300%' and line_no = 7").first()["value"] == "00-7\té"


def test_keyed_log_reads_one_bucket(spark, tmp_path):
    path = str(tmp_path / "log")
    for half in (0, 1):
        rows = [(f"k{i % 20}" if i % 21 else None, f"v{i}", dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(minutes=(7 * i) % 200)) for i in range(100 * half, 100 * half + 100)]
        publish_records(spark.createDataFrame(rows, "key string, value string, timestamp timestamp"), path, buckets=8)
    got = read_key(spark, path, "k3", 8)
    want = [f"v{i}" for i in sorted((i for i in range(200) if i % 20 == 3 and i % 21), key=lambda i: (7 * i) % 200)]
    assert [r["value"] for r in got.collect()] == want
    files = set(got.inputFiles())
    assert files and len({f.split("/")[-2] for f in files}) == 8  # what the log has
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert sorted(r["value"] for r in stream_records_batch(spark, path)) == sorted(f"v{i}" for i in range(200))


def stream_records_batch(spark, path):
    return run_available(stream_records(spark, path).select("key", "value", "timestamp"), "keyed-log").collect()

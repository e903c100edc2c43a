"""One test per semantic fork F1–F11 on hand-made records."""

import datetime as dt

import pytest
from conftest import record_line
from pyspark.sql import functions as F

from trendlens.operators.clean import clean_names
from trendlens.operators.daily import daily_counts, daily_lists, to_result_schema, top_k_daily
from trendlens.operators.metrics import reject_counts
from trendlens.sources.records import read_records, read_records_text

DAY = dt.date(2015, 2, 18)


def counts_of(spark, path, reader="csv", **kw):
    rec = read_records(spark, path) if reader == "csv" else read_records_text(spark, path)
    names = clean_names(rec, **kw)
    return {(r["DATE"], r["name"]): r["count"] for r in daily_counts(names).collect()}


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_f1_repeated_name_once_per_record(spark, write_lines, reader):
    p = write_lines("f1.tsv", [record_line(names="A,5;B,7;A,9")])
    assert counts_of(spark, p, reader) == {(DAY, "A"): 1, (DAY, "B"): 1}
    assert counts_of(spark, p, reader, per_record="mentions") == {(DAY, "A"): 2, (DAY, "B"): 1}


def test_f2_ties_at_rank_k(spark, write_lines):
    names = ";".join(f"N{chr(97 + i)},1" for i in range(12))
    p = write_lines("f2.tsv", [record_line(names=names)])
    c = daily_counts(clean_names(read_records(spark, p)))
    assert top_k_daily(c, 10, "rank").count() == 12
    exact = top_k_daily(c, 10, "row_number").orderBy("rank").collect()
    assert [r["name"] for r in exact] == [f"N{chr(97 + i)}" for i in range(10)]
    assert [r["rank"] for r in exact] == list(range(1, 11))


def test_f3_list_order(spark, write_lines):
    lines = [record_line(names="A,1;B,2;C,3", rid=f"r{i}") for i in range(2)] + \
            [record_line(names="B,1", rid="r9")]
    p = write_lines("f3.tsv", lines)
    res = to_result_schema(daily_lists(top_k_daily(daily_counts(clean_names(read_records(spark, p))))))
    row = res.collect()[0]
    assert row["data"] == DAY
    assert [(x["topic"], x["count"]) for x in row["result"]] == [("B", 3), ("A", 2), ("C", 2)]


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_f4_empty_names_dropped(spark, write_lines, reader):
    p = write_lines("f4.tsv", [record_line(names="")])
    assert counts_of(spark, p, reader) == {}


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_f5_trailing_separator(spark, write_lines, reader):
    p = write_lines("f5.tsv", [record_line(names="A,5;B,7;")])
    assert counts_of(spark, p, reader) == {(DAY, "A"): 1, (DAY, "B"): 1}


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_f6_short_record_dropped(spark, write_lines, reader):
    p = write_lines("f6.tsv", [record_line(names="A,1", fields=23)])
    assert counts_of(spark, p, reader) == {}


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_f7_lone_quote_kept(spark, write_lines, reader):
    p = write_lines("f7.tsv", [record_line(names='"Q,1;R,2')])
    assert counts_of(spark, p, reader) == {(DAY, '"Q'): 1, (DAY, "R"): 1}


@pytest.mark.parametrize("reader", ["csv", "text"])
def test_f8_bad_date_rejected(spark, write_lines, reader):
    p = write_lines("f8.tsv", [record_line(date="bad", names="A,5"), record_line(names="B,1")])
    assert counts_of(spark, p, reader) == {(DAY, "B"): 1}
    rec = read_records(spark, p) if reader == "csv" else read_records_text(spark, p)
    r = reject_counts(rec).collect()[0]
    assert (r["records"], r["null_date"], r["null_names"]) == (2, 1, 0)


def test_f9_noise_names(spark, write_lines):
    p = write_lines("f9.tsv", [record_line(names="Type ParentCategory,1;A,2")])
    assert counts_of(spark, p) == {(DAY, "A"): 1}
    assert counts_of(spark, p, stop_substrings=()) == {(DAY, "Type ParentCategory"): 1, (DAY, "A"): 1}


def test_f10_whitespace(spark, write_lines):
    p = write_lines("f10.tsv", [record_line(names="A 1,5;A,9")])
    assert counts_of(spark, p) == {(DAY, "A "): 1, (DAY, "A"): 1}
    assert counts_of(spark, p, trim=True) == {(DAY, "A"): 1}


def test_f11_digits_inside_names(spark, write_lines):
    p = write_lines("f11.tsv", [record_line(names="Area 51,10")])
    assert counts_of(spark, p) == {(DAY, "Area "): 1}


def test_csv_scan_prunes_columns(spark, write_lines):
    p = write_lines("prune.tsv", [record_line(names="A,1")])
    plan = clean_names(read_records(spark, p)).select("name")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "ReadSchema: struct<DATE:date,AllNames:string>" in plan


def test_dates_truncate_to_day(spark, write_lines):
    p = write_lines("day.tsv", [record_line(date="20150218235959", names="A,1"),
                                record_line(date="20150219000000", names="A,1")])
    got = counts_of(spark, p)
    assert got == {(DAY, "A"): 1, (dt.date(2015, 2, 19), "A"): 1}


def test_text_reader_keeps_record_id(spark, write_lines):
    p = write_lines("id.tsv", [record_line(names="A,1", rid="20150218230000-7")])
    assert read_records_text(spark, p).select(F.col("GKGRECORDID")).first()[0] == "20150218230000-7"

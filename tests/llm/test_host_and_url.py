"""Host-level rules and url reputation on hand-made rows."""

import random

import pytest

from trendlens.llm import quality_rules as qr, url_filter as uf
from trendlens.llm.queries import QUERIES, SQL

WORDS = [f"word{i}" for i in range(400)]


def clean(seed, n=80):
    return " ".join(random.Random(seed).sample(WORDS, n))


def brute(text):
    import re
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \t\n", "one", "a b c a b c", "a b c\na b c\n\n \nx", "é 日本 \U0001f600 # | <>", "w " * 3000, clean(1), clean(2) + " " + clean(2),
         "x\x0by\x0cz\x1cq", "$" * 50, "a b a b a b a", "\n".join(["same line here"] * 9), " ".join(f"t{i % 7} t{i % 5}" for i in range(500))]


@pytest.mark.parametrize("bits", [20, 3])
def test_measures_equal_brute_force(spark, monkeypatch, bits):
    # with three position bits most texts take the exact way for long or colliding texts
    monkeypatch.setattr(qr, "_POS_BITS", bits)
    monkeypatch.setattr(qr, "_POS_MASK", (1 << bits) - 1)
    df = spark.createDataFrame([(i, t, "h", 9) for i, t in enumerate(TEXTS)], "doc_id long, text string, source string, n_words int").repartition(3)
    got = {r.row.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in qr.measure(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_a_bad_host_goes_and_small_samples_do_not_decide(spark):
    rows = [(i, "# " * 60, "junk") for i in range(60)] + [(100 + i, clean(i), "junk") for i in range(5)]
    rows += [(200 + i, clean(i + 50), f"good{i % 4}") for i in range(200)] + [(500, "# " * 60, "new"), (501, clean(7), "new"), (502, clean(8), None), (502, clean(8), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    judged = qr.quality_rules(df).collect()
    assert len(judged) == len(rows)
    kept = {r.row.doc_id for r in judged if r.kept}
    assert kept == {200 + i for i in range(200)} | {501, 502}
    assert {r.host for r in judged if r.host_blocked} == {"junk"}
    assert qr.keep_good(df).columns == df.columns and qr.keep_good(df).count() == 203
    assert qr.quality_rules(df.limit(0)).collect() == []


URLS = [(1, "https://a.example.org/es/x?q#f", "example.org/es/", "block"), (2, "http://example.org/en/12", "example.org/en/1", "allow"), (3, "x://EXAMPLE.com/de/", "com/de/", "block"),
        (4, "http://b.com/fr/1", "com/fr/", "allow"), (5, "http://example.org", None, "allow"), (6, None, None, "allow"), (7, "no scheme", None, "allow"),
        (8, "http://notexample.org/es/", "org/", "allow"), (9, "https://h.net?x=/es/", None, "allow"), (10, "://", None, "allow"), (11, "http://a://b.org/x", None, "allow"),
        (12, "http://org/", "org/", "allow"), (12, "http://org/", "org/", "allow")]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u, _, _ in URLS], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = [(r.page_id, r.rule, r.verdict) for r in uf.url_filter(df, none).collect()]
    assert sorted(got, key=str) == sorted([(i, rule, v) for i, _, rule, v in URLS], key=str)
    by = {r.page_id: (r.host, r.path) for r in uf.url_filter(df, none).collect()}
    assert by[1] == ("a.example.org", "/es/x") and by[6] == by[7] == ("", "") and by[9] == ("h.net", "") and by[3][0] == "example.com" and by[11] == ("a:", "//b.org/x")
    assert uf.url_filter(df.limit(0), none).collect() == []


def test_reputation_shrinks_and_blocks(spark):
    pages, out = [], []
    for host, n, bad in (("spam.x.net", 200, 150), ("ok.x.net", 200, 4), ("tiny.x.net", 1, 1), ("fine.y.info", 300, 6)):
        for _ in range(n):
            i = len(pages)
            pages.append((i, f"https://{host}/p{i}"))
            out.append((i, bad > 0))
            bad -= 1
    df = spark.createDataFrame([*pages, (9999, "https://spam.x.net/unlabelled")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in uf.url_filter(df, spark.createDataFrame([*out, (None, True), (3, None)], "page_id long, bad boolean")).collect()}
    assert {v for i, v in got.items() if i < 200 or i == 9999} == {"block"}
    assert {v for i, v in got.items() if 200 <= i < 9999 and i != 400} == {"allow"}  # 400: the tiny host of a bad domain
    counts = spark.createDataFrame([("spam.x.net", 200, 150), ("tiny.x.net", 1, 1), ("ok.x.net", 200, 4)], "host string, n long, bad long")
    mean = {r.host: r["mean"] for r in uf.host_reputation(counts).collect()}
    assert mean["ok.x.net"] < mean["tiny.x.net"] < 1.0 and 0.7 < mean["spam.x.net"] < 0.76


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_null_and_empty_hosts_are_two_hosts(spark, tmp_path):
    import duckdb
    rows = [(i, "# " * 60, "") for i in range(60)] + [(100 + i, clean(i), None) for i in range(60)] + [(200 + i, clean(300 + i), "good") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op1_quality_rules"](spark, str(tmp_path))
    cur = con.execute(SQL["op1_quality_rules"])
    names = [d[0] for d in cur.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cur.fetchall())
    assert sum(r.host_blocked for r in got.collect()) == 60

import re

import pytest

from trendlens.llm import licenses as L

ROWS = [
    (1, "Released under the MIT License."), (2, None), (3, ""), (4, "mit   LICENSE mit-license\n mit\nlicense"),
    (5, "GNU General Public License, apache license"), (6, "smit license mit licenses"),
    (7, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\ncode"),
    (8, "# SPDX-License-Identifier: MIT OR\nx"), (9, "mitélicense mit é license"), (10, "mit license " * 30000),
    (10, "mit license"), (None, "Licensed under CC BY-NC 4.0."), (11, "\x00mit\x7flicense\x1cend 日本 license"),
]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    at = [(i, label) for p, label in L.BASE_PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))


def test_base_finds_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, 3) for i, t in ROWS], "doc_id long, text string, n_words int").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted([tuple(r)[:6] for r in L.scan_licenses(df).collect()], key=key)
    assert got == sorted([(i, *brute(t)) for i, t in ROWS], key=key)


def test_labels_score_and_expression(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    by = {r.doc_id: r for r in L.scan_licenses(df).collect() if r.doc_id not in (10,)}
    assert by[7].labels == "apache-2.0,gpl-2.0-only,mit" and by[7].score == 1.0 and by[7].permissive is False
    assert by[8].labels == "" and by[8].score == 0.0 and by[8].expression is None
    assert by[None].labels == "cc" and by[1].labels == "mit" and 0 < by[1].score < 1
    assert by[3].labels == "" and by[3].score == 0.0


@pytest.mark.parametrize("text, want, ok", [
    ("MIT", "mit", True), ("MIT or GPL-2.0", "mit gpl-2.0 or", True), ("MIT and GPL-2.0 or ISC", "mit gpl-2.0 and isc or", True),
    ("MIT and (GPL-2.0 or ISC)", "mit gpl-2.0 isc or and", True), ("GPL-2.0 with Linux-note and MIT", "gpl-2.0 linux-note with mit and", False),
    ("MIT */ more", "mit", True), ("(MIT", None, None), ("MIT)", None, None), ("or MIT", None, None), ("", None, None), ("MIT or", None, None),
])
def test_expressions(text, want, ok):
    got = L.parse_expression(text)
    assert (" ".join(got) if got else None) == want
    assert got is None or L.permissive(got) is ok


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("text, ok", [("mitxyz", False), ("iscsi", False), ("bsd-3-clause", True), ("BSD-3-Clause+", True), ("apache-3.0", False), ("cc-by-nc-4.0", False), ("zlib", True)])
def test_permissive_ids_are_exact(text, ok):
    assert L.permissive(L.parse_expression(text)) is ok

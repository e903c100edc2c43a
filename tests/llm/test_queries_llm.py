"""The subpackage's queries against their DuckDB SQL on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "scripts"))

from conftest import SF_SMALL  # noqa: E402
from oracle_check import digest  # noqa: E402
from trendlens.llm.queries import QUERIES, SQL  # noqa: E402
from trendlens.sources.tables import TABLES  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, rows) == digest(cols, want)

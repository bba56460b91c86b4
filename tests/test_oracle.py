"""Every registered query with SQL equals DuckDB's answer on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import entry_queries
from tools.check_oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
OWN = entry_queries.load()
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    con = connect(SF)
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert compare(df.columns, got, columns, cur.fetchall()) is None

"""Every registered query against its comparison SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lakewarden.plans import queries as registered
from lakewarden.plans.dialect import TABLES
from tools.check_queries import plan_problems, rows_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_comparison_sql():
    assert set(registered.QUERIES) == set(registered.ORACLES)
    assert set(registered.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, sql, name):
    df = registered.QUERIES[name](spark, SF_DIR)
    got = df.collect()
    assert plan_problems(df) == []
    result = sql.execute(registered.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())

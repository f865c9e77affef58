"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import compare
from tallyhouse.sources.readers import TABLES
from tests.conftest import TEST_FOLDER

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{TEST_FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    status, _, note = compare(spark, duck, name, QUERIES[name], SQL.get(name), TEST_FOLDER)
    assert status in ("ok", "rows", "EMPTY"), f"{status}: {note}"


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)

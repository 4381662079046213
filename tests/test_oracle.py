"""Every registered query next to its DuckDB twin on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check import TABLES, compare


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    text, _, good = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF_SMALL)
    assert good, text


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

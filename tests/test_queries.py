"""Every registered query against DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from certwatch.checks.queries import QUERIES
from check import rows_of

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = db.sql(SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows_of(got.to_pandas(integer_object_nulls=True)) == rows_of(want.to_pandas(integer_object_nulls=True))


def test_action_table_looks_up_tickets(spark):
    """A ticket of the certificate shown in a row, where it has one with a text."""
    rows = QUERIES["action_table"](spark, SF).select("ticket").collect()
    assert {r["ticket"] == "N/A" for r in rows} == {True, False}

"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from shopstrata.llm.sql import SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR)
    asked = duck.execute(SQL[name])
    names = [d[0] for d in asked.description]
    assert sorted(names) == sorted(found.columns)
    expected = sorted(map(str, asked.fetchall()))
    assert expected and sorted(str(tuple(r)) for r in found.select(*names).collect()) == expected

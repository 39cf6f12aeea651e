"""Every registered query against its SQL text in DuckDB."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
STAR = ["customer", "part", "orders", "lineitem"]
OWN = {n: q for n, q in contract.queries().items() if not re.match(r"op\d+_|spotsigs_|pipeline$", n)}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in STAR:
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_matches_sql(spark, duck, name):
    found = OWN[name](spark, SF_DIR)
    asked = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in asked.description]
    assert sorted(found.columns) == sorted(names)
    expected = _rows(names, asked.fetchall())
    assert expected, "an empty answer proves nothing"
    assert _rows(found.columns, found.collect()) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0

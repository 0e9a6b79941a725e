"""Every registered query against its SQL, on the driver's smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry
from conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.sql("SET timezone = 'UTC'")
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield connection
    connection.close()


def canonical(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(row[i] for i in at) for row in rows), key=repr)


def test_every_query_has_its_sql():
    own = {name for name in registry.queries() if name.startswith("q_")}
    assert own == {name for name in registry.oracle_sql() if name.startswith("q_")}


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_matches_sql(spark, oracle, name):
    got = registry.queries()[name](spark, SF)
    expected = oracle.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows = [tuple(r) for r in got.collect()]
    assert rows
    assert canonical(got.columns, rows) == canonical(expected.columns, expected.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() > 0

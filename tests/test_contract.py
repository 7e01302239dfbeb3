"""The registered queries against their SQL in DuckDB, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
SF_DIR = contract.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def ordered(rows, columns):
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in by_name) for row in rows), key=repr)


def test_every_query_has_its_sql():
    optional = set(contract.TRAINING_DATA_QUERIES)
    assert [n for n in contract.queries() if n not in optional] == [n for n in contract.oracle_sql() if n not in optional]
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if n not in contract.TRAINING_DATA_QUERIES])
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert ordered(frame.collect(), frame.columns) == ordered(result.fetchall(), columns)


def test_entry(spark):
    assert contract.entry(spark).count() == 3

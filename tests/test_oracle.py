"""Every registered query that has a statement, against DuckDB on the smallest data set."""

import math

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry
from orderwake import oracle

TABLES = "region nation customer supplier part orders lineitem events".split()
STATEMENTS = oracle.statements()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def as_table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def test_every_statement_belongs_to_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_agrees_with_sql(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    cursor = duck.execute(STATEMENTS[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    assert as_table(found.columns, found.collect()) == as_table(columns, cursor.fetchall())


def test_flagship_query_runs(spark):
    assert entry.entry(spark).count() > 0

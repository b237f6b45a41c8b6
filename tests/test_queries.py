"""Every registered query against its SQL on the smallest test data."""

import duckdb
import pytest

import __spark_entry__
from workload.catalog import QUERIES, SQL
from workload.check import TABLES, sorted_rows


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def test_entry(spark, folder):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    df = __spark_entry__.queries()[name](spark, folder)
    result = database.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())

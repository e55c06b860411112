"""Every registered query against its SQL in DuckDB, on the smallest data."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans import oracles, queries as plans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test data not here")
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_registries_agree():
    assert plans.catalog().keys() == oracles.oracle_sql().keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def ordered(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in data)


@pytest.mark.parametrize("name", sorted(plans.catalog()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(columns, result.fetchall())

"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return None
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return str(value) if isinstance(value, pd.Timestamp) else value


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(
        repr([plain(value) for value in row]) for row in frame[columns].itertuples(index=False)
    )


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    got = rows(driver.queries()[name](spark, FOLDER).toPandas())
    assert got[1]
    oracle = driver.oracle_sql().get(name)
    if oracle:
        assert got == rows(duck.execute(oracle).df())


def test_entry(spark):
    assert driver.entry(spark).count() > 0

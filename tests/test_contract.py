"""Every query at the smallest scale, beside its SQL."""

import duckdb
import pytest
from compare import TABLES, compare

import __spark_entry__ as driver
from checks.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    database = duckdb.connect()
    for table in TABLES:
        database.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return database


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[:5] == ["srcip", "dstip", "recordtime", "proto", "label"]
    assert result.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    good, text = compare(spark, connection, name, SF_DIR)
    assert good, text

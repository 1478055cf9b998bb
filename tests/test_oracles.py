"""Every registered query against its SQL on the driver's smallest tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from helpers import as_set

from celltide.plans.oracles import ORACLES
from celltide.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS FROM '{SF_DIR}/{name}'")
    return con


def _plain(value):
    return value.isoformat() if isinstance(value, datetime.datetime) else value


def _rows(rows, order):
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=str)


def test_every_query_is_registered_with_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = oracle.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    rows = df.collect()
    assert rows
    assert _rows(rows, [df.columns.index(c) for c in columns]) == _rows(
        expected.fetchall(), [expected.columns.index(c) for c in columns]
    )


def test_entry_has_a_stable_schema(spark):
    df = entry_point.entry(spark)
    assert df.columns[:4] == ["date", "hour", "h3_index", "cell_id"]
    assert len(as_set(df, "h3_index", "cell_id")) > 0

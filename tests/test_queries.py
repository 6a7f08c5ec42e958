"""Every registered query against its SQL, on the smallest data set."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridtables.plans.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return datetime.datetime(value.year, value.month, value.day)
    return value


def result(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    expected = result([d[0] for d in cursor.description], cursor.fetchall())
    assert result(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "id"


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(entry.oracle_sql())

"""Queries of the subpackage against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from gridtables.llm import queries  # noqa: F401
from gridtables.llm.registry import QUERIES, SQL
from tests.test_queries import result

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    df = QUERIES[name](spark, FOLDER)
    cursor = connection.execute(SQL[name])
    assert result(df.columns, df.collect()) == result([d[0] for d in cursor.description], cursor.fetchall())


def test_a_query_of_each_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_registered_beside_the_others():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())

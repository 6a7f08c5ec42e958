"""Stored tables by name."""

from datetime import datetime

import pytest

from gridtables.plans import catalog, versioned
from gridtables.sources import commits


def test_a_versioned_table_by_name(spark, tmp_path):
    root = str(tmp_path / "v")
    with pytest.raises(ValueError):
        catalog.publish(spark, "rates", root)
    versioned.synchronise(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], datetime(2020, 1, 1))
    catalog.publish(spark, "rates", root)
    assert sorted((r.k, r.v) for r in spark.sql("SELECT k, v FROM rates").collect()) == [(1, "a"), (2, "b")]
    second = spark.createDataFrame([(1, "a", None), (2, "c", "n"), (3, "d", "m")], "k int, v string, w string")
    versioned.synchronise(spark, root, second, ["k"], datetime(2020, 1, 2))
    # a name goes on showing the run it was published with
    assert spark.table("rates").columns == ["id", "k", "v", "last_modified_dttm"] and spark.table("rates").count() == 2
    catalog.publish(spark, "rates", root)
    assert sorted(((r.k, r.v, r.w) for r in spark.table("rates").collect()), key=repr) == [(1, "a", None), (2, "c", "n"), (3, "d", "m")]
    versions = sorted((r.k, r.v, r.w or "") for r in spark.table("rates_versions").collect())
    assert versions == [(1, "a", ""), (2, "b", ""), (2, "c", "n"), (3, "d", "m")]
    catalog.rename(spark, "rates", "prices")
    assert spark.table("prices").count() == 3 and spark.table("prices_versions").count() == 4
    assert not spark.catalog.tableExists("rates") and not spark.catalog.tableExists("rates_versions")
    assert sorted(spark.table("prices").columns) == sorted(["id", "k", "v", "w", "last_modified_dttm"])


def test_ids_go_on_from_the_noted_one(spark, tmp_path):
    root = str(tmp_path / "i")
    for day, rows in ((1, [(1, "a"), (2, "b")]), (2, [(1, "x")]), (3, [(1, "x")]), (4, [(1, "y"), (5, "e"), (None, "n"), (None, "n")])):
        assert versioned.synchronise(spark, root, spark.createDataFrame(rows, "k int, v string"), ["k"], datetime(2020, 1, day)).first().process_status == "SUCCESS"
        table = versioned.read(spark, root)
        ids = [r.id for r in table.select("id").collect()]
        assert len(ids) == len(set(ids)) and versioned._top_id(spark, root) == max(ids)


def test_tables_of_a_commit_by_name(spark, tmp_path):
    root = str(tmp_path / "c")
    with pytest.raises(ValueError):
        catalog.publish_parts(spark, "parts_view", root, "t")
    commits.commit(spark, root, {"t": commits.added(spark.createDataFrame([(1, "a")], "k int, v string"), root, "t")})
    commits.commit(spark, root, {"t": commits.added(spark.createDataFrame([(2, 0.5)], "k int, w double"), root, "t")})
    catalog.publish_parts(spark, "parts_view", root, "t")
    assert sorted(tuple(r) for r in spark.table("parts_view").collect()) == [(1, "a", None), (2, None, 0.5)]

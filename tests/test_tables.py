"""Partitioned upserts that load twice."""

from datetime import datetime

import pytest

from gridtables.plans import versioned
from gridtables.sources import commits
from gridtables.sources.tables import append_batch, read_appended, read_partitioned, upsert_partitions

SCHEMA = "day string, k int, v string"


def rows(spark, root, schema=SCHEMA):
    declared = spark.createDataFrame([], schema).select("day").schema
    return sorted((tuple(r[c] for c in ("day", "k", "v")) for r in read_partitioned(spark, root, declared).collect()), key=repr)


def test_null_partitions_and_text_that_looks_like_a_number(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_partitions(spark, root, spark.createDataFrame([(None, 1, "a"), ("01", 1, "b"), ("1", 1, "c")], SCHEMA), ["day", "k"], ["day"])
    upsert_partitions(spark, root, spark.createDataFrame([(None, 2, "d"), ("01", 1, "e")], SCHEMA), ["day", "k"], ["day"])
    assert rows(spark, root) == sorted([(None, 1, "a"), (None, 2, "d"), ("01", 1, "e"), ("1", 1, "c")], key=repr)


def test_a_column_of_one_batch_stays(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_partitions(spark, root, spark.createDataFrame([("a", 1, "x", "W")], SCHEMA + ", w string"), ["day", "k"], ["day"])
    upsert_partitions(spark, root, spark.createDataFrame([("a", 1, "y"), ("b", 2, "z")], SCHEMA), ["day", "k"], ["day"])
    declared = spark.createDataFrame([], SCHEMA).select("day").schema
    got = {r.k: (r.v, r.w) for r in read_partitioned(spark, root, declared).collect()}
    assert got == {1: ("y", "W"), 2: ("z", None)}


def test_a_repeated_batch_adds_no_null_key_twice(spark, tmp_path):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([("a", None, "x"), ("a", 1, "y")], SCHEMA)
    for _ in range(2):
        upsert_partitions(spark, root, first, ["day", "k"], ["day"], batch=0)
    upsert_partitions(spark, root, spark.createDataFrame([("a", None, "z")], SCHEMA), ["day", "k"], ["day"], batch=1)
    assert rows(spark, root) == sorted([("a", None, "x"), ("a", 1, "y"), ("a", None, "z")], key=repr)
    safe = str(tmp_path / "s")
    for v in ("x", "y"):
        upsert_partitions(spark, safe, spark.createDataFrame([("a", None, v)], SCHEMA), ["day", "k"], ["day"], null_safe=True)
    assert rows(spark, safe) == [("a", None, "y")]


def test_appended_batches_leave_earlier_files_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    append_batch(spark.createDataFrame([(1,)], "k int"), root, 0)
    before = sorted(p.name for p in (tmp_path / "t" / "batch_id=0").glob("part-*"))
    append_batch(spark.createDataFrame([(2, "n")], "k int, w string"), root, 1)
    append_batch(spark.createDataFrame([(2, "n")], "k int, w string"), root, 1)
    assert sorted(p.name for p in (tmp_path / "t" / "batch_id=0").glob("part-*")) == before
    assert sorted((r.k, r.w) for r in read_appended(spark, root).collect()) == [(1, None), (2, "n")]


def test_a_versioned_table_takes_a_new_column(spark, tmp_path):
    root = str(tmp_path / "v")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(1, "a", None), (2, "c", "n"), (3, "d", "m")], "k int, v string, w string")
    assert versioned.synchronise(spark, root, first, ["k"], datetime(2020, 1, 1)).first().process_status == "SUCCESS"
    for day in (2, 3):
        assert versioned.synchronise(spark, root, second, ["k"], datetime(2020, 1, day)).first().process_status == "SUCCESS"
    late = datetime(9999, 1, 1)
    got = sorted((r.k, r.v, r.w or "", r.active_to < late) for r in versioned.read(spark, root).collect())
    assert got == [(1, "a", "", False), (2, "b", "", True), (2, "c", "n", False), (3, "d", "m", False)]


def test_tables_of_a_commit_change_together(spark, tmp_path):
    root = str(tmp_path / "s")
    one, two = spark.createDataFrame([(1, "a")], "id long, v string"), spark.createDataFrame([(7, 1)], "id long, one long")
    entries = {"one": commits.added(one, root, "one", "id"), "two": commits.added(two, root, "two", "id")}
    assert commits.read(spark, root, "one") is None  # written, not committed
    assert commits.commit(spark, root, entries, batch=5) == 1
    assert [tuple(r) for r in commits.read(spark, root, "one").collect()] == [(1, "a")] and commits.top_id(spark, root, "two") == 7
    assert commits.commit(spark, root, {"one": commits.added(one, root, "one", "id")}, batch=5) == 1  # the same batch again
    more = spark.createDataFrame([(2, "b", 0.5)], "id long, v string, w double")
    commits.commit(spark, root, {"one": commits.added(more, root, "one", "id"), "two": commits.added(two.limit(0), root, "two", "id")}, batch=6)
    assert sorted(tuple(r) for r in commits.read(spark, root, "one").collect()) == [(1, "a", None), (2, "b", 0.5)]
    assert commits.compact(spark, root, "one", "id") == 3 and commits.compact(spark, root, "one", "id") is None
    assert len([p for p in commits.parts(spark, root) if p.table == "one"]) == 1 and commits.top_id(spark, root, "one") == 2
    assert sorted(tuple(r) for r in commits.read(spark, root, "one").collect()) == [(1, "a", None), (2, "b", 0.5)]
    assert commits.commit(spark, root, {}, batch=5) == 3  # batches stay known


def test_an_upsert_rewrites_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "b")
    first = spark.createDataFrame([(i, f"v{i}", 1) for i in range(500)] + [(None, "null", 1)], "k int, v string, at int")

    def load(rows, **options):
        commits.commit(spark, root, {"t": commits.upserted(spark, root, "t", rows, ["k"], ["at"], **options)})
        return {p.bucket: p.part for p in commits.parts(spark, root) if p.table == "t" and p.bucket}

    before = load(first)
    assert len(before) > 200 and sum(p.n for p in commits.parts(spark, root)) == 501
    second = spark.createDataFrame([(3, "old", 1), (3, "new", 2), (1000, "more", 1), (None, "again", 1)], "k int, v string, at int")
    after = load(second)
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2
    want = {(i, f"v{i}") for i in range(500) if i != 3} | {(3, "new"), (1000, "more"), (None, "null"), (None, "again")}
    assert {(r.k, r.v) for r in commits.read(spark, root, "t").collect()} == want
    assert {(r.k, r.v) for r in commits.read(spark, root, "t", [*changed]).collect()} < want
    third = spark.createDataFrame([(3, "w", 9.5)], "k int, v string, w double")
    commits.commit(spark, root, {"t": commits.upserted(spark, root, "t", third, ["k"])})
    got = {r.k: (r.v, r.w) for r in commits.read(spark, root, "t").collect()}
    assert got[3] == ("w", 9.5) and got[4] == ("v4", None) and len(got) == 502
    assert commits.upserted(spark, root, "t", second.limit(0), ["k"]) == []
    with pytest.raises(ValueError):
        commits.upserted(spark, root, "t", second, ["k"], ["at"], digits=1)


def test_nulls_are_keys_where_they_are_equal(spark, tmp_path):
    root = str(tmp_path / "n")
    for v in ("x", "y"):
        rows = spark.createDataFrame([(None, v)], "k int, v string")
        commits.commit(spark, root, {"t": commits.upserted(spark, root, "t", rows, ["k"], null_safe=True)})
    assert [tuple(r) for r in commits.read(spark, root, "t").collect()] == [(None, "y")]

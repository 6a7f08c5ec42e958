import zlib

import pytest

from gridtables.llm import kdtree


def check(rows, got, n_shards):
    assert len(got) == len(rows)
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == want
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(n_shards))
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by_shard.items()}


SCHEMA = "doc_id long, text string, n_chars long, source string, score double, shard string"


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_equal_bytes_even_where_one_value_holds_most_rows(spark, n_shards):
    rows = [(i, "x" * (i % 40), 5 if i % 3 else i, None if i % 2 else "hot", float("nan") if i % 5 == 0 else 1.0 * i, "clash") for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sizes = check(rows, kdtree.shards(df, ["n_chars", "source", "score"], n_shards=n_shards).collect(), n_shards)
    mean = sum(sizes.values()) / n_shards
    assert len(sizes) == n_shards and max(abs(s - mean) for s in sizes.values()) < 200


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None, None, None, "a")] * 3 + [(7, "same", 4, "s", 0.0, "b")] * 4
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, kdtree.shards(df, ["n_chars", "source"], n_shards=4).collect(), 4)


def test_target_bytes_and_empty(spark):
    rows = [(i, "y" * 9, i, "s", 0.0, "c") for i in range(64)]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = check(rows, kdtree.shards(df, ["n_chars"], target_bytes=160).collect(), 4)
    assert sorted(sizes.values()) == [160] * 4
    assert kdtree.shards(df.limit(0), ["n_chars"], n_shards=4).count() == 0


def splits(rows, n_shards, first=0):
    """Shards by plain recursion over (id, crc, size, places, tie): the widest dimension, cut at the weighted quantile."""
    if n_shards == 1 or not rows:
        return {(i, crc): first for i, crc, *_ in rows}
    dims = range(len(rows[0][3]))
    dim = max(dims, key=lambda d: (max(r[3][d] for r in rows) - min(r[3][d] for r in rows), -d))
    key = lambda r: (r[3][dim] << 31) | r[4]
    wanted = sum(r[2] for r in rows) * (n_shards // 2) / n_shards
    sizes = {}
    for r in rows:
        sizes[key(r)] = sizes.get(key(r), 0) + r[2]
    upto = 0
    for k in sorted(sizes):
        if upto + sizes[k] >= wanted:
            threshold = k if (wanted - upto) * 2 >= sizes[k] else k - 1
            break
        upto += sizes[k]
    left, right = [r for r in rows if key(r) <= threshold], [r for r in rows if key(r) > threshold]
    return splits(left, n_shards // 2, first) | splits(right, n_shards - n_shards // 2, first + n_shards // 2)


@pytest.mark.parametrize("n_shards", [2, 5, 16])
@pytest.mark.parametrize("broadcast", [0, 1 << 16])
def test_nodes_are_split_at_the_weighted_quantile_of_the_widest_dimension(spark, n_shards, broadcast, monkeypatch):
    monkeypatch.setattr(kdtree, "BROADCAST_NODES", broadcast)
    rows = [(i, "x" * (i * i % 97), (i * 37) % 500 if i % 4 else 7, "hot" if i % 3 else f"s{i % 11}", None, "c") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    dims = ["n_chars", "source"]
    made = [(r.id, r.crc, r["size"], list(r.place), r.tie) for r in kdtree._rows(df, dims, "doc_id", "text").collect()]
    want = splits(made, n_shards)
    got = kdtree.shards(df, dims, n_shards=n_shards).collect()
    assert {(r.doc_id, r.text_crc32): r.shard for r in got} == want


def test_rows_meet_the_tree_without_a_product(spark):
    rows = [(i, "x" * (i % 40), i, "s", 1.0, "c") for i in range(200)]
    plan = kdtree.shards(spark.createDataFrame(rows, SCHEMA), ["n_chars"], n_shards=4)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

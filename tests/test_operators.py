"""Merge, versions, positions and quality on small frames."""

import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridtables.operators import control, ids, merge, positional, quality, ranges, scd2
from gridtables.plans import versioned
from gridtables.session import cut_lineage
from gridtables.sources.tables import finished_versions, read_latest, upsert_partitions, write_version

T = [f"2020-01-0{i} 00:00:00" for i in range(1, 7)]


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns or df.columns).collect()], key=repr)


# --- upsert -----------------------------------------------------------------------------------------


def test_upsert_rules(spark):
    target = spark.createDataFrame([(1, "old", 10), (2, "old", 20), (None, "old", 30)], "k int, v string, id int")
    source = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (3, "c", 2), (None, "n", 3), (None, "m", 4)], "k int, v string, n int")
    got = merge.upsert(target, source, ["k"], ["n"])
    assert rows(got) == sorted([(1, "b", 10), (2, "old", 20), (None, "old", 30), (3, "c", None), (None, "n", None), (None, "m", None)], key=repr)
    safe = merge.upsert(target, source, ["k"], ["n"], null_safe=True)
    assert rows(safe) == sorted([(1, "b", 10), (2, "old", 20), (None, "m", 30), (3, "c", None)], key=repr)
    assert merge.upsert(target, source, [], ["n"]).count() == 8
    with pytest.raises(merge.KeyColumnError):
        merge.upsert(target, source, ["nope"])


def test_upsert_updates_every_row_of_a_repeated_target_key(spark):
    target = spark.createDataFrame([(1, "x")] * 3 + [(2, "y")], "k int, v string")
    got = merge.upsert(target, spark.createDataFrame([(1, "z")], "k int, v string"), ["k"])
    assert rows(got) == [(1, "z")] * 3 + [(2, "y")]


def test_upsert_of_only_keys_and_new_columns(spark):
    target = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(merge.upsert(target, spark.createDataFrame([(2,), (3,), (3,)], "k int"), ["k"])) == [(1,), (2,), (3,)]
    grown = merge.upsert(target, spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), ["k"])
    assert rows(grown) == [(1, None), (2, "b"), (3, "c")]


def test_many_short_keys_are_joined_by_many_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(1_200_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
        source = spark.range(600_000, 1_800_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
        for null_safe in (False, True):
            got = merge.upsert(target, source, ["k"], null_safe=null_safe)
            by_task = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_if(F.col("v") == "new").alias("new")).collect()
            assert sum(r.n for r in by_task) == 1_800_000 and sum(r.new for r in by_task) == 1_200_000
            assert max(r.n for r in by_task) < 400_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("case", [test_upsert_rules, test_upsert_updates_every_row_of_a_repeated_target_key, test_upsert_of_only_keys_and_new_columns])
def test_upsert_of_dealt_rows(spark, monkeypatch, case):
    monkeypatch.setattr(merge, "_TASK_ROWS", 1)
    case(spark)


def test_dealt_keys_of_another_type_or_with_nulls(spark, monkeypatch):
    monkeypatch.setattr(merge, "_TASK_ROWS", 1)
    target = spark.createDataFrame([(1, None, "old"), (None, 0, "old"), (0, None, "old")], "a int, b long, v string")
    source = [(1, None, "x"), (None, None, "y"), (0, None, "z"), (0, 0, "w")]
    for kind in ("int", "long"):
        got = merge.upsert(target, spark.createDataFrame(source, f"a {kind}, b long, v string"), ["a", "b"], null_safe=True)
        assert rows(got) == sorted([(1, None, "x"), (None, 0, "old"), (0, None, "z"), (None, None, "y"), (0, 0, "w")], key=repr)
        new = merge.insert_absent(target, spark.createDataFrame(source, f"a {kind}, b long, v string"), ["a", "b"])
        assert rows(new) == sorted([(1, None, "old"), (None, 0, "old"), (0, None, "old"), (None, None, "y"), (0, 0, "w")], key=repr)


def test_insert_absent_keeps_the_first_row(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (2, "c", 2), (None, "d", 3)], "k int, v string, n int")
    once = merge.insert_absent(target, source, ["k"], ["n"])
    assert rows(once) == sorted([(1, "old"), (2, "b"), (None, "d")], key=repr)
    assert rows(merge.insert_absent(once, source, ["k"], ["n"])) == rows(once)


def test_get_or_create_keys(spark):
    dim = spark.createDataFrame([(7, "x", None)], "id long, a string, b int")
    source = spark.createDataFrame([("x", None, 1), ("x", 2, 2), ("x", 2, 3), ("y", None, 4)], "a string, b int, n int")
    grown, found = merge.get_or_create_keys(dim, source, ["a", "b"])
    assert sorted(r.id for r in grown.collect()) == [7, 8, 9]
    by_n = {r.n: r.id for r in found.collect()}
    assert by_n[1] == 7 and by_n[2] == by_n[3] != by_n[4]
    again, _ = merge.get_or_create_keys(grown, source, ["a", "b"])
    assert rows(again) == rows(grown)


def test_ids_are_dense_and_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7).alias("k"))
    a = ids.assign_ids(df.repartition(7), ["k"], "n", F.lit(10))
    b = ids.assign_ids(df.repartition(3, F.col("k") % 3), ["k"], "n", F.lit(10))
    assert rows(a) == rows(b)
    assert sorted(r.n for r in a.collect()) == list(range(11, 5011))


def test_ids_of_copies(spark):
    df = spark.createDataFrame([(1,)] * 25_000 + [(2,)] * 3 + [(None,)] * 4, "k int")
    got = ids.assign_ids_to_copies(df, "n", F.lit(5))
    assert sorted(r.n for r in got.collect()) == list(range(6, 6 + 25_007))
    assert rows(got.groupBy("k").count()) == sorted([(1, 25_000), (2, 3), (None, 4)], key=repr)


def test_copies_are_unrolled_by_many_tasks(spark):
    df = spark.range(3_000_000).select((F.col("id") % 2).alias("k"))
    by_task = ids.assign_ids_to_copies(df, "n", F.lit(0)).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("n").alias("top")).collect()
    assert sum(r.n for r in by_task) == max(r.top for r in by_task) == 3_000_000
    assert len(by_task) > 6 and max(r.n for r in by_task) < 1_000_000


# --- versioned tables ---------------------------------------------------------------------------------


def snapshot(spark, *data):
    return spark.createDataFrame([("d", *r) for r in data], "day string, region string, rrp double")


def life(df):
    return sorted(((r.region, r.rrp, str(r.active_from)[:10], str(r.active_to)[:10]) for r in df.collect()), key=repr)


KEYS = ["day", "region"]
OPEN = "9999-12-31"


def test_versions_run_by_run(spark):
    t1 = cut_lineage(scd2.init(snapshot(spark, ("NSW", 30.0), ("VIC", 31.0)), KEYS, T[0]))
    assert life(t1) == [("NSW", 30.0, "2020-01-01", OPEN), ("VIC", 31.0, "2020-01-01", OPEN)]
    old_id = {r.region: r.id for r in t1.collect()}

    second = scd2.merge(t1, snapshot(spark, ("NSW", 35.0), ("VIC", 31.0)), KEYS, T[1])
    t2 = cut_lineage(second.table)
    assert life(t2) == [("NSW", 30.0, "2020-01-01", "2020-01-02"), ("NSW", 35.0, "2020-01-02", OPEN), ("VIC", 31.0, "2020-01-01", OPEN)]
    now = {(r.region, r.rrp): r.id for r in t2.collect()}
    assert now["NSW", 35.0] == old_id["NSW"] and now["NSW", 30.0] == 3
    count = scd2.audit(second.changes, t1, "spot", T[1], T[1]).first()
    assert (count.records_inserted, count.records_updated, count.records_deleted, count.total_source_records) == (0, 1, 0, 2)

    third = scd2.merge(t2, snapshot(spark, ("NSW", None)), KEYS, T[2])
    t3 = cut_lineage(third.table)
    assert [r for r in life(t3) if r[3] == OPEN] == [("NSW", None, "2020-01-03", OPEN)]
    assert ("VIC", 31.0, "2020-01-01", "2020-01-03") in life(t3)
    count = scd2.audit(third.changes, t1, "spot", T[2], T[2]).first()
    assert (count.records_inserted, count.records_updated, count.records_deleted) == (0, 1, 1)

    back = snapshot(spark, ("NSW", None), ("VIC", 31.0))
    assert ("VIC", 31.0, "2020-01-04", OPEN) in life(scd2.merge(t3, back, KEYS, T[3]).table)
    assert life(scd2.merge(t3, back, KEYS, T[3], resurrect=False).table) == life(t3)
    assert scd2.as_of(t3, "2020-01-02 00:00:00").count() == 2
    assert [(r.region, str(r.last_modified_dttm)[:10]) for r in scd2.current(t3).collect()] == [("NSW", "2020-01-03")]


def test_version_flags(spark):
    t1 = scd2.init(snapshot(spark, ("NSW", 30.0), ("VIC", 31.0)), KEYS, T[0])
    source = snapshot(spark, ("NSW", 35.0))
    assert life(scd2.merge(t1, source, KEYS, T[1], point_in_time=False).table) == [("NSW", 35.0, "2020-01-02", OPEN)]
    kept = scd2.merge(t1, source, KEYS, T[1], remove_if_not_found=False)
    assert ("VIC", 31.0, "2020-01-01", OPEN) in life(kept.table)
    with pytest.raises(ValueError):
        scd2.merge(t1, source, [], T[1])
    with pytest.raises(merge.KeyColumnError):
        scd2.merge(t1, source, ["nope"], T[1])


def test_versions_of_random_snapshots(spark):
    """One open row per key, no overlapping lives, no id used twice, and counts that add up."""
    random.seed(5)
    table = None
    for n in range(4):
        data = [(f"r{i}", float(random.randint(1, 3))) for i in range(30) if random.random() < 0.6]
        source = snapshot(spark, *data)
        if table is None:
            table = scd2.init(source, KEYS, T[n])
            continue
        before = scd2.current(table).count()
        result = scd2.merge(table, source, KEYS, T[n])
        count = scd2.audit(result.changes, source, "x", T[n], T[n]).first()
        table = spark.createDataFrame(result.table.collect(), table.schema)
        assert before + count.records_inserted - count.records_deleted == len(data) == scd2.current(table).count()
        assert {(r.region, r.rrp) for r in scd2.current(table).collect()} == set(data)
        found = table.collect()
        assert len({r.id for r in found}) == len(found)
        for key in {r.region for r in found}:
            spans = sorted((r.active_from, r.active_to) for r in found if r.region == key)
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_stored_versions_and_failure(spark, tmp_path):
    root = f"{tmp_path}/spot"
    versioned.synchronise(spark, root, snapshot(spark, ("NSW", 30.0), ("VIC", 31.0)), KEYS, datetime(2020, 1, 1))
    versioned.synchronise(spark, root, snapshot(spark, ("NSW", 35.0), ("VIC", 31.0)), KEYS, datetime(2020, 1, 2))
    before = rows(versioned.read(spark, root))
    failed = versioned.synchronise(spark, root, snapshot(spark, ("NSW", 1.0), ("NSW", 2.0)), KEYS, datetime(2020, 1, 3)).first()
    assert failed.process_status == "FAILURE" and rows(versioned.read(spark, root)) == before
    versioned.synchronise(spark, root, snapshot(spark, ("NSW", 35.0)), KEYS, datetime(2020, 1, 4))
    assert life(versioned.read(spark, root)) == [
        ("NSW", 30.0, "2020-01-01", "2020-01-02"), ("NSW", 35.0, "2020-01-02", OPEN), ("VIC", 31.0, "2020-01-01", "2020-01-04")]
    audit = spark.read.parquet(f"{root}/audit").orderBy("start_time").collect()
    assert [a.process_status for a in audit] == ["SUCCESS", "SUCCESS", "FAILURE", "SUCCESS"]
    assert [(a.records_inserted, a.records_updated, a.records_deleted) for a in audit] == [(2, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 1)]
    assert "source repeats a key" in " ".join(r.log_entry for r in spark.read.parquet(f"{root}/messages").collect())


def test_repeated_source_key_fails_the_job(spark):
    t1 = scd2.init(snapshot(spark, ("NSW", 30.0)), KEYS, T[0])
    with pytest.raises(PySparkException):
        scd2.merge(t1, snapshot(spark, ("NSW", 1.0), ("NSW", 1.0)), KEYS, T[1]).table.collect()


# --- stored tables ------------------------------------------------------------------------------------


def test_unfinished_version_is_not_read(spark, tmp_path):
    root = f"{tmp_path}/t"
    write_version(spark.range(3), root)
    write_version(read_latest(spark, root).union(spark.range(1)), root)
    (tmp_path / "t" / "version=9").mkdir()
    assert finished_versions(spark, root) == [1, 2] and read_latest(spark, root).count() == 4


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    root = f"{tmp_path}/p"
    schema = "day string, k int, v string"
    upsert_partitions(spark, root, spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema), ["day", "k"], ["day"])
    untouched = sorted((tmp_path / "p" / "day=a").iterdir())
    upsert_partitions(spark, root, spark.createDataFrame([("b", 1, "z"), ("c", 2, "w")], schema), ["day", "k"], ["day"])
    assert rows(spark.read.parquet(root), "day", "k", "v") == [("a", 1, "x"), ("b", 1, "z"), ("c", 2, "w")]
    assert sorted((tmp_path / "p" / "day=a").iterdir()) == untouched


# --- positions ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_scans_equal_plain_windows(spark, chunk_rows):
    random.seed(chunk_rows)
    data = [(f"f{random.randint(0, 2)}", i, random.choice([None, None, i]), random.random() < 0.3) for i in range(60)]
    df = spark.createDataFrame(data, "f string, n long, v long, s boolean")
    w = Window.partitionBy("f").orderBy("n")
    upto, before, whole = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("f")
    expected = df.select(
        "f", "n", F.last("v", True).over(upto).alias("c"), F.last("v", True).over(before).alias("b"), F.lag("v").over(w).alias("p"),
        F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("r"), F.min("v").over(whole).alias("lo"), F.max("v").over(whole).alias("hi"))
    v = F.col("v")
    got = positional.scan(
        df, ["f"], "n", chunk_rows=chunk_rows, c=positional.carry(v), b=positional.carry_before(v), p=positional.previous(v),
        r=positional.running(v), lo=positional.whole_min(v), hi=positional.whole_max(v)).drop("v", "s")
    assert rows(got) == rows(expected)


def test_blocks(spark):
    df = spark.createDataFrame([("f", i, c) for i, c in enumerate("ab|cd||e|f")], "f string, n long, c string")
    got = positional.blocks(df, ["f"], "n", F.col("c") == "|", chunk_rows=2)
    assert rows(got, "c", "block", "block_row", "closed") == [("c", 1, 1, True), ("d", 1, 2, True), ("e", 3, 1, True), ("f", 4, 1, False)]


def test_range_join_over_cells(spark):
    random.seed(1)
    points = spark.createDataFrame([("k", random.randint(-50, 200)) for _ in range(200)], "k string, p int")
    held = spark.createDataFrame([("k", a, a + random.randint(-3, 90), i) for i, a in enumerate(random.sample(range(-60, 200), 40))], "k string, a int, b int, i int")
    expected = rows(points.alias("p").join(held.alias("h"), F.expr("p.k = h.k AND p.p BETWEEN a AND b")), "p", "i")
    for salts in (1, 3):
        got = ranges.range_join(points, held, ["k"], "p", "a", "b", how="inner", salts=salts)
        assert rows(got, "p", "i") == expected


# --- quality ----------------------------------------------------------------------------------------------


def test_duplicates_conflicts_and_resolution(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, None), ("b", 1, 3), ("c", 5, 1), ("c", 4, 1), (None, 7, 1), (None, 7, 1)], "k string, hi int, lo int")
    assert rows(quality.duplicates(df, ["k"]).select("k").distinct()) == sorted([("b",), ("c",), (None,)], key=repr)
    assert rows(quality.conflicts(df, ["k"]).select("k").distinct()) == [("c",)]
    assert rows(quality.resolve(df, ["k"], {"hi": "min"})) == sorted([("a", 1, 2), ("b", 1, 3), ("c", 4, 1), (None, 7, 1)], key=repr)


def test_fill_from_first(spark):
    df = spark.createDataFrame([("f", 1, None), ("f", 2, "x"), ("f", 3, None), ("g", 1, "y"), ("g", 2, None)], "f string, n int, v string")
    got = quality.fill_from_first(df, "v", ["f"], "n", F.concat(F.lit("name "), "f"))
    assert [r[2] for r in rows(got)] == ["name f", "x", "name f", "y", "y"]


# --- load control -------------------------------------------------------------------------------------------


def test_queue_ledger_and_retention(spark, tmp_path):
    for folder in ("in", "done"):
        (tmp_path / folder).mkdir()
    for name in ("b.CSV", "a.csv", "c.txt"):
        (tmp_path / "in" / name).write_text("x" * len(name))
    (tmp_path / "done" / "old.csv").write_text("x")
    jobs = spark.createDataFrame(
        [(1, f"{tmp_path}/in/", f"{tmp_path}/done", f"{tmp_path}/bad", 5, "*.csv", "delimited", "{}", 3, 1),
         (2, f"{tmp_path}/in", f"{tmp_path}/done", f"{tmp_path}/bad", 1, "*.txt", "move_only", "{}", -1, 1),
         (3, f"{tmp_path}/in", f"{tmp_path}/done", f"{tmp_path}/bad", 0, "*", "meter", "{}", -1, 0)],
        "id int, source_folder string, success_folder string, fail_folder string, priority int, filename_pattern string,"
        " handler string, handler_params string, success_retention_days int, active_flag int")
    files = control.list_files(spark, f"{tmp_path}/in")
    queue = control.file_queue(files, jobs)
    assert [r.file_name for r in queue.collect()][0] == "c.txt" and {r.file_name for r in queue.collect()} == {"a.csv", "b.CSV", "c.txt"}
    assert control.next_file(queue).first().file_name == "c.txt"
    ledger = spark.createDataFrame([], "id long, job_id int, file_name string, source_folder string, process_status string,"
                                       " records_processed long, file_modified_dttm timestamp_ntz")
    started = control.start_loads(queue, ledger)
    assert sorted(r.id for r in started.collect()) == [1, 2, 3]
    assert control.start_loads(queue, started).count() == 0
    loaded = started.filter("file_name = 'a.csv'").select(F.col("id").alias("source_file_id"))
    bad = started.filter("file_name = 'b.CSV'").select(F.col("id").alias("source_file_id"))
    done = control.finish_loads(started, loaded.union(loaded), bad)
    assert rows(done, "file_name", "process_status", "records_processed") == [("a.csv", "SUCCESS", 2), ("b.CSV", "ERROR", 0), ("c.txt", "SUCCESS", 0)]
    routed = {r.file_name: r.destination for r in control.route(done, jobs).collect()}
    assert routed["a.csv"] == f"{tmp_path}/done/a.csv" and routed["b.CSV"] == f"{tmp_path}/bad/b.CSV"
    archive = control.list_files(spark, f"{tmp_path}/done")
    assert control.retention(archive, jobs, datetime(2099, 1, 1)).count() == 1
    assert control.retention(archive, jobs, datetime(2000, 1, 1)).count() == 0


def test_links_and_listings(spark):
    html = """<a href="f1.zip">1</a> <A class=x HREF='/r/f2.zip'>2</a><a href="http://o/f3.zip">3</a><a name="n">no</a>
      <a href="../up.zip?a=1&amp;b=2">4</a><a href=./same.zip>5</a><a href="#top">6</a><a href="//cdn/f4.zip">7</a><a href="?q=1">8</a>"""
    pages = spark.createDataFrame([("http://h/d/e/index.html", html)], "url string, html string")
    links = control.extract_links(pages, "url", "html")
    assert [r.file_url for r in links.collect()] == [
        "http://h/d/e/f1.zip", "http://h/r/f2.zip", "http://o/f3.zip", "http://h/d/up.zip?a=1&b=2", "http://h/d/e/same.zip",
        "http://h/d/e/index.html#top", "http://cdn/f4.zip", "http://h/d/e/index.html?q=1"]
    manifest = spark.createDataFrame([("f1.zip",)], "file_name string")
    assert rows(control.work_list(links, manifest, "f?.zip"), "file_name") == [("f2.zip",), ("f3.zip",), ("f4.zip",)]
    assert control.work_list(links, manifest, "f?.zip", redownload=True).count() == 4
    text = "-rw-r--r-- 1 ftp ftp 120 Jun 30 2014 IDY03000.axf\r\n-rw-r--r-- 1 ftp ftp 1 Jun 30 2014 a.zip\r\nrest"
    names = control.parse_listing(spark.createDataFrame([("ftp://h/p/", text)], "url string, t string"), "url", "t")
    assert rows(control.work_list(names, manifest, "IDY03000*"), "file_url") == [("ftp://h/p/IDY03000.axf",)]


def test_parameters(spark):
    df = spark.createDataFrame([('{"a": "1", "b": 2}',), ("{'a'",), (None,)], "p string")
    assert [r[0] for r in df.select(control.job_parameters(F.col("p"))).collect()] == [{"a": "1", "b": "2"}, {}, {}]


def test_range_join_of_ranges_of_any_length(spark):
    from gridtables.operators.ranges import range_join

    points = spark.createDataFrame([(1, p) for p in (0, 5, 16, 17, 300, 10**6, 2 * 10**9)] + [(2, 5), (None, 5)], "k int, p long")
    spans = [(1, 3, 17, "a"), (1, 0, 10**9, "b"), (1, 250, 400, "c"), (1, 9, 3, "never"), (2, 6, 7, "d"), (1, 10**6, 10**6 + 5000, "e")]
    ranges = spark.createDataFrame(spans, "k int, s long, e long, name string")
    got = sorted(((r.k, r.p, r.name) for r in range_join(points, ranges, ["k"], "p", "s", "e").collect()), key=repr)
    want = []
    for k, p in [(r.k, r.p) for r in points.collect()]:
        names = [n for key, s, e, n in spans if key == k and s <= p <= e] or [None]
        want += [(k, p, n) for n in names]
    assert got == sorted(want, key=repr)


def test_range_join_by_keys_alone(spark):
    points = spark.range(40).selectExpr("id % 4 AS k", "cast(id AS int) AS p")
    held = spark.createDataFrame([(0, 0, 8, "a"), (0, 4, 20, "b"), (1, 1, 2000000000, "c"), (2, 9, 3, "turned"), (None, 0, 40, "null")], "k long, a int, b int, name string")
    for how in ("left", "inner"):
        assert rows(ranges.range_join(points, held, ["k"], "p", "a", "b", width=None, how=how)) == rows(ranges.range_join(points, held, ["k"], "p", "a", "b", how=how))

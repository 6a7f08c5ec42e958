import os

from gridtables.sources.tables import finished_versions, read_appended, read_latest
from gridtables.streaming.folder import load_folder


def test_folder_is_loaded_once_and_upserted(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    os.mkdir(folder)

    def put(name, text, mtime):
        path = os.path.join(folder, name)
        with open(path, "w") as f:
            f.write(text)
        os.utime(path, (mtime, mtime))

    def run():
        query = load_folder(spark, folder, "delimited", root, checkpoint, keys=["k"], params={"top": "[d]\n", "tail": "[$]"}, glob="*.csv")
        query.awaitTermination()
        return sorted((r.k, r.v) for r in read_latest(spark, root).collect())

    put("z.csv", "[d]\nk,v\n1,old\n2,b\n[$]", 1_000_000)
    put("a.csv", "[d]\nk,v\n1,new\n[$]", 2_000_000)  # later by time, though not by name
    put("bad.csv", "[d]\nk,v\n9,x\n", 2_000_000)
    put("skip.txt", "?", 1_000_000)
    assert run() == [("1", "new"), ("2", "b")]
    assert [r.reason for r in spark.read.parquet(f"{root}.rejects").collect()] == ["footer text not found"]
    versions = finished_versions(spark, root)
    assert run() == [("1", "new"), ("2", "b")] and finished_versions(spark, root) == versions
    put("c.csv", "[d]\nk,v\n2,bb\n3,c\n[$]", 3_000_000)
    assert run() == [("1", "new"), ("2", "bb"), ("3", "c")]


def test_partitioned_folder_load(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    os.mkdir(folder)

    def run():
        load_folder(spark, folder, "delimited", root, checkpoint, keys=["day", "k"], partitions=["day"], params={}).awaitTermination()
        return sorted((r.day, r.k, r.v) for r in spark.read.schema("k string, v string, day string").parquet(root).collect())

    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("day,k,v\nmon,1,a\ntue,1,b\n")
    assert run() == [("mon", "1", "a"), ("tue", "1", "b")]
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("day,k,v\ntue,1,c\ntue,2,d\n")
    assert run() == [("mon", "1", "a"), ("tue", "1", "c"), ("tue", "2", "d")]


def test_a_bad_file_does_not_stop_the_stream(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    os.mkdir(folder)

    def put(name, text):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)

    def run():
        load_folder(spark, folder, "delimited", root, checkpoint, params={"dates": [1]}, glob="*.csv").awaitTermination()
        return sorted(r.k for r in read_appended(spark, root).collect())

    put("narrow.csv", "k\n1")
    put("a [1].csv", "k,day\n2,2014/01/02")
    assert run() == ["2"]
    put("more.csv", "k,day\n3,2014/01/02")
    assert run() == ["2", "3"]
    assert [r.reason for r in spark.read.parquet(f"{root}.rejects").collect()] == ["too few columns"]


def test_files_without_the_key_are_refused_by_name(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "table")
    os.mkdir(folder)

    def put(name, text):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)

    def run(keys, checkpoint):
        load_folder(spark, folder, "delimited", root, str(tmp_path / checkpoint), keys=keys, params={}).awaitTermination()
        return sorted((r.file.rsplit("/", 1)[1], r.reason) for r in spark.read.parquet(f"{root}.rejects").collect())

    put("a.csv", "k,v\n1,x\n,y\n")
    put("b.csv", "x,v\n2,y\n")
    assert run(["nokey"], "one") == [("a.csv", "no key column nokey"), ("b.csv", "no key column nokey")]
    assert finished_versions(spark, root) == []
    assert run(["k"], "two") == [("a.csv", "no value in key k"), ("b.csv", "no key column k")]
    assert [(r.k, r.v) for r in read_latest(spark, root).collect()] == [("1", "x")]


def test_outcomes_are_kept_and_finished_files_archived(spark, tmp_path):
    folder, root, archive = (str(tmp_path / n) for n in ("in", "table", "done"))
    os.mkdir(folder)

    def put(name, text):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)

    def run():
        load_folder(spark, folder, "delimited", root, str(tmp_path / "checkpoint"), keys=["k"], params={}, archive=archive).awaitTermination()
        return {r.file.rsplit("/", 1)[1]: (r.process_status, r.reason, r.records_processed, r.cells_lost) for r in spark.read.parquet(f"{root}.outcomes").collect()}

    put("good.csv", "k,v\n1,x\n2\n")
    put("bad.csv", "x,v\n2,y\n")
    assert run() == {"good.csv": ("SUCCESS", None, 2, 1), "bad.csv": ("ERROR", "no key column k", 0, 0)}
    put("next.csv", "k,v\n3,z\n")
    assert run()["next.csv"] == ("SUCCESS", None, 1, 0)
    moved = {name for _, _, names in os.walk(archive) for name in names if not name.startswith(".")}
    assert {"good.csv", "bad.csv"} <= moved and not os.path.exists(os.path.join(folder, "good.csv"))
    assert sorted((r.k, r.v) for r in read_latest(spark, root).collect()) == [("1", "x"), ("2", None), ("3", "z")]

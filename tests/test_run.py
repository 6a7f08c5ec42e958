import dataclasses

from pyspark.sql import functions as F

from gridtables.plans import loads
from gridtables.plans.run import LEDGER, process_queue, storing
from gridtables.sources import commits, meter
from gridtables.sources.tables import read_appended, read_latest


def test_queue_is_processed_by_job(spark, tmp_path):
    for folder in ("a", "b", "c"):
        (tmp_path / folder).mkdir()
    (tmp_path / "a" / "one.csv").write_text("[d]\nk,v\n1,x\n2,y\n[$]")
    (tmp_path / "a" / "bad.csv").write_text("[d]\nk,v\n1,x\n")
    (tmp_path / "a" / "skip.txt").write_text("?")
    (tmp_path / "b" / "two.csv").write_text("k\n1")
    (tmp_path / "c" / "Rates 2018-10-22.csv").write_text(
        "Instrument,Tenor Type,Tenor,Settle,Bid,Offer,Mid,Bid Method,Offer Method,Mid Method,\nLGC,Spot,CAL18,x,1,2,3,1,1,A,\n")
    jobs = spark.createDataFrame(
        [(1, f"{tmp_path}/a", 5, "*.csv", "delimited", '{"top": "[d]\\n", "tail": "[$]"}', 1),
         (2, f"{tmp_path}/b/", 1, "*", "delimited", '{"tabel": 1}', 1),
         (3, f"{tmp_path}/c", 2, "*.csv", "environmental", "{}", 1),
         (4, f"{tmp_path}/c", 2, "*.csv", "meter", "{}", 0)],
        "id int, source_folder string, priority int, filename_pattern string, handler string, handler_params string, active_flag int")
    stored = {}

    def write(job, parsed):
        stored[job.id] = parsed

    ledger = process_queue(spark, jobs, spark.createDataFrame([], LEDGER), write)
    got = {r.file_name: (r.job_id, r.process_status, r.records_processed) for r in ledger.collect()}
    assert got == {"one.csv": (1, "SUCCESS", 2), "bad.csv": (1, "ERROR", 0), "two.csv": (2, "ERROR", 0), "Rates 2018-10-22.csv": (3, "SUCCESS", 1)}
    ids = {r.file_name: r.id for r in ledger.collect()}
    assert {r.source_file_id for r in stored[1].rows.collect()} == {ids["one.csv"]}
    table = loads.store(spark.createDataFrame([], "k string, v string"), stored[1].rows.select("k", "v", "mtime", "line_no"), ["k"], ["mtime", "line_no"])
    assert sorted(map(tuple, loads.added_at(table, "2020-01-01").select("k", "v", F.col("added_dttm").cast("string")).collect())) == [
        ("1", "x", "2020-01-01 00:00:00"), ("2", "y", "2020-01-01 00:00:00")]
    assert process_queue(spark, jobs, ledger, write).count() == 0


JOBS = "id int, source_folder string, priority int, filename_pattern string, handler string, handler_params string, active_flag int"


def run(spark, jobs, **options):
    stored = {}

    def write(job, parsed):
        stored.setdefault(job.id, []).extend(r.asDict() for r in parsed.rows.collect())

    ledger = process_queue(spark, spark.createDataFrame(jobs, JOBS), spark.createDataFrame([], LEDGER), write, **options)
    return {r.file_name: (r.process_status, r.records_processed) for r in ledger.collect()}, stored


def test_files_with_faults_fail_alone(spark, tmp_path):
    for folder in ("csv", "zip", "profile"):
        (tmp_path / folder).mkdir()
    (tmp_path / "csv" / "one.csv").write_text("k,v\n1,x")
    (tmp_path / "csv" / "other.csv").write_text("k,w\n2,y")
    (tmp_path / "csv" / "extra.csv").write_text("k,v\n1,x,extra")
    (tmp_path / "csv" / "a [1].csv").write_text("k,v\n3,z")
    (tmp_path / "profile" / "narrow.csv").write_text("<CSVData>\na,b\n1,2\n</CSVData>")
    (tmp_path / "profile" / "good.csv").write_text("<CSVData>\nProfileName,ProfileArea,SettlementDate,CreationDT\nP,A,2014/01/02,2014/01/03 04:05:06\n</CSVData>")
    import zipfile

    with zipfile.ZipFile(tmp_path / "zip" / "good.zip", "w") as archive:
        archive.writestr("m.csv", "k,v\n5,q")
    (tmp_path / "zip" / "broken.zip").write_bytes(b"PK not really")
    got, stored = run(spark, [
        (1, f"{tmp_path}/csv", 1, "*.csv", "delimited", "{}", 1), (2, f"{tmp_path}/zip", 2, "*.zip", "delimited", '{"archived": true}', 1),
        (3, f"{tmp_path}/profile", 3, "*.csv", "delimited", '{"feed": "load_profile"}', 1)])
    assert got == {
        "one.csv": ("SUCCESS", 1), "other.csv": ("SUCCESS", 1), "extra.csv": ("ERROR", 0), "a [1].csv": ("SUCCESS", 1), "good.zip": ("SUCCESS", 1),
        "broken.zip": ("ERROR", 0), "narrow.csv": ("ERROR", 0), "good.csv": ("SUCCESS", 1)}
    assert sorted((r["k"], r.get("v"), r.get("w")) for r in stored[1]) == [("1", "x", None), ("2", None, "y"), ("3", "z", None)]
    assert [(r["k"], r["v"]) for r in stored[2]] == [("5", "q")] and [r["profilename"] for r in stored[3]] == ["P"]


def test_the_queue_is_drained(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"k\n{i}")
    got, stored = run(spark, [(1, str(tmp_path), 1, "*.csv", "delimited", "{}", 1)], max_files=2)
    assert got == {f"{i}.csv": ("SUCCESS", 1) for i in range(5)} and sorted(r["k"] for r in stored[1]) == list("01234")


def test_daily_files_are_found_whatever_their_case(spark, tmp_path):
    head = "title" + "\t" * 11 + "04 Sep 2002\nNSW\n"
    row = "Q1\t1" + "\t" * 10 + "\n"
    (tmp_path / "Settlement_Caps_20020903.txt").write_text(head + row)
    (tmp_path / "settlement_caps_20020904.txt").write_text(head + row)
    found = loads.read_daily(spark, str(tmp_path), ["settlement_caps"])
    assert found["settlement_caps"].rows.select("file").distinct().count() == 2


def test_from_folder_to_tables_and_ledger(spark, tmp_path):
    root = str(tmp_path / "tables")
    (tmp_path / "in").mkdir()
    (tmp_path / "log").mkdir()
    jobs = spark.createDataFrame([
        (1, f"{tmp_path}/in", 1, "*.csv", "delimited", '{"table": "prices", "key_fields": ["k"]}', 1),
        (2, f"{tmp_path}/log", 2, "*.csv", "delimited", '{"table": "events"}', 1),
        (3, f"{tmp_path}/log", 3, "*.txt", "delimited", '{"mode": "merge"}', 1)], JOBS)

    def put(name, text, mtime):
        import os

        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (mtime, mtime))

    put("in/b.csv", "k,v\n1,new\n2,b", 2_000_000)
    put("in/a.csv", "k,v\n1,old", 3_000_000 - 2_000_000)
    put("log/x.csv", "k,v\n1,x", 1_000_000)
    put("log/y.txt", "?", 1_000_000)
    ledger = process_queue(spark, jobs, spark.createDataFrame([], LEDGER), storing(spark, root))
    status = {r.file_name: (r.process_status, r.records_processed) for r in ledger.collect()}
    assert status == {"a.csv": ("SUCCESS", 1), "b.csv": ("SUCCESS", 2), "x.csv": ("SUCCESS", 1), "y.txt": ("ERROR", 0)}
    ids = {r.file_name: r.id for r in ledger.collect()}
    assert sorted((r.k, r.v, r.source_file_id) for r in read_latest(spark, f"{root}/prices").collect()) == [
        ("1", "new", ids["b.csv"]), ("2", "b", ids["b.csv"])]
    put("in/c.csv", "k,v\n2,c\n3,d", 3_000_000)
    put("log/z.csv", "k,w\n2,z", 3_000_000)
    process_queue(spark, jobs, ledger, storing(spark, root))
    assert sorted((r.k, r.v) for r in read_latest(spark, f"{root}/prices").collect()) == [("1", "new"), ("2", "c"), ("3", "d")]
    assert sorted((r.k, r.v, r.w) for r in read_appended(spark, f"{root}/events").collect()) == [("1", "x", None), ("2", None, "z")]


def test_long_names_are_loaded_by_their_path(spark, tmp_path):
    (tmp_path / "in").mkdir()
    long = "a" * 90 + ".csv"
    for name, text in ((long, "k,v\n1,x"), ("b" + long, "k,v\n2,y"), ("short.csv", "k,v\n3,z")):
        (tmp_path / "in" / name).write_text(text)
    jobs = spark.createDataFrame([(1, f"{tmp_path}/in", 1, "*.csv", "delimited", "{}", 1)], JOBS)
    seen = []
    ledger = process_queue(spark, jobs, spark.createDataFrame([], LEDGER), lambda job, parsed: seen.extend(r.k for r in parsed.rows.collect()))
    rows = ledger.collect()
    assert sorted(seen) == ["1", "2", "3"] and {(r.process_status, r.records_processed) for r in rows} == {("SUCCESS", 1)}
    assert sorted(r.path.rsplit("/", 1)[1] for r in rows) == sorted([long, "b" + long, "short.csv"])
    assert {r.file_name for r in rows} == {long[-80:], "short.csv"} and len({r.id for r in rows}) == 3
    assert process_queue(spark, jobs, ledger, lambda job, parsed: None).count() == 0
    # a ledger written before paths were kept knows files by what it shows
    older = ledger.drop("path", "reason", "cells_lost")
    assert process_queue(spark, jobs, older, lambda job, parsed: None).count() == 0


def test_files_without_the_key_fail_alone_and_reasons_are_kept(spark, tmp_path):
    root = str(tmp_path / "tables")
    (tmp_path / "in").mkdir()
    files = {"a.csv": "k,v\n1,x\n,lost\n2\n", "b.csv": "x,v\n9,y", "c.csv": "k,v\n3,z,extra", "d.csv": "k,k\n1,1"}
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    jobs = spark.createDataFrame([
        (1, f"{tmp_path}/in", 1, "*.csv", "delimited", '{"table": "prices", "key_fields": ["k"]}', 1),
        (2, f"{tmp_path}/in", 2, "a.csv", "delimited", '{"tabel": 1}', 1)], JOBS)
    rows = process_queue(spark, jobs, spark.createDataFrame([], LEDGER), storing(spark, root)).collect()
    found = {(r.job_id, r.file_name): (r.process_status, r.records_processed, r.reason, r.cells_lost) for r in rows}
    assert found == {
        (1, "a.csv"): ("SUCCESS", 2, None, 2), (1, "b.csv"): ("ERROR", 0, "no key column k", 0),
        (1, "c.csv"): ("ERROR", 0, "a row with more cells than the heading", 0), (1, "d.csv"): ("ERROR", 0, "a column name stands twice", 0),
        (2, "a.csv"): ("ERROR", 0, "unknown parameters: tabel", 0)}
    assert sorted((r.k, r.v) for r in read_latest(spark, f"{root}/prices").collect()) == [("1", "x"), ("2", None)]
    rejects = read_appended(spark, f"{root}/prices.rejects").collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.line_no, r.column, r.reason) for r in rejects if r.line_no is not None) == [
        ("a.csv", 2, "k", "no value in key k"), ("a.csv", 3, "v", "fewer cells than columns")]
    assert sorted(r.file.rsplit("/", 1)[1] for r in rejects if r.line_no is None) == ["b.csv", "c.csv", "d.csv"]


METER = "100,NEM12,202403010000,MDA,RET\n200,{nmi},E1,1,E1,N1,M1,kWh,30,\n300,20240201," + ",".join(["1.5"] * 48) + ",V,,,20240301000000,\n400,1,20,A,,\n400,21,48,F14,76,\n500,O,S1,20240301000000,\n900\n"


def test_meter_files_fill_their_six_tables_in_one_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    (tmp_path / "in").mkdir()
    jobs = spark.createDataFrame([(1, f"{tmp_path}/in", 1, "*.csv", "meter", "{}", 1)], JOBS)

    def put(nmi, text=METER):
        (tmp_path / "in" / f"NEM12#{nmi}#MDA#RET.csv").write_text(text.format(nmi=nmi))

    def counts():
        held = meter.stored_tables(spark, f"{root}/meter")
        return {f.name: getattr(held, f.name).count() for f in dataclasses.fields(held)}

    put("N000000001")
    put("N000000002")
    put("N000000003", METER.replace("kWh", "nope"))
    ledger = process_queue(spark, jobs, spark.createDataFrame([], LEDGER), storing(spark, root))
    status = {r.file_name: (r.process_status, r.records_processed, r.reason) for r in ledger.collect()}
    assert status == {"NEM12#N000000001#MDA#RET.csv": ("SUCCESS", 48, None), "NEM12#N000000002#MDA#RET.csv": ("SUCCESS", 48, None),
                      "NEM12#N000000003#MDA#RET.csv": ("ERROR", 0, "invalid UOM")}
    first = {"file_details": 1, "stream_details": 2, "readings": 2, "interval_key": 2, "quality": 4, "b2b": 2}
    assert counts() == first
    held = meter.stored_tables(spark, f"{root}/meter")
    ids = {r.id for r in ledger.collect() if r.process_status == "SUCCESS"}
    assert {r.source_file_id for r in held.interval_key.collect()} == ids
    assert {r.ReadingID for r in held.interval_key.collect()} == {r.ID for r in held.readings.collect()} == {1, 2}
    assert {r.KeyID for r in held.quality.collect()} == {1, 2}

    written = commits.added

    def fails(df, root, table, id_col=None):
        if table == "interval_key":
            raise ValueError("disk full")
        return written(df, root, table, id_col)

    put("N000000004")
    monkeypatch.setattr(commits, "added", fails)
    failed = process_queue(spark, jobs, ledger, storing(spark, root))
    assert [(r.process_status, r.reason) for r in failed.collect()] == [("ERROR", "disk full")] and counts() == first
    monkeypatch.setattr(commits, "added", written)
    process_queue(spark, jobs, ledger, storing(spark, root))
    assert counts() == {"file_details": 1, "stream_details": 3, "readings": 3, "interval_key": 3, "quality": 6, "b2b": 3}


def test_a_keyed_job_in_buckets(spark, tmp_path):
    root = str(tmp_path / "tables")
    (tmp_path / "in").mkdir()
    jobs = spark.createDataFrame([(1, f"{tmp_path}/in", 1, "*.csv", "delimited", '{"table": "t", "key_fields": ["k"], "buckets": 1}', 1)], JOBS)
    (tmp_path / "in" / "a.csv").write_text("k,v\n" + "\n".join(f"{i},x" for i in range(60)))
    ledger = process_queue(spark, jobs, spark.createDataFrame([], LEDGER), storing(spark, root))
    before = {p.bucket: p.part for p in commits.parts(spark, f"{root}/t") if p.bucket}
    (tmp_path / "in" / "b.csv").write_text("k,v\n7,y\n99,z")
    process_queue(spark, jobs, ledger, storing(spark, root))
    after = {p.bucket: p.part for p in commits.parts(spark, f"{root}/t") if p.bucket}
    got = {r.k: r.v for r in commits.read(spark, f"{root}/t", "t").collect()}
    assert len(got) == 61 and (got["7"], got["8"], got["99"]) == ("y", "x", "z") and sum(after[b] != before.get(b) for b in after) <= 2


def test_backfill_loads_the_files_of_a_span_of_days(spark, tmp_path):
    from gridtables.plans.run import backfill

    (tmp_path / "in").mkdir()
    for day in (1, 2, 4, 9):
        (tmp_path / "in" / f"p_2020010{day}.csv").write_text(f"k,v\n{day},x")
    (tmp_path / "in" / "other.csv").write_text("k,v\n77,x")
    jobs = spark.createDataFrame(
        [(1, f"{tmp_path}/in/", 1, "*.csv", "delimited", "{}", 1, "p_{year}{month}{day}.csv"), (2, f"{tmp_path}/in", 1, "*.csv", "delimited", "{}", 0, "p_{year}.csv")],
        JOBS + ", file_template string")
    seen = []

    def write(job, parsed):
        seen.extend(r.k for r in parsed.rows.collect())

    ledger, missing = backfill(spark, jobs, spark.createDataFrame([], LEDGER), write, "2020-01-01", "2020-01-04")
    assert sorted(seen) == ["1", "2", "4"] and {r.process_status for r in ledger.collect()} == {"SUCCESS"}
    assert [(r.job_id, r.file_name) for r in missing.collect()] == [(1, "p_20200103.csv")]
    again, _ = backfill(spark, jobs, ledger, write, "2020-01-01", "2020-01-09")
    assert [r.file_name for r in again.collect()] == ["p_20200109.csv"]

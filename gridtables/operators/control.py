"""Load control as data: file queue, ledger, retention, backfill grids and download work lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.functions.expr import absolute_url, expand_template, file_name, glob_match, hrefs, last_characters, listing_names, plain_path
from gridtables.operators.ids import assign_ids, max_id

QUEUE_ORDER = ("priority", "mtime", "size", "path")


def list_files(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    """``path, folder, file_name, mtime, size`` of files; their contents are not read."""
    found = spark.read.format("binaryFile").load(folders if isinstance(folders, str) else list(folders))
    path = plain_path(F.col("path"))
    return found.select(
        path.alias("path"),
        F.regexp_replace(path, "/[^/]*$", "").alias("folder"),
        file_name(path).alias("file_name"),
        F.col("modificationTime").cast("timestamp_ntz").alias("mtime"),
        F.col("length").alias("size"),
    )


def active_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("active_flag") == 1)


def file_queue(files: DataFrame, jobs: DataFrame) -> DataFrame:
    """Files waiting for a job: joined on the folder, matched by the job's pattern, in processing order."""
    wanted = active_jobs(jobs).select(
        F.col("id").alias("job_id"), plain_path(F.col("source_folder")).alias("folder"), "priority",
        F.trim("filename_pattern").alias("_glob"), "handler", "handler_params",
    )
    tagged = files.join(wanted, "folder").filter(glob_match(F.col("file_name"), F.col("_glob"))).drop("_glob")
    return tagged.orderBy(*QUEUE_ORDER)


def next_file(queue: DataFrame) -> DataFrame:
    """The file to process next."""
    return queue.orderBy(*QUEUE_ORDER).limit(1)


def start_loads(queue: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows ``STARTED`` for queued files that the ledger does not hold in this version (path, mtime).

    A file is known by its path; ``file_name`` shows the last 80 characters of its name. Entries without a path, of ledgers
    written before it was kept, are met by folder and shown name.
    """
    rows = queue.select(
        "job_id", last_characters(F.col("file_name")).alias("file_name"), F.col("folder").alias("source_folder"),
        F.lit("STARTED").alias("process_status"), F.lit(0).cast("long").alias("records_processed"),
        F.col("mtime").alias("file_modified_dttm"), "path",
    ).distinct()
    shown = ["source_folder", "file_name", "file_modified_dttm"]
    older = ledger
    if "path" in ledger.columns:
        rows = rows.join(ledger.select("path", "file_modified_dttm").distinct(), ["path", "file_modified_dttm"], "left_anti")
        older = ledger.filter("path IS NULL")
    fresh = rows.join(older.select(*shown).distinct(), shown, "left_anti")
    return assign_ids(fresh, ["job_id", *shown], "id", max_id(ledger, "id"), ties=["path"]).select(
        "id", "job_id", "file_name", "source_folder", "process_status", "records_processed", "file_modified_dttm", "path"
    )


def finish_loads(started: DataFrame, loaded: DataFrame, refused: DataFrame) -> DataFrame:
    """The started rows with their outcome. ``loaded`` and ``refused`` carry ``source_file_id``; a reject with a line number is a
    fault of that line and leaves the file loaded. Where the started rows have ``reason`` and ``cells_lost``, these are filled too."""
    counts = loaded.groupBy(F.col("source_file_id").alias("id")).agg(F.count("*").alias("_n"))
    whole = F.col("line_no").isNull() if "line_no" in refused.columns else F.lit(True)
    reason = F.col("reason") if "reason" in refused.columns else F.lit(None).cast("string")
    faults = refused.groupBy(F.col("source_file_id").alias("id")).agg(
        F.max(whole).alias("_bad"), F.min(F.when(whole, reason)).alias("_reason"), F.count(F.when(~whole, 1)).alias("_lost"))
    done = started.join(counts, "id", "left").join(faults, "id", "left")
    ok = ~F.coalesce("_bad", F.lit(False))
    found = {
        "process_status": F.when(ok, "SUCCESS").otherwise("ERROR"),
        "records_processed": F.when(ok, F.coalesce("_n", F.lit(0))).otherwise(0).cast("long"),
        "reason": F.col("_reason"), "cells_lost": F.coalesce("_lost", F.lit(0)).cast("long"),
    }
    return done.withColumns({c: v for c, v in found.items() if c in started.columns}).select(*started.columns)


def latest_status(ledger: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Latest ledger row per file, as an aggregate that shrinks before the shuffle."""
    best = ledger.groupBy(*keys).agg(F.max(F.struct(*order, *columns)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in (*order, *columns)])


def route(files: DataFrame, jobs: DataFrame) -> DataFrame:
    """Where each finished file belongs: the job's success or fail folder."""
    folders = jobs.select(F.col("id").alias("job_id"), "success_folder", "fail_folder")
    target = F.when(F.col("process_status") == "SUCCESS", F.col("success_folder")).otherwise(F.col("fail_folder"))
    return files.join(folders, "job_id").withColumn("destination", F.concat_ws("/", target, "file_name")).drop(
        "success_folder", "fail_folder"
    )


def retention(files: DataFrame, jobs: DataFrame, now: datetime | str) -> DataFrame:
    """Archived files older than their job's retention; a negative number of days keeps files for good."""
    rules = jobs.select(
        F.col("id").alias("job_id"), plain_path(F.col("success_folder")).alias("folder"),
        F.trim("filename_pattern").alias("_glob"), F.col("success_retention_days").alias("_days"),
    ).filter("_days >= 0")
    limit = F.lit(str(now)).cast("timestamp_ntz") - F.make_dt_interval("_days")
    old = files.join(rules, "folder").filter(glob_match(F.col("file_name"), F.col("_glob")) & (F.col("mtime") < limit))
    return old.drop("_glob", "_days")


def backfill_grid(jobs: DataFrame, start: str, end: str, step: str = "1 day") -> DataFrame:
    """Every job at every moment from ``start`` to ``end``, as ``run_time``."""
    def moment(text: str) -> Column:
        return F.lit(text).cast("timestamp_ntz")

    return jobs.withColumn("run_time", F.explode(F.sequence(moment(start), moment(end), F.expr(f"interval {step}"))))


def expand_templates(df: DataFrame, columns: Sequence[str], at: str) -> DataFrame:
    return df.withColumns({c: expand_template(F.col(c), F.col(at)) for c in columns})


def job_parameters(text: Column) -> Column:
    """Handler parameters from a JSON object; anything else gives an empty map."""
    none = F.create_map().cast("map<string,string>")
    return F.coalesce(F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"}), none)


def extract_links(pages: DataFrame, url: str, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """``file_url`` and ``file_name`` for every link of the pages, repeated links included."""
    link = F.explode(hrefs(F.col(html)))
    found = pages.select(*keep, F.col(url).alias("_base"), link.alias("_href"))
    return found.select(*keep, absolute_url(F.col("_base"), F.col("_href")).alias("file_url")).withColumn(
        "file_name", file_name(F.col("file_url"))
    )


def parse_listing(listings: DataFrame, url: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``file_url`` and ``file_name`` for every line of FTP directory listings."""
    names = listings.select(*keep, F.col(url).alias("_base"), F.explode(listing_names(F.col(text))).alias("_name"))
    return names.select(*keep, absolute_url(F.col("_base"), F.col("_name")).alias("file_url")).withColumn(
        "file_name", file_name(F.col("file_url"))
    )


def work_list(links: DataFrame, manifest: DataFrame, pattern: str | Column = "*", redownload: bool = False) -> DataFrame:
    """Links to fetch: names that match the pattern and, unless ``redownload``, are not in the manifest."""
    wanted = links.filter(glob_match(F.col("file_name"), pattern))
    if redownload:
        return wanted
    return wanted.join(manifest.select("file_name").distinct(), "file_name", "left_anti").select(*links.columns)

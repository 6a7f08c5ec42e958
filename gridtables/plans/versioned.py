"""A stored versioned table: current rows are replaced per run, closed versions are only ever added to."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.operators import scd2
from gridtables.sources.tables import finished_versions, write_version


def committed(spark: SparkSession, root: str) -> tuple[str | None, list[str]]:
    """Folders of the current rows and of the closed versions of the last committed run. History newer than that belongs to a run that failed."""
    done = finished_versions(spark, f"{root}/current")
    if not done:
        return None, []
    return f"{root}/current/version={done[-1]}", [f"{root}/history/version={v}" for v in finished_versions(spark, f"{root}/history") if v <= done[-1]]


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions."""
    current, past = committed(spark, root)
    if current is None:
        return None
    table = spark.read.parquet(current)
    if not past:
        return table
    # a column that came later is null in older versions
    return table.unionByName(spark.read.option("mergeSchema", "true").parquet(*past), allowMissingColumns=True)


def _top_id(spark: SparkSession, root: str) -> int | None:
    """The largest id of the last committed run, as it noted it; null for tables from before runs did."""
    done = finished_versions(spark, f"{root}/current")
    if done and done[-1] in finished_versions(spark, f"{root}/ids"):
        return spark.read.schema("top_id long").parquet(f"{root}/ids/version={done[-1]}").first().top_id
    return None


def synchronise(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    keys: Sequence[str],
    now: datetime,
    process: str | None = None,
    **options: bool,
) -> DataFrame:
    """Merges a snapshot into the table under ``root`` and appends the audit and message rows.

    The closed versions are written first and the current rows last: the run takes effect when the current
    rows are committed, and a failed run leaves the table as it was, with status FAILURE in the audit.
    """
    process = process or root.rstrip("/").rsplit("/", 1)[-1]
    log = [(datetime.now(), f"Starting process for table {process}")]
    try:
        table = read(spark, root)
        if table is None:
            table = spark.createDataFrame([], scd2.definition(source.schema))
        version = max(finished_versions(spark, f"{root}/current"), default=0) + 1
        log.append((datetime.now(), "Commencing merge"))
        result = scd2.merge(table, source, keys, now, top_id=_top_id(spark, root), **options)
        audit = scd2.audit(result.changes, source, process, now, datetime.now()).first()
        if result.added:  # a run without closed versions adds no history
            write_version(result.closed, f"{root}/history", version)
        write_version(spark.createDataFrame([(result.top_id,)], "top_id long").coalesce(1), f"{root}/ids", version)
        write_version(result.current, f"{root}/current", version)
        log.append((
            datetime.now(),
            f"Process complete. Inserted {audit.records_inserted}, updated {audit.records_updated},"
            f" deleted {audit.records_deleted}",
        ))
        row = spark.createDataFrame([audit])
    except (PySparkException, ValueError) as fault:
        log.append((datetime.now(), str(fault).splitlines()[0]))
        row = spark.range(1).select(
            F.lit(process).alias("process_name"), F.lit(process).alias("target_table"),
            F.lit("FAILURE").alias("process_status"), *[F.lit(0).cast("long").alias(f"records_{a}") for a in ("inserted", "updated", "deleted")],
            F.lit(None).cast("long").alias("total_source_records"),
            scd2.instant(now).alias("start_time"), scd2.instant(datetime.now()).alias("finish_time"),
        )
    row.write.mode("append").parquet(f"{root}/audit")
    messages = spark.createDataFrame(log, "entry_datetime timestamp_ntz, log_entry string")
    messages.write.mode("append").parquet(f"{root}/messages")
    return row

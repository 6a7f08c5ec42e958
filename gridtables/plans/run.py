"""One pass over the file queue: every active job's waiting files are loaded together and entered in the ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridtables.functions.expr import literal_path, plain_path
from gridtables.operators import control
from gridtables.operators.merge import check_keys
from gridtables.plans.loads import HandlerError, dispatch, parameters, store, with_lineage
from gridtables.session import cut_lineage
from gridtables.sources import commits, meter
from gridtables.sources.lines import REJECT_COLUMNS, Parsed, Records
from gridtables.sources.tables import append_batch, read_latest, write_version

LEDGER = (
    "id long, job_id int, file_name string, source_folder string, process_status string, records_processed long,"
    " file_modified_dttm timestamp_ntz, path string, reason string, cells_lost long"
)


def process_queue(
    spark: SparkSession,
    jobs: DataFrame,
    ledger: DataFrame,
    write: Callable[[Row, Parsed], None],
    max_files: int = 1000,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Loads all waiting files of each active job, ``max_files`` at a time, and returns their finished ledger rows.

    Jobs are configuration and run by priority. ``write`` gets the job and its parsed rows and rejects, both with
    ``source_file_id`` and, for last-row-wins, ``priority``, ``mtime`` and ``size``, once for each set of files that were read
    together. A fault of one job, such as bad parameters, fails that job's files and leaves the others alone. Any other fault
    is narrowed down to the files that have it, and these fail alone. A file that fails is entered with the reason, a loaded one
    with the number of cells that were lost from it. ``wanted`` (job_id, file_name) leaves all other files waiting.
    """
    active = control.active_jobs(jobs).orderBy("priority", "id").collect()
    if not active:
        return spark.createDataFrame([], LEDGER)
    folders = sorted({job.source_folder.strip() for job in active})
    queue = control.file_queue(control.list_files(spark, folders), jobs)
    if wanted is not None:
        queue = queue.join(wanted.select("job_id", "file_name").distinct(), ["job_id", "file_name"], "left_semi")
    started = control.start_loads(queue, ledger).select("id", "job_id", "path", F.col("file_name").alias("shown"))
    waiting = cut_lineage(queue.join(started, ["job_id", "path"]))
    done = spark.createDataFrame([], LEDGER)
    for job in active:
        own = waiting.filter(F.col("job_id") == job.id)
        # the driver holds one batch of paths at a time
        rows = own.orderBy(*control.QUEUE_ORDER).select("path").toLocalIterator()
        while paths := [r.path for r in islice(rows, max_files)]:
            wanted = spark.createDataFrame([(p,) for p in paths], "path string")
            done = done.unionByName(_load(spark, job, own.join(wanted, "path", "left_semi"), paths, write))
    return done


def backfill(
    spark: SparkSession, jobs: DataFrame, ledger: DataFrame, write: Callable[[Row, Parsed], None], start: str, end: str,
    step: str = "1 day", max_files: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """Loads the files that jobs expect for every moment from ``start`` to ``end``: (finished ledger rows, files that are not there).

    A job's ``file_template`` names its file of a moment, see ``expr.expand_template``. All moments of a job are loaded together. Files that the
    ledger holds are not loaded again, and the missing ones (job_id, run_time, file_name) can be asked for.
    """
    grid = control.backfill_grid(control.active_jobs(jobs), start, end, step).withColumn("file_name", F.col("file_template"))
    grid = control.expand_templates(grid, ["file_name"], "run_time").select(F.col("id").alias("job_id"), "run_time", "file_name", "source_folder")
    grid = cut_lineage(grid.withColumn("folder", plain_path(F.col("source_folder"))).drop("source_folder"))
    folders = [r.folder for r in grid.select("folder").distinct().collect()]  # of the jobs, which are configuration
    there = control.list_files(spark, folders).select("folder", "file_name") if folders else grid.select("folder", "file_name").limit(0)
    missing = grid.join(there, ["folder", "file_name"], "left_anti").select("job_id", "run_time", "file_name")
    return process_queue(spark, jobs, ledger, write, max_files, grid), missing


#: What reading or writing files may raise; a fault of the job's own parameters is not among them.
FAULTS = (PySparkException, ValueError, LookupError, ArithmeticError, TypeError, Py4JJavaError)


def isolated(paths: Sequence[str], attempt: Callable[[Sequence[str]], object]) -> tuple[list[tuple[Sequence[str], object]], dict[str, str]]:
    """Results of ``attempt`` over sets of paths, and the reasons of the paths that fail alone: a set that fails is halved."""
    try:
        return [(paths, attempt(paths))], {}
    except HandlerError:
        raise
    except FAULTS as fault:
        if len(paths) == 1:
            return [], {paths[0]: reason_of(fault)}
    half = len(paths) // 2
    first, second = isolated(paths[:half], attempt), isolated(paths[half:], attempt)
    return first[0] + second[0], first[1] | second[1]


def _load(spark: SparkSession, job: Row, batch: DataFrame, paths: list[str], write: Callable[[Row, Parsed], None]) -> DataFrame:
    started = batch.select(
        "id", "job_id", F.col("shown").alias("file_name"), F.col("folder").alias("source_folder"), F.lit("STARTED").alias("process_status"),
        F.lit(0).cast("long").alias("records_processed"), F.col("mtime").alias("file_modified_dttm"), "path",
        F.lit(None).cast("string").alias("reason"), F.lit(0).cast("long").alias("cells_lost"))
    sources = batch.select(F.col("path").alias("file"), F.col("id").alias("source_file_id"), "priority", "mtime", "size")

    def plain(df: DataFrame) -> DataFrame:
        """A member of an archive belongs to the archive's entry."""
        return df.withColumn("member", F.col("file")).withColumn("file", F.regexp_replace("file", "!/.*$", ""))

    def attempt(some: Sequence[str]) -> Parsed:
        parsed = dispatch(spark, job.handler, [literal_path(p) for p in some], job.handler_params)
        found = with_lineage(Parsed(plain(parsed.rows), plain(parsed.rejects)), sources)
        found = Parsed(cut_lineage(found.rows), cut_lineage(found.rejects))
        if isinstance(parsed, Records):
            found = Records(*found)
            found.parts = parsed.parts
        return found

    try:
        results, faults = isolated(paths, attempt)
    except HandlerError as fault:
        return _failed(started, fault)
    done = spark.createDataFrame([], LEDGER)
    files = batch.select("id", "path")
    for some, found in results:
        read = spark.createDataFrame([(p,) for p in some], "path string").join(files, "path").select("id")
        own = started.join(read, "id", "left_semi")
        try:
            write(job, found)
            done = done.unionByName(cut_lineage(control.finish_loads(own, found.rows, found.rejects)))
        except FAULTS as fault:
            done = done.unionByName(_failed(own, fault))
    if faults:
        reasons = spark.createDataFrame([*faults.items()], "path string, _reason string")
        done = done.unionByName(started.join(reasons, "path").withColumns(
            {"process_status": F.lit("ERROR"), "reason": F.col("_reason")}).select(*started.columns))
    return done


def _failed(started: DataFrame, fault: Exception) -> DataFrame:
    return started.withColumns({"process_status": F.lit("ERROR"), "reason": F.lit(reason_of(fault))})


def reason_of(fault: Exception) -> str:
    """First line of what went wrong."""
    return str(fault).splitlines()[0][:300] if str(fault) else type(fault).__name__


def storing(spark: SparkSession, root: str) -> Callable[[Row, Parsed], None]:
    """A ``write`` that puts a job's rows into the table its parameters name, below ``root``.

    A keyed load writes a new version of its table: later files overwrite earlier ones, by priority, time, size and line. A load
    without keys only adds files; one in buckets rewrites the buckets it touches. Rows keep ``source_file_id``. A meter job adds to its six
    tables, below the folder its parameters name, in one commit. Refused files and lost cells go to the table's ``.rejects``, a batch
    named after its first file.
    """

    def write(job: Row, found: Parsed) -> None:
        target, _ = parameters(job.handler, job.handler_params)
        if not target.table:
            raise HandlerError("the job names no table")
        first = found.rejects.agg(F.min("source_file_id")).first()[0]
        if first is not None:
            append_batch(found.rejects.select("source_file_id", *REJECT_COLUMNS), f"{root}/{target.table}.rejects", first)
        if isinstance(found, Records):
            files = found.rows.select("member", "source_file_id").distinct().withColumnRenamed("member", "file")
            ids = files.agg(F.min("source_file_id")).first()[0]
            if ids is not None:
                meter.store(spark, f"{root}/{target.table}", found.parts, files, ids)
            return
        rows = found.rows.drop("member", "chunk")
        order = [c for c in ("priority", "mtime", "size", "file", "line_no") if c in rows.columns and c not in target.keys]
        path = f"{root}/{target.table}"
        if not target.keys or target.mode == "append":
            check_keys(rows, target.keys)
            ids = rows.agg(F.min("source_file_id")).first()[0]
            if ids is not None:  # the batch is named after its first file, so a repeated load replaces itself
                append_batch(rows.drop(*order), path, ids)
            return
        if target.buckets:
            ids = rows.agg(F.min("source_file_id")).first()[0]
            entries = commits.upserted(spark, path, target.table, rows, target.keys, order, digits=target.buckets)
            commits.commit(spark, path, {target.table: entries}, ids)
            return
        old = read_latest(spark, path)
        if old is None:
            old = spark.createDataFrame([], rows.drop(*order).schema)
        write_version(store(old, rows, target.keys, order, ignore_duplicates=target.mode == "insert"), path)

    return write

"""Continuous load of a folder: new files are found by Structured Streaming and upserted batch by batch."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtables.functions.expr import literal_path, plain_path
from gridtables.operators import control
from gridtables.operators.merge import check_keys
from gridtables.plans.loads import dispatch, store
from gridtables.plans.run import isolated
from gridtables.session import cut_lineage
from gridtables.sources.lines import REJECT_COLUMNS, Parsed, whole_files
from gridtables.sources.tables import append_batch, finished_versions, read_latest, upsert_partitions, write_version

_FILES = "path string, modificationTime timestamp, length long, content binary"


def load_folder(
    spark: SparkSession,
    folder: str,
    handler: str,
    root: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    params: Mapping[str, object] | None = None,
    glob: str = "*",
    max_files: int = 1000,
    null_safe: bool = False,
    partitions: Sequence[str] = (),
    archive: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Loads each new file of ``folder`` once into the Parquet table under ``root``.

    The stream only lists files (their contents are not read by it); a batch hands its paths to the handler, ``max_files`` being the
    size of a batch and not of the load. Batch ``n`` writes table version ``n + 1``, so a batch that is repeated after a failure
    is not applied twice. Without keys a batch only adds its own files, see ``tables.read_appended``. With ``partitions`` (key
    columns) a batch rewrites only the partitions it touches, the way for large tables; repeating such an upsert gives the
    same rows. Files that cannot be read or lack a key column fail alone. A file rewritten under an old name is not seen again: such
    feeds are loaded from the queue and ledger instead. Refused files and lost cells go to ``root.rejects``, the outcome of every
    file (status, reason, rows, lost cells) to ``root.outcomes``. With ``archive`` the stream moves the files of finished batches there, those of
    the last batch when the load is started again; refused ones are told apart by their outcome. Default
    trigger: everything there is, then stop.
    """
    source = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
    if archive:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = source.load(folder).select("path", "modificationTime", "length")

    def load(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        version = epoch + 1
        if not partitions and version in finished_versions(session, root):
            return
        paths = [r.path for r in batch.select("path").collect()]
        if not paths:
            return

        def attempt(some: Sequence[str]) -> Parsed:
            given = {**(params or {}), "key_fields": list(keys)} if keys else params
            found = dispatch(session, handler, [literal_path(p) for p in some], given)
            check_keys(found.rows, keys if found.rows.columns[2:] else ())  # no columns: every file is among the rejects
            return Parsed(cut_lineage(found.rows), cut_lineage(found.rejects.select(*REJECT_COLUMNS)))

        results, faults = isolated([plain(p) for p in paths], attempt)
        rejects = whole_files(session.createDataFrame([*faults.items()], "file string, reason string"))
        rows = None
        for _, found in results:
            rejects = rejects.unionByName(found.rejects)
            rows = found.rows if rows is None else rows.unionByName(found.rows, allowMissingColumns=True)
        rejects.write.mode("overwrite").parquet(f"{root}.rejects/batch={epoch}")
        outcomes(session, paths, rows, rejects).write.mode("overwrite").parquet(f"{root}.outcomes/batch={epoch}")
        if rows is None or not set(keys) <= set(rows.columns):
            return
        if not keys and not partitions:
            append_batch(rows, root, epoch)
            return
        order = ("mtime", "size", "file", "line_no")
        rows = rows.join(queue_order(session, paths), "file", "left")
        if partitions:
            upsert_partitions(session, root, rows.drop("member"), keys, partitions, order, null_safe, epoch)
            return
        old = read_latest(session, root)
        if old is None:
            old = session.createDataFrame([], rows.drop(*order).schema)
        write_version(store(old, rows, keys, order, null_safe=null_safe), root, version)

    return (
        files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def outcomes(spark: SparkSession, paths: Sequence[str], rows: DataFrame | None, rejects: DataFrame) -> DataFrame:
    """(file, process_status, reason, records_processed, cells_lost) of the files of a batch."""
    files = spark.createDataFrame([(i, plain(p)) for i, p in enumerate(paths, 1)], "id long, path string")
    started = files.select("id", F.col("path").alias("file"), F.lit("STARTED").alias("process_status"), F.lit(None).cast("string").alias("reason"),
                           F.lit(0).cast("long").alias("records_processed"), F.lit(0).cast("long").alias("cells_lost"))
    named = files.select(F.col("id").alias("source_file_id"), F.col("path").alias("_path"))

    def of_file(df: DataFrame) -> DataFrame:
        """By the file's number; a member of an archive belongs to the archive."""
        return df.join(named, F.regexp_replace("file", "!/.*$", "") == F.col("_path")).drop("_path")

    loaded = named.limit(0) if rows is None else of_file(rows.select("file"))
    return control.finish_loads(started, loaded, of_file(rejects)).drop("id")


def plain(uri: str) -> str:
    """A local listing's URI as a path; other stores keep theirs."""
    return re.sub("^file:/+", "/", uri)


def queue_order(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Modification time and size of the batch's files: later files overwrite earlier ones."""
    listed = spark.read.format("binaryFile").load([literal_path(plain(p)) for p in paths])
    return listed.select(
        plain_path(F.col("path")).alias("file"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size")
    )

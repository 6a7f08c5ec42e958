"""Parquet tables that are replaced as a whole or by partition without reading what is being overwritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtables.operators.merge import any_null, check_keys, same_key, tagged, upsert
from gridtables.session import cut_lineage


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def finished_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose write was committed (``_SUCCESS`` is there), ascending."""
    fs, path = _file_system(spark, root)
    if not fs.exists(path):
        return []
    done = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            done.append(int(name.removeprefix("version=")))
    return sorted(done)


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    versions = finished_versions(spark, root)
    return spark.read.parquet(f"{root}/version={versions[-1]}") if versions else None


def write_version(df: DataFrame, root: str, version: int | None = None) -> int:
    """Writes a new version beside the one being read; readers switch when the write is committed."""
    if version is None:
        version = max(finished_versions(df.sparkSession, root), default=0) + 1
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    return version


def read_partitioned(spark: SparkSession, root: str, partitions: StructType) -> DataFrame:
    """A partitioned table with every column any of its files has; partition values keep their declared type (``01`` stays text)."""
    stored = spark.read.option("mergeSchema", "true").parquet(root).schema
    declared = {f.name: f for f in partitions}
    return spark.read.schema(StructType([declared.get(f.name, f) for f in stored])).parquet(root)


def upsert_partitions(
    spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str], partitions: Sequence[str],
    order: Sequence[str] = (), null_safe: bool = False, batch: int | None = None,
) -> None:
    """Upsert into a partitioned table, reading and rewriting only the partitions the source touches.

    The partition columns must be keys, so a row never changes its partition; a null is a partition like any other. The merged
    rows are stored before the old files are replaced. With ``batch`` every stored row carries the batch that wrote it, and
    rows with a null key, which no upsert can match, are not added again when a batch is repeated.
    """
    check_keys(source.select(*keys), partitions)
    fs, path = _file_system(spark, root)
    if batch is not None:
        source = source.withColumn("batch_id", F.lit(batch).cast("long"))
    written = [c for c in source.columns if c not in order]
    if fs.exists(path):
        declared = StructType([source.schema[p] for p in partitions])
        touched = tagged(source.select(*partitions).distinct())
        old = read_partitioned(spark, root, declared).join(touched, same_key(partitions, null_safe=True), "left_semi")
        if batch is not None and not null_safe:
            old = old.filter(~(any_null(keys) & (F.col("batch_id") == batch)) | F.col("batch_id").isNull())
    else:
        old = spark.createDataFrame([], source.select(*written).schema)
    merged = cut_lineage(upsert(old, source, keys, order, null_safe))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(root)


def append_batch(df: DataFrame, root: str, batch: int) -> None:
    """Adds one batch's files to an append-only table; earlier files stay as they are and a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{root}/batch_id={batch}")


def read_appended(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(root)

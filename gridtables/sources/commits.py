"""Several tables under one root that change together: a commit is a Parquet file that names the parts of every table.

A part is a folder of Parquet files, written before the commit and never changed. A load adds parts, or puts new ones in the place of
those it rewrote, for one table or for many; the commit is written last, so readers see all of a load or nothing. A keyed
table keeps its rows in buckets by the MD5 of the key, a part for each bucket, with the number of rows and the largest id in
the commit: an upsert reads and rewrites only the buckets its rows fall into, and new ids need no pass over the table. Rows with a
null key, which no upsert can match, are only added.

Rows of a commit: table, part (path below the root), bucket (null for parts that are only added), n, top_id, batch, schema. The
driver holds this list, one row for each bucket and each added part; ``compact`` makes one part of a table's added ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtables.operators.ids import key_digits
from gridtables.operators.merge import any_null, check_keys, upsert
from gridtables.sources.tables import finished_versions

PARTS = "table string, part string, bucket string, n long, top_id long, batch long, schema string"
BUCKET = "_bucket"
#: Hexadecimal digits of the bucket's name: 16, 256 or 4096 buckets.
DIGITS = 2


def parts(spark: SparkSession, root: str) -> list[Row]:
    """The parts of the last commit."""
    done = finished_versions(spark, f"{root}/commits")
    return spark.read.schema(PARTS).parquet(f"{root}/commits/version={done[-1]}").collect() if done else []


def read(spark: SparkSession, root: str, table: str, buckets: Sequence[str] | None = None) -> DataFrame | None:
    """A table as of the last commit, or only some of its buckets; null where it has no parts. A column that came later is null in older parts."""
    mine = [p for p in parts(spark, root) if p.table == table]
    return _rows(spark, root, mine, buckets)


def _rows(spark: SparkSession, root: str, mine: Sequence[Row], buckets: Sequence[str] | None = None) -> DataFrame | None:
    if not mine:
        return None
    fields = {f.name: f for schema in dict.fromkeys(p.schema for p in mine) for f in StructType.fromJson(json.loads(schema))}
    schema = StructType([*fields.values()])
    paths = [f"{root}/{p.part}" for p in mine if buckets is None or p.bucket in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def added(df: DataFrame, root: str, table: str, id_col: str | None = None) -> list[Row]:
    """Writes rows as a new part of ``table`` and gives its entry; no reader sees it before the commit. No rows, no part."""
    spark, part = df.sparkSession, f"data/{table}/{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{part}")
    top = F.max(id_col).cast("long") if id_col else F.lit(None).cast("long")
    n, top_id = spark.read.schema(df.schema).parquet(f"{root}/{part}").agg(F.count("*"), top).first()
    return [Row(table=table, part=part, bucket=None, n=n, top_id=top_id, schema=df.schema.json())] if n else []


def commit(spark: SparkSession, root: str, entries: Mapping[str, Sequence[Row]], batch: int | None = None, replace: Sequence[str] = ()) -> int:
    """Makes the entries of each table take effect together and gives the commit's number.

    An entry of a bucket replaces the earlier one of this bucket; other entries are added, or, for the tables to ``replace``, put in the
    place of all that were added before. A ``batch`` that a commit already holds is not committed again, so a repeated load has no effect. One writer
    at a time: two that start from the same commit write the same number, and the later one wins.
    """
    done = finished_versions(spark, f"{root}/commits")
    held = parts(spark, root)
    if batch is not None and any(p.batch == batch for p in held):
        return done[-1]
    fresh = {(t, e.bucket) for t, es in entries.items() for e in es if e.bucket is not None}
    kept = [p for p in held if (p.table, p.bucket) not in fresh and not (p.bucket is None and p.table in replace)]
    rows = [tuple(p) for p in kept]
    rows += [(t, e.part, e.bucket, e.n, e.top_id, batch, e.schema) for t, es in entries.items() for e in es]
    if batch is not None:  # a load without rows is remembered too
        rows.append(("", "", None, 0, None, batch, StructType([]).json()))
    version = (done[-1] if done else 0) + 1
    spark.createDataFrame(rows, PARTS).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/version={version}")
    return version


def top_id(spark: SparkSession, root: str, table: str) -> int:
    """The largest id of a table, from the commit alone."""
    return max((p.top_id for p in parts(spark, root) if p.table == table and p.top_id is not None), default=0)


def upserted(
    spark: SparkSession, root: str, table: str, source: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
    null_safe: bool = False, id_col: str | None = None, digits: int = DIGITS,
) -> list[Row]:
    """Entries of the buckets of ``table`` that ``source`` touches, with the upsert's result written to them; see ``merge.upsert``.

    ``source`` is read several times, so pass one that is stored. ``digits`` must stay the same for a table.
    """
    check_keys(source, keys)
    written = [c for c in source.columns if c not in order]
    keyed, loose = source, []
    if not null_safe:
        keyed, null = source.filter(~any_null(keys)), source.filter(any_null(keys)).select(*written)
        loose = [] if null.isEmpty() else added(null, root, table, id_col)
    place = key_digits([F.col(k) for k in keys], digits).alias(BUCKET)
    touched = [r[0] for r in keyed.select(place).distinct().collect()]
    if not touched:
        return loose
    mine = [p for p in parts(spark, root) if p.table == table]
    if {len(p.bucket) for p in mine if p.bucket is not None} - {digits}:
        raise ValueError(f"{table} is not kept in buckets of {digits} digits")
    old = _rows(spark, root, mine, touched)
    if old is None:
        old = spark.createDataFrame([], keyed.select(*written).schema)
    merged = upsert(old, keyed, keys, order, null_safe)
    schema, part = merged.schema, f"data/{table}/{uuid.uuid4().hex}"
    merged = merged.select("*", place)
    # a bucket may be larger than a task: adaptive execution cuts large ones and joins small ones
    merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/{part}")
    stored = spark.read.schema(merged.schema).parquet(f"{root}/{part}")
    top = F.max(id_col).cast("long") if id_col else F.lit(None).cast("long")
    counts = stored.groupBy(BUCKET).agg(F.count("*").alias("n"), top.alias("top_id")).collect()
    return loose + [
        Row(table=table, part=f"{part}/{BUCKET}={r[BUCKET]}", bucket=r[BUCKET], n=r.n, top_id=r.top_id, schema=schema.json()) for r in counts]


def compact(spark: SparkSession, root: str, table: str, id_col: str | None = None) -> int | None:
    """Puts one part in the place of those that were added one by one."""
    mine = [p for p in parts(spark, root) if p.table == table and p.bucket is None]
    return commit(spark, root, {table: added(_rows(spark, root, mine), root, table, id_col)}, replace=[table]) if len(mine) > 1 else None

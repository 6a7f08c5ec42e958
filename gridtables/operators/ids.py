"""Dense surrogate ids that need no global sort.

Rows are spread over a fixed number of buckets by a hash of their key, counted per bucket, and numbered
inside the bucket after the rows of all lower buckets. The numbering depends on the keys only, so a
recomputed or retried task gives the same ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtables.session import cut_lineage

# three hex digits of the key hash
BUCKET_DIGITS = 3
_COPIES = 10_000
# rows that one task unrolls, about
_TASK_ROWS = 250_000


def key_bucket(columns: Sequence[Column]) -> Column:
    return key_digits(columns, BUCKET_DIGITS)


def key_digits(columns: Sequence[Column], digits: int) -> Column:
    """The first hex digits of the MD5 of a key's text."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])
    return F.substring(F.md5(text), 1, digits)


def max_id(df: DataFrame, id_col: str) -> Column:
    """Highest id in use, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()


def _with_offset(rows: DataFrame, group: Sequence[str], size: Column) -> DataFrame:
    """Adds ``_offset``: how many rows lie in lower buckets. The bucket table has 4096 rows per lead value."""
    counts = rows.groupBy(*group).agg(F.sum(size).alias("_n"))
    lower = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_offset"))
    return rows.join(F.broadcast(offsets), list(group), "inner")


def assign_ids(
    df: DataFrame, keys: Sequence[str], id_col: str, start: Column, lead: str | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Numbers the rows of ``df`` from ``start + 1``; ``keys`` and ``ties`` must identify a row (nulls count as values).

    ``lead`` names a column with a handful of values that is numbered through first (all rows of the
    lowest value, then the next).
    """
    rows = df.withColumn("_bucket", key_bucket([F.col(k) for k in keys]))
    group = ([lead] if lead else []) + ["_bucket"]
    placed = _with_offset(rows, group, F.lit(1))
    inside = Window.partitionBy(*group).orderBy(*[F.col(k).asc_nulls_first() for k in (*keys, *ties)])
    return placed.withColumn(
        id_col, (start + F.col("_offset") + F.row_number().over(inside)).cast("long")
    ).drop("_bucket", "_offset")


def assign_ids_to_copies(df: DataFrame, id_col: str, start: Column) -> DataFrame:
    """Numbers rows that may be exact copies of each other, however many copies there are.

    Copies are counted first (combined map-side) and unrolled again in runs of at most 10,000, so a
    row repeated for a third of the table is neither sorted nor numbered in one task. The runs are dealt to
    as many tasks as there are rows for: they are few and short before they are unrolled, so adaptive execution,
    which goes by their bytes, would put them all into one. The counted rows are stored once, as three steps use them.
    """
    columns = df.columns
    rows = cut_lineage(df.groupBy(*columns).agg(F.count("*").alias("_copies")))
    tasks = -(-(rows.agg(F.sum("_copies")).first()[0] or 1) // _TASK_ROWS)
    rows = rows.withColumn("_bucket", key_bucket([F.col(c) for c in columns]))
    placed = _with_offset(rows, ["_bucket"], F.col("_copies"))
    before = (
        Window.partitionBy("_bucket")
        .orderBy(*[F.col(c).asc_nulls_first() for c in columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = placed.withColumn("_base", F.col("_offset") + F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    runs = placed.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_copies") - 1), F.lit(_COPIES).cast("long"))))
    spread = runs.repartition(tasks, F.col("_base"), F.col("_run"))
    size = F.least(F.lit(_COPIES).cast("long"), F.col("_copies") - F.col("_run"))
    return spread.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(
        *columns, (start + F.col("_base") + F.col("_run") + F.col("_i")).cast("long").alias(id_col)
    )

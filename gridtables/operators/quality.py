"""Repeated and conflicting rows, column fills and data-driven number columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.operators.merge import same_key, tagged


def _of_keys(df: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(tagged(chosen.select(*keys)), same_key(keys, null_safe=True), "left_semi")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once. Counted with map-side combine, never by a window per key."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    return _of_keys(df, repeated, keys)


def conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has two different non-null values in some other column."""
    rest = [c for c in df.columns if c not in keys]
    differ = F.lit(False)
    for c in rest:
        differ = differ | F.coalesce(F.min(c) != F.max(c), F.lit(False))
    clashing = df.groupBy(*keys).agg(differ.alias("_differ")).filter("_differ")
    return _of_keys(df, clashing, keys)


def resolve(df: DataFrame, keys: Sequence[str], rules: Mapping[str, str] | None = None) -> DataFrame:
    """One row per key: ``max`` of each column, or ``min`` where ``rules`` says so; nulls are ignored.

    A unique row and agreeing duplicates come out unchanged, so no branch by kind of duplicate is needed.
    """
    rules = rules or {}
    pick = {"max": F.max, "min": F.min}
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(*[pick[rules.get(c, "max")](c).alias(c) for c in rest])
    return best.select(*df.columns)


def fill_from_first(
    df: DataFrame, column: str, part: Sequence[str], order: str, default: Column | None = None
) -> DataFrame:
    """Fills nulls of ``column`` with the value on the first row of the group, or ``default`` if that is null.

    ``default`` (say, a date taken from the file name) may differ per group.
    """
    first = df.groupBy(*part).agg(F.min_by(F.struct(F.col(column).alias("v")), F.col(order)).alias("_row"))
    filled = df.join(tagged(first), same_key(part, null_safe=True), "left")
    start = F.col("_r__row.v")
    if default is not None:
        start = F.coalesce(start, default)
    return filled.withColumn(column, F.coalesce(F.col(column), start)).select(*df.columns)


def numeric_coerce(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns to doubles, other text becoming null.

    Without ``columns`` the data decides (one pass): a text column holding no number at all stays text.
    """
    if columns is None:
        texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
        if not texts:
            return df
        hits = df.agg(*[F.count(F.col(c).try_cast("double")).alias(c) for c in texts]).first()
        columns = [c for c in texts if hits[c] > 0]
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns}) if columns else df


def pivot_attributes(
    df: DataFrame, entity: Sequence[str], name: str, value: str, names: Sequence[str], order: str
) -> DataFrame:
    """Attribute rows to one column per listed name; the last row by ``order`` wins."""
    return df.groupBy(*entity).agg(
        *[F.max_by(F.col(value), F.when(F.col(name) == n, F.col(order))).alias(n) for n in names]
    )


def union_pad(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, columns matched by name and padded with nulls."""
    return first.unionByName(second, allowMissingColumns=True)

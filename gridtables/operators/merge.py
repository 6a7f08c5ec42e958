"""Keyed writes as joins: upsert, insert-if-absent, get-or-create of surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.operators.ids import assign_ids, max_id
from gridtables.session import cut_lineage, staged


# rows of a source that one task joins, about
_TASK_ROWS = 250_000


class KeyColumnError(ValueError):
    """A key is not a column of the data."""


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyColumnError(f"keys must be among the columns, missing: {', '.join(missing)}")


def any_null(keys: Sequence[str]) -> Column:
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return test


def tagged(df: DataFrame, tag: str = "_r_") -> DataFrame:
    """Every column renamed with a prefix, so both sides of a join can be told apart by name."""
    return df.select(*[F.col(c).alias(tag + c) for c in df.columns])


def same_key(keys: Sequence[str], null_safe: bool, tag: str = "_r_") -> Column:
    """Join condition between a frame and a ``tagged`` one."""
    test = F.lit(True)
    for n, k in enumerate(keys):
        one = F.col(k).eqNullSafe(F.col(tag + k)) if null_safe else F.col(k) == F.col(tag + k)
        test = one if n == 0 else test & one
    return test


def whole_key(keys: Sequence[str], tag: str = "") -> Column:
    """All keys as one value that is never null; nulls inside are equal to each other."""
    return F.struct(*[F.col(tag + k).alias(f"k{n}") for n, k in enumerate(keys)])


def matching(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    """``same_key`` between ``left`` and ``tagged(right)``, in the form by which ``dealt`` deals rows."""
    if null_safe and all(left.schema[k].dataType == right.schema[k].dataType for k in keys):
        return whole_key(keys) == whole_key(keys, "_r_")
    return same_key(keys, null_safe)


def dealt(source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """A stored source dealt by key to as many tasks as its rows need; a small one, which may be broadcast, stays as it is.

    Joins by key move short rows, and adaptive execution, which goes by their bytes, would sort many millions of them in one task.
    """
    rows = source.count()
    if rows <= _TASK_ROWS:
        return source
    tasks = max(-(-rows // _TASK_ROWS), int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return source.repartition(tasks, *([whole_key(keys)] if null_safe else keys))


def pick_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = True
) -> DataFrame:
    """One row per key: the last (or first) by ``order``, ties settled by the row's own values.

    An aggregate rather than a window, so a repeated key shrinks to one row per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    order = [c for c in order if c not in keys]
    if not rest and not order:
        return df.select(*keys).distinct()
    row = F.struct(*order, *rest)
    best = (F.max if last else F.min)(row).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def present_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Keys of ``source`` that ``target`` holds. Reads only key columns of the target."""
    wanted = tagged(source.select(*keys))
    return target.select(*keys).join(wanted, matching(target, source, keys, null_safe), "left_semi").distinct()


def absent(source: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Rows of ``source`` whose key ``target`` does not hold."""
    found = tagged(present_keys(target, source, keys, null_safe))
    return source.join(found, matching(source, target, keys, null_safe), "left_anti")


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """Overwrite matched rows with the source's columns, insert the others.

    * Repeated keys in the source: the last row by ``order`` wins (order columns are not written unless
      the target has them).
    * Plain equality by default: a row with a null key matches nothing and is always inserted.
      ``null_safe=True`` treats nulls as equal.
    * Columns only the target has are kept on a match and null on an insert.
    * No keys: append. Only key columns: insert if absent.

    The target side is joined from the left, so a small source is broadcast by its measured size and a
    hot target key can be split by adaptive execution.
    """
    check_keys(source, keys)
    written = [c for c in source.columns if c in target.columns or c not in order]
    if not keys:
        return append(target, source.select(*written))
    check_keys(target, keys)

    usable = source if null_safe else source.filter(~any_null(keys))
    latest = staged(pick_per_key(usable, keys, order).select(*written))  # last rows are picked once for updates and inserts
    latest = dealt(latest, keys, null_safe)
    inserts = absent(latest, target, keys, null_safe)
    if not null_safe:
        inserts = inserts.unionByName(source.filter(any_null(keys)).select(*written))

    data = [c for c in written if c not in keys]
    if not data:
        return append(target, inserts)
    fresh = tagged(latest.withColumn("hit", F.lit(True)))
    joined = target.join(fresh, matching(target, latest, keys, null_safe), "left")
    columns = [
        F.when(F.col("_r_hit"), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c) if c in data else F.col(c)
        for c in target.columns
    ]
    columns += [F.col(f"_r_{c}").alias(c) for c in data if c not in target.columns]
    return append(joined.select(*columns), inserts)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Insert rows whose key is new, the first row per key by ``order``; nulls count as equal."""
    check_keys(source, keys)
    check_keys(target, keys)
    written = [c for c in source.columns if c in target.columns or c not in order]
    first = dealt(staged(pick_per_key(source, keys, order, last=False).select(*written)), keys, null_safe=True)
    return append(target, absent(first, target, keys, null_safe=True))


def get_or_create_keys(
    dim: DataFrame, source: DataFrame, keys: Sequence[str], id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Surrogate keys for the key combinations of ``source``; nulls count as equal.

    Returns the dimension with the missing combinations added and ``source`` with ``id_col``. The new
    combinations are stored once where a checkpoint folder is set, as both results use them.
    """
    grown = append(dim, new_keys(dim, source, keys, id_col))
    return grown, with_keys(grown, source, keys, id_col)


def new_keys(dim: DataFrame, source: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """The key combinations of ``source`` that the dimension lacks, numbered after it."""
    check_keys(source, keys)
    check_keys(dim, keys)
    combos = dealt(staged(source.select(*keys).distinct()), keys, null_safe=True)
    new = cut_lineage(absent(combos, dim, keys, null_safe=True))
    return assign_ids(new, keys, id_col, max_id(dim, id_col))


def with_keys(dim: DataFrame, source: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """``source`` with the id that the dimension has for its keys."""
    known = tagged(dim.select(*keys, id_col))
    found = source.join(known, same_key(keys, null_safe=True), "left")
    return found.select(*source.columns, F.col(f"_r_{id_col}").alias(id_col))


def with_row_ids(df: DataFrame, target: DataFrame, position: Sequence[str], id_col: str = "id") -> DataFrame:
    """Ids for plainly inserted rows, numbered after ``target``; ``position`` (file, line) identifies a row."""
    return assign_ids(df, position, id_col, max_id(target, id_col))

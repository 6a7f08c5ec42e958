"""Versioned (type 2) tables: key and data columns plus ``id``, ``active_from``, ``active_to``.

Validity is half-open, ``[active_from, active_to)``; the open end is 9999-12-31. Only the current rows
take part in a merge, so closed versions are never shuffled or rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtables.operators.ids import assign_ids, assign_ids_to_copies
from gridtables.operators.merge import absent, any_null, check_keys, same_key, tagged
from gridtables.session import staged

ID, FROM, TO = "id", "active_from", "active_to"


def instant(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


OPEN_END = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class MergeResult:
    current: DataFrame  # rows valid from now on
    closed: DataFrame  # versions closed by this merge
    changes: DataFrame  # one row per INSERT / UPDATE / DELETE with the replaced values
    history: DataFrame  # versions closed earlier, untouched
    numbered: DataFrame  # rows with a key that got a new id
    loose: int  # rows without a key that got one
    base: int  # the largest id before

    @cached_property
    def added(self) -> int:
        """Rows that got a new id."""
        return self.loose + self.numbered.count()

    @property
    def top_id(self) -> int:
        """The largest id in use after the merge."""
        return self.base + self.added

    @property
    def table(self) -> DataFrame:
        return self.history.unionByName(self.current).unionByName(self.closed)


def definition(source: T.StructType) -> T.StructType:
    """Schema of the versioned table for a source."""
    fields = [T.StructField(ID, T.LongType())]
    fields += [T.StructField(f.name, f.dataType) for f in source.fields]
    fields += [T.StructField(FROM, T.TimestampNTZType()), T.StructField(TO, T.TimestampNTZType())]
    return T.StructType(fields)


def init(source: DataFrame, keys: Sequence[str], now: datetime | str) -> DataFrame:
    """First load into an empty versioned table."""
    check_keys(source, keys)
    columns = source.columns
    data = [c for c in columns if c not in keys]
    life = [instant(now).alias(FROM), instant(OPEN_END).alias(TO)]
    keyed = _unique(source, keys, data).select(*keys, *[F.col(f"_s.{c}").alias(c) for c in data])
    given_null = source.filter(any_null(keys))
    loose = given_null.count()
    table = assign_ids(keyed, keys, ID, F.lit(loose)).select(ID, *columns, *life)
    if loose:
        table = table.unionByName(assign_ids_to_copies(given_null, ID, F.lit(0)).select(ID, *columns, *life))
    return table


def _unique(source: DataFrame, keys: Sequence[str], data: Sequence[str]) -> DataFrame:
    """One row per key; a repeated key fails the job, and with it the whole merge."""
    row = F.min(F.struct(*[F.col(c) for c in data]) if data else F.lit(1)).alias("_s")
    grouped = source.filter(~any_null(keys)).groupBy(*keys).agg(F.count("*").alias("_n"), row)
    once = F.assert_true(F.col("_n") == 1, F.lit("source repeats a key"))
    return grouped.filter(once.isNull()).drop("_n")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now: datetime | str,
    point_in_time: bool = True,
    remove_if_not_found: bool = True,
    resurrect: bool = True,
    top_id: int | None = None,
) -> MergeResult:
    """Synchronise the versioned ``target`` with a full snapshot ``source``.

    * changed current row: overwritten in place (keeps its id), valid from ``now``;
    * key without a row: inserted. With ``resurrect=False`` a key that has only closed versions stays closed;
    * current row without a source row: removed, unless ``remove_if_not_found`` is off;
    * ``point_in_time``: the replaced or removed values stay as a closed version with a new id.

    Data columns are compared null-safely, keys plainly (a null key never matches). A repeated source
    key makes the job fail. A data column that only the source has is added. The joined rows feed every output and are
    stored once (see ``session.staged``). Given the largest id in use, ``top_id``, the closed versions are not read for it.
    """
    check_keys(source, keys)
    if not keys:
        raise ValueError("a versioned table needs at least one key")
    columns = source.columns
    data = [c for c in columns if c not in keys]
    at, late = instant(now), instant(OPEN_END)

    # a column that the source has gained is null in every stored row
    gained = {c: F.lit(None).cast(source.schema[c].dataType) for c in data if c not in target.columns}
    held = target.withColumns(gained).select(ID, *columns, FROM, TO)
    history = held.filter(F.col(TO) != late)
    current = held.filter(F.col(TO) == late)
    cur = current.filter(~any_null(keys)).withColumn("_held", F.lit(True))
    src = tagged(_unique(source, keys, data).withColumn("given", F.lit(True)))

    differs = F.lit(False)
    for c in data:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_r__s.{c}"))
    action = (
        F.when(F.col("_held").isNull(), "INSERT")
        .when(F.col("_r_given").isNull(), F.lit("DELETE" if remove_if_not_found else "KEEP"))
        .when(differs, "UPDATE")
        .otherwise("KEEP")
    )
    sides = cur.join(src, same_key(keys, null_safe=False), "full_outer").select(
        action.alias("merge_action"),
        ID,
        *[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys],
        *data,
        *[F.col(f"_r__s.{c}").alias(f"_new_{c}") for c in data],
        FROM,
        TO,
    )
    sides = staged(sides, "merge_action")  # the join runs once; its outputs read what is theirs
    kept = sides.filter("merge_action = 'KEEP'").select(ID, *columns, FROM, TO)
    moved = sides.filter("merge_action <> 'KEEP'")
    if not resurrect:
        fresh = absent(moved.filter("merge_action = 'INSERT'"), history, keys, null_safe=False)
        moved = fresh.unionByName(moved.filter("merge_action <> 'INSERT'"))

    new_values = [F.col(f"_new_{c}").alias(c) if c in data else F.col(c) for c in columns]
    updated = moved.filter("merge_action = 'UPDATE'").select(ID, *new_values, at.alias(FROM), late.alias(TO))

    # Null keys match nothing, so they never enter the join: all held ones go, all given ones come.
    given_null = source.filter(any_null(keys))
    held_null = current.filter(any_null(keys))
    if not remove_if_not_found:
        kept = kept.unionByName(held_null)
        held_null = held_null.filter(F.lit(False))
    loose = given_null.select(*columns, at.alias(FROM), late.alias(TO))
    if point_in_time:
        loose = loose.unionByName(held_null.select(*columns, FROM, at.alias(TO)))

    # Rows that need an id: those without a key, then inserts, then the closed versions.
    starting = moved.filter("merge_action = 'INSERT'").select(
        F.lit(0).alias("_kind"), *new_values, at.alias(FROM), late.alias(TO)
    )
    if point_in_time:
        ending = moved.filter("merge_action <> 'INSERT'").select(F.lit(1).alias("_kind"), *columns, FROM, at.alias(TO))
        starting = starting.unionByName(ending)
    top = held.agg(F.coalesce(F.max(ID), F.lit(0))).first()[0] if top_id is None else top_id
    loose_rows = loose.count()
    added = assign_ids(starting, keys, ID, F.lit(top + loose_rows), lead="_kind").select(ID, *columns, FROM, TO)
    added = staged(added)
    numbered = added
    if loose_rows:
        added = added.unionByName(assign_ids_to_copies(loose, ID, F.lit(top)).select(ID, *columns, FROM, TO))
    open_rows = added.filter(F.col(TO) == late)
    closed = added.filter(F.col(TO) != late)

    nothing = [F.lit(None).cast("timestamp_ntz").alias(c) for c in (FROM, TO)]
    no_data = [F.col(c) if c in keys else F.lit(None).cast(source.schema[c].dataType).alias(c) for c in columns]
    log = moved.select("merge_action", *columns, FROM, TO)
    if loose_rows or not point_in_time:
        log = log.unionByName(given_null.select(F.lit("INSERT").alias("merge_action"), *no_data, *nothing))
        log = log.unionByName(held_null.select(F.lit("DELETE").alias("merge_action"), *columns, FROM, TO))
    return MergeResult(kept.unionByName(updated).unionByName(open_rows), closed, log, history, numbered, loose_rows, top)


def current(table: DataFrame) -> DataFrame:
    """The rows valid now, as the reporting view shows them."""
    columns = [c for c in table.columns if c not in (ID, FROM, TO)]
    return table.filter(F.col(TO) == instant(OPEN_END)).select(ID, *columns, F.col(FROM).alias("last_modified_dttm"))


def as_of(table: DataFrame, moment: datetime | str) -> DataFrame:
    """The rows that were valid at ``moment``."""
    at = instant(moment)
    return table.filter((F.col(FROM) <= at) & (F.col(TO) > at))


def audit(
    changes: DataFrame,
    source: DataFrame,
    process: str,
    start: datetime | str,
    finish: datetime | str,
) -> DataFrame:
    """One audit row: counts per action, total source rows, status and times."""

    def hits(action: str) -> Column:
        return F.count(F.when(F.col("merge_action") == action, 1))

    return changes.agg(
        F.lit(process).alias("process_name"),
        F.lit(process).alias("target_table"),
        F.lit("SUCCESS").alias("process_status"),
        hits("INSERT").alias("records_inserted"),
        hits("UPDATE").alias("records_updated"),
        hits("DELETE").alias("records_deleted"),
    ).select(
        "*",
        source.agg(F.count("*")).scalar().alias("total_source_records"),
        instant(start).alias("start_time"),
        instant(finish).alias("finish_time"),
    )

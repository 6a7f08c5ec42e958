"""Joins and checks on integer ranges such as ``start_interval .. end_interval``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.operators import positional
from gridtables.operators.merge import same_key, tagged
from gridtables.session import cut_lineage


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    point: str,
    start: str,
    end: str,
    width: int | None = 16,
    how: str = "left",
    salts: int = 1,
) -> DataFrame:
    """Points with the ranges of the same key that hold them (both ends included).

    Ranges are laid out over cells and joined on key and cell, so one key with very many points or ranges is spread over its
    cells and no row meets all ranges of its key. Cells are ``width`` positions wide, or 8, 64, ... times that for longer
    ranges: a range lies in at most 9 cells however long it is, and a point asks one cell for each width there is, in one join whose
    key has the width. Where a hot key has only few cells, ``salts`` spreads its
    points further at the price of as many copies of the ranges.

    ``width=None`` is for keys that have few ranges each, however many keys there are: there are no cells and no look at the ranges
    before, and points that are dealt by the keys already are neither moved nor sorted. All ranges of a key meet each of its points.
    """
    if width is None:
        return _by_keys(points, ranges, keys, point, start, end, how)
    length = F.col(end) - F.col(start)
    level = F.greatest(F.lit(0), F.ceil(F.log(F.greatest(length, F.lit(1)) / F.lit(8.0 * width)) / F.log(F.lit(8.0)) - 1e-9)).cast("int")
    usable = ranges.filter(F.col(start) <= F.col(end)).withColumn("_level", level)
    levels = sorted(r[0] for r in usable.select("_level").distinct().collect())  # at most 21
    if not levels or levels == [0]:
        return _in_cells(points, usable.drop("_level"), keys, point, start, end, F.lit(width), how, salts)
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    wide = F.lit(width) * F.pow(F.lit(8.0), F.col("_level"))
    rows = points if how == "inner" else cut_lineage(points.withColumn("_row", F.monotonically_increasing_id()))
    asked = rows.withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    found = _in_cells(asked, usable, [*keys, "_level"], point, start, end, wide, "inner", salts).drop("_level")
    if how == "inner":
        return found
    rest = rows.join(found.select("_row").distinct(), "_row", "left_anti")
    return found.unionByName(rest, allowMissingColumns=True).drop("_row")


def _by_keys(points: DataFrame, ranges: DataFrame, keys: Sequence[str], point: str, start: str, end: str, how: str) -> DataFrame:
    held = tagged(ranges.filter(F.col(start) <= F.col(end))).hint("shuffle_hash")
    inside = F.col(point).between(F.col(f"_r_{start}"), F.col(f"_r_{end}"))
    joined = points.join(held, same_key(keys, null_safe=False) & inside, how)
    extra = [c for c in ranges.columns if c not in keys]
    return joined.select(*points.columns, *[F.col(f"_r_{c}").alias(c) for c in extra])


def _in_cells(
    points: DataFrame, ranges: DataFrame, keys: Sequence[str], point: str, start: str, end: str, width: Column, how: str, salts: int,
) -> DataFrame:
    cell = F.floor(F.col(point) / width)
    cells = F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))
    laid = tagged(ranges.filter(F.col(start) <= F.col(end)).withColumn("_cell", F.explode(cells)))
    points_at = points.withColumn("_cell", cell)
    matched = [*keys, "_cell"]
    if salts > 1:
        points_at = points_at.withColumn("_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int"))
        laid = laid.withColumn("_r__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        matched.append("_salt")
    on = same_key(matched, null_safe=False)
    inside = F.col(point).between(F.col(f"_r_{start}"), F.col(f"_r_{end}"))
    joined = points_at.join(laid, on & inside, how)
    extra = [c for c in ranges.columns if c not in keys]
    return joined.select(*points.columns, *[F.col(f"_r_{c}").alias(c) for c in extra])


def contiguous_error(
    df: DataFrame,
    part: Sequence[str],
    order: str,
    start: str,
    end: str,
    chunk: Column | None = None,
    chunk_rows: int = positional.CHUNK_ROWS,
) -> DataFrame:
    """Adds ``range_error``: the first range must start at 1, every other right after the one before."""
    with_end = positional.scan(df, part, order, chunk, chunk_rows, _before=positional.previous(F.col(end)))
    begin = F.coalesce(F.col("_before"), F.lit(0)) + 1
    error = F.when(F.col(end) < F.col(start), "range ends before it starts").when(
        F.col(start) != begin, "range does not follow the one before"
    )
    return with_end.withColumn("range_error", error).drop("_before")


def slots(values: DataFrame, array: str, slot: str = "interval", value: str = "value") -> DataFrame:
    """One row per element of an array column, numbered from 1."""
    rest = [c for c in values.columns if c != array]
    return values.select(*rest, F.posexplode(array).alias("_p", value)).select(
        *rest, (F.col("_p") + 1).alias(slot), value
    )

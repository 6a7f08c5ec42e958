"""Row-order logic (parents by position, running counts, previous row) that survives a huge group.

A window partitioned by file alone would put a whole file into one task. Here each file is cut into
chunks of consecutive rows, the window runs per (file, chunk), every chunk is reduced to one summary
row, and a second window over the summaries carries values across chunk borders. The full rows are
shuffled once, by (file, chunk); the per-file window only ever sees one row per chunk.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# A group of 10^11 rows gives a million chunks, still few for the one task that carries values across them.
CHUNK_ROWS = 100_000

_START, _HERE = Window.unboundedPreceding, Window.currentRow


@dataclass(frozen=True)
class Scan:
    """How one ordered value is computed inside a chunk, summarised per chunk, and combined."""

    inside: Callable[[WindowSpec], Column] | None
    summary: Callable[[Column], Column]
    across: Callable[[Column, WindowSpec], Column]
    combine: Callable[[Column | None, Column, Column], Column]


def carry(value: Column) -> Scan:
    """Latest non-null ``value`` up to and including the row."""
    return Scan(
        lambda w: F.last(value, True).over(w.rowsBetween(_START, _HERE)),
        lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        lambda s, w: F.last(s, True).over(w.rowsBetween(_START, -1)),
        lambda local, before, first: F.coalesce(local, before),
    )


def carry_before(value: Column) -> Scan:
    """Latest non-null ``value`` on the rows strictly before the row."""
    return Scan(
        lambda w: F.last(value, True).over(w.rowsBetween(_START, -1)),
        lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        lambda s, w: F.last(s, True).over(w.rowsBetween(_START, -1)),
        lambda local, before, first: F.coalesce(local, before),
    )


def previous(value: Column) -> Scan:
    """``value`` of the row directly before, null on the first row of the group."""
    return Scan(
        lambda w: F.lag(value).over(w),
        lambda order: F.max_by(F.struct(value.alias("v")), order),
        lambda s, w: F.lag(s).over(w),
        lambda local, before, first: F.when(first, before["v"]).otherwise(local),
    )


def running(value: Column) -> Scan:
    """Sum of ``value`` up to and including the row, nulls counting as zero."""
    zero = F.coalesce(value, F.lit(0))
    return Scan(
        lambda w: F.sum(zero).over(w.rowsBetween(_START, _HERE)),
        lambda order: F.sum(zero),
        lambda s, w: F.sum(s).over(w.rowsBetween(_START, -1)),
        lambda local, before, first: local + F.coalesce(before, F.lit(0)),
    )


def _whole(reduce_: Callable[[Column], Column], value: Column) -> Scan:
    return Scan(
        None,
        lambda order: reduce_(value),
        lambda s, w: reduce_(s).over(w.rowsBetween(_START, Window.unboundedFollowing)),
        lambda local, total, first: total,
    )


def whole_min(value: Column) -> Scan:
    """Minimum over the whole group, nulls ignored."""
    return _whole(F.min, value)


def whole_max(value: Column) -> Scan:
    return _whole(F.max, value)


def whole_sum(value: Column) -> Scan:
    return _whole(F.sum, F.coalesce(value, F.lit(0)))


def scan(
    df: DataFrame,
    part: Sequence[str],
    order: str,
    chunk: Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
    **scans: Scan,
) -> DataFrame:
    """``df`` plus one column per named scan.

    ``part`` columns must not be null and ``order`` must be unique within them. ``chunk`` has to grow
    with ``order``; by default it is ``order`` divided into runs of ``chunk_rows``, which suits line
    numbers and other dense integers. ``df`` is evaluated twice (summaries and rows): cut its lineage first
    (``session.cut_lineage``) if it is itself the result of a scan or another costly plan.
    """
    part = list(part)
    cut = chunk if chunk is not None else F.expr(f"`{order}` div {int(chunk_rows)}L")
    keys = [*part, "_chunk"]
    rows = df.withColumn("_chunk", cut)

    sums = rows.groupBy(*keys).agg(*[s.summary(F.col(order)).alias(f"_s_{n}") for n, s in scans.items()])
    border = Window.partitionBy(*part).orderBy("_chunk")
    sums = sums.select(*keys, *[s.across(F.col(f"_s_{n}"), border).alias(f"_a_{n}") for n, s in scans.items()])

    within = Window.partitionBy(*keys).orderBy(order)
    local = {n: s.inside(within) for n, s in scans.items() if s.inside is not None}
    if local:
        rows = rows.withColumns({f"_l_{n}": c for n, c in local.items()})
        rows = rows.withColumn("_first", F.row_number().over(within) == 1)
    joined = rows.join(sums, keys, "left")
    first = F.col("_first") if local else F.lit(False)
    return joined.select(
        *df.columns,
        *[
            s.combine(F.col(f"_l_{n}") if n in local else None, F.col(f"_a_{n}"), first).alias(n)
            for n, s in scans.items()
        ],
    )


def blocks(
    df: DataFrame,
    part: Sequence[str],
    order: str,
    separator: Column,
    chunk: Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows between separator rows, with ``block`` (1-based), ``block_row`` (1-based) and ``closed``.

    ``order`` must count rows without gaps. Rows before the first separator and the separators themselves
    are left out, as they belong to no block. ``closed`` tells whether another separator follows the block.
    """
    marked = df.withColumn("_sep", F.coalesce(separator, F.lit(False)))
    is_sep = F.col("_sep").cast("long")
    placed = scan(
        marked, part, order, chunk, chunk_rows,
        block=running(is_sep),
        _seps=whole_sum(is_sep),
        _at=carry(F.when(F.col("_sep"), F.col(order))),
    )
    return (
        placed.filter(~F.col("_sep") & (F.col("block") > 0))
        .withColumn("block_row", F.col(order) - F.col("_at"))
        .withColumn("closed", F.col("block") < F.col("_seps"))
        .drop("_sep", "_seps", "_at")
    )


def numbered(df: DataFrame, part: Sequence[str], order: str, chunk: Column | None = None, chunk_rows: int = CHUNK_ROWS,
             name: str = "row_no") -> DataFrame:
    """Adds a gapless row number (from 0) within each group."""
    counted = scan(df, part, order, chunk, chunk_rows, **{name: running(F.lit(1).cast("long"))})
    return counted.withColumn(name, F.col(name) - 1)

"""Declarative field checks: a list of field specs becomes one expression that names the first fault."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.functions.expr import digits_to_timestamp
from gridtables.operators import positional


@dataclass(frozen=True)
class Field:
    """``kind``: C fixed-length text, V text up to a length, D digits of a date (8, 12 or 14), N number.

    ``scale`` None means an integer of at most ``length`` characters; otherwise ``length`` and ``scale``
    are the digits allowed before and after the point.
    """

    name: str
    kind: str
    length: int
    mandatory: bool = False
    scale: int | None = None


def decimal_ok(c: Column, before: int, after: int) -> Column:
    whole = F.substring_index(c, ".", 1)
    decimals = F.when(F.instr(c, ".") > 0, F.length(c) - F.length(whole) - 1).otherwise(0)
    shape = c.rlike(r"^([+-]?[0-9]+(\.[0-9]+)?|\.[0-9]+)$")
    return shape & (F.length(whole) <= before) & (decimals <= after)


def integer_ok(c: Column, length: int) -> Column:
    return c.rlike(r"^[+-]?[0-9]+$") & (F.length(c) <= length)


def decimal_shape(before: int, after: int) -> str:
    """What ``decimal_ok`` takes, as a pattern for ``all_fit``; ``after`` is at least 1."""
    return rf"(?=[^.,]{{0,{before}}}(?:[.,]|\z))(?:[+-]?[0-9]+(?:\.[0-9]{{1,{after}}})?|\.[0-9]{{1,{after}}})"


def integer_shape(length: int) -> str:
    return rf"(?=[^,]{{0,{length}}}(?:,|\z))[+-]?[0-9]+"


def all_fit(texts: Column, shape: str) -> Column:
    """True if every text of an array has the shape. They must hold no comma: the joined texts are searched once for one that does not fit."""
    return (F.size(texts) <= 0) | ~F.array_join(texts, ",").rlike(rf"(?:^|,)(?!(?:{shape})(?:,|\z))")


def value_ok(c: Column, f: Field) -> Column:
    empty = c == ""
    if f.kind == "C":
        return empty | (F.length(c) == f.length)
    if f.kind == "V":
        return F.length(c) <= f.length
    if f.kind == "D":
        return empty | ((F.length(c) == f.length) & digits_to_timestamp(c).isNotNull())
    if f.kind == "N" and f.scale is None:
        return empty | integer_ok(c, f.length)
    if f.kind == "N":
        return decimal_ok(c, f.length, f.scale)
    raise ValueError(f"unknown field kind {f.kind!r}")


def field_error(c: Column, f: Field) -> Column:
    """Null if the text ``c`` (never null, already stripped) fits the field, else the fault."""
    error = F.when(F.lit(f.mandatory) & (c == ""), f"{f.name}: missing mandatory value")
    return error.when(~F.coalesce(value_ok(c, f), F.lit(False)), f"{f.name}: invalid {f.kind}{f.length} value")


def first_error(errors: Sequence[Column]) -> Column:
    return F.coalesce(*errors, F.lit(None).cast("string"))


def tokens_error(tokens: Column, fields: Sequence[Field]) -> Column:
    """Checks an array of texts field by field; the number of texts must be the number of fields."""
    count = F.when(F.size(tokens) != len(fields), f"expected {len(fields)} fields")
    return first_error([count, *[field_error(F.get(tokens, F.lit(i)), f) for i, f in enumerate(fields)]])


def columns_error(df: DataFrame, fields: Sequence[Field]) -> Column:
    """The same checks on the columns of a frame, nulls counting as empty."""
    return first_error([field_error(F.coalesce(F.col(f.name).cast("string"), F.lit("")), f) for f in fields])


def order_error(record: Column, before: Column, allowed: Mapping[str, Sequence[str | None]]) -> Column:
    """Which records may follow which: ``allowed[record]`` lists predecessors, None standing for the start."""
    error = F.lit("unknown record")
    for name, predecessors in allowed.items():
        named = [p for p in predecessors if p is not None]
        fits = before.isin(*named) if named else F.lit(False)
        if None in predecessors:
            fits = before.isNull() | fits
        else:
            fits = F.coalesce(fits, F.lit(False))
        error = F.when(record == name, F.when(~fits, F.lit("record out of order"))).otherwise(error)
    return F.when(record.isNull(), F.lit("unknown record")).otherwise(error)


def until_first_error(
    df: DataFrame,
    part: Sequence[str],
    order: str,
    error: str,
    mode: str = "prefix",
    chunk: Column | None = None,
    chunk_rows: int = positional.CHUNK_ROWS,
) -> DataFrame:
    """``prefix``: rows before the first faulty row of their group. ``atomic``: rows of faultless groups."""
    if mode not in ("prefix", "atomic"):
        raise ValueError(f"unknown mode {mode!r}")
    marked = positional.scan(
        df, part, order, chunk, chunk_rows,
        _bad=positional.whole_min(F.when(F.col(error).isNotNull(), F.col(order))),
    )
    keep = F.col("_bad").isNull()
    if mode == "prefix":
        keep = keep | (F.col(order) < F.col("_bad"))
    return marked.filter(keep).drop("_bad")

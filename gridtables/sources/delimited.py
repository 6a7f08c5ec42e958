"""Headed delimited files: topped-and-tailed payloads, multi-row headings, missing values, dates."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.functions.expr import heading, null_tokens, strip
from gridtables.session import cut_lineage
from gridtables.sources.lines import (
    Parsed, lost_cells, parse_delimited, payload_between, refused, scan_file, unread, whole_files, width_faults, without_value,
)
from gridtables.operators import positional


@dataclass(frozen=True)
class Delimited:
    """How one feed's files look. ``dates`` lists columns to parse or, as a tuple, to combine into one."""

    top: str | None = None
    tail: str | None = None
    header_lines: tuple[int, ...] = (0,)
    skip_rows: int = 0
    skip_footer: int = 0
    sep: str = ","
    skip_initial_space: bool = False
    na_values: tuple[str, ...] = ()
    dates: tuple[int | tuple[int, ...], ...] = ()
    day_first: bool = False
    keep_date_columns: bool = False
    numeric: tuple[str, ...] = ()


# The feeds known by name and how their files are laid out.
FEEDS = {
    "daily_weather": Delimited(header_lines=(9, 10, 11, 12), skip_footer=1, skip_initial_space=True, dates=(1,), day_first=True),
    "aws_weather": Delimited("[metar2Data]\n", "[$]", skip_initial_space=True, na_values=("-9999", "-9999.0"), dates=((2, 3),), keep_date_columns=True),
    "synop_weather": Delimited("[synopData]\n", "[$]", skip_initial_space=True, na_values=("-9999", "-9999.0"), dates=((3, 4),), keep_date_columns=True),
    "observations": Delimited("[data]\n", "[$]", skip_initial_space=True, na_values=("-9999", "-9999.0"), dates=(5, 6), keep_date_columns=True),
    "load_profile": Delimited("<CSVData>", "</CSVData>", dates=(2, 3)),
    "trade_log": Delimited(skip_rows=1, dates=(0,), day_first=True),
}

KEYS = {
    "daily_weather": ("station_name", "date"),
    "aws_weather": ("id_num", "date", "time"),
    "synop_weather": ("wmo_id", "date", "time"),
    "observations": ("wmo", "aifstime_utc"),
    "load_profile": ("profilename", "profilearea", "settlementdate"),
    "trade_log": (),
}

# Date texts the feeds use: shape of the text and its pattern.
_TIME = ((r"", ""), (r" \d{1,2}:\d{2}", " H:m"), (r" \d{1,2}:\d{2}:\d{2}", " H:m:s"))
_YEAR_FIRST = tuple(
    (rf"\d{{4}}{s}\d{{1,2}}{s}\d{{1,2}}{shape}", f"yyyy{s}M{s}d{time}") for s in "/-" for shape, time in _TIME
) + ((r"\d{8}", "yyyyMMdd"), (r"\d{8} \d{4}", "yyyyMMdd HHmm"), (r"\d{8} \d{1,2}:\d{2}", "yyyyMMdd H:m"),
     (r"\d{12}", "yyyyMMddHHmm"), (r"\d{14}", "yyyyMMddHHmmss"))
_DAY_FIRST = tuple((rf"\d{{1,2}}{s}\d{{1,2}}{s}\d{{4}}{shape}", f"d{s}M{s}yyyy{time}") for s in "/-" for shape, time in _TIME)
_MONTH_FIRST = tuple((rf"\d{{1,2}}{s}\d{{1,2}}{s}\d{{4}}{shape}", f"M{s}d{s}yyyy{time}") for s in "/-" for shape, time in _TIME)


class HeadingError(ValueError):
    """A heading that no table can be read with."""


def heading_texts(lines: DataFrame, header_lines: Sequence[int] = (0,)) -> DataFrame:
    """(file, texts): the heading rows of each file."""
    rows = lines.filter(F.col("line_no").isin(*header_lines))
    per_file = rows.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    return per_file.select("file", F.col("rows.line").alias("texts"))


def column_names(texts: Sequence[str], sep: str = ",") -> list[str]:
    """Normalised column names from the heading rows of a file."""
    levels = list(csv.reader(texts, delimiter=sep, skipinitialspace=True))
    names = []
    for i in range(max(len(level) for level in levels)):
        parts = [level[i] if i < len(level) else "" for level in levels]
        name = heading(parts[0]) if len(parts) == 1 else heading([p or "Unnamed" for p in parts])
        names.append(name or f"unnamed_{i}")
    return names


def headings(lines: DataFrame, header_lines: Sequence[int] = (0,), sep: str = ",") -> list[str]:
    """Column names of files that share one heading."""
    variants = heading_texts(lines, header_lines).select("texts").distinct().take(2)
    if len(variants) != 1:
        raise HeadingError("no heading found" if not variants else "files with different headings in one read")
    return column_names(variants[0].texts, sep)


def _moment(text: Column, day_first: bool) -> Column:
    """A text is parsed only by the patterns of its shape; ambiguous dates follow ``day_first`` where they can."""
    either = _DAY_FIRST + _MONTH_FIRST if day_first else _MONTH_FIRST + _DAY_FIRST
    tries = [F.when(text.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(p))) for shape, p in _YEAR_FIRST + either]
    return F.coalesce(*tries).cast("timestamp_ntz")


def read_delimited(lines: DataFrame, spec: Delimited, names: Sequence[str] | None = None, keys: Sequence[str] = ()) -> Parsed:
    """Data rows of headed files, each by its own heading unless ``names`` fixes the columns.

    Files of one heading are read together and the tables united by column name; the distinct headings reach the driver. A file
    whose heading lacks a column that the feed dates are made of or one of ``keys``, or that holds a row with more cells than its
    heading, is refused with the reason. Texts that are no date or number, short lines and, left out of the rows, lines without a
    value in ``keys`` are rejects of their line.
    """
    if spec.top is None and spec.tail is None:
        payload, rejects = lines, whole_files(lines.select("file", F.lit("").alias("reason")).filter(F.lit(False)))
    else:
        payload, rejects = payload_between(lines, spec.top, spec.tail)
    if spec.skip_rows:
        payload = payload.filter(F.col("line_no") >= spec.skip_rows).withColumn(
            "line_no", F.col("line_no") - spec.skip_rows
        )
    if names is not None:
        rows, more = _read_group(payload, spec, list(names), keys)
        return Parsed(rows, rejects.unionByName(more))
    texts = cut_lineage(heading_texts(payload, spec.header_lines))
    tables: list[DataFrame] = []
    needed = max((i for d in spec.dates for i in ([d] if isinstance(d, int) else d)), default=-1)
    for variant in texts.select("texts").distinct().collect():
        files = texts.filter(F.col("texts") == F.array(*map(F.lit, variant.texts))).select("file")
        columns = column_names(variant.texts, spec.sep)
        reason = _unusable(columns, spec, needed, keys)
        if reason:
            rejects = rejects.unionByName(whole_files(files.withColumn("reason", F.lit(reason))))
            continue
        rows, more = _read_group(payload.join(files, "file", "left_semi"), spec, columns, keys)
        tables.append(rows)
        rejects = rejects.unionByName(more)
    if not tables:
        return Parsed(payload.select("file", "line_no").filter(F.lit(False)), rejects)
    united = tables[0]
    for t in tables[1:]:
        united = united.unionByName(t, allowMissingColumns=True)
    return Parsed(united, rejects)


def _unusable(columns: list[str], spec: Delimited, needed: int, keys: Sequence[str]) -> str | None:
    """Why files under a heading cannot be read."""
    if needed >= len(columns):
        return "too few columns"
    if len(set(columns)) < len(columns):
        return "a column name stands twice"
    combined = [[columns[i] for i in d] for d in spec.dates if not isinstance(d, int)]
    gone = set() if spec.keep_date_columns else {c for parts in combined for c in parts}
    missing = [k for k in keys if k not in {*columns, *("_".join(parts) for parts in combined)} - gone]
    return f"no key column {', '.join(missing)}" if missing else None


def _read_group(payload: DataFrame, spec: Delimited, names: list[str], keys: Sequence[str] = ()) -> Parsed:
    """Files of one heading."""
    data = payload.filter((F.col("line_no") > max(spec.header_lines)) & (strip(F.col("line")) != ""))
    if spec.skip_footer:
        ends = scan_file(data, _rows=positional.whole_sum(F.lit(1).cast("long")), _row=positional.running(F.lit(1).cast("long")))
        data = ends.filter(F.col("_row") <= F.col("_rows") - spec.skip_footer).drop("_rows", "_row")
    too_many, too_few = width_faults(F.col("line"), names, spec.sep)
    data = data.withColumn("_beyond", too_many.isNotNull()).withColumn("_short", too_few)
    table = parse_delimited(data, names, spec.sep, spec.skip_initial_space, keep=["_beyond", "_short"])
    rejects = refused(table.filter("_beyond"), "a row with more cells than the heading")
    table = table.join(rejects.select("file"), "file", "left_anti").drop("_beyond")
    if spec.na_values:
        table = table.withColumns({n: null_tokens(strip(F.col(n)), spec.na_values) for n in names})

    drop, lost = [], []
    for date in spec.dates:
        parts = [names[date]] if isinstance(date, int) else [names[i] for i in date]
        text = F.col(parts[0]) if isinstance(date, int) else F.concat_ws(" ", *[F.col(p) for p in parts])
        name, place = "_".join(parts), f"_lost{len(lost)}"
        moment = _moment(text, spec.day_first)
        table = table.withColumns({place: unread(name, text, moment, "date"), name: moment})
        lost.append(place)
        drop += [] if isinstance(date, int) or spec.keep_date_columns else parts
    numeric = [c for c in spec.numeric if c in table.columns]
    table = table.withColumns({f"_lost_{c}": unread(c, F.col(c), F.col(c).try_cast("double"), "number") for c in numeric})
    lost += [f"_lost_{c}" for c in numeric]
    table = table.withColumns({c: F.col(c).try_cast("double") for c in numeric})
    # a key whose text could not be read has both entries: the second says that the line stays out
    entries = F.array_compact(F.array(*[F.col(c) for c in ("_short", *lost)], *[without_value(k) for k in keys]))
    faults = lost_cells(table, entries)
    table = table.drop("_short", *lost).dropna(subset=list(keys)) if keys else table.drop("_short", *lost)
    return Parsed(table.drop("chunk", *drop), whole_files(rejects).unionByName(faults))

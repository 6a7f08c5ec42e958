"""Text files as numbered lines, and the payloads and blocks cut out of them.

Files are read through Spark's splittable text source, so one very large file is spread over many tasks.
A line carries ``file``, ``line_no`` (0-based), ``line`` and ``chunk`` (the start of its file block); all
order logic runs per (file, chunk) through ``operators.positional``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtables.functions.expr import metadata_path, strip
from gridtables.operators import positional
from gridtables.session import cut_lineage


class Parsed(NamedTuple):
    """Rows of files and what is not among them, as (file, reason, line_no, column, text).

    A reject without a line number refuses its file. One with a line number is a lost cell: a text that is no date or number
    where one belongs, a cell beyond the columns, a line with too few cells (no text), a key without a value. The line is loaded
    with null in that place, unless the cell belongs to the key of the load: then the line stays out.
    """

    rows: DataFrame
    rejects: DataFrame


class Records(Parsed):
    """Parsed files whose records belong to several tables: ``parts`` has them by type, as a dataclass of frames with ``file``."""

    parts: object = None


REJECT_COLUMNS = ("file", "reason", "line_no", "column", "text")
REJECTS = "file string, reason string, line_no long, column string, text string"


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """Lines of text files. Rows of a block keep their order inside a task, so the line number is the
    position inside the block plus the number of lines in the file's earlier blocks."""
    raw = (
        spark.read.format("text").options(**options).load(paths if isinstance(paths, str) else list(paths))
        .select(
            metadata_path(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("chunk"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("line"),
        )
    )
    counts = raw.groupBy("file", "chunk").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "chunk", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return raw.join(starts, ["file", "chunk"]).select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), "line", "chunk"
    )


def lines_of(df: DataFrame, keys: Sequence[str], text: str, separator: str = "\n") -> DataFrame:
    """Lines of a text column, numbered from 0 within the row."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), separator)).alias("line_no", "line")).withColumn(
        "line_no", F.col("line_no").cast("long")
    )


def scan_file(lines: DataFrame, **scans: positional.Scan) -> DataFrame:
    """Positional scan over the lines of each file. Readers that chain scans cut the lineage in between."""
    return positional.scan(lines, ["file"], "line_no", F.col("chunk"), **scans)


def with_file_facts(lines: DataFrame, **facts: Column) -> DataFrame:
    """Adds aggregates over each line's file. One small row per file is joined back: no order, no copy of the lines."""
    found = lines.groupBy("file").agg(*[c.alias(n) for n, c in facts.items()])
    return lines.join(found, "file")


def refused(df: DataFrame, reason: Column | str) -> DataFrame:
    """One reject row per file of ``df``."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return df.select("file", reason.alias("reason")).filter("reason IS NOT NULL").groupBy("file").agg(
        F.min("reason").alias("reason")
    )


def whole_files(df: DataFrame) -> DataFrame:
    """(file, reason) of refused files as rejects."""
    none = F.lit(None)
    return df.select("file", "reason", none.cast("long").alias("line_no"), none.cast("string").alias("column"), none.cast("string").alias("text"))


def cell(column: str | None, text: Column, reason: Column | str) -> Column:
    """An entry of a line's array of lost cells."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(F.lit(column).cast("string").alias("column"), text.cast("string").alias("text"), reason.cast("string").alias("reason"))


def unread(column: str, text: Column, value: Column, what: str) -> Column:
    """The entry of a cell that holds a text and gives no value; null otherwise."""
    return F.when((strip(text) != "") & value.isNull(), cell(column, text, f"no {what} in {column}"))


def without_value(column: str) -> Column:
    return F.when(F.col(column).isNull(), cell(column, F.lit(None), f"no value in key {column}"))


TOO_MANY, TOO_FEW = "more cells than columns", "fewer cells than columns"


def width_faults(line: Column, names: Sequence[str], sep: str = ",") -> list[Column]:
    """Entries of a line whose number of cells is not that of the columns; blank cells beyond them are no loss.

    Separators inside quotes do not count. The text of cells beyond the columns is shown without what quotes hold.
    """
    found = F.split(F.regexp_replace(line, '"[^"]*"', '""'), re.escape(sep))
    beyond = F.slice(found, F.lit(len(names) + 1), F.greatest(F.size(found) - len(names), F.lit(0)))
    short = F.element_at(F.array(*[F.lit(n) for n in names]), F.least(F.size(found) + 1, F.lit(len(names))))
    return [
        F.when(F.exists(beyond, lambda c: strip(c) != ""), cell(None, F.array_join(beyond, sep), TOO_MANY)),
        F.when(F.size(found) < len(names), F.struct(short.alias("column"), F.lit(None).cast("string").alias("text"), F.lit(TOO_FEW).alias("reason"))),
    ]


def lost_cells(df: DataFrame, entries: Column) -> DataFrame:
    """The entries of every line, an array by line, as rejects."""
    each = df.select("file", "line_no", F.explode(entries).alias("_cell"))
    return each.select("file", "_cell.reason", F.col("line_no").cast("long").alias("line_no"), "_cell.column", "_cell.text")


def lost_by_file(rejects: DataFrame) -> DataFrame:
    """(file, lines, cells): how many lines of each file lost something, and how many cells."""
    return rejects.filter("line_no IS NOT NULL").groupBy("file").agg(F.count_distinct("line_no").alias("lines"), F.count("*").alias("cells"))


def payload_between(lines: DataFrame, top: str | None = None, tail: str | None = None) -> Parsed:
    """Lines between the first ``top`` marker and the next ``tail`` marker of each file, renumbered from 0.

    A marker lies within one line; a line break at its end only demands that the line ends there. Text
    beside a marker on its own line belongs to the payload. A file without a demanded marker is refused.
    """
    text = F.concat(F.col("line"), F.lit("\n"))
    marked = lines.withColumn("_from", F.lit(0))
    rejects = []
    if top is not None:
        hit = F.instr(text, top)
        place = F.when(hit > 0, F.struct("line_no", (hit + F.lit(len(top)) - 1).alias("at")))
        found = with_file_facts(lines, _top=F.min(place))
        rejects.append(refused(found.filter("_top IS NULL"), "header text not found"))
        marked = found.filter("line_no >= _top.line_no").withColumn(
            "_from", F.when(F.col("line_no") == F.col("_top.line_no"), F.col("_top.at")).otherwise(0)
        ).drop("_top")
    marked = marked.withColumn("line", F.substr(F.col("line"), F.col("_from") + 1))
    if tail is not None:
        hit = F.instr(text, tail)
        place = F.when(hit > 0, F.struct("line_no", (hit - 1).alias("at")))
        found = with_file_facts(marked, _tail=F.min(place))
        rejects.append(refused(found.filter("_tail IS NULL"), "footer text not found"))
        marked = found.filter("_tail IS NOT NULL AND line_no <= _tail.line_no").withColumn(
            "line",
            F.when(F.col("line_no") == F.col("_tail.line_no"), F.substr(F.col("line"), F.lit(1), F.col("_tail.at")))
            .otherwise(F.col("line")),
        ).drop("_tail")
    kept = marked.drop("_from").filter(strip(F.col("line")) != "")
    body = positional.numbered(kept, ["file"], "line_no", F.col("chunk")).drop("line_no")
    body = cut_lineage(body.withColumnRenamed("row_no", "line_no"))
    none = lines.select("file", F.lit("").alias("reason")).filter(F.lit(False))
    for r in rejects:
        none = none.unionByName(r)
    return Parsed(body, whole_files(none))


def cells(line: Column, count: int, sep: str = ",", skip_blanks: bool = False) -> Column:
    """Struct ``c0 .. c{count-1}`` of the texts of a delimited line; empty and missing cells are null."""
    schema = ", ".join(f"c{i} string" for i in range(count))
    options = {"sep": sep, "mode": "PERMISSIVE"}
    if skip_blanks:
        options["ignoreLeadingWhiteSpace"] = "true"
    return F.from_csv(line, schema, options)


def parse_delimited(lines: DataFrame, names: Sequence[str], sep: str = ",", skip_blanks: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """The lines as text columns ``names`` beside ``file``, ``line_no``, ``chunk`` and the columns to ``keep``."""
    parsed = lines.withColumn("_c", cells(F.col("line"), len(names), sep, skip_blanks))
    return parsed.select("file", "line_no", "chunk", *keep, *[F.col(f"_c.c{i}").alias(n) for i, n in enumerate(names)])


def split_blocks(lines: DataFrame, separator: Column, closed_only: bool = False) -> DataFrame:
    """Line blocks between separator lines, see ``positional.blocks``."""
    found = positional.blocks(lines, ["file"], "line_no", separator, F.col("chunk"))
    return found.filter("closed") if closed_only else found

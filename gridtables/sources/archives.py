"""Members of zip archives as numbered lines or whole contents."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.functions.expr import plain_path

BATCH_LINES = 10_000


def _archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select(plain_path(F.col("path")).alias("path"), "content")


def expand(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``archive``, ``member``, ``content`` of every file inside the archives."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        if not name.endswith("/"):
                            yield pd.DataFrame({"archive": [path], "member": [name], "content": [archive.read(name)]})

    return _archives(spark, paths).mapInPandas(members, "archive string, member string, content binary")


def archive_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "utf-8") -> DataFrame:
    """Lines of every member, in the shape of ``lines.numbered_lines``; members are streamed, not held whole."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        if name.endswith("/"):
                            continue
                        with io.TextIOWrapper(archive.open(name), encoding) as text:
                            yield from _batches(f"{path}!/{name}", text)

    return _archives(spark, paths).mapInPandas(lines, "file string, line_no long, line string, chunk long")


def _batches(file: str, text: Iterator[str]) -> Iterator[pd.DataFrame]:
    start, held = 0, []
    for line in text:
        held.append(line.rstrip("\r\n"))
        if len(held) == BATCH_LINES:
            yield _frame(file, start, held)
            start, held = start + len(held), []
    if held:
        yield _frame(file, start, held)


def _frame(file: str, start: int, held: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"file": file, "line_no": range(start, start + len(held)), "line": held, "chunk": start})

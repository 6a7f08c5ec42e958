"""What the operators share: staging in the cluster's shared folder, byte views of Arrow text, hashed words."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# freed batches go back to the system instead of staying with an idle worker
pa.set_memory_pool(pa.system_memory_pool())

#: Bytes of text that one step of a task works on; a longer document is a step of its own.
SLICE = 1 << 20
BATCH_ROWS = 1000
#: Python's ``string.whitespace`` as bytes: what separates words where the contract says "words".
BLANKS = bytes([0x20, *range(0x09, 0x0E)])


def release() -> None:
    """Gives freed memory back at the end of a task: workers are kept for other stages."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def small_batches(spark: SparkSession) -> None:
    """Sets the session to Arrow batches of at most ``BATCH_ROWS`` rows: JVM and worker each hold a few of them, and texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor and the driver see.

    Only a local session without that setting gets a temporary folder; a cluster without it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        import tempfile

        root = tempfile.mkdtemp(prefix="gridtables-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, *partition: str, compression: str = "zstd") -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage is cut, and a lost executor costs nothing before it."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    df.write.option("compression", compression).partitionBy(*partition).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_old_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles that no plan refers to any more: its cleaner learns of them when the driver collects garbage,
    which an iterative job on a large heap may not do for long."""
    gc.collect()
    spark._jvm.System.gc()


def mix(c: np.ndarray) -> np.ndarray:
    """Finalises 64-bit sums so that near sums have far hashes."""
    c = c ^ (c >> np.uint64(31))
    c = c * np.uint64(0x9E3779B97F4A7C15)
    c = c ^ (c >> np.uint64(29))
    c = c * np.uint64(0xD6E8FEB86659FD93)
    return c ^ (c >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``size`` bytes."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_BASE = 0x9FB21C651E98DF25


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
_LOWERED = _TABLE[LOWER]


def word_class(separators: bytes) -> np.ndarray:
    table = np.ones(256, bool)
    table[np.frombuffer(separators, np.uint8)] = False
    return table


class Words:
    """The words of some documents: byte spans, document of each, and a 64-bit hash with A-Z lower-cased."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        n = len(buf)
        inside = is_word[buf]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.buf = buf
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: words of document i: first[i] to first[i + 1]
        self.first = np.searchsorted(self.starts, offsets, "left")
        lengths = self.ends - self.starts
        if not len(lengths):
            self.hashes = np.zeros(0, np.uint64)
            return
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        powers = np.ones(int(lengths.max()), np.uint64)
        powers[1:] = np.uint64(_BASE)
        powers = np.cumprod(powers, dtype=np.uint64)
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        self.hashes = mix(np.add.reduceat(_LOWERED[buf[inside]] * powers[place], at))


def unsigned_crc32(c: Column | str) -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), "utf-8"))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))

"""Directly addressable codes: ids split into chunks of 8 bits, one level per chunk.

Level k holds chunk k of every id that has one, in order, and a bitmap that says whether the id goes on in level k + 1. The place there
is the number of set bits before, which a directory of counts per 512 bits gives after one short popcount. So any id is
read by at most four look-ups, and no block is decoded.

A file holds one segment: whole documents in ascending order of their id, up to about ``SEGMENT`` ids (a longer document
is a segment of its own). Layout, little-endian: magic, documents, ids, levels, place of the first id in its run of files
(header); ids of the documents, null flags, ends of the documents; then per level: length, chunks, bitmap, directory.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from gridtables.llm.bpe import gathered, library_encoder, text_batches
from gridtables.llm.common import release, shared_folder, small_batches, staged

MAGIC = b"DACODES1"
HEADER = struct.Struct("<8sQQQQQ")
SEGMENT = 2 << 20
WORD = 512
#: Bytes of input files for one writing task.
TASK = 16 << 20


def pack(ids: np.ndarray) -> list[bytes]:
    """Levels of an array of unsigned 32-bit ids."""
    out, level = [], ids
    while True:
        more = level > 0xFF
        bits = np.packbits(more, bitorder="little")
        words = np.zeros(-(-len(level) // WORD) * WORD // 8, np.uint8)
        words[: len(bits)] = bits
        ones = np.add.reduceat(more, np.arange(0, len(level), WORD), dtype=np.uint64) if len(level) else np.zeros(0, np.uint64)
        directory = np.cumsum(ones) - ones
        out.append(struct.pack("<Q", len(level)) + (level & 0xFF).astype(np.uint8).tobytes() + words.tobytes() + directory.astype("<u8").tobytes())
        level = level[more] >> 8
        if not len(level):
            return out


class Segment:
    """A view of one segment's bytes."""

    def __init__(self, blob: bytes):
        magic, docs, self.size, levels, self.partition, self.before = HEADER.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a segment")
        at = HEADER.size
        self.doc_ids = np.frombuffer(blob, "<i8", docs, at)
        self.nulls = np.frombuffer(blob, np.bool_, docs, at + 8 * docs)
        self.ends = np.frombuffer(blob, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            blocks = -(-n // WORD)
            chunks = np.frombuffer(blob, np.uint8, n, at + 8)
            bits = np.frombuffer(blob, np.uint8, blocks * WORD // 8, at + 8 + n)
            directory = np.frombuffer(blob, "<u8", blocks, at + 8 + n + len(bits))
            self.levels.append((chunks, bits, directory))
            at += 8 + n + len(bits) + 8 * blocks

    def __getitem__(self, i: int) -> int:
        """The id at a place, from one chunk per level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // WORD
            low = bits[block * WORD // 8 : i >> 3].tobytes()
            i = int(directory[block]) + int.from_bytes(low, "little").bit_count() + (int(bits[i >> 3]) & (1 << (i & 7)) - 1).bit_count()
        return value

    def ids(self) -> np.ndarray:
        """All ids at once, last level first."""
        value = None
        for chunks, bits, _ in reversed(self.levels):
            own = chunks.astype(np.uint32)
            if value is not None:
                own[np.flatnonzero(np.unpackbits(bits, count=len(chunks), bitorder="little"))] |= value << 8
            value = own
        return value


def extent(blob: bytes) -> tuple[int, int, int]:
    """(partition, first place, places) of a segment, from its header."""
    _, _, size, _, partition, before = HEADER.unpack_from(blob)
    return partition, before, size


def segment(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray, partition: int, before: int) -> bytes:
    levels = pack(ids)
    head = HEADER.pack(MAGIC, len(doc_ids), len(ids), len(levels), partition, before)
    return b"".join([
        head, doc_ids.astype("<i8").tobytes(), nulls.astype(np.bool_).tobytes(), np.cumsum(lengths).astype("<u8").tobytes(), *levels])


def write_ids(
    docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    tasks: int | None = None,
) -> None:
    """Encodes every text, adds ``end_id``, and writes segments in ascending order of the document id.

    Null ids come first and are marked; rows of equal id stand in the order of their text's hash. A null text is empty: one id,
    the end. An empty table writes no segment. Range partitions follow the order and Spark's committer publishes the files, one
    segment each, so a lost task leaves nothing behind.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"),
        F.xxhash64(F.col(text_col)).alias("tie"), F.monotonically_increasing_id().alias("row"))
    keys = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("row")]
    ordered = narrow.repartitionByRange(tasks or _tasks(docs), *keys).sortWithinPartitions(*keys).select("id", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(shared.value)
        partition = TaskContext.get().partitionId()
        before = 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal before, size
            doc_ids, nulls, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            blob = segment(doc_ids, nulls, lengths, ids, partition, before)
            before += size
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["value"])

        for batch in gathered(batches, "body"):
            for low, texts in text_batches(batch["body"]):
                ids, bounds = encoder.batch(texts)
                lengths = np.diff(bounds) + 1
                with_end = np.insert(ids, bounds[1:], end_id).astype("<u4", copy=False)
                del ids
                key = batch["id"].slice(low, len(texts))
                nulls = key.is_null().to_numpy(zero_copy_only=False)
                own = key.fill_null(0).to_numpy()
                ends = np.cumsum(lengths)
                at = 0
                while at < len(own):
                    start = int(ends[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, start + SEGMENT - size, "right")))
                    held.append((own[at:to], nulls[at:to], lengths[at:to], with_end[start : int(ends[to - 1])]))
                    size += int(ends[to - 1]) - start
                    at = to
                    if size >= SEGMENT or at < len(own):
                        yield flush()
        if held:
            yield flush()
        release()

    blobs = ordered.mapInArrow(run, T.StructType([T.StructField("value", T.BinaryType())]))
    # the text writer puts a string's bytes down as they are; with one record per file each file is one segment and a line end
    blobs.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def _tasks(docs: DataFrame) -> int:
    """Writing tasks by the size of the input files: what one task holds does not grow with the input."""
    size = docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(1, min(1_000_000, int(size) // (TASK) + 1))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in the files: doc_id, partition, at (place within the partition's ids), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["content"]:
                own = Segment(blob.as_buffer().to_pybytes())
                raw = memoryview(own.ids().astype("<u4").tobytes())
                ends = own.ends.tolist()
                starts = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own.doc_ids, pa.int64(), mask=own.nulls), pa.array([own.partition] * len(ends), pa.int64()),
                    pa.array([own.before + s for s in starts], pa.int64()), pa.array(np.diff([0, *ends]), pa.int64()),
                    pa.array([zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts, ends, strict=True)], pa.int64()),
                ], names=["doc_id", "partition", "at", "n_tokens", "ids_crc32"])

    files = _files(spark, folder)
    return files.select("content").mapInArrow(run, "doc_id long, partition long, at long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """``places`` has partition and at; gives each place's id by random access: places meet the one segment that holds them."""

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, blob in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                partition, before, size = extent(blob.as_buffer().slice(0, 64).to_pybytes())
                yield pa.RecordBatch.from_pydict({"path": [path], "partition": [partition], "low": [before], "high": [before + size]})

    heads = _files(spark, folder).select("path", "content").mapInArrow(head, "path string, partition long, low long, high long")
    wanted = places.join(heads, (places["partition"] == heads["partition"]) & (places["at"] >= heads["low"]) & (places["at"] < heads["high"]))
    wanted = wanted.groupBy("path").agg(F.collect_set(F.struct(places["partition"], places["at"], (places["at"] - F.col("low")).alias("i"))).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, rows in zip(batch["content"], batch["wanted"].to_pylist(), strict=True):
                own = Segment(blob.as_buffer().to_pybytes())
                yield pa.RecordBatch.from_pydict({
                    "partition": [r["partition"] for r in rows], "at": [r["at"] for r in rows], "id": [own[r["i"]] for r in rows]})

    return _files(spark, folder).join(wanted, "path").select("content", "wanted").mapInArrow(run, "partition long, at long, id long")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).where(F.col("length") >= HEADER.size)


def stored(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes the files and reads them back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A null or empty text has the end id only. Repeated rows each have their place; rows of equal id stand in any order, null ids first. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    write_ids(docs, tokenizer, folder, id_col, text_col, end_id)
    found = staged(read_documents(spark, folder))
    # one row per writing task; everything else stays spread out
    sizes = found.groupBy("partition").agg(F.sum("n_tokens").alias("size"))
    starts = sizes.withColumn("start", F.sum("size").over(Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)))
    return found.join(starts, "partition").select(
        F.col("doc_id").alias(id_col), (F.coalesce("start", F.lit(0)) + F.col("at")).cast("long").alias("start"), "n_tokens", "ids_crc32")

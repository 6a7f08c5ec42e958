"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is hashed words and a pattern is a window of a benchmark item. Patterns of one length ``m`` form a class. A block
is ``b`` consecutive words. ``shift`` says for a block's hash how far the search may move on: ``m - b + 1`` where no pattern
holds the block, else the distance to the pattern's end. At shift 0 the suffix bucket of the block names the patterns that end
with it, the hash of their first block sorts most of them out, and the bytes of the words decide. Many places of a text
are searched at once, each in its own lane of the array, so a step costs one array operation instead of one per place.

Benchmark windows go to the tasks in blocks of at most ``block_bytes`` of text, as arrays that the driver builds once: word places in
one buffer, equal windows once. More blocks mean more passes over the documents, never a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtables.llm.common import LOWER, Words, release, slices, staged, utf8, word_class

#: Bytes that are no part of a word once A-Z are lower-cased; A-Z themselves are words' bytes here.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
WINDOW = 13
LANE = 256
TABLE_BITS = 20
COMPARED = 1 << 14  # windows compared at a time


@dataclass(frozen=True)
class Patterns:
    """Windows of one length, each once, in the order of their suffix blocks: shift table, the hashes of their last and first blocks, the
    place of their first word in the items' words, and the items that hold them (``items[held[i]:held[i + 1]]``)."""

    length: int
    block: int
    shift: np.ndarray
    suffix: np.ndarray
    prefix: np.ndarray
    starts: np.ndarray
    held: np.ndarray
    items: np.ndarray

    def search(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the last word, pattern) of the possible occurrences, equal in suffix and prefix block."""
        m, b = self.length, self.block
        low, high = first[:-1] + m - 1, first[1:]
        some = high > low
        low, high = low[some], high[some]
        lanes = (high - low + LANE - 1) // LANE
        within = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(low, lanes) + within * LANE
        stop = np.minimum(at + LANE, np.repeat(high, lanes))
        found = []
        while len(at):
            h = block_hash([hashes[at - b + 1 + i] for i in range(b)])
            step = self.shift[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
            hit = step == 0
            if hit.any():
                found.append((at[hit], h[hit]))
            at = at + np.maximum(step, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, h = (np.concatenate(x) for x in zip(*found, strict=True))
        left, right = np.searchsorted(self.suffix, h, "left"), np.searchsorted(self.suffix, h, "right")
        count = right - left
        row = np.repeat(left - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        at = np.repeat(at, count)
        start = at - m + 1
        same = self.prefix[row] == block_hash([hashes[start + i] for i in range(b)])
        return at[same], row[same]


def block_hash(parts: list[np.ndarray]) -> np.ndarray:
    h = parts[0]
    for part in parts[1:]:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _windows(hashes: np.ndarray, starts: np.ndarray, items: np.ndarray, m: int) -> Patterns:
    """``starts`` are first words of windows of ``m`` words, ``items`` the items they stand in."""
    one, two = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for i in range(m):
        word = hashes[starts + i]
        one = (one ^ (one >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
        two = (two ^ (two >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25) + (word ^ np.uint64(0x5851F42D4C957F2D))
    order = np.lexsort((items, two, one))
    one, two, starts, items = one[order], two[order], starts[order], items[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    more = new.copy()
    more[1:] |= items[1:] != items[:-1]  # an item that repeats a window holds it once
    group = (np.cumsum(new) - 1)[more]
    items, starts = items[more], starts[new]
    held = np.searchsorted(group, np.arange(len(starts) + 1))
    b = min(3, m)
    shift = np.full(1 << TABLE_BITS, m - b + 1, np.uint8)
    blocks = {}
    for end in range(b, m + 1):
        h = block_hash([hashes[starts + end - b + i] for i in range(b)])
        if end in (b, m):
            blocks[end] = h
        np.minimum.at(shift, (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64), m - end)
    order = np.argsort(blocks[m], kind="stable")
    sizes = np.diff(held)[order]
    place = np.repeat(held[:-1][order] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    return Patterns(
        m, b, shift, blocks[m][order], blocks[b][order], starts[order].astype(np.int64),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), items[place].astype(np.int32))


@dataclass(frozen=True)
class Benchmark:
    """A block of items as arrays: their lowered bytes, the words' places in them, the patterns by length, and the items' names."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    classes: tuple[Patterns, ...]
    names: tuple[str | None, ...]

    @staticmethod
    def of(items: list[tuple[str | None, str | None]], window: int) -> Benchmark:
        buf, offsets = utf8(pa.array([text for _, text in items], pa.large_string()))
        buf = LOWER[buf]
        words = Words(buf, offsets, word_class(SEPARATORS))
        n = np.diff(words.first)
        length = np.minimum(n, window)
        found = []
        for m in np.unique(length[length > 0]).tolist():
            of = np.flatnonzero(length == m)
            each = n[of] - m + 1 if m == window else np.ones(len(of), np.int64)
            starts = np.repeat(words.first[:-1][of] - np.cumsum(each) + each, each) + np.arange(int(each.sum()))
            found.append(_windows(words.hashes, starts, np.repeat(of, each), m))
        return Benchmark(buf, words.starts.astype(np.int32), words.ends.astype(np.int32), tuple(found), tuple(name for name, _ in items))

    def equal(self, lowered: np.ndarray, words: Words, start: np.ndarray, own: np.ndarray, m: int) -> np.ndarray:
        """Whether the ``m`` words of the document from ``start`` are, byte by byte, those of the items from ``own``."""
        out = np.zeros(len(start), bool)
        for low in range(0, len(start), COMPARED):
            i = start[low : low + COMPARED, None] + np.arange(m)
            j = own[low : low + COMPARED, None] + np.arange(m)
            size = words.ends[i] - words.starts[i]
            same = (size == self.ends[j] - self.starts[j]).all(axis=1)
            i, j, size = i[same].ravel(), j[same].ravel(), size[same].ravel()
            if len(i):
                within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                differs = lowered[np.repeat(words.starts[i], size) + within] != self.buf[np.repeat(self.starts[j].astype(np.int64), size) + within]
                word = np.repeat(np.arange(len(i)), size)[differs]
                good = np.ones(int(same.sum()), bool)
                good[word // m] = False
                same[same] = good
            out[low : low + COMPARED] = same
        return out


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in runs of at most ``block_bytes`` of text; the driver holds one run at a time."""
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator()
    run, size = [], 0
    for name, text in rows:
        more = len((text or "").encode())
        if run and size + more > block_bytes:
            yield run
            run, size = [], 0
        run.append((name, text))
        size += more
    yield run


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _search(batch: pa.Array, benchmark: Benchmark) -> tuple[np.ndarray, dict[int, tuple[list, list]]]:
    """(words of each text, {row: (spans, items)} of the texts with hits)."""
    buf, offsets = utf8(batch)
    is_word = word_class(SEPARATORS)
    n_words, found = np.zeros(len(batch), np.int64), {}
    for low, high in slices(offsets):
        words = Words(buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], is_word)
        n_words[low:high] = np.diff(words.first)
        marks, lowered, met = np.zeros(len(words.starts) + 1, np.int32), None, []
        for patterns in benchmark.classes:
            at, which = patterns.search(words.hashes, words.first)
            if not len(at):
                continue
            if lowered is None:
                lowered = LOWER[words.buf]
            start = at - patterns.length + 1
            same = benchmark.equal(lowered, words, start, patterns.starts[which], patterns.length)
            at, start, which = at[same], start[same], which[same]
            np.add.at(marks, start, 1)
            np.add.at(marks, at + 1, -1)
            doc = np.searchsorted(words.first, at, "right") - 1
            pair = np.unique(np.stack([doc, which]), axis=1)
            count = patterns.held[pair[1] + 1] - patterns.held[pair[1]]
            place = np.repeat(patterns.held[pair[1]] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            met.append(np.stack([np.repeat(pair[0], count), patterns.items[place].astype(np.int64)]))
        if not met:
            continue
        hit = np.cumsum(marks[:-1]) > 0
        pairs = np.unique(np.concatenate(met, axis=1), axis=1)
        bounds = np.searchsorted(pairs[0], np.arange(high - low + 1))
        for doc in np.unique(pairs[0]).tolist():
            own = hit[int(words.first[doc]) : int(words.first[doc + 1])]
            spans = [{"start": int(s), "end": int(e)} for s, e in zip(*_spans(own), strict=True)]
            names = {benchmark.names[i] for i in pairs[1][bounds[doc] : bounds[doc + 1]].tolist()} - {None}
            found[low + doc] = (spans, sorted(names))
    return n_words, found


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = 16 << 20, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: id, the ``keep`` columns, n_words, spans (hit words, merged), items (sorted as strings).

    An item of fewer words than ``window`` is one window of all its words; an item without words matches nothing. Null texts
    have no words. Repeated rows each give a row. An item without an id marks words and is not listed. Empty tables give no rows, or no
    hits. Other columns of either table are not read. From the second block of items on, a pass over the documents gives only what it
    hits, by the digest of the text; the passes are united by it.
    """
    spark = docs.sparkSession
    runs = blocks_of(benchmark, item_col, item_text, block_bytes)
    run, after = next(runs), next(runs, None)
    several = after is not None
    body = F.col(text_col).alias("body")
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("digest")
    out = docs.select(F.col(id_col).alias("id"), body, *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)), *([digest] if several else []))
    kept = [f for f in out.schema.fields if f.name != "body"]
    first = spark.sparkContext.broadcast(Benchmark.of(run, window))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found = _search(batch["body"], first.value)
            none = ([], [])
            spans, items = zip(*(found.get(i, none) for i in range(len(batch))), strict=True) if len(batch) else ((), ())
            columns = {c: batch[c] for c in batch.schema.names if c != "body"}
            columns |= {"n_words": pa.array(n_words), "spans": pa.array(spans, _SPAN), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(columns)
        release()

    result = T.StructType([*kept, T.StructField("n_words", T.LongType()), T.StructField("spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))])
    out = out.mapInArrow(scan, result)
    texts, parts = docs.select(digest, body), []
    while after is not None:
        parts.append(_hits_of(texts, spark.sparkContext.broadcast(Benchmark.of(after, window))).withColumn("block", F.lit(len(parts))))
        after = next(runs, None)
    if several:
        out = _united(out, parts)
    return out.select(
        F.col("id").alias(id_col), *(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)), "n_words", "spans", "items")


def _hits_of(texts: DataFrame, shared) -> DataFrame:
    """(digest, spans, items) of the texts that one block of items hits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = _search(batch["body"], shared.value)
            if found:
                rows = pa.array([*found], pa.int64())
                spans, items = zip(*found.values(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch["digest"].take(rows), pa.array(spans, _SPAN), pa.array(items, pa.list_(pa.string()))], names=["digest", "spans", "items"])
        release()

    found = staged(texts.mapInArrow(scan, T.StructType([
        T.StructField("digest", T.StringType()), T.StructField("spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))])))
    shared.unpersist()
    return found


def _united(out: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """What the first pass found with the other blocks' hits: spans merged, items united."""
    more = parts[0]
    for part in parts[1:]:
        more = more.unionByName(part)
    # equal texts have equal hits: one of each block is enough
    more = more.groupBy("digest", "block").agg(F.any_value("spans").alias("spans"), F.any_value("items").alias("items"))
    more = more.groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    every = F.sort_array(F.concat("spans", "more_spans"))
    last = lambda done: F.element_at(done, -1)
    merged = F.aggregate(every, F.array().cast(SPAN), lambda done, s: F.when(
        (F.size(done) > 0) & (s["start"] <= F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(-1))),
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(done, F.array(s))))
    joined = out.join(more, "digest", "left")
    hit = F.col("more_spans").isNotNull()
    return joined.withColumns({
        "spans": F.when(hit, merged).otherwise(F.col("spans")),
        "items": F.when(hit, F.array_sort(F.array_distinct(F.concat("items", "more_items")))).otherwise(F.col("items"))})


def hits(found: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated (a twentieth of the words or more) to the rows of ``contamination``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("own_id"), F.col(text_col).alias("own_text"))
    found = contamination(row, benchmark, "own_id", "own_text", keep=("row",), **options)
    return hits(found).where(~F.col("contaminated")).select("row.*")

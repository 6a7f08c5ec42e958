"""Removal of every byte inside a string of 200 bytes that also starts anywhere else.

Anchors. Of the 96-byte strings inside a window of 200 bytes the one with the least hash (the leftmost of equals) is its anchor. It depends
on the window's bytes alone, so equal windows have equal anchors at equal places, and a window whose anchor's string stands
nowhere else is unique. One position in about 50 is an anchor; what follows looks only at anchors that occur twice.

Suffixes. Windows with one anchor are the suffixes that start up to 104 bytes before it. Contexts (104 bytes to either side) that
occur twice are repeated whole and are settled by counting. The other distinct contexts of an anchor meet in one task, as the
pieces that the shards (tasks over documents) hold of the suffix order. Their interleave is refined iteratively: all start in shard
order, and each round splits the blocks that still hold several contexts by their next 8 bytes, leaving everything else
in place; where a split falls gives the common prefix of neighbours. From there the Burrows-Wheeler transform takes over: the
order of the suffixes one byte further left is the stable partition of the present order by the byte to the left, so no suffix
is sorted again, and neighbours' common prefixes are range minima of the first ones. Neighbours that share all 200 bytes are repeated
intervals. Contexts left alone in their block drop out.

An anchor with more distinct contexts than a task should hold is settled window by window, by counting hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtables.llm.common import _TABLE, mix, release, slices, staged, utf8

LENGTH = 200
GRAM = 96
SIDE = LENGTH - GRAM  # bytes of context on each side of an anchor
PLACE_BITS = 28
BITS = 1 << 27
CROWD = 20_000  # distinct contexts of an anchor that one task takes
CHUNK = 1 << 15
_R, _R_INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 21)
        tables = []
        for base in (_R, _R_INVERSE):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


class Anchors:
    """Anchors of some texts: place, hash of the 96 bytes, digest of the context and its extent to both sides."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        n = len(buf)
        self.doc = self.place = np.zeros(0, np.int64)
        if n < LENGTH:
            return
        power, inverse = _power_tables(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[buf] * power[:n], out=total[1:])
        grams = mix((total[GRAM:] - total[:-GRAM]) * inverse[: n - GRAM + 1])
        place_mask = np.uint64((1 << PLACE_BITS) - 1)
        keys = (grams & ~place_mask) | np.arange(len(grams), dtype=np.uint64)
        ends = np.repeat(offsets[1:], np.diff(offsets))  # end of each byte's text
        at = np.arange(len(grams))
        keys[at + GRAM > ends[: len(grams)]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        width = SIDE + 1
        padded = np.full(-(-len(keys) // width) * width, 0xFFFFFFFFFFFFFFFF, np.uint64)
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.arange(n - LENGTH + 1)
        starts = starts[starts + LENGTH <= ends[: len(starts)]]
        least = np.minimum(behind[starts], ahead[starts + width - 1]) & place_mask
        if not len(least):
            return
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        place = least[new].astype(np.int64)
        doc = np.searchsorted(offsets, place, "right") - 1
        self.place, self.doc, self.starts = place, doc, offsets[:-1]
        self.low = np.maximum(place - SIDE, offsets[doc])
        self.high = np.minimum(place + GRAM + SIDE, offsets[doc + 1])
        self.gram = grams[place]
        self.left, self.right = place - self.low, self.high - place - GRAM
        extent = (self.left * 1000 + self.right).astype(np.uint64)
        self.digest = mix((total[self.high] - total[self.low]) * inverse[self.low] + extent * np.uint64(0xBF58476D1CE4E5B9))


def _found(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Anchors]]:
    """(bytes, offsets, copies of each text in the batch, anchors) by slice; a text that the batch holds again is passed over."""
    buf, offsets = utf8(batch["body"])
    keys = [*zip(batch["k1"].to_numpy().tolist(), batch["k2"].to_numpy().tolist(), strict=True)]
    copies: dict = {}
    for key in keys:
        copies[key] = copies.get(key, 0) + 1
    for low, high in slices(offsets):
        chosen, n = [], []
        for i in range(low, high):
            count = copies.pop(keys[i], 0)
            if count and offsets[i + 1] - offsets[i] >= LENGTH:
                chosen.append(i)
                n.append(count)
        if chosen:
            parts = [buf[offsets[i] : offsets[i + 1]] for i in chosen]
            own = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            text = np.concatenate(parts)
            yield text, np.array(chosen), np.array(n), Anchors(text, own)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A table of ``BITS`` bits of the hashes' first 27 bits: its size does not depend on the input's."""
    bit = F.shiftrightunsigned("h", 37)
    words = hashes.select(bit.alias("bit")).groupBy(F.shiftrightunsigned("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toArrow()
    table = np.zeros(BITS >> 6, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint8)


def _marked(gram: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bits[(gram >> np.uint64(40)).astype(np.int64)] >> (gram >> np.uint64(37) & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(text.alias("body"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def _counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for _, _, n, a in _found(batch):
                if len(a.place):
                    grams.append(a.gram)
                    counts.append(n[a.doc])
            h, which = np.unique(np.concatenate(grams), return_inverse=True)
            n = np.bincount(which, np.concatenate(counts), len(h)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([_signed(h), pa.array(n, pa.int32())], names=["h", "n"])

    return docs.mapInArrow(run, "h long, n int")


def _occurrences(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for _, rows, n, a in _found(batch):
                if not len(a.place):
                    continue
                on = np.flatnonzero(_marked(a.gram, shared.value))
                doc = a.doc[on]
                yield pa.RecordBatch.from_arrays(
                    [_signed(a.gram[on]), _signed(a.digest[on]), pa.array(k1[rows[doc]]), pa.array(k2[rows[doc]]),
                     pa.array((a.place[on] - a.starts[doc]).astype(np.int32)), pa.array(a.left[on].astype(np.int16)),
                     pa.array(a.right[on].astype(np.int16)), pa.array(n[doc].astype(np.int32))],
                    names=["h", "digest", "k1", "k2", "place", "before", "after", "n"])

    return docs.mapInArrow(run, "h long, digest long, k1 long, k2 long, place int, before short, after short, n int")


def _contexts(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, _, _, a in _found(batch):
                if not len(a.place):
                    continue
                on = np.flatnonzero(_marked(a.gram, shared.value))
                _, first = np.unique(a.digest[on], return_index=True)
                on = on[first]
                raw = text.tobytes()
                bodies = [raw[i:j] for i, j in zip(a.low[on].tolist(), a.high[on].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [_signed(a.gram[on]), _signed(a.digest[on]), pa.array(a.left[on].astype(np.int16)), pa.array(bodies, pa.binary())],
                    names=["h", "digest", "before", "body"])

    return docs.mapInArrow(run, "h long, digest long, before short, body binary")


def repeated_offsets(group: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """For contexts grouped by anchor: which windows, by their start's distance before the anchor (0 to SIDE), stand in another context.

    ``left`` holds the bytes before the anchor, nearest first, ``right`` those behind it; both zero beyond their lengths.
    """
    m = len(group)
    out = np.zeros((m, SIDE + 1), bool)
    # interleave refinement: blocks of several contexts are split by their next 8 bytes, others stay where they are
    wide = -(-SIDE // 8) * 8
    padded = np.zeros((m, wide), np.uint8)
    padded[:, :SIDE] = right
    symbols = padded.reshape(m, -1, 8).view(">u8").reshape(m, -1).astype(np.uint64)
    order = np.argsort(group, kind="stable")
    block = np.concatenate([[0], np.cumsum(group[order][1:] != group[order][:-1])])
    common = np.where(group[order][1:] == group[order][:-1], SIDE, -1).astype(np.int16)  # of neighbours in the order
    for step in range(symbols.shape[1] + 1):
        size = np.bincount(block)
        at = np.flatnonzero(size[block] > 1)
        if not len(at):
            break
        last = step == symbols.shape[1]
        key = n_right[order[at]].astype(np.uint64) if last else symbols[order[at], step]
        sub = np.lexsort((key, block[at]))
        order[at], key = order[at][sub], key[sub]
        same_block = np.zeros(len(at), bool)
        same_block[1:] = (block[at][1:] == block[at][:-1]) & (at[1:] == at[:-1] + 1)
        cut = same_block.copy()
        cut[1:] &= key[1:] != key[:-1]
        if not last and cut.any():
            i = np.flatnonzero(cut)
            differ = key[i] ^ key[i - 1]
            # bytes before the first that differs
            equal = np.zeros(len(i), np.int16)
            for b in range(7):
                equal += (differ >> np.uint64(56 - 8 * b) == 0).astype(np.int16)
            common[at[i] - 1] = 8 * step + equal
        starts = np.zeros(m, bool)
        starts[1:] = block[1:] != block[:-1]
        starts[at[cut]] = True
        block = np.cumsum(starts)
    ends = np.minimum(n_right[order][1:], n_right[order][:-1])
    common = np.minimum(common, ends).astype(np.int16)

    # range minima over the order
    tables = [common]
    while 2 << len(tables) - 1 <= len(common):
        t, step = tables[-1], 1 << len(tables) - 1
        tables.append(np.minimum(t[:-step], t[step:]))
    log = np.zeros(m + 1, np.int64)
    for i in range(1, len(tables)):
        log[1 << i :] = i

    def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = log[b - a]
        got = np.empty(len(a), np.int16)
        for level in np.unique(k):
            on = k == level
            got[on] = np.minimum(tables[level][a[on]], tables[level][b[on] - (1 << int(level))])
        return got

    # backward steps: stable partition by the byte to the left
    rank = np.arange(m)
    block = np.concatenate([[0], np.cumsum(group[order][1:] != group[order][:-1])])
    for offset in range(SIDE + 1):
        pair = block[1:] == block[:-1]
        on = np.flatnonzero(pair)
        if not len(on):
            break
        enough = shared(rank[on], rank[on + 1]) >= SIDE - offset
        hit = on[enough]
        out[order[rank[hit]], offset] = True
        out[order[rank[hit + 1]], offset] = True
        if offset == SIDE:
            break
        alone = np.ones(len(block), bool)
        alone[on] = alone[on + 1] = False
        stay = ~alone & (n_left[order[rank]] > offset)
        rank, block = rank[stay], block[stay]
        if not len(rank):
            break
        key = block * 256 + left[order[rank], offset]
        sub = np.argsort(key, kind="stable")
        rank, key = rank[sub], key[sub]
        block = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    return out


def _merge(h: np.ndarray, before: np.ndarray, bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the bytes, counted from the anchor, that windows repeated in another context cover."""
    m = len(h)
    column = bodies.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + m + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)
    n_left = before.astype(np.int64)
    n_right = np.diff(offsets) - n_left - GRAM
    k = np.arange(SIDE)
    at = offsets[:-1] + n_left
    left = np.where(k < n_left[:, None], raw[np.maximum(at[:, None] - 1 - k, 0)], 0).astype(np.uint8)
    right = np.where(k < n_right[:, None], raw[np.minimum(at[:, None] + GRAM + k, len(raw) - 1)], 0).astype(np.uint8)
    hit = repeated_offsets(np.unique(h, return_inverse=True)[1], left, n_left, right, n_right)
    some = np.flatnonzero(hit.any(axis=1))
    far = SIDE - np.argmax(hit[some][:, ::-1], axis=1)
    near = np.argmax(hit[some], axis=1)
    return some, -far, LENGTH - near


def _merged(contexts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if len(table):
                table = table.combine_chunks()
                one = lambda c: table[c].chunk(0)
                some, start, end = _merge(one("h").to_numpy(), one("before").to_numpy(), one("body"))
                yield pa.RecordBatch.from_arrays(
                    [one("h").take(pa.array(some)), one("digest").take(pa.array(some)), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                    names=["h", "digest", "start", "end"])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= CHUNK:
                # an anchor's contexts are neighbours; the last anchor may go on
                table = pa.Table.from_batches(held).combine_chunks()
                h = table["h"].chunk(0).to_numpy()
                cut = int(np.searchsorted(h, h[-1], "left"))
                yield from flush(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    return contexts.repartition("h").sortWithinPartitions("h").select("h", "digest", "before", "body").mapInArrow(
        run, "h long, digest long, start int, end int")


def _by_window(contexts: DataFrame) -> DataFrame:
    """The same for crowded anchors: every window's hash is counted, combined before the shuffle."""
    offset = F.explode(F.sequence(F.greatest(F.lit(0), SIDE - (F.length("body") - F.col("before") - GRAM)), F.least(F.lit(SIDE), F.col("before").cast("int"))))
    wide = contexts.where(F.length("body") >= LENGTH).withColumn("offset", offset)
    window = F.substring("body", F.col("before") - F.col("offset") + 1, F.lit(LENGTH))
    hashed = wide.select("h", "digest", "offset", F.xxhash64(window).alias("w1"), F.xxhash64(F.lit(1), window).alias("w2"))
    again = hashed.groupBy("h", "offset", "w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return hashed.join(again, ["h", "offset", "w1", "w2"], "left_semi").groupBy("h", "digest").agg(
        (-F.max("offset")).alias("start"), (LENGTH - F.min("offset")).alias("end"))


def repeated_spans(docs: DataFrame, text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """(k1, k2, spans): by text key, the byte spans to remove; texts without any are absent."""
    keyed = _keyed(docs, text_col)
    shared = _counts(keyed).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    occurrences = staged(_occurrences(keyed, _bitmap(shared)))
    distinct = staged(occurrences.groupBy("h", "digest").agg(F.sum("n").alias("n"), F.first("before").alias("before"), F.first("after").alias("after")))
    mixed = staged(distinct.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"))
    whole = distinct.where(F.col("n") > 1).select(
        "h", "digest", (-F.col("before").cast("int")).alias("start"), (F.col("after").cast("int") + GRAM).alias("end"))
    contexts = _contexts(keyed, _bitmap(mixed.select("h"))).join(mixed, "h")
    contexts = contexts.groupBy("h", "digest", "m").agg(F.first("before").alias("before"), F.first("body").alias("body"))
    contexts = staged(contexts)
    partial = _merged(contexts.where(F.col("m") <= crowd).drop("m")).unionByName(_by_window(contexts.where(F.col("m") > crowd).drop("m")))
    found = staged(whole.where(F.col("end") - F.col("start") >= LENGTH).unionByName(partial).groupBy("h", "digest").agg(
        F.min("start").alias("start"), F.max("end").alias("end")))
    spans = occurrences.select("h", "digest", "k1", "k2", "place").join(found, ["h", "digest"]).select(
        "k1", "k2", F.struct((F.col("place") + F.col("start")).alias("start"), (F.col("place") + F.col("end")).alias("end")).alias("span"))
    return spans.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def _union(spans: list[dict] | None) -> list[list[int]]:
    out: list[list[int]] = []
    for s in spans or ():
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return out


def without_repeats(docs: DataFrame, text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """All columns of ``docs`` plus kept (binary: the bytes that stay), kept_text (their characters that no cut split),
    n_bytes and removed (array of maximal spans of removed bytes).

    Null texts count as empty. Equal texts of 200 bytes or more lose everything, each being the other's repeat; a repeated row is
    such a text. Clashing column names are an error.
    """
    if clash := {"kept", "kept_text", "removed", "n_bytes"} & set(docs.columns):
        raise ValueError(f"{sorted(clash)} are columns already")
    spans = repeated_spans(docs, text_col, crowd)
    names = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    joined = row.join(spans, ["k1", "k2"], "left").select("row", "spans")
    at_text = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, sizes = [], [], []
            buf, offsets = utf8(batch["row"].flatten()[at_text])
            for low, high, own in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch["spans"].to_pylist(), strict=True):
                raw = buf[low:high].tobytes()
                merged = _union(own)
                parts, at = [], 0
                for a, b in merged:
                    parts.append(raw[at:a])
                    at = b
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                removed.append([{"start": a, "end": b} for a, b in merged])
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(sizes, pa.int64())],
                names=["row", "kept", "kept_text", "removed", "n_bytes"])
            del kept, removed
        release()

    schema = T.StructType([joined.schema["row"], T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType()),
                           T.StructField("removed", T._parse_datatype_string("array<struct<start:int,end:int>>")), T.StructField("n_bytes", T.LongType())])
    return joined.mapInArrow(run, schema).select("row.*", "kept", "kept_text", "removed", "n_bytes")


def cut_documents(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated strings cut out of their texts. A character that a cut splits goes. A document of which nothing is
    left goes; one that was empty or null before stays as it is."""
    # the other columns travel by position in one struct, so none can clash with what is added
    places = {c: f"row.c{i}" for i, c in enumerate(docs.columns) if c != text_col}
    row = F.struct(F.lit(0).alias("one"), *(F.col(f"`{c}`").alias(p[4:]) for c, p in places.items()))
    done = without_repeats(docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("body")), "body")
    some = F.size("removed") > 0
    values = {c: F.col(p) for c, p in places.items()} | {text_col: F.when(some, F.col("kept_text")).otherwise(F.col("body"))}
    if n_chars_col in places:
        values[n_chars_col] = F.when(some, F.char_length("kept_text").cast(docs.schema[n_chars_col].dataType)).otherwise(values[n_chars_col])
    return done.where(~some | (F.length("kept_text") > 0)).select(*(values[c].alias(c) for c in docs.columns))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 from what ``without_repeats`` gives.

    A null text counts as empty. Rows of equal texts, repeated rows among them, are each other's repeats. Null ids stay, an empty table gives
    no rows, other columns are not read.
    """
    done = without_repeats(docs.select(id_col, text_col), text_col)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return done.select(
        id_col, "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

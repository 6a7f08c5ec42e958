"""Prefix trie of conversations, built as burst tries.

A conversation is a sequence of turns, a turn the digest of its role and text. Sequences are cut into pieces of 64 turns; the pieces that follow the
same turns share a head. Under each head stands a burst trie: all distinct pieces start in one container; a container with more than ``LIMIT``
pieces bursts into one container for each next turn, all oversized containers of a round at once, until none is left or its pieces
end. The other containers are sorted and swept into nodes, each by one task, whose work ``LIMIT`` bounds. However many turns a
conversation has and however many copies, no group is larger: equal pieces are counted before they enter, longer ones have further heads.

The trie labels every place of every distinct piece with its node, which is named by its depth and the smallest conversation
that runs through it. What a node needs of its whole subtree are sums over the conversations below it of two values that each has:
whether it is the smallest at a childless node, and the bytes it shares with a smaller conversation. So no round climbs the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtables.llm.common import release, staged, utf8

#: Turns of a piece, and hexadecimal digits of a turn's digest.
PIECE, DIGITS = 64, 32
#: Distinct pieces that a container holds at most.
LIMIT = 4096
#: Bits of conversation ids that one list of ends spans.
SPAN = 12


def turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, tid, bytes) by conversation in the order of turn, null first; of equal turn numbers by digest. Rows without a conversation go.

    Positions are counted by ranges of the sorted rows, so a conversation may be larger than a task.
    """
    digest = [F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) for c in (role_col, text_col)]
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.md5(F.concat(*digest).cast("binary")).alias("tid"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("seq"))
    parts = staged(rows.repartitionByRange("conv", "turn", "tid", "seq").drop("seq").withColumn("part", F.spark_partition_id()))
    counts = parts.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = counts.select("conv", "part", (F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy("turn", "tid"))
    numbered = parts.withColumn("within", within).join(before, ["conv", "part"])
    return staged(numbered.select("conv", (F.col("before") + F.col("within")).alias("pos"), "tid", "bytes"))


def rebuilt(own: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): of each conversation c the first h turns of c - c % family and its own after its first h, h = crc32(c) % (most + 1)."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    convs = staged(own.select("conv").distinct())
    kin = convs.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    heads = own.where((F.col("conv") % family == 0) & (F.col("pos") <= most)).withColumnRenamed("conv", "base")
    first = kin.join(heads, "base").where(F.col("pos") <= F.col("h")).select("conv", "pos", "tid", "bytes")
    have = heads.groupBy("base").agg(F.count("*").alias("have"))
    gaps = kin.join(have, "base", "left").select("conv", (F.col("h") - F.least("h", F.coalesce("have", F.lit(0)))).alias("gap")).where("gap > 0")
    rest = own.where(F.col("pos") > h).join(gaps, "conv", "left").select(
        "conv", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "tid", "bytes")
    return first.unionByName(rest), convs


def _total(sizes: str | Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)


def _digests() -> list[Column]:
    return [F.xxhash64("seg", "path"), F.xxhash64(F.lit("second"), "path", "seg")]


def pieces(sequences: DataFrame) -> DataFrame:
    """(conv, seg, path, sizes, last, h1, h2, pre, eid): pieces with the digest of what stands before them, its bytes, and a digest of both."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "tid", "bytes")))
    seg = F.floor((F.col("pos") - 1) / PIECE).cast("long").alias("seg")
    cut = sequences.groupBy("conv", seg).agg(ordered.alias("s")).select(
        "conv", "seg", F.array_join(F.col("s.tid"), "").alias("path"), F.col("s.bytes").alias("sizes"))
    cut = staged(cut)
    ends = cut.groupBy("conv").agg(F.max("seg").alias("end"))
    first, second = _digests()
    slim = cut.select("conv", "seg", first.alias("d1"), second.alias("d2"), _total("sizes").alias("all")).join(ends.where("end > 0").select("conv"), "conv")
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    later = slim.select(
        "conv", "seg", F.bit_xor("d1").over(before).alias("h1"), F.bit_xor("d2").over(before).alias("h2"), F.sum("all").over(before).alias("pre"))
    zero = F.lit(0).cast("long")
    found = cut.where("seg = 0").select("*", zero.alias("h1"), zero.alias("h2"), zero.alias("pre")).unionByName(
        cut.where("seg > 0").join(later, ["conv", "seg"]).select(*cut.columns, "h1", "h2", "pre"))
    eid = F.md5(F.concat_ws("/", "seg", "h1", "h2", "path").cast("binary"))
    return staged(found.join(ends, "conv").select("*", (F.col("seg") == F.col("end")).alias("last"), eid.alias("eid")).drop("end"))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (box, suffix): the node of each place of a suffix is the least conversation of the run that shares all up to there."""
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
        box = _fixed(rows["box"])
        low = int(np.flatnonzero(box != box[-1])[-1]) + 1 if (box != box[-1]).any() else 0
        kept = rows.slice(low)  # the last container may go on
        if low:
            yield _swept(rows.slice(0, low))
    if kept is not None and len(kept):
        yield _swept(kept)
    release()


def _fixed(column: pa.ChunkedArray) -> np.ndarray:
    buf, _ = utf8(column.combine_chunks())
    return np.ascontiguousarray(buf).view(f"S{DIGITS}")


def _swept(rows: pa.Table) -> pa.RecordBatch:
    box, least = _fixed(rows["box"]), rows["least"].to_numpy()
    buf, offsets = utf8(rows["suffix"].combine_chunks())
    lengths = np.diff(offsets) // DIGITS
    base = np.concatenate([[0], np.cumsum(lengths)])
    nodes = np.zeros(int(base[-1]), np.int64)
    group = np.concatenate([[0], np.cumsum(box[1:] != box[:-1])])
    for depth in range(int(lengths.max(initial=0))):
        on = np.flatnonzero(lengths > depth)
        at = (offsets[on] + DIGITS * depth)[:, None] + np.arange(DIGITS)
        turn = buf[at].view(f"S{DIGITS}").ravel()
        new = np.ones(len(on), bool)
        new[1:] = (group[on][1:] != group[on][:-1]) | (turn[1:] != turn[:-1])
        run = np.cumsum(new) - 1
        group[on] = run
        nodes[base[on] + depth] = np.minimum.reduceat(least[on], np.flatnonzero(new))[run]
    tail = pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), pa.array(nodes))
    return pa.RecordBatch.from_arrays([rows["eid"].combine_chunks(), rows["nodes"].combine_chunks(), tail], names=["eid", "nodes", "tail"])


def labelled(entries: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(eid, nodes): of each distinct piece (eid, seg, h1, h2, path, least) the smallest conversation at each of its places."""
    heads = entries.select(
        "eid", "seg", "path", "least", F.md5(F.concat_ws("/", "seg", "h1", "h2").cast("binary")).alias("box"),
        F.array().cast("array<bigint>").alias("nodes"))
    # all first pieces share one head, which needs no join
    top = heads.where("seg = 0")
    crowded = top.count() > limit
    further = heads.where("seg > 0")
    sizes = further.groupBy("box").agg(F.count("*").alias("n"))
    state = top.withColumn("open", F.lit(crowded)).unionByName(
        further.join(sizes, "box").withColumn("open", F.col("n") > limit).drop("n")).drop("seg")
    state, settled, whole, depth = staged(state), [], [], 0
    while True:
        settled.append((state.where("NOT open"), depth))
        state = state.where("open")
        if state.isEmpty():
            break
        whole.append(state.where(F.length("path") <= DIGITS * depth).select("eid", "nodes"))
        turn = F.substring("path", DIGITS * depth + 1, DIGITS)
        step = state.where(F.length("path") > DIGITS * depth).withColumn("box", F.md5(F.concat("box", turn).cast("binary")))
        found = step.groupBy("box").agg(F.min("least").alias("node"), F.count("*").alias("n"))
        state = staged(step.join(found, "box").select(
            "eid", "path", "least", "box", F.concat("nodes", F.array("node")).alias("nodes"), (F.col("n") > limit).alias("open")))
        depth += 1
    rows = None
    for part, depth in settled:
        part = part.select("box", F.substring(F.col("path"), DIGITS * depth + 1, DIGITS * PIECE).alias("suffix"), "least", "eid", "nodes")
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.repartition("box").sortWithinPartitions("box", "suffix")
    out = rows.mapInArrow(_sweep, "eid string, nodes array<bigint>, tail array<bigint>").select("eid", F.concat("nodes", "tail").alias("nodes"))
    for part in whole:
        out = out.unionByName(part)
    return staged(out)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (node, depth, part): one running digest a node over the lists of its parts."""
    key, state = None, None
    for batch in batches:
        done = []
        for node, depth, ids in zip(batch["node"].to_pylist(), batch["depth"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if (node, depth) == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (node, depth), hashlib.sha256()
            state.update(ids.encode())
        yield _digest_rows(done)
    if state is not None:
        yield _digest_rows([(*key, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    node, depth, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(node, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())], names=["node", "depth", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256) of (conv, node, depth): the ids, ascending and joined by commas, hashed piece by piece in their order."""
    part = F.shiftright("conv", SPAN).alias("part")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    lists = ends.groupBy("node", "depth", part).agg(ids.alias("ids"))
    rows = lists.repartition("node", "depth").sortWithinPartitions("node", "depth", "part").select("node", "depth", "ids")
    return rows.mapInArrow(_hashed, "node long, depth long, ends_sha256 string")


def trie(sequences: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``sequences`` has (conv, pos from 1 without gaps, tid, bytes), ``convs`` all conversations, those without turns included. Without conversations
    there is no row.
    """
    top = convs.agg(F.count("*").alias("n"), F.min("conv").alias("least")).first()
    if not top.n:
        return convs.sparkSession.createDataFrame([], SCHEMA)
    rows = pieces(sequences)
    entries = staged(rows.groupBy("eid", "seg", "h1", "h2", "path", "sizes", "pre").agg(
        F.count("*").alias("n"), F.sum(F.col("last").cast("long")).alias("n_ends"), F.min("conv").alias("least")))
    nodes = labelled(entries, limit)

    # what a head is called: the smallest conversation through the place before it
    first, second = _digests()
    full = rows.where(F.size("sizes") == PIECE)
    heads = full.groupBy(
        (F.col("seg") + 1).alias("seg"), F.col("h1").bitwiseXOR(first).alias("h1"), F.col("h2").bitwiseXOR(second).alias("h2")).agg(F.min("conv").alias("head"))
    named = entries.where("seg = 0").withColumn("head", F.lit(top.least).cast("long")).unionByName(
        entries.where("seg > 0").join(heads, ["seg", "h1", "h2"]).select(*entries.columns, "head"))
    places = named.join(nodes, "eid").select(
        "seg", "n", "n_ends", "nodes", "head", "pre", "sizes", F.posexplode("nodes").alias("i", "node"))
    depth = (F.col("seg") * PIECE + F.col("i") + 1).alias("depth")
    found = staged(places.groupBy("node", depth).agg(
        F.min(F.when(F.col("i") == 0, F.col("head")).otherwise(F.col("nodes")[F.greatest(F.col("i") - 1, F.lit(0))])).alias("parent"),
        F.sum("n").alias("n_convs"), F.sum(F.when(F.col("i") == F.size("nodes") - 1, F.col("n_ends")).otherwise(0)).alias("n_ends"),
        F.min(F.col("pre") + _total(F.slice("sizes", F.lit(1), F.col("i")))).alias("pre")))

    # of each conversation: where it ends, what it shares with a smaller one, and whether it is the name of a childless node
    shared = F.size(F.filter("nodes", lambda x: x < F.col("conv")))
    own = rows.join(nodes, "eid").select(
        "conv", "seg", F.size("nodes").alias("length"), _total(F.slice("sizes", F.lit(1), shared)).alias("shared"), F.element_at("nodes", -1).alias("node"))
    own = own.groupBy("conv").agg(
        F.sum("length").alias("depth"), F.sum("shared").alias("shared"), F.max(F.struct("seg", "node")).alias("end"))
    leaves = found.where("n_convs = n_ends").select(F.col("node").alias("conv"), F.lit(1).cast("long").alias("leaf"))
    own = staged(own.join(leaves, "conv", "left").select(
        "conv", "depth", "shared", F.col("end.node").alias("node"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")))

    sums = rows.select("conv", "eid").join(own.select("conv", "shared", "leaf"), "conv").groupBy("eid").agg(
        F.sum("shared").alias("shared"), F.sum("leaf").alias("leaves"), F.min(F.struct("conv", "shared")).alias("least"))
    below = sums.join(entries.select("eid", "seg"), "eid").join(nodes, "eid").select("shared", "leaves", "least", "seg", F.posexplode("nodes").alias("i", "node"))
    below = below.groupBy("node", depth).agg(F.sum("shared").alias("shared"), F.sum("leaves").alias("n_leaves"), F.min("least").alias("least"))
    children = found.groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    turnless = convs.join(own, "conv", "left_anti").select("conv", F.lit(top.least).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"))
    ends = staged(end_digests(own.select("conv", "node", "depth").unionByName(turnless)))

    whole = own.agg(F.sum("leaf").alias("leaves"), F.sum("shared").alias("shared")).first()
    root = convs.sparkSession.createDataFrame(
        [(top.least, 0, None, top.n, 1 if whole.leaves is None else whole.leaves, whole.shared or 0)],
        "node long, depth long, parent long, n_convs long, n_leaves long, saved long")
    at = ["node", "depth"]
    saved = F.col("shared") - F.col("least.shared") - (F.col("n_convs") - 1) * F.col("pre")
    every = found.join(below, at).select(*at, "parent", "n_convs", "n_leaves", saved.alias("saved")).unionByName(root)
    return every.join(children, at, "left").join(ends, at, "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", limit: int = LIMIT,
) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node.

    Null roles and texts count as empty. A null turn comes first; rows of one conversation with equal turn are taken in the order of their
    digests, exact copies one after the other. Rows without a conversation id are left out. An empty table gives no rows. Other columns
    are not read.
    """
    sequences, convs = rebuilt(turns(conversations, conv_col, turn_col, role_col, text_col))
    return trie(sequences, convs, limit)

"""Exact Jaccard join of documents on word shingles, with token-combination prefixes.

A document is the set of its 64-bit hashed shingles; documents of one set are one node. Two sets link when they share at least 4/5 of
their union (``LINK``). All tokens have one order, rare before frequent. Of the smaller set at most a ninth of the tokens can be missing
in a partner, of the larger at most a fifth (tau). A prefix in the order yields signatures: each rare token alone, and for short sets
each pair of frequent tokens. It is extended until rare + max(0, frequent - 1) > tau. Then the tau tokens that may be missing cannot
spoil all signatures, so linked sets share one, of the prefix of the smaller with tau = n // 9 and of the larger with tau = n // 5.
Frequencies come from sets counted within tasks and summed in a table of fixed size; they steer the order only, any order is exact.

Signatures that no two nodes of fitting size hold go. Each node is first verified against the pivot it shares most signatures with (the
least node by signature and size class). Then only signatures whose nodes fell into different components matter, for pairs within a
component cannot change it. Pairs that a signature of few nodes gives are listed and verified. Signatures of many nodes tie these
into clusters; a cluster's sets meet in cells of two blocks, where all intersections are one matrix product and only links that
connect something come out. Copies are never expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.llm.common import BLANKS, Words, drop_old_shuffles, mix, release, slices, staged, utf8, word_class
from gridtables.llm.components import components

SHINGLE = 5
BUCKETS = 1 << 20  # of the frequency table
FREQUENT = 64
SHORT = 128  # sets up to this size pair their frequent tokens
CROWD = 64  # nodes from which a signature's pairs are not listed but met in cells
CELL = 128  # sets in a block
CELL_TOKENS = 1 << 20  # tokens in a block
COUNTED = 1 << 20  # tokens that a task holds to count them
KEPT_BYTES = 6  # of a token's hash, in the sets that are moved for verification
BITS = 1 << 27  # of the table of nodes whose sets are wanted

_IS_WORD = word_class(BLANKS)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: (sorted distinct shingle hashes of each, offsets). Fewer words than ``size`` are one shingle."""
    buf, offsets = utf8(column)
    for low, high in slices(offsets):
        words = Words(buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], _IS_WORD)
        h, first = words.hashes, words.first
        n_words = np.diff(first)
        n_shingles = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
        doc = np.repeat(np.arange(high - low), n_shingles)
        start = np.repeat(first[:-1], n_shingles) + np.arange(len(doc)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
        length = np.minimum(n_words, size)[doc]
        total = length.astype(np.uint64)
        for i in range(size):
            inside = i < length
            part = np.where(inside, h[np.where(inside, start + i, 0)], np.uint64(0)) if len(h) else total
            total = total * np.uint64(0xC2B2AE3D27D4EB4F) + (part ^ (total >> np.uint64(33)))
        tokens = mix(total)
        order = np.lexsort((tokens, doc))
        tokens, doc = tokens[order], doc[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
        tokens, doc = tokens[new], doc[new]
        yield tokens, np.searchsorted(doc, np.arange(high - low + 1))


def node_ids(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set (0 for an empty one)."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        at = offsets[:-1][some]
        out[some] = mix(np.add.reduceat(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), at) + np.bitwise_xor.reduceat(tokens, at) * np.uint64(3) + n[some].astype(np.uint64))
    return out.view(np.int64)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(44)).astype(np.int64)


def describe(docs: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, n, node) by row, and the frequency table's (bucket, n) from sets that are distinct within their task."""
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        total = 0

        def counted() -> Iterator[pa.RecordBatch]:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            tokens, n = tokens[n > 1], n[n > 1]
            bucket, which = np.unique(_bucket(tokens), return_inverse=True)
            n = np.bincount(which, n, len(bucket)).astype(np.int64)
            if len(bucket):
                none = pa.nulls(len(bucket), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(bucket), kind), none, pa.array(n), none, pa.array(bucket)], names=names)
            held.clear()

        names = ["id", "text_hash", "n", "node", "bucket"]
        kind = pa.null()
        for batch in batches:
            kind = batch["id"].type
            ns, nodes = [], []
            for tokens, offsets in shingle_sets(batch["body"], size):
                own = node_ids(tokens, offsets)
                for i, node in enumerate(own.tolist()):
                    if node not in seen:
                        seen.add(node)
                        held.append(tokens[offsets[i] : offsets[i + 1]])
                        total += len(held[-1])
                ns.append(np.diff(offsets))
                nodes.append(own)
            if total > COUNTED:
                yield from counted()
                total = 0
            n = len(batch)
            columns = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (ns, nodes)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text_hash"], *columns, pa.nulls(n, pa.int64())], names=names)
        if held:
            yield from counted()
        seen.clear()
        release()

    schema = f"id {narrow.schema['id'].dataType.simpleString()}, text_hash long, n long, node long, bucket long"
    found = staged(narrow.mapInArrow(run, schema))
    rows = found.where("bucket IS NULL").drop("bucket")
    return rows, found.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n"))


def frequencies(table: DataFrame) -> np.ndarray:
    """The table as an array: at most ``BUCKETS`` rows come to the driver, whatever the input."""
    rows = table.where(F.col("n") >= 4).toArrow()
    out = np.zeros(BUCKETS, np.uint32)
    out[rows["bucket"].to_numpy()] = np.minimum(rows["n"].to_numpy(), 0xFFFFFFFF)
    return out


def signatures(tokens: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(signatures, how many of them are of the smaller role) of one set in the common order, for each mode it takes part in.

    The signatures of the smaller role come first. A single token is no set that two different nodes can link over.
    """
    n = len(tokens)
    if n < 2:
        return
    smaller, larger = n // 9 + 1, n // 5 + 1
    if n > SHORT:
        yield tokens[:larger], smaller
    if -(-4 * n // 5) <= SHORT:
        rare = int(np.searchsorted(weight, FREQUENT, "left"))
        parts, roles = [], []
        for want in (smaller, larger):
            single = min(want, rare)
            frequent = 0 if single == want else min(want - single + 1, n - rare)
            i, j = np.triu_indices(frequent, 1)
            # pairs (i, j) with j below a bound come first, so that the smaller role's pairs are a prefix
            order = np.lexsort((i, j))
            left, right = tokens[rare : rare + frequent][i[order]], tokens[rare : rare + frequent][j[order]]
            parts.append((tokens[:single], mix(left * np.uint64(0x9FB21C651E98DF25) + right)))
            roles.append((single, len(left)))
        (s0, p0), (s1, p1) = roles
        single, pairs = parts[1]
        own = np.concatenate([single[:s0], pairs[:p0], single[s0:s1], pairs[p0:p1]]) ^ np.uint64(0xA5A5A5A55A5A5A5A)
        yield own, s0 + p0 if n <= SHORT else 0


def _distinct_sets(column: pa.Array, size: int, seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    for tokens, offsets in shingle_sets(column, size):
        for i, node in enumerate(node_ids(tokens, offsets).tolist()):
            if node not in seen and offsets[i + 1] > offsets[i]:
                seen.add(node)
                yield node, tokens[offsets[i] : offsets[i + 1]]


def postings(docs: DataFrame, text_col: str, size: int, table: np.ndarray) -> DataFrame:
    """(sig, node, n, small): the signatures of each set, once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        weights = shared.value
        for batch in batches:
            sigs, nodes, ns, small = [], [], [], []
            for node, tokens in _distinct_sets(batch["body"], size, seen):
                weight = weights[_bucket(tokens)]
                order = np.argsort(weight, kind="stable")
                for own, role in signatures(tokens[order], weight[order]):
                    sigs.append(own)
                    nodes.append(np.full(len(own), node))
                    ns.append(np.full(len(own), len(tokens), np.int32))
                    small.append(np.arange(len(own)) < role)
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (nodes, ns, small))],
                    names=["sig", "node", "n", "small"])
        seen.clear()
        release()

    return docs.select(F.col(text_col).alias("body")).mapInArrow(run, "sig long, node long, n int, small boolean")


def _bit(node: Column) -> Column:
    return F.shiftrightunsigned(node, 37)


def packed(tokens: np.ndarray) -> bytes:
    """The first ``KEPT_BYTES`` bytes of each hash, in order."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES].tobytes()


def unpacked(data: pa.BinaryScalar) -> np.ndarray:
    short = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, KEPT_BYTES)
    wide = np.zeros((len(short), 8), np.uint8)
    wide[:, :KEPT_BYTES] = short
    return wide.view(">u8").ravel().astype(np.uint64)


def sets_of(docs: DataFrame, text_col: str, size: int, nodes: DataFrame) -> DataFrame:
    """(node, tokens) of the wanted nodes: a table of ``BITS`` bits, never larger, keeps most others from the shuffle, the join all."""
    words = nodes.select(_bit(F.col("node")).alias("bit")).groupBy(F.shiftrightunsigned("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toArrow()
    table = np.zeros(BITS >> 6, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        bits = shared.value
        for batch in batches:
            found = [
                (node, packed(tokens)) for node, tokens in _distinct_sets(batch["body"], size, seen)
                if bits[(node & 0xFFFFFFFFFFFFFFFF) >> 40] >> ((node & 0xFFFFFFFFFFFFFFFF) >> 37 & 7) & 1]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], names=["node", "tokens"])
        seen.clear()
        release()

    found = docs.select(F.col(text_col).alias("body")).mapInArrow(run, "node long, tokens binary")
    return staged(found.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("tokens").alias("tokens")), compression="none")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = unpacked(x), unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 80 * (len(x) + len(y) - both))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(chosen), batch["b"].filter(chosen)], names=["a", "b"])
        release()

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def links(docs: DataFrame, text_col: str, size: int, table: np.ndarray) -> DataFrame:
    """(a, b) links between nodes that have the components of all links between nodes."""
    every = staged(postings(docs, text_col, size, table))
    met = every.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    shared = staged(every.join(met.select("sig"), "sig", "left_semi").groupBy("sig", "node").agg(F.max("n").alias("n"), F.max("small").alias("small")))
    drop_old_shuffles(docs.sparkSession)
    # sizes of one class, or of one class of the other cut, are at most a quarter apart; any two fitting sizes are in neighbouring ones
    scale = F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))
    low = F.floor(scale - 1e-6).cast("int")
    fitting = shared.withColumn("near", F.explode(F.array(low, low + 1))).groupBy("sig", "near").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.max("small").alias("small")).where("low != high AND small")
    kept = shared.withColumn("near", F.explode(F.array(low, low + 1))).join(fitting.select("sig", "near"), ["sig", "near"], "left_semi")
    shared = staged(kept.drop("near").distinct())
    drop_old_shuffles(docs.sparkSession)
    sets = sets_of(docs, text_col, size, staged(shared.select("node").distinct()))
    drop_old_shuffles(docs.sparkSession)

    classes = F.array((F.floor(scale) * 2).cast("int"), (F.floor(scale + 0.5) * 2 + 1).cast("int"))
    by_class = shared.withColumn("class", F.explode(classes))
    pivots = by_class.groupBy("sig", "class").agg(F.min("node").alias("pivot"))
    near = by_class.join(pivots, ["sig", "class"]).where("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("shared"))
    star = near.groupBy("node").agg(F.max_by("pivot", F.struct("shared", "pivot")).alias("pivot"))
    star = staged(star.select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    root = components(staged(verified(star, sets)))
    drop_old_shuffles(docs.sparkSession)

    placed = staged(shared.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = placed.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("holders"), F.max("small").alias("small"))
    mixed = staged(mixed.where("low != high AND small").select("sig", "holders"))
    few = placed.join(mixed.where(F.col("holders") <= CROWD), "sig")
    left, right = few.select("sig", *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "small", "root"))), few.select("sig", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "small", "root")))
    pairs = left.join(right, "sig").where(
        (F.col("root_a") != F.col("root_b")) & (F.col("node_a") < F.col("node_b")) & (5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b"))
        & F.when(F.col("n_a") < F.col("n_b"), F.col("small_a")).when(F.col("n_a") > F.col("n_b"), F.col("small_b")).otherwise(F.col("small_a") | F.col("small_b")))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    listed = verified(staged(pairs.join(tried, ["a", "b"], "left_anti")), sets)
    drop_old_shuffles(docs.sparkSession)

    crowded = staged(placed.join(mixed.where(F.col("holders") > CROWD), "sig").select("sig", "node", "root", "n"))
    ties = crowded.join(crowded.groupBy("sig").agg(F.min("node").alias("least")), "sig")
    cluster = components(ties.select(F.col("node").alias("a"), F.col("least").alias("b")))
    members = crowded.select("node", "root", "n").distinct().join(cluster.select("node", F.col("root").alias("cluster")), "node", "left")
    in_cells = cell_links(members.withColumn("cluster", F.coalesce("cluster", "node")), sets)
    return root.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(listed).unionByName(in_cells)


def cell_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different roots within each cluster, from cells of two blocks of at most about ``CELL`` sets and
    ``CELL_TOKENS`` tokens.

    Blocks follow the sets' sizes, so that cells of blocks whose sizes cannot fit are left out.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    members = staged(members.withColumn("band", band))
    wanted = F.greatest(F.ceil(F.count("*") / CELL), F.ceil(F.sum("n") / CELL_TOKENS))
    counts = members.groupBy("cluster", "band").agg(wanted.cast("int").alias("blocks"))
    after = counts.select("cluster", (F.col("band") - 1).alias("band"), F.col("blocks").alias("next_blocks"))
    before = counts.select("cluster", (F.col("band") + 1).alias("band"), F.col("blocks").alias("last_blocks"))
    counts = counts.join(after, ["cluster", "band"], "left").join(before, ["cluster", "band"], "left")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.join(counts, ["cluster", "band"]).withColumn("block", block)

    def cells(low_band: Column, i: Column, high_band: Column, j: Column, side: Column) -> Column:
        return F.struct(low_band.alias("low_band"), i.alias("i"), high_band.alias("high_band"), j.alias("j"), side.alias("side"))

    b, own = F.col("band"), F.col("block")
    upto = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    within = F.transform(upto(F.col("blocks")), lambda o: cells(b, F.least(own, o), b, F.greatest(own, o), F.when(own <= o, 0).otherwise(1)))
    up = F.transform(upto(F.col("next_blocks")), lambda o: cells(b, own, b + 1, o, F.lit(0)))
    down = F.transform(upto(F.col("last_blocks")), lambda o: cells(b - 1, o, b, own, F.lit(1)))
    rows = dealt.select("cluster", "node", "root", F.explode(F.concat(within, up, down)).alias("cell")).select("cluster", "cell.*", "node", "root")

    def link(table: pa.Table) -> pa.Table:
        found = _cell(table["node"].to_numpy(), table["root"].to_numpy(), table["side"].to_numpy(), [unpacked(x) for x in table["tokens"]])
        release()
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return rows.join(sets, "node").groupBy("cluster", "low_band", "i", "high_band", "j").applyInArrow(link, "a long, b long")


def _cell(node: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the two sides (or within the only one) that join different roots, as few as connect the same."""
    sizes = np.array([len(s) for s in sets])
    one = len(set(side.tolist())) == 1
    left, right = (np.arange(len(node)),) * 2 if one else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    order = np.argsort(tokens)
    tokens, owner = tokens[order], owner[order]
    del order
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    column = np.cumsum(new, dtype=np.int64) - 1
    both = np.zeros((len(left), len(right)), np.float32)
    # a run of 4096 distinct tokens at a time
    steps = np.searchsorted(column, np.arange(0, int(column[-1]) + 4097, 4096))
    for low, high in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[low:high], column[low:high] - column[low]] = 1
        both += part[left] @ part[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - both
    x, y = np.nonzero((100 * both >= 80 * union) & (root[left][:, None] != root[right][None, :]))
    parent: dict[int, int] = {}

    def find(r: int) -> int:
        while parent.get(r, r) != r:
            r = parent[r]
        return r

    found = []
    for a, b in zip(left[x].tolist(), right[y].tolist(), strict=True):
        ra, rb = find(int(root[a])), find(int(root[b]))
        if ra != rb:
            parent[ra] = rb
            found.append((int(node[a]), int(node[b])))
    return found


def _rooted(docs: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, n, node) by row, and (node, least id of the node, root of its component) of the nodes with shingles."""
    rows, table = describe(docs, id_col, text_col, size)
    found = staged(links(docs, text_col, size, frequencies(table)))
    root = components(found)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    return rows, staged(nodes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per document: id, text_hash, n_shingles, component_id (smallest id that links reach).

    Null, empty and blank texts have no shingles and link with nothing, not even each other: component_id is their id. Repeated rows, and
    rows of equal sets, are in one component. A null id is passed over by the minimum and stays null where no row has an id.
    Other columns are not read.
    """
    rows, placed = _rooted(docs, id_col, text_col, size)
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = placed.join(least, "root").select("node", "component_id")
    some = rows.where("n > 0").join(by_node, "node").select("id", "text_hash", "n", "component_id")
    none = rows.where("n = 0").select("id", "text_hash", "n", F.col("id").alias("component_id"))
    return some.unionByName(none).select(F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id stays (of equal ids the one with
    the least text hash, of equal rows one). Documents without shingles all stay."""
    rows, placed = _rooted(docs, id_col, text_col, size)
    # by root: a component is known by its node, for ids may be null or stand for several texts
    kept = rows.where("n > 0").join(placed.select("node", "root"), "node").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "text_hash")).alias("first"))
    kept = kept.select(F.col("first.id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    text = F.col(f"`{text_col}`")
    with_words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    with_hash = docs.where(with_words).select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("kept_id"), F.xxhash64(text_col).alias("kept_hash"))
    same = with_hash["kept_id"].eqNullSafe(kept["kept_id"]) & (with_hash["kept_hash"] == kept["kept_hash"])
    chosen = with_hash.join(kept, same, "left_semi").groupBy("kept_id", "kept_hash").agg(F.first("row").alias("row"))
    return chosen.select("row.*").unionByName(docs.where(~with_words))

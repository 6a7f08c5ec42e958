"""Sharding by a k-d tree over document metadata, with leaves of near equal bytes.

Every metadata column becomes a coordinate of 31 bits: numbers by their place in the column's range, other values by a hash that keeps
equal values together; null is the lowest. A node that stands for k shards is split along the dimension with the widest range
of coordinates in it, at the weighted quantile k//2 / k of the rows' bytes. The quantile is found for all nodes of a level at
once and exactly: four rounds, each a sum of bytes by (node, next 15 or 16 bits of the key), then a running sum over the at most 65,536
bins of a node. The key is the coordinate and, so that a value held by many rows can be split, 31 bits of a hash of id and text.

Rows meet the tree through tables of one row per node. Neither rows nor leaves pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtables.llm.common import staged, unsigned_crc32

TOP = (1 << 31) - 1
ROUNDS = (46, 30, 15, 0)  # bits of the key below each round's digit
BROADCAST_NODES = 1 << 16


def _coordinates(docs: DataFrame, dims: Sequence[str]) -> list[Column]:
    numeric = [c for c in dims if isinstance(docs.schema[c].dataType, T.NumericType)]
    ranges = {}
    if numeric:
        finite = [F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")) for c in numeric]
        row = docs.agg(*(f(x).alias(f"{n}{i}") for i, x in enumerate(finite) for n, f in (("low", F.min), ("high", F.max)))).first()
        ranges = {c: (row[f"low{i}"], row[f"high{i}"]) for i, c in enumerate(numeric)}
    out = []
    for c in dims:
        if c in ranges:
            low, high = ranges[c]
            value = F.col(c).cast("double")
            place = F.lit(0.0) if low is None or low == high else (value - low) / (high - low)
            out.append(F.when(value.isNull() | F.isnan(value), 0).otherwise(F.floor(place * TOP)).cast("long"))
        else:
            out.append(F.coalesce(F.shiftrightunsigned(F.crc32(F.col(c).cast("string").cast("binary")), 1), F.lit(0)).cast("long"))
    return out


def _rows(docs: DataFrame, dims: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    crc = unsigned_crc32(text_col)
    return docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"), crc.alias("crc"),
        F.array(*_coordinates(docs, dims)).alias("place"),
        (F.xxhash64(F.col(id_col), crc).bitwiseAND(TOP)).alias("tie"),
        F.spark_partition_id().alias("part"))


def _key(dim: str = "dim") -> Column:
    return F.shiftleft(F.element_at("place", F.col(dim) + 1), 31).bitwiseOR(F.col("tie"))


def _reached(bins: DataFrame, state: DataFrame, on: list[str]) -> DataFrame:
    """(node, shards, first, dim, prefix, wanted, size): of each node the first bin that reaches the wanted bytes, and what is wanted of it."""
    upto = F.sum("size").over(Window.partitionBy("node").orderBy("digit"))
    reached = bins.join(state, on).withColumn("upto", upto)
    # rounding must not leave a node without a bin: then it is the last one
    found = reached.groupBy("node", "shards", "first", "dim").agg(
        F.min_by(F.struct("digit", "size", (F.col("wanted") - F.col("upto") + F.col("size")).alias("wanted")),
                 F.when(F.col("upto") >= F.col("wanted"), F.col("digit")).otherwise(F.lit(1 << 62).cast("long") + F.col("digit") * -1)).alias("at"))
    return staged(found.select("node", "shards", "first", "dim", F.col("at.digit").alias("prefix"), F.col("at.wanted").alias("wanted"), F.col("at.size").alias("size")))


def _below(side: Column) -> Column:
    return F.col("node") * 2 + side.cast("long")


def _level(rows: DataFrame, nodes: DataFrame, small) -> tuple[DataFrame, DataFrame]:
    """(rows, split): rows by their node one level down, and the split nodes with dim and threshold (keys up to it go left).

    One pass over the rows sums bytes by the first digit of every dimension, which gives the widest one and the bin of the
    quantile. A second pass sends the rows beside that bin left or right; only those within it are read again for the other digits.
    """
    at = F.posexplode("place").alias("dim", "at")
    bins = rows.join(small(nodes), "node").select("node", "size", at).groupBy("node", "dim", F.shiftrightunsigned("at", ROUNDS[0] - 31).alias("digit")).agg(
        F.sum("size").alias("size"), F.min("at").alias("low"), F.max("at").alias("high"))
    bins = staged(bins)
    spread = bins.groupBy("node", "dim").agg((F.max("high") - F.min("low")).alias("w"), F.sum("size").alias("bytes"))
    widest = spread.groupBy("node").agg(F.max(F.struct("w", (-F.col("dim")).alias("d"))).alias("top"), F.max("bytes").alias("bytes"))
    state = widest.join(small(nodes), "node").select(
        "node", "shards", "first", (-F.col("top.d")).cast("int").alias("dim"),
        (F.col("bytes") * F.floor(F.col("shards") / 2) / F.col("shards")).alias("wanted"))
    state = _reached(bins.select("node", "dim", "digit", "size"), state, ["node", "dim"])

    digit = F.shiftrightunsigned(_key(), ROUNDS[0])
    side = F.when(F.col("dim").isNull(), 0).when(digit < F.col("prefix"), 0).when(digit > F.col("prefix"), 1)
    placed = rows.join(small(state.select("node", "dim", "prefix")), "node", "left").withColumn("side", side)
    own = [c for c in rows.columns if c != "node"]
    placed = staged(placed.select(*own, F.coalesce(_below(F.col("side")), F.col("node")).alias("node"), F.col("side").isNull().alias("open")), "open")
    inside, done = placed.where("open").drop("open"), placed.where("NOT open").drop("open")
    for low, high in zip(ROUNDS[1:], ROUNDS[:-1]):
        met = inside.join(small(state.select("node", "dim", "prefix")), "node").where(F.shiftrightunsigned(_key(), high) == F.col("prefix"))
        bins = met.groupBy("node", F.shiftrightunsigned(_key(), low).alias("digit")).agg(F.sum("size").alias("size"))
        state = _reached(bins, state.drop("size", "prefix"), ["node"])
    # the row at the quantile goes to the side that it fits better
    threshold = F.col("prefix") - (F.col("wanted") * 2 < F.col("size")).cast("long")
    split = state.select("node", "shards", "first", "dim", threshold.alias("threshold"))
    met = inside.join(small(split), "node").select(*own, _below(_key() > F.col("threshold")).alias("node"))
    return done.select(*own, "node").unionByName(met), split


def shards(
    docs: DataFrame, dims: Sequence[str], n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, size (UTF-8 bytes and 1), text_crc32, shard, slot (gapless from 0 within the shard).

    Give ``n_shards``, or ``target_bytes`` for a leaf. Null texts have size 1. Rows equal in id and text are interchangeable and stay in
    one shard; all others can be split from each other, by the hash of id and text where their metadata are the same. Of dimensions
    equally wide the first is split. An empty table gives no rows. Other columns are not read. Tables of nodes are broadcast up to
    65,536 shards and joined beyond.
    """
    rows = staged(_rows(docs, dims, id_col, text_col).withColumn("node", F.lit(0).cast("long")))
    if n_shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, -(-total // target_bytes))
    small = F.broadcast if n_shards <= BROADCAST_NODES else lambda df: df
    spark, depth = docs.sparkSession, max(0, (n_shards - 1).bit_length())
    nodes = spark.createDataFrame([(0, n_shards, 0)], "node long, shards long, first long")
    for _ in range(depth):
        rows, split = _level(rows, nodes.where(F.col("shards") > 1), small)
        left = F.floor(F.col("shards") / 2)
        nodes = staged(
            nodes.where(F.col("shards") == 1).select((F.col("node") * 2).alias("node"), "shards", "first")
            .unionByName(split.select((F.col("node") * 2).alias("node"), left.alias("shards"), "first"))
            .unionByName(split.select((F.col("node") * 2 + 1).alias("node"), (F.col("shards") - left).alias("shards"), (F.col("first") + left).alias("first"))))
    placed = rows.join(small(nodes), "node").select("id", "size", "crc", F.col("first").cast("int").alias("shard"), "part")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "crc")) - 1
    return placed.withColumn("within", within).join(before, ["shard", "part"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("before") + F.col("within")).alias("slot"))

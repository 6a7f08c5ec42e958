"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Statistics of every whole text are taken in one pass. On a bounded sample of labelled rows a random forest is grown; every path from a
root to a node is a rule "statistic <= a and statistic > b ...". A logistic regression with an L1 penalty over the rules' 0/1
values keeps few of them with weights. The kept rules are compiled into one Spark column expression, so scoring is a
projection over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtables.llm.common import BLANKS, Words, release, slices, utf8, word_class

STATISTICS = (
    "n_bytes", "n_words", "mean_word", "long_words", "distinct_words", "repeated_words", "top_word", "letters", "digits", "symbols", "marks",
    "upper", "non_ascii", "n_lines", "mean_line", "distinct_lines", "odd_endings", "bars",
)
_WORD, _LINE = word_class(BLANKS), word_class(b"\n")


def _class(values: bytes) -> np.ndarray:
    table = np.zeros(256, np.float64)
    table[np.frombuffer(values, np.uint8)] = 1
    return table


_UPPER = _class(bytes(range(65, 91)))
_LETTER = _UPPER + _class(bytes(range(97, 123)))
_HIGH = _class(bytes(range(128, 256)))
_DIGIT = _class(b"0123456789")
_MARK = _class(b".,;:!?'\"()-")
_SYMBOL = _class(b"#$%&*+/<=>@[\\]^_`{|}~")
_BAR = _class(b"|")


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0)


def _counts(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, count of the most frequent key) by text."""
    n = len(first) - 1
    distinct, top = np.zeros(n), np.zeros(n)
    doc = np.repeat(np.arange(n), np.diff(first))
    if len(doc):
        order = np.lexsort((keys, doc))
        k, d = keys[order], doc[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        np.add.at(distinct, d[at], 1)
        np.maximum.at(top, d[at], np.diff(np.concatenate([at, [len(k)]])))
    return distinct, top


def _statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n_bytes = np.diff(offsets).astype(float)
    words, lines = Words(buf, offsets, _WORD), Words(buf, offsets, _LINE)
    n_words, n_lines = np.diff(words.first).astype(float), np.diff(lines.first).astype(float)
    length = (words.ends - words.starts).astype(float)
    distinct, top = _counts(words.hashes, words.first)
    distinct_lines, _ = _counts(lines.hashes, lines.first)
    again = np.zeros(len(words.hashes))
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    starts = words.first[:-1][np.diff(words.first) > 0]
    again[starts] = 0
    of = {name: _per_text(table[buf], offsets) for name, table in (
        ("letters", _LETTER), ("digits", _DIGIT), ("symbols", _SYMBOL), ("marks", _MARK), ("upper", _UPPER), ("non_ascii", _HIGH), ("bars", _BAR))}
    odd = _SYMBOL[buf[words.ends - 1]] if len(words.ends) else np.zeros(0)
    columns = {
        "n_bytes": n_bytes, "n_words": n_words, "mean_word": _share(_per_text(length, words.first), n_words),
        "long_words": _share(_per_text((length > 20).astype(float), words.first), n_words), "distinct_words": _share(distinct, n_words),
        "repeated_words": _share(_per_text(again, words.first), n_words), "top_word": _share(top, n_words),
        **{name: _share(value, n_bytes) for name, value in of.items()},
        "n_lines": n_lines, "mean_line": _share(n_bytes, n_lines), "distinct_lines": _share(distinct_lines, n_lines),
        "odd_endings": _share(_per_text(odd, words.first), n_words),
    }
    return np.stack([columns[c] for c in STATISTICS], axis=1)


def _array(column: pa.Array) -> pa.Array:
    buf, offsets = utf8(column)
    found = [_statistics(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
    flat = pa.array(np.concatenate(found).ravel() if found else np.zeros(0))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * len(STATISTICS)), flat)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats array<double>) of every whole text.

    Null and empty texts have only zeros. Repeated rows and null ids each give a row, an empty table gives none, other columns are not read.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["id"], _array(batch["body"])], names=["id", "stats"])

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, stats array<double>")


def with_statistics(docs: DataFrame, text_col: str = "text", stats_col: str = "stats") -> DataFrame:
    """All columns of ``docs`` plus their statistics, in one pass over the rows, of which only the texts leave the JVM. A clashing column
    name is an error."""
    if stats_col in docs.columns:
        raise ValueError(f"{stats_col} is already a column")

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield _array(column)
            release()

    return docs.withColumn(stats_col, F.arrow_udf(run, T.ArrayType(T.DoubleType()))(F.col(text_col)))


@dataclass(frozen=True)
class Rules:
    """Kept rules: each a conjunction of (statistic, is upper bound, bound), its weight, and the intercept."""

    rules: tuple[tuple[tuple[tuple[int, bool, float], ...], float], ...]
    intercept: float

    def score(self, stats: str = "stats") -> Column:
        """Probability of label 1 as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(fits(rule, stats), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fits(rule: tuple[tuple[int, bool, float], ...], stats: str) -> Column:
    out = F.lit(True)
    for i, upper, bound in rule:
        value = F.col(stats)[i]
        out = out & ((value <= bound) if upper else (value > bound))
    return out


def tree_paths(forest) -> list[tuple[tuple[int, bool, float], ...]]:
    """Every path from a root to a node, bounds on one statistic merged; each conjunction once."""
    found: dict[tuple, None] = {}

    def walk(node, bounds: dict[tuple[int, bool], float]) -> None:
        if bounds:
            found[tuple((i, upper, b) for (i, upper), b in sorted(bounds.items()))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        i, b = split.featureIndex(), float(split.threshold())
        walk(node.leftChild(), {**bounds, (i, True): min(b, bounds.get((i, True), b))})
        walk(node.rightChild(), {**bounds, (i, False): max(b, bounds.get((i, False), b))})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return [*found]


def fit(rows: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 0.0005, seed: int = 7) -> Rules:
    """Fits on ``rows`` (stats, label, weight), which the caller bounds. One class only, or no rows, gives that class's share."""
    shares = rows.agg(F.sum(F.col("label") * F.col("weight")), F.sum("weight"), F.min("label"), F.max("label")).first()
    if shares[1] is None or shares[2] == shares[3]:
        share = 0.5 if shares[1] is None else min(max(shares[0] / shares[1], 0.001), 0.999)
        return Rules((), float(np.log(share / (1 - share))))
    vectors = rows.select(array_to_vector("stats").alias("features"), "stats", "label", "weight")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, maxBins=64,
        featureSubsetStrategy="onethird").fit(vectors)
    paths = tree_paths(forest)
    hits = F.array(*(fits(p, "stats").cast("double") for p in paths))
    binary = vectors.select(array_to_vector(hits).alias("features"), "label", "weight")
    model = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(binary)
    weights = model.coefficients.toArray()
    return Rules(tuple((p, float(w)) for p, w in zip(paths, weights, strict=True) if w), float(model.intercept))


def kept_documents(docs: DataFrame, rules: Rules, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns, whatever these are called."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text_col}`").alias("body"))
    return with_statistics(row, "body").where(rules.score() >= least).select("row.*")

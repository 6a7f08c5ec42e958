"""Language identification by string kernels.

Two texts are as alike as the n-grams of 1 to 3 bytes that both have: the blended-spectrum kernel over presence, divided by the root of each
text's own value. Letters A-Z are lower-cased and all other ASCII bytes that are no letters are one separator. Some texts of
each language are the landmarks of a Nyström approximation; their n-grams are the features, others count nowhere. Kernel
ridge regression of each language against the rest is fitted on a bounded sample: tasks add up the products of the rows' kernel values, the
driver solves systems of the size of the landmarks. Texts are scored in batches: presence matrix x landmarks x weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtables.llm.common import LOWER, SLICE, release, staged, utf8

LENGTHS = (1, 2, 3)
#: Texts of each language to fit on, and landmarks among them.
PER_LANGUAGE, LANDMARKS = 1000, 32
UNKNOWN = "und"
#: Bytes of a presence matrix.
MATRIX = 24 << 20
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _symbols() -> np.ndarray:
    table = LOWER.copy()
    code = np.arange(256)
    table[(code < 128) & ~((table >= 97) & (table <= 122))] = 32
    return table


_SYMBOL = _symbols()


def grams(buf: np.ndarray, offsets: np.ndarray, lengths: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, code) of every n-gram, in steps of bounded size however long a document is."""
    ends = offsets[1:]
    for low in range(0, len(buf), SLICE):
        high = min(low + SLICE, len(buf))
        piece = _SYMBOL[buf[low : min(high + max(lengths) - 1, len(buf))]].astype(np.uint64)
        at = np.arange(low, high)
        doc = np.searchsorted(ends, at, "right")
        left = ends[doc] - at
        for p in lengths:
            fits = left >= p
            code = np.full(high - low, p << 56, np.uint64)
            for j in range(p):
                part = piece[j : j + high - low] << np.uint64(8 * (p - 1 - j))
                code[: len(part)] |= part
            yield doc[fits], code[fits]


def gram_sets(buf: np.ndarray, offsets: np.ndarray, lengths: Sequence[int]) -> list[np.ndarray]:
    """The distinct codes of each document."""
    found = [[np.zeros(0, np.uint64)] for _ in offsets[1:]]
    for doc, code in grams(buf, offsets, lengths):
        for d in np.unique(doc):
            found[d].append(np.unique(code[doc == d]))
    return [np.unique(np.concatenate(x)) for x in found]


@dataclass(frozen=True)
class Model:
    """Sorted codes, presence bits of the landmarks by code, and weights by landmark and language (the last row is the constant)."""

    languages: tuple[str, ...]
    lengths: tuple[int, ...]
    codes: np.ndarray
    bits: np.ndarray
    weights: np.ndarray

    @cached_property
    def landmarks(self) -> np.ndarray:
        """Normalised landmarks by column."""
        present = np.unpackbits(self.bits, axis=1, count=len(self.codes)).astype(np.float32)
        return (present / np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))).T.copy()

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Open addressing: keys, places of the codes, and the shift that makes a slot of a product."""
        size = 1 << max(4, int(4 * len(self.codes)).bit_length())
        keys, places, shift = np.full(size, _EMPTY), np.zeros(size, np.int32), 64 - size.bit_length() + 1
        todo, slot = np.arange(len(self.codes)), self._slot(self.codes, shift)
        while len(todo):
            free = keys[slot] == _EMPTY
            keys[slot[free]], places[slot[free]] = self.codes[todo[free]], todo[free]
            lost = keys[slot] != self.codes[todo]
            todo, slot = todo[lost], (slot[lost] + 1) & (size - 1)
        return keys, places, shift

    @staticmethod
    def _slot(codes: np.ndarray, shift: int) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype(np.int64)

    def _places(self, codes: np.ndarray) -> np.ndarray:
        """Place of each code, -1 for those of no landmark."""
        keys, places, shift = self.table
        slot = self._slot(codes, shift)
        seen = keys[slot]
        out = np.where(seen == codes, places[slot], -1)
        todo = np.flatnonzero((seen != codes) & (seen != _EMPTY))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & (len(keys) - 1)
            seen = keys[slot]
            hit = seen == codes[todo]
            out[todo[hit]] = places[slot[hit]]
            on = ~hit & (seen != _EMPTY)
            todo, slot = todo[on], slot[on]
        return out

    def kernel(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Kernel values of each document with the landmarks, and a column of ones."""
        n = len(offsets) - 1
        present = np.zeros((n, len(self.codes)), np.float32)
        for doc, code in grams(buf, offsets, self.lengths):
            place = self._places(code)
            known = place >= 0
            present[doc[known], place[known]] = 1
        own = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return np.hstack([(present @ self.landmarks) / own, np.ones((n, 1), np.float32)]).astype(np.float64)

    def batches(self, buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first, last, kernel values) of documents in runs whose presence matrix is bounded."""
        step = max(1, MATRIX // (4 * max(1, len(self.codes))))
        for low in range(0, len(offsets) - 1, step):
            high = min(low + step, len(offsets) - 1)
            yield low, high, self.kernel(buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])


def sample(rows: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(body, lang, place): about ``per_language`` rows of each language, those of least hash, or all where there are fewer.

    ``rows`` has id, body and lang, all usable. The driver sees one count a language.
    """
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # a row is in if its hash, as a share of all values, lies below the share of its language that is wanted
    share = (F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)).alias("place")
    # one row a language, as the model has one column a language: no text moves to find its count
    return staged(rows.join(F.broadcast(counts), "lang").select("body", "lang", "n", share).where(F.col("place") * F.col("n") < per_language).drop("n"))


def _landmarks(chosen: DataFrame, each: int, lengths: tuple[int, ...]) -> list[np.ndarray]:
    order = Window.partitionBy("lang").orderBy("place", "body")
    rows = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each).select("lang", "rank", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = gram_sets(*utf8(batch["body"]), lengths)
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], batch["rank"], pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["lang", "rank", "codes"])
        release()

    found = rows.mapInArrow(run, f"lang {rows.schema['lang'].dataType.simpleString()}, rank int, codes array<long>").collect()
    return [np.array(r.codes, np.int64).view(np.uint64) for r in sorted(found, key=lambda r: (r.lang, r["rank"]))]


def _root(kernel: np.ndarray) -> np.ndarray:
    """Inverse root of the landmarks' own kernel matrix; directions without weight are left out."""
    values, vectors = np.linalg.eigh(kernel)
    keep = values > 1e-6 * max(values.max(initial=0.0), 1e-12)
    return vectors[:, keep] / np.sqrt(values[keep])


def fit(
    chosen: DataFrame, lengths: Sequence[int] = LENGTHS, landmarks: int = LANDMARKS, penalty: float = 1e-4,
) -> Model:
    """Fits on ``chosen`` (body, lang, place), which the caller bounds. Each language has the same total weight."""
    lengths = tuple(lengths)
    counts = {r.lang: r.n for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(counts))
    if len(languages) < 2:
        return Model(languages, lengths, np.zeros(0, np.uint64), np.zeros((0, 0), np.uint8), np.ones((1, len(languages))))
    sets = _landmarks(chosen, landmarks, lengths)
    codes = np.unique(np.concatenate(sets))
    present = np.stack([np.isin(codes, s, assume_unique=True) for s in sets])
    m, total = len(sets), sum(counts.values())
    blank = Model(languages, lengths, codes, np.packbits(present, axis=1), np.zeros((m + 1, len(languages))))
    place = {x: i for i, x in enumerate(languages)}
    weight = {x: total / len(languages) / n for x, n in counts.items()}
    width = m + 1 + len(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((m + 1, width))
        for batch in batches:
            lang = batch["lang"].to_pylist()
            target = -np.ones((len(lang), len(languages)))
            target[np.arange(len(lang)), [place[x] for x in lang]] = 1
            w = np.array([weight[x] for x in lang])
            for low, high, kernel in blank.batches(*utf8(batch["body"])):
                sums += (kernel * w[low:high, None]).T @ np.hstack([kernel, target[low:high]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size, dtype=np.int32)), pa.array(sums.ravel())], names=["at", "value"])
        release()

    sums = np.zeros((m + 1) * width)
    for r in chosen.select("body", "lang").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toLocalIterator():
        sums[r["at"]] = r.value
    sums = sums.reshape(m + 1, width)
    norm = blank.landmarks.astype(np.float64)
    root = _root(norm.T @ norm)
    turn = np.zeros((m + 1, root.shape[1] + 1))
    turn[:m, :-1], turn[m, -1] = root, 1
    ridge = penalty * total * np.diag([1.0] * root.shape[1] + [0.0])
    solved = np.linalg.solve(turn.T @ sums[:, : m + 1] @ turn + ridge, turn.T @ sums[:, m + 1 :])
    return Model(languages, lengths, codes, blank.bits, turn @ solved)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text.

    The score is that of the best language, half of one plus its regression value, between 0 and 1; of equal ones the first by name is
    taken. A null text, one without a letter, and every text under a model without languages are ``und`` with score 0; a model of one language
    gives it to all others with score 1. Null and repeated ids stay, an empty table gives no rows, other columns are not read.
    """
    narrow = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            best, score = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for low, high, kernel in model.batches(*utf8(batch["body"])):
                value = kernel @ model.weights
                if value.shape[1]:
                    best[low:high] = value.argmax(axis=1)
                    score[low:high] = np.clip((1 + value.max(axis=1)) / 2, 0, 1)
            known = batch["known"].to_numpy(zero_copy_only=False) & bool(model.languages)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(names[np.where(known, best, -1)], pa.string()), pa.array(np.where(known, score, 0.0))],
                names=["id", "lang_pred", "score"])
        release()

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def learn(
    docs: DataFrame, usable, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE,
    lengths: Sequence[int] = LENGTHS, landmarks: int = LANDMARKS, penalty: float = 1e-4,
) -> Model:
    """Learns from the rows for which ``usable`` holds and that have an id, a language and a text with a letter."""
    rows = docs.where(usable & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.col(lang_col).cast("string").alias("lang"))
    return fit(sample(rows, per_language), lengths, landmarks, penalty)

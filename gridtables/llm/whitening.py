"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the distributed, centred matrix.

Entries become integers x = floor(64 c) + 1000000, so counts and sums are exact. The matrix X has one row for each distinct
x vector, less the mean. A step of the bidiagonalisation takes a right vector v of the size of a row; the tasks form their part of the left vector
u = X v - beta u' and of X^T u in one pass over their rows, and Spark adds the parts up. A left vector is never written: it is kept as the
coefficients p with u = X p, which each task applies to its rows. Both sequences are fully reorthogonalised: right vectors directly, left
ones through U^T u = P X^T u, which needs no further pass. The singular values of the small bidiagonal matrix give the deviations
along the components, its right vectors the components.

What passes the driver are vectors of the length of one row, as many as there are steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.llm.common import release, staged

#: Fixed by the contract of the integer code.
FACTOR, SHIFT = 64, 1_000_000
#: Entries from here on have no code that can be counted with; their rows are left out like those that are not finite.
LARGEST = 2.0**50
#: Rows of a matrix product in a task.
BLOCK = 4096
#: Directions with less than this share of the largest deviation count as constant.
CONSTANT = 1e-8


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x array<long>) of the usable rows: no null, every entry finite and below 2^50, and of the most frequent length (of equally frequent
    ones the longest)."""
    entry = lambda c: c.cast("double")
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < LARGEST))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable)
    width = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    return rows.where(F.size("v") == (width.width if width else 0)).select(
        "id", F.transform("v", lambda c: (F.floor(entry(c) * FACTOR) + SHIFT).cast("long")).alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def summed(rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> np.ndarray:
    """The sum of ``part(block of rows)``, a vector of ``width``, over all rows of x: one vector a task, added up by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0))
            for low in range(0, len(x), BLOCK):
                found = part(x[low : low + BLOCK])
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["place", "value"])
        release()

    kind = "long" if exact else "double"
    value = F.col("value").cast("decimal(38,0)") if exact else F.col("value")
    found = rows.select("x").mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum(value).alias("value")).collect()
    out = np.zeros(width, object if exact else np.float64)
    for r in found:
        out[r.place] = int(r.value) if exact else r.value
    return out


@dataclass(frozen=True)
class Centre:
    """Counts and exact sums of the distinct rows: the mean is ``whole + rest / n`` by dimension."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum of squares of n x - sums by row, exact; null from 38 digits on."""
        y, rest = x - self.whole, self.rest
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 62:
            return pa.array(((y * self.n - rest) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        rows = ((y.astype(object) * self.n - rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([int(v) if v < 10**38 else None for v in rows], pa.decimal128(38, 0))


def centre(rows: DataFrame, width: int) -> Centre:
    """``rows`` are the distinct ones. Entries are added up in two halves of 32 bits, so that no sum overflows."""

    def part(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])

    found = summed(rows, 2 * width + 1, part, exact=True)
    return Centre(int(found[0]), tuple(int(h) * (1 << 32) + int(low) for h, low in zip(found[1 : width + 1], found[width + 1 :], strict=True)))


def bidiagonal(
    product: Callable[[np.ndarray], tuple[float, np.ndarray]], width: int, wanted: int, tolerance: float = 0.0, seed: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors by column) of X, the ``wanted`` largest; ``product(p)`` gives |X p|^2 and X^T X p.

    A breakdown starts again from a random direction across all right vectors, so repeated values are found as often as they
    occur when all ``width`` steps are made. With a ``tolerance`` the steps end when the residuals of the wanted values, against the largest
    value, are no larger; of exactly equal values one is then found.
    """
    random = np.random.default_rng(seed)
    right, left, back = (np.zeros((0, width)) for _ in range(3))  # v, p with u = X p, and X^T u, by row
    alphas, betas = [], []

    def across(w: np.ndarray) -> np.ndarray:
        for _ in range(2):
            w = w - right.T @ (right @ w)
        return w

    v, beta, fresh = random.normal(size=width), 0.0, True
    v /= np.linalg.norm(v)
    while True:
        p = v - beta * left[-1] if beta else v
        square, g = product(p)
        for _ in range(2):
            c = left @ g
            if c @ c > 0.5 * square:  # what is left is too small a difference to be taken from the sums
                p = p - c @ left
                square, g = product(p)
            else:
                p, g, square = p - c @ left, g - c @ back, square - c @ c
        alpha = float(np.sqrt(max(square, 0.0)))
        scale = max([alpha, *alphas, *betas])
        if alpha <= 1e-12 * scale:
            alpha, p, g = 0.0, np.zeros(width), np.zeros(width)
        else:
            p, g = p / alpha, g / alpha
        right, left, back = np.vstack([right, v]), np.vstack([left, p]), np.vstack([back, g])
        alphas.append(alpha)
        if len(alphas) == width or fresh and not alpha:
            break
        w = across(g - alpha * v)
        beta = float(np.linalg.norm(w))
        fresh = beta <= 1e-12 * scale
        if fresh:
            beta, w = 0.0, across(random.normal(size=width))
        w /= np.linalg.norm(w)
        if tolerance and len(alphas) >= wanted:
            small = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if np.abs(beta * small[0][-1, :wanted]).max() <= tolerance * small[1][0]:
                break
        betas.append(beta)
        v = w
    _, values, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1))
    return values[:wanted], right.T @ turned[:wanted].T


@dataclass(frozen=True)
class Whitening:
    """Components by column, eigenvalues of the covariance, their share of its trace, and the largest error of the whitened covariance."""

    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def fit(distinct: DataFrame, width: int, components: int = 16, tolerance: float = 0.0) -> Whitening | None:
    """``distinct`` has each x vector once and is read once a step. None without rows or without any spread."""
    middle = centre(distinct, width) if width else Centre(0, ())
    if not middle.n:
        return None
    trace = summed(distinct, 1, lambda x: np.array([(middle.centred(x) ** 2).sum()]))[0]
    if not trace > 0:
        return None

    def product(p: np.ndarray) -> tuple[float, np.ndarray]:
        def part(x: np.ndarray) -> np.ndarray:
            rows = middle.centred(x)
            u = rows @ p
            return np.concatenate([[u @ u], rows.T @ u])

        found = summed(distinct, width + 1, part)
        return found[0], found[1:]

    values, vectors = bidiagonal(product, width, min(components, width), tolerance)
    keep = values > CONSTANT * values[0]
    values, vectors = values[keep], vectors[:, keep]
    k, eigenvalues = len(values), values**2 / middle.n
    model = Whitening(middle, vectors, eigenvalues, values**2 / trace, 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        z = model.whitened(x)
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    found = summed(distinct, k + k * k, moments) / middle.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return Whitening(middle, vectors, eigenvalues, model.explained, float(np.abs(covariance - np.eye(k)).max()))


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, tolerance: float = 0.0,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row for each usable row and component.

    Rows with a null vector, null or non-finite entries, entries of 2^50 and more, or another length than the most frequent one are left out;
    null and repeated ids stay. Repeated vectors count once in the fit and each gets its rows. Directions without spread have no component, so
    an empty table, or one of equal vectors, gives no rows. Other columns are not read.
    """
    rows = integers(vectors, id_col, vector_col)
    distinct = staged(rows.select("x").distinct())
    first = distinct.first()
    model = fit(distinct, len(first.x) if first else 0, components, tolerance)
    schema = (f"{id_col} {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
              "whitened double, explained double, identity_error double")
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), BLOCK):
                ids, x = batch.column(0)[low : low + BLOCK], _matrix(batch.column(1)[low : low + BLOCK])
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n)),
                     model.centre.deviation(x).take(each), pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.explained, m)),
                     pa.array(np.full(m * k, model.identity_error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
        release()

    return rows.mapInArrow(run, schema)


def as_long(value: str) -> Column:
    """A deviation as long, null where it does not fit."""
    return F.col(value).try_cast("long")

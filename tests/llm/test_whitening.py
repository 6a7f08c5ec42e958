import math

import numpy as np
import pytest

from gridtables.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component string"


def brute(rows, components=16):
    """Of (id, vector): n, sums, eigenvalues and components by a dense decomposition, and the rows that remain."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    return kept, n, sums, values[order], vectors[:, order], values.sum()


def compare(spark, rows, components=16):
    got = whitening.whiten(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3), components=components).collect()
    kept, n, sums, values, vectors, trace = brute(rows, components)
    k = int((values > 1e-12 * values[0]).sum())
    assert len(got) == k * len(kept)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, x in kept:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        own = by[(i, deviation)]
        assert sorted(own) == list(range(1, k + 1))
        for c, rs in own.items():
            want = (n * np.array(x) - sums) / n @ vectors[:, c - 1] / np.sqrt(values[c - 1])
            for r in rs:
                assert r.n == n and abs(r.explained * trace / values[c - 1] - 1) < 1e-9 and r.identity_error < 1e-8
            if len(rs) == 1 and abs(want) > 1e-3:
                sign = np.sign(want) * np.sign(rs[0].whitened)
                assert signs.setdefault(c, sign) == sign
                assert abs(abs(want) - abs(rs[0].whitened)) < 1e-8
    return got


def test_equals_dense_decomposition(spark):
    random = np.random.default_rng(3)
    mixing = random.normal(size=(20, 20)) * np.linspace(3, 0.2, 20)
    rows = [(i, [float(c) for c in random.normal(size=20) @ mixing]) for i in range(300)]
    compare(spark, rows)


def test_nulls_repeats_and_other_entries_are_left_out(spark):
    random = np.random.default_rng(4)
    rows = [(i, [float(c) for c in random.normal(size=5)]) for i in range(40)]
    odd = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan"), 1.0, 1.0, 1.0, 1.0]), (53, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    got = compare(spark, rows + rows[:7] + odd)
    assert got[0].n == 40 and {r.vec_id for r in got} == set(range(40))
    short = whitening.whiten(spark.createDataFrame([(*r, "c") for r in [*rows, (60, [1.0]), (61, []), (62, [1e300] * 5), (None, rows[0][1])]], SCHEMA)).collect()
    assert {r.vec_id for r in short} == {*range(40), None}


def test_constant_dimensions_and_few_rows(spark):
    rows = [(0, [1.0, 2.0, 0.5]), (1, [1.0, 3.0, 0.5]), (2, [1.0, 5.0, 0.5])]
    got = compare(spark, rows)
    assert {r.component for r in got} == {1}


def test_no_rows_without_spread(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], "c") for i in range(5)], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, "c"), (2, [], "c")], SCHEMA)).collect() == []


def test_large_entries_are_counted_exactly(spark):
    rows = [(i, [float((i * 7919) % 101) * 2.0**40, float(i % 13)]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame([(*r, "c") for r in rows], SCHEMA)).collect()
    kept, n, sums, *_ = brute(rows)
    want = {i: sum((n * a - int(s)) ** 2 for a, s in zip(x, sums)) for i, x in kept}
    assert {r.vec_id: int(r.deviation) for r in got} == want


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [9, 4, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1], [1e3, 1, 1e-3, 1e-3, 0, 0]])
def test_repeated_and_vanishing_singular_values(values):
    random = np.random.default_rng(5)
    u, _ = np.linalg.qr(random.normal(size=(50, 6)))
    v, _ = np.linalg.qr(random.normal(size=(6, 6)))
    x = u @ np.diag(values) @ v.T

    def product(p):
        left = x @ p
        return float(left @ left), x.T @ left

    found, vectors = whitening.bidiagonal(product, 6, 6)
    want = np.array(values, float)
    assert np.allclose(found, want[: len(found)], atol=1e-9 * want[0]) and not want[len(found) :].any()
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.allclose(x.T @ x @ vectors, vectors * found**2, atol=1e-9 * want[0] ** 2)


def test_a_tolerance_ends_the_steps_early():
    random = np.random.default_rng(6)
    x = random.normal(size=(500, 60)) * 0.9 ** np.arange(60)
    calls = []

    def product(p):
        calls.append(1)
        left = x @ p
        return float(left @ left), x.T @ left

    found, _ = whitening.bidiagonal(product, 60, 4, tolerance=1e-10)
    assert len(calls) < 45 and np.allclose(found, np.linalg.svd(x)[1][:4], rtol=1e-9)

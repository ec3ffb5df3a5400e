import math
from fractions import Fraction

import numpy as np
import pytest

from viewloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(i + first, v, "x") for i, v in enumerate(vectors)], SCHEMA).repartition(3)


def slow(vectors):
    """(n, deviations, covariance) with exact fractions, of usable vectors."""
    whole = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(whole))
    n, width = len(fit), len(fit[0])
    sums = [sum(v[d] for v in fit) for d in range(width)]
    deviations = [sum((n * v[d] - sums[d]) ** 2 for d in range(width)) for v in whole]
    mean = [Fraction(s, n) for s in sums]
    covariance = [[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(width)] for i in range(width)]
    return whole, n, deviations, np.array(covariance), [float(m) for m in mean]


def rows_of(found):
    by_key = {}
    for r in found.collect():
        by_key.setdefault(r.vec_id, {})[r.component] = r
    return by_key


def test_brute_force(spark):
    rng = np.random.default_rng(2)
    data = (rng.standard_normal((300, 24)) * np.linspace(3, 0.1, 24)) @ np.linalg.qr(rng.standard_normal((24, 24)))[0]
    vectors = [v.tolist() for v in data.astype(np.float32)]
    vectors += vectors[:50] * 3  # copies weigh nothing
    found = rows_of(whitening.whiten(table(spark, vectors)))
    whole, n, deviations, covariance, mean = slow(vectors)
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(found) == len(vectors)
    for i, v in enumerate(whole):
        assert sorted(found[i]) == list(range(1, 17))
        r = found[i][1]
        assert (r.n, r.deviation) == (n, deviations[i])
        assert r.identity_error < 1e-9
    for k in range(16):
        want = (np.array(whole) - mean) @ basis[:, k] / np.sqrt(values[k])
        got = np.array([found[i][k + 1].whitened for i in range(len(whole))])
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-7
        assert found[0][k + 1].explained == pytest.approx(values[k] / values.sum(), rel=1e-9)


def test_unusable_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[0.5, 1.0], [1.0, 0.25], None, [None, 1.0], [nan, 1.0], [inf, 0.0], [2.0, 3.0], [1e30, 0.0], [0.5]]
    found = rows_of(whitening.whiten(table(spark, vectors)))
    assert sorted(found) == [0, 1, 6, 8]
    _, n, deviations, _, _ = slow([[0.5, 1.0], [1.0, 0.25], [2.0, 3.0], [0.5, 0.0]])
    assert [found[i][1].deviation for i in (0, 1, 6, 8)] == deviations and found[0][1].n == n == 4
    assert sorted(found[0]) == [1, 2]


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]]])
def test_nothing_to_whiten(spark, vectors):
    found = whitening.whiten(table(spark, vectors))
    assert found.count() == 0 and found.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_null_and_repeated_keys(spark):
    rows = [(None, [1.0, 0.0], ""), (None, [0.0, 1.0], ""), (4, [3.0, 0.5], ""), (4, [3.0, 0.5], "")]
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 8


def test_large_sums_stay_exact():
    model = whitening.Whitening(whitening.Statistics(1 << 40, [1 << 41, 0], np.eye(2)), np.ones(2), np.eye(2))
    matrix = np.array([[5, 1], [1 << 30, 7]])
    n = 1 << 40
    exact = [(n * 5 - 2 * n) ** 2 + n**2, (n * (1 << 30) - 2 * n) ** 2 + (7 * n) ** 2]
    assert model.deviations(matrix) == [x if x < 1 << 63 else None for x in exact]
    small = whitening.Whitening(whitening.Statistics(3, [3 * 10**6 + 1, 3], np.eye(2)), np.ones(2), np.eye(2))
    assert small.deviations(np.array([[10**6, 1]])) == [1]


@pytest.mark.parametrize(
    "spectrum",
    [
        [5.0] * 20,
        [1.0] * 15 + [1 - 1e-12, 1 - 1e-9, 0.5, 0.5, 0.1],
        np.geomspace(1, 1e-12, 30).tolist(),
        [3, 2, 1, 0, 0, 0, 0],
        np.linspace(2, 1, 64).tolist(),
        [1e9, 1, 0.999999, 1e-3],
        [7.0],
    ],
)
def test_spectra(spectrum):
    n = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))[0]
    matrix = (turn * spectrum) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.components(matrix)
    want = sorted((s for s in spectrum if s > 0), reverse=True)[:16]
    assert len(values) == len(want)
    assert np.allclose(values, want, rtol=1e-9, atol=1e-15 * n * max(spectrum))
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-10
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * max(spectrum) * n


def test_inertia_counts():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    shifts = np.linspace(-8, 8, 50)
    assert whitening.count_above(whitening.tridiagonal(a), shifts).tolist() == [(values > s).sum() for s in shifts]

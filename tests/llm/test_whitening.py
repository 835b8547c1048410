"""Whitening against exact fractions and a plain covariance."""

from fractions import Fraction

import numpy as np
import pytest

from tallystar.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n int, x string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, 2, "clash") for k, v in rows], SCHEMA)


def integers(v):
    return [int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v]


def exact_fit(rows):
    """Distinct integer vectors, sums, and the covariance in fractions."""
    x = sorted({tuple(integers(v)) for _, v in rows})
    n, width = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(width)]
    cov = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3)
            for j in range(width)] for i in range(width)]
    return x, sums, cov


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(20, 20)) * np.linspace(0.2, 3, 20)
    return [(k, [float(np.float32(c)) for c in rng.normal(size=20) @ mix + 5]) for k in range(400)]


@pytest.mark.parametrize("block_rows", [4096, 64])
def test_against_fractions(spark, vectors, block_rows):
    rows = vectors + [(k + 1000, v) for k, v in vectors[:150]] + [(vectors[0][0], vectors[0][1]), (None, vectors[1][1])]
    odd = [(5000, None), (5001, []), (5002, [None] * 20), (5003, [float("nan")] * 20),
           (5004, [float("inf")] + [0.0] * 19), (5005, [1.0] * 19), (5006, [1e30] * 20)]
    found = whitening.whiten(frame(spark, rows + odd), block_rows=block_rows).collect()
    x, sums, cov = exact_fit(rows)
    n = len(x)
    assert len(found) == 16 * len(rows)
    assert {r["n"] for r in found} == {n}
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    trace = float(sum(cov[d][d] for d in range(20)))
    by_id = {k: integers(v) for k, v in rows}
    signs = {}
    for r in found:
        v, k = by_id[r["vec_id"]], r["component"]
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(v, sums))
        assert r["deviation_digits"] == str(r["deviation"])
        assert abs(r["explained"] - values[-k] / trace) < 1e-9
        want = sum(float(Fraction(n * c - s, n)) * a for c, s, a in zip(v, sums, axes[:, -k])) / np.sqrt(values[-k])
        sign = signs.setdefault(k, 1 if abs(r["whitened"] - want) < abs(r["whitened"] + want) else -1)
        assert abs(r["whitened"] - sign * want) < 1e-6
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9


def test_bit_sliced_products_are_exact():
    rng = np.random.default_rng(8)
    numbers = np.column_stack([
        rng.integers(0, 2, 130), rng.integers(0, 2**40, 130), np.zeros(130, dtype=np.int64), rng.integers(0, 999, 130)])
    bits = [int(c.max()).bit_length() for c in numbers.T]
    sliced = whitening.planes(numbers, bits)
    assert sliced.shape == (sum(bits), 3)
    cross = whitening.scatter(sliced, bits)
    for i in range(4):
        for j in range(i, 4):
            assert cross[i][j] == sum(int(a) * int(b) for a, b in zip(numbers[:, i], numbers[:, j]))


def test_small_and_flat_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    # One direction of spread among three dimensions: one component.
    line = whitening.whiten(frame(spark, [(k, [float(k), 2.0 * k, 7.0]) for k in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 5
    assert abs(line[0]["explained"] - 1) < 1e-12


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(k * k) * 2.0**45, float(-k) * 2.0**44, 1.0]) for k in range(6)]
    found = whitening.whiten(frame(spark, rows)).collect()
    x, sums, _ = exact_fit(rows)
    by_id = {k: integers(v) for k, v in rows}
    for r in found:
        want = sum((len(x) * c - s) ** 2 for c, s in zip(by_id[r["vec_id"]], sums))
        assert r["deviation_digits"] == str(want) and r["deviation"] is None
    assert found[0]["identity_error"] < 1e-6

"""Whitening against numpy's eigenvectors and exact integers."""

import math

import numpy as np
import pytest

from gaugeframe.llm.whitening import fit_whitening, inertia, leading, whitened_components


def matrices():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 9, 30):
        b = rng.standard_normal((n, n))
        yield b @ b.T
        b[:, n // 2 :] = 0
        yield b @ b.T  # without full rank
        yield np.eye(n)
        yield np.diag(np.repeat([3.0, 1.0], [n // 2, n - n // 2]))
        yield np.diag(10.0 ** -np.arange(n))
        yield np.diag(1 + 1e-9 * np.arange(n))


@pytest.mark.parametrize("m", matrices())
def test_spectrum_equals_numpy(m):
    values, n = np.linalg.eigvalsh(m)[::-1], len(m)
    for shift in np.random.default_rng(2).uniform(-1, values.max() * 1.1 + 0.1, 6):
        assert inertia(m - shift * np.eye(n)) == (values > shift).sum()
    found = leading(m, 8)
    k = len(found.values)
    assert k >= min(8, (values > 1e-11 * values.max()).sum()) if values.max() > 0 else k == 0
    assert np.allclose(found.values, values[:k], rtol=1e-12, atol=1e-13 * max(values.max(), 1e-300))
    if k:
        assert np.abs(found.vectors @ found.vectors.T - np.eye(k)).max() < 1e-9
        rest = m @ found.vectors.T - found.vectors.T * found.values
        assert np.abs(rest).max() < 1e-12 * n * values.max()
        assert found.certified.all()


def rows_of(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame(
        [(i, v, "x", 1) for i, v in zip(ids, vectors)],
        "vec_id long, embedding array<float>, whitened string, n int").repartition(3)


def test_results_equal_numpy(spark):
    rng = np.random.default_rng(5)
    base = (rng.standard_normal((400, 12)) * np.linspace(2, 0.1, 12)).astype(np.float32)
    vectors = [v.tolist() for v in base]
    vectors += [None, [None] * 12, [math.nan] * 12, [math.inf] + [0.0] * 11, [1.0], []]
    got = whitened_components(rows_of(spark, vectors)).collect()
    x = np.floor(1024 * base.astype(float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    d = [[n * int(v) - int(s) for v, s in zip(row, total)] for row in x]
    cov = (x - total / n).T @ (x - total / n) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 400 * 8 and {r["component"] for r in got} == set(range(1, 9))
    white = np.zeros((400, 8))
    for r in got:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["certified"]
        assert int(r["deviation"]) == sum(v * v for v in d[r["vec_id"]])
        assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(cov)) - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    want = (x - total / n) @ axes[:, :8] / np.sqrt(values[:8])
    for k in range(8):
        assert min(np.abs(white[:, k] - s * want[:, k]).max() for s in (1, -1)) < 1e-7


def test_values_beyond_64_bits_stay_exact(spark):
    vectors = [[float(2**40)], [0.0], [-float(2**40)]]
    got = {r["vec_id"]: int(r["deviation"]) for r in whitened_components(
        rows_of(spark, vectors)).collect()}
    x = [v[0] * 1024 + 100_000 for v in vectors]
    assert got == {i: (3 * int(v) - int(sum(x))) ** 2 for i, v in enumerate(x)}


def test_equal_few_and_no_vectors(spark):
    same = whitened_components(rows_of(spark, [[1.0, 2.0]] * 5))
    assert same.count() == 0  # no variance, no components
    two = whitened_components(rows_of(spark, [[1.0, 2.0], [2.0, 2.0], [1.0, 2.0]], [7, None, 7]))
    assert sorted((r["vec_id"] or -1, r["component"]) for r in two.collect()) == [
        (-1, 1), (7, 1), (7, 1)]
    assert two.head()["explained"] == pytest.approx(1.0)
    for odd in ([], [None], [[]], [[math.nan]]):
        df = rows_of(spark, odd) if odd else rows_of(spark, [[1.0]]).limit(0)
        assert whitened_components(df).count() == 0


def test_only_the_most_frequent_length_counts(spark):
    model = fit_whitening(rows_of(spark, [[1.0, 2.0], [3.0, 2.5], [1.0], [2.0], [5.0]]))
    assert model.n == 3 and len(model.total) == 1

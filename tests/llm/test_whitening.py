"""Spectra by rank-one updates, and the whitening that rests on them, against a plain eigendecomposition."""

import numpy as np
import pytest

from quarrymill.llm import queries
from quarrymill.llm.rank_one import Spectrum, secular_roots, updated
from quarrymill.llm.whitening import whiten


def _same(spectrum, x, tolerance=1e-10):
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    scale = max(np.abs(scatter).max(), 1e-300)
    rebuilt = (spectrum.vectors * spectrum.values) @ spectrum.vectors.T
    assert spectrum.n == len(x) and np.allclose(spectrum.mean, x.mean(axis=0))
    assert np.abs(rebuilt - scatter).max() <= tolerance * scale
    assert np.abs(spectrum.vectors.T @ spectrum.vectors - np.eye(x.shape[1])).max() < 1e-11
    assert (np.diff(spectrum.values) >= 0).all()


def _of(x):
    spectrum = Spectrum.empty(x.shape[1])
    for row in x:
        spectrum.add(row)
    return spectrum


@pytest.mark.parametrize("shape", [(1, 1), (3, 1), (2, 5), (40, 5), (300, 17)])
def test_updates_equal_the_scatter_matrix(shape):
    rng = np.random.default_rng(shape[0])
    x = np.floor(rng.normal(size=shape) * 64)
    _same(_of(x), x)
    x[len(x) // 3 :] = x[0]
    _same(_of(x), x)
    x[:] = 5.0
    assert _of(x).values.tolist() == [0.0] * shape[1]


def test_merged_spectra_equal_one_of_all_rows():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(200, 9)) * 64 * np.arange(1, 10))
    merged = _of(x[:1])
    for part in (x[1:3], x[3:120], x[120:]):
        merged.merge(_of(part))
    _same(merged, x)


def test_roots_lie_between_poles():
    rng = np.random.default_rng(2)
    for k in (1, 2, 10, 40):
        poles, weights = np.sort(rng.random(k) * 10.0 ** rng.integers(-6, 6, k)), 10.0 ** rng.uniform(-12, 3, k)
        origin, tau = secular_roots(poles, weights)
        roots = poles[origin] + tau
        exact = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
        assert np.allclose(roots, exact, rtol=1e-9, atol=1e-12 * exact.max())
        assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()


def test_equal_values_are_deflated():
    values, vectors = updated(np.zeros(4), np.eye(4), np.array([3.0, 0.0, 4.0, 0.0]), 2.0)
    assert np.allclose(values, [0, 0, 0, 50]) and np.allclose(np.abs(vectors[:, 3]), [0.6, 0, 0.8, 0])


def _expected(x, components=32):
    n, s = len(x), x.sum(axis=0)
    far = n * x - s
    centred = far / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = [k for k in np.argsort(-values) if values[k] > 1e-12 * values.sum()][:components]
    return (far * far).sum(axis=1), centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def _check(found, ids, x, components=32):
    """`found` has rows of (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    deviation, white, explained = _expected(x, components)
    k = white.shape[1]
    assert len(found) == len(x) * k
    got = np.empty_like(white)
    place = {i: at for at, i in enumerate(ids)}
    for r in found:
        at = place[r["vec_id"]]
        got[at, r["component"] - 1] = r["whitened"]
        assert r["n"] == len(x) and r["deviation"] == deviation[at]
        assert abs(r["explained"] - explained[r["component"] - 1]) <= 1e-10 * explained[r["component"] - 1]
        assert r["identity_error"] < 1e-8
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * sign).max() < 1e-7
    assert np.abs(got.T @ got / len(x) - np.eye(k)).max() < 1e-8


def test_the_query_equals_a_plain_eigendecomposition(llm):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op12_whitening(llm, sf_dir).collect()
    given = llm.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = np.floor(np.array([r["embedding"] for r in given], float) * 64).astype(np.int64) + 1_000_000
    _check(found, [r["vec_id"] for r in given], x)


def test_hot_vectors_bad_rows_and_other_columns(llm):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 6)) * np.arange(1, 7)
    x[80:160] = x[0]
    rows = [(i, [float(c) for c in v], i, "s") for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None, 1, "x"), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0], 1, "x"), (902, [nan] * 6, 1, "x"), (903, [inf] * 6, 1, "x")]
    table = llm.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component int, whitened string")
    found = whiten(table.repartition(5), 4).collect()
    _check(found, list(range(240)), np.floor(x * 64).astype(np.int64) + 1_000_000, 4)


def test_lengths_few_rows_and_empty_tables(llm):
    schema = "vec_id long, embedding array<float>"
    assert whiten(llm.createDataFrame([], schema)).collect() == []
    assert whiten(llm.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert whiten(llm.createDataFrame([(1, []), (2, [])], schema)).collect() == []
    two = [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0]), (4, [2.0]), (5, [4.0]), (None, [4.0])]
    found = whiten(llm.createDataFrame(two, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in found) == [(0, 1, 4), (1, 1, 2), (2, 1, 2), (3, 1, 4), (4, 1, 4), (5, 1, 4)]
    assert {abs(round(r["whitened"], 9)) for r in found if r["n"] == 2} == {1.0}

"""Whitening against numpy's eigenvalues and plain loops."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm.queries import QUERIES
from folioflow.llm.whitening import SCALE, SHIFT, fit_whitening, inertia, leading_eigenpairs, whiten
from tests.llm.conftest import SF


def plain(vectors, most=8):
    """x, n, sums, eigenvalues and vectors by the definition."""
    x = [[math.floor(SCALE * float(c)) + SHIFT for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[v - s / n for v, s in zip(r, sums)] for r in x])
    v = centred.T @ centred / n
    values, own = np.linalg.eigh(v)
    return x, n, sums, v, values[::-1][:most], own[:, ::-1][:, :most], centred


def test_whole_table_against_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = QUERIES["op13_whitening"](spark, SF).collect()
    x, n, sums, v, values, own, centred = plain([r["embedding"] for r in rows])
    assert len(got) == 8 * n
    by = {(r["vec_id"], r["component"]): r for r in got}
    signs = None
    for i, r in enumerate(rows):
        expected = centred[i] @ own / np.sqrt(values)
        mine = np.array([by[r["vec_id"], k + 1]["whitened"] for k in range(8)])
        if signs is None:
            signs = np.sign(mine * expected)
        assert np.allclose(mine, signs * expected, atol=1e-8)
        first = by[r["vec_id"], 1]
        assert first["n"] == n and first["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
        assert first["identity_error"] <= 1e-9
    for k in range(8):
        assert by[rows[0]["vec_id"], k + 1]["explained"] == pytest.approx(values[k] / np.trace(v), rel=1e-12)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 12))
def test_inertia_counts_positive_eigenvalues(seed, d):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((d, d))
    a = a + a.T
    if seed % 3 == 0:
        np.fill_diagonal(a, 0)  # pivots of two rows
    values = np.linalg.eigvalsh(a)
    if np.abs(values).min() > 1e-9:
        assert inertia(a) == int((values > 0).sum())


@pytest.mark.parametrize(
    "values",
    [
        [9, 5, 5, 5, 2, 1, 1, 1, 1, 1], [4, 4, 4, 4, 4, 4, 4, 4, 4], [1e6, 1e6 - 1e-3, 1e6 - 2e-3, 5, 4, 3, 2, 1, 0.5],
        [7, 3, 0, 0, 0, 0, 0, 0, 0, 0], [1e9, 1, 1e-3, 0.9e-3, 1e-4, 1e-5], [3.0],
    ],
)
def test_slices_of_close_and_equal_eigenvalues(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))[0]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    found, vectors = leading_eigenpairs(v)
    real = [x for x in np.linalg.eigvalsh(v)[::-1] if x > 1e-9][:8]
    assert np.allclose(found, real[: len(found)], rtol=1e-10, atol=1e-9 * max(values)) and len(found) >= len([x for x in real if x > 1e-12 * max(values)])
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-10)
    assert np.allclose(v @ vectors, vectors * found, atol=1e-9 * max(values))


def frame(spark, rows):
    schema = "n string, VEC_ID string, vec_id long, embedding array<float>, component string, label int"
    return spark.createDataFrame([("x", "y", i, e, "z", 1) for i, e in rows], schema)


def test_dropped_rows_ties_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(0)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(20)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [inf, 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (None, None)]
    repeated = [(None, good[0][1]), good[1], good[1]]
    rows = good + bad + repeated
    got = whiten(frame(spark, rows).repartition(3)).collect()
    kept = good + repeated
    x, n, sums, v, values, own, centred = plain(np.float32([e for _, e in kept]))
    assert n == 23 and {r["n"] for r in got} == {23} and len(got) == 23 * 3
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == sorted((i is None, i or 0, k) for i, _ in kept for k in (1, 2, 3))
    assert max(r["identity_error"] for r in got) < 1e-9


def test_few_rows_and_empty_tables(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).collect() == []  # no variance
    got = whiten(frame(spark, [(1, [1.0, 2.0, 5.0]), (2, [3.0, 2.0, 5.0])])).collect()  # one component
    assert sorted((r["vec_id"], r["component"], abs(round(r["whitened"], 9)), r["explained"]) for r in got) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_moments_are_exact_for_large_entries_and_any_split(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((50, 4)) * [1, 1e3, 1e6, 1e9]).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    fits = [fit_whitening(df.repartition(p)) for p in (1, 7)]
    assert (fits[0].sums == fits[1].sums).all() and (fits[0].values == fits[1].values).all() and (fits[0].vectors == fits[1].vectors).all()
    values = plain(vectors)[4]
    assert np.allclose(fits[0].values, values[: len(fits[0].values)], rtol=1e-9, atol=1e-14 * values[0])  # eigenvalues are exact to the norm

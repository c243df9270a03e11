"""Embedding whitening by spectrum slicing.

1. *Moments.*  Entries become integers; each task adds up its rows' sums, and
   in a second pass the products of the rows centred on the integer part of
   the mean.  Both are exact integers (BLAS only where every partial sum stays
   under 2 ** 53), added up in Spark per cell, so the moments do not depend on
   the order of rows or on repeated tasks.  The fraction of the mean left out
   is under one and is taken off the covariance afterwards.
2. *Slicing.*  The number of positive pivots of an LDL^T factorisation
   (symmetric, Bunch-Kaufman pivots) of ``V - s I`` is the number of
   eigenvalues above ``s``.  Bisection on it isolates each leading eigenvalue,
   Rayleigh quotient iteration from the middle of its slice converges
   cubically, and counts on both sides of the result certify its number.  Equal
   eigenvalues share a slice; their vectors are kept orthogonal.
3. *Projection.*  Rows are projected by tasks that hold only the mean and the
   leading eigenvectors.  The covariance of the whitened rows is measured in a
   pass of its own, not derived from ``V``.

The driver holds one d x d matrix (d entries of a vector, not rows).

Defined results: a row whose vector is NULL or holds NULL or non-finite
entries is dropped, and so is one whose length is not the most frequent one
(the larger of equally frequent ones; length 0 never).  An entry beyond
2 ** 52 counts as that bound.  Components whose eigenvalue is zero up to
rounding (fewer rows than components, constant entries) cannot be whitened and
are left out; a table without usable rows gives an empty result.  Repeated
rows and NULL ``vec_id`` count and come out one by one.  A ``deviation``
beyond 63 bits is NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import pick, slices

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LIMIT = 2.0**52  # entries are held within it
EXACT = 2**53  # doubles are exact integers below
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """Mean and leading eigenpairs of a fit list."""

    n: int
    sums: np.ndarray  # exact, object dtype
    mean: np.ndarray
    vectors: np.ndarray  # one column for each component
    values: np.ndarray
    trace: float


# -- rows --------------------------------------------------------------------


def _lengths(column: pa.Array) -> np.ndarray:
    """Entries of each vector; -1 for one that is dropped."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(valid, np.diff(column.offsets.to_numpy()), 0)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL entries are NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    offsets = column.offsets.to_numpy()
    whole = bad[offsets[1:]] == bad[offsets[:-1]]
    return np.where(valid & whole & (sizes > 0), sizes, -1)


def _integers(batch: pa.RecordBatch, d: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of a batch (vec_id, embedding) with ``d`` usable entries, and their integers."""
    kept = batch.filter(pa.array(_lengths(batch.column(1)) == d))
    flat = kept.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT)
    return kept, scaled.astype(np.int64).reshape(-1, d) + SHIFT


def _exact_products(z: np.ndarray) -> np.ndarray:
    """``z.T @ z`` of integers, exact, as Python integers."""
    d = z.shape[1]
    total = np.zeros((d, d), dtype=object)
    most = int(np.abs(z).max(initial=0))
    if most == 0:
        return total
    if most * most >= EXACT:  # far beyond any usual entry
        big = z.astype(object)
        return big.T @ big
    step = max(1, EXACT // (most * most) - 1)
    for lo in range(0, len(z), step):
        part = z[lo : lo + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


# -- moments ------------------------------------------------------------------


def _dimension(rows: DataFrame) -> int:
    """The most frequent length of a usable vector (0: there is none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            for d, n in zip(*np.unique(_lengths(batch.column(0)), return_counts=True)):
                if d > 0:
                    counts[int(d)] = counts.get(int(d), 0) + int(n)
        yield pa.RecordBatch.from_pydict({"d": pa.array(list(counts), pa.int32()), "n": pa.array(list(counts.values()), pa.int64())})

    sizes = rows.select("embedding").mapInArrow(run, "d int, n long").groupBy("d").agg(F.sum("n").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return 0 if top is None else top["d"]


def _added_up(rows: DataFrame, width: int, partial, size: int) -> tuple[int, np.ndarray]:
    """Rows counted, and ``size`` exact sums of what ``partial`` makes of each task's rows (Python integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, dtype=object)
        for batch in batches:
            x = _integers(batch, width)[1]
            if len(x):
                n += len(x)
                total += partial(x)
        cells = [*range(size), size]
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int32()), "v": pa.array([str(v) for v in [*total, n]])})

    parts = rows.mapInArrow(run, "cell int, v string").select("cell", F.col("v").cast("decimal(38,0)").alias("v"))
    cells = {r["cell"]: int(r["v"]) for r in parts.groupBy("cell").agg(F.sum("v").alias("v")).collect()}
    return cells.get(size, 0), np.array([cells.get(i, 0) for i in range(size)], dtype=object)


def covariance(sums: np.ndarray, products: np.ndarray, n: int, base: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) from exact sums of ``x`` and of the products of ``x - base``; one rounding for each cell."""
    left = sums - n * base  # n times the part of the mean that base leaves out
    exact = [Fraction(int(n * p - a * b), n * n) for (a, b), p in zip(((a, b) for a in left for b in left), products.ravel())]
    return np.array([float(v) for v in exact]).reshape(products.shape)


# -- spectrum slicing ------------------------------------------------------------


def inertia(m: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix: positive pivots of its LDL^T factorisation (Bunch-Kaufman)."""
    a = np.array(m, dtype=float)
    n, k, positive = len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8
    while k < n:
        below = np.abs(a[k + 1 :, k])
        diagonal = abs(a[k, k])
        two = False
        if below.size and below.max() > 0:
            r = k + 1 + int(below.argmax())
            most = below[r - k - 1]
            if diagonal < alpha * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if diagonal * other < alpha * most * most:
                    if abs(a[r, r]) >= alpha * other:
                        a[[k, r]] = a[[r, k]]
                        a[:, [k, r]] = a[:, [r, k]]
                    else:
                        two = True
                        a[[k + 1, r]] = a[[r, k + 1]]
                        a[:, [k + 1, r]] = a[:, [r, k + 1]]
        if two:  # a pivot of two rows holds one eigenvalue of either sign
            block = a[k : k + 2, k : k + 2]
            positive += 1
            w = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= w @ np.linalg.solve(block, w.T)
            k += 2
        else:
            if a[k, k] > 0:
                positive += 1
            if a[k, k] != 0:
                w = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(w, w / a[k, k])
            k += 1
    return positive


def _solve(v: np.ndarray, shift: float, y: np.ndarray, size: float) -> np.ndarray:
    eye = np.eye(len(v))
    for nudge in (0.0, EPS, 8 * EPS, 64 * EPS):  # an exact eigenvalue makes the matrix singular
        try:
            found = np.linalg.solve(v - (shift + nudge * size) * eye, y)
        except np.linalg.LinAlgError:
            continue
        norm = np.linalg.norm(found)
        if np.isfinite(norm) and norm > 0:
            return found / norm
    return y


def leading_eigenpairs(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a covariance above rounding, falling, and their unit vectors as columns.

    Raises ArithmeticError if the counts do not certify the numbering.
    """
    d = len(v)
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    top, size = float((np.diag(v) + radius).max()), float(np.abs(v).sum(axis=1).max())
    if size == 0:
        return np.zeros(0), np.zeros((d, 0))
    eye, known = np.eye(d), {}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = inertia(v - shift * eye)
        return known[shift]

    width = 16 * EPS * size  # slices are not cut finer
    floor = d * width  # below, an eigenvalue is rounding
    rng = np.random.default_rng(0)
    values: list[float] = []
    vectors = np.zeros((d, 0))
    for k in range(1, min(most, above(floor)) + 1):
        # at least k eigenvalues above lo, fewer than k above hi
        lo = max((s for s, c in known.items() if c >= k), default=floor)
        hi = min((s for s, c in known.items() if c < k and s > lo), default=top + width)
        while hi - lo > width:
            alone = above(lo) == k and above(hi) == k - 1
            if alone:
                found = _rayleigh(v, (lo + hi) / 2, vectors, rng, size)
                if found is not None and lo - width <= found[0] <= hi + width:
                    break
            mid = (lo + hi) / 2
            if above(mid) >= k:
                lo = mid
            else:
                hi = mid
        else:  # equal up to rounding: any vector of the slice that is orthogonal to those before
            found = _rayleigh(v, (lo + hi) / 2, vectors, rng, size)
        if found is None:
            raise ArithmeticError(f"no eigenvector in slice {k}")
        value, vector = found
        slack = d * width
        if not above(value + slack) < k <= above(value - slack):
            raise ArithmeticError(f"counts around {value} do not certify eigenvalue {k}")
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    order = np.argsort(-np.array(values), kind="stable")  # equal ones may differ in the last bit
    return np.array(values)[order], vectors[:, order]


def _rayleigh(v: np.ndarray, shift: float, before: np.ndarray, rng: np.random.Generator, size: float) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration, orthogonal to the vectors ``before``, after two steps at a fixed shift; None: not converged."""
    y = rng.standard_normal(len(v))

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - before @ (before.T @ x)
            x = x / np.linalg.norm(x)
        return x

    y = apart(y)
    for _ in range(2):
        y = apart(_solve(v, shift, y, size))
    value = float(y @ v @ y)
    for _ in range(12):
        if np.linalg.norm(v @ y - value * y) <= 4 * EPS * size:
            break
        y = apart(_solve(v, value, y, size))
        value = float(y @ v @ y)
    if np.linalg.norm(v @ y - value * y) > 64 * EPS * size * np.sqrt(len(v)):
        return None
    return value, y * (1.0 if y[int(np.abs(y).argmax())] > 0 else -1.0)


# -- the operator ------------------------------------------------------------------


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit over every usable row of ``rows`` (``vec_id``, ``embedding``); None: there is none."""
    rows = pick(rows, vec_id="long", embedding="array<double>")
    d = _dimension(rows)
    if d == 0:
        return None
    n, sums = _added_up(rows, d, lambda x: x.astype(object).sum(axis=0) if np.abs(x).max() > 2**31 else x.sum(axis=0).astype(object), d)
    base = np.array([int(s) // n for s in sums], dtype=object)
    held = base.astype(np.int64)
    upper = np.triu_indices(d)
    cells = _added_up(rows, d, lambda x: _exact_products(x - held)[upper], len(upper[0]))[1]
    products = np.zeros((d, d), dtype=object)
    products[upper] = cells
    products.T[upper] = cells
    v = covariance(sums, products, n, base)
    values, vectors = leading_eigenpairs(v, components)
    mean = np.array([float(Fraction(int(s), n)) for s in sums])
    return Whitening(n, sums, mean, vectors, values, float(np.trace(v)))


def _whitened(x: np.ndarray, fit: Whitening) -> np.ndarray:
    base = np.array([int(s) // fit.n for s in fit.sums], dtype=np.int64)
    rest = np.array([float(Fraction(int(s) - int(b) * fit.n, fit.n)) for s, b in zip(fit.sums, base)])
    return ((x - base).astype(np.float64) - rest) @ (fit.vectors / np.sqrt(fit.values))


def _deviations(x: np.ndarray, fit: Whitening) -> list[int | None]:
    most = max(abs(fit.n * int(v) - int(s)) for s, lo, hi in zip(fit.sums, x.min(axis=0), x.max(axis=0)) for v in (lo, hi))
    if most * most * x.shape[1] < 2**63 and max(map(abs, fit.sums)) < 2**63:
        return (((fit.n * x - fit.sums.astype(np.int64)) ** 2).sum(axis=1)).tolist()
    exact = ((fit.n * x.astype(object) - fit.sums) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    d, k = len(fit.mean), len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _whitened(_integers(batch, d)[1], fit)
            sums, products = sums + w.sum(axis=0), products + w.T @ w
        flat = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(flat), dtype=np.int32)), "v": pa.array(flat)})

    rows = pick(rows, vec_id="long", embedding="array<double>")
    cells = {r["cell"]: r["v"] for r in rows.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([cells[i] for i in range(k + k * k)]) / fit.n
    return float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: ``whitened`` with the figures of the fit."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = fit_whitening(rows, components)
    if fit is None or not len(fit.values):
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, fit)
    d, k, n = len(fit.mean), len(fit.values), fit.n
    explained = fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, x = _integers(batch, d)
            if not len(x):
                continue
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": kept.column(0).take(each),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(x) * k, n)),
                    "deviation": pa.array(_deviations(x, fit), pa.int64()).take(each),
                    "whitened": pa.array(_whitened(x, fit).ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(len(x) * k, error)),
                }
            )

    return pick(rows, vec_id="long", embedding="array<double>").mapInArrow(run, schema)

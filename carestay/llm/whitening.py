"""Embedding whitening: leading principal components of integer-scaled vectors, scaled to unit variance.

Entries become integers ``floor(scale * c)``. The fit list, each distinct vector once, is dealt by the vector itself
and stored. One pass sums it, a second adds up the centred products: vectors are centred by the whole
number nearest to the mean before multiplying, products and sums are exact, and the remainder of the
mean (half a unit at most) is taken off as an exact fraction, so the covariance does not depend on
how rows are dealt out or on a retried task. The driver holds dims x dims numbers and solves them:
Householder tridiagonalisation, bisection on Sturm counts for the leading eigenvalues, inverse
iteration with reorthogonalisation of clusters for their vectors. The projection is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import map_arrow, stored

_WIDTHS = ((np.int8, b"1"), (np.int16, b"2"), (np.int32, b"4"), (np.int64, b"8"))


# --- symmetric eigenproblem -----------------------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, e, q): diagonal and off-diagonal of ``q.T @ a @ q``, by Householder reflections; ``q`` is orthogonal."""
    a = a.copy()
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        part = a[k + 1:, k:]
        part -= 2 * np.outer(v, v @ part)
        part = a[k:, k + 1:]
        part -= 2 * np.outer(part @ v, v)
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_count(d: np.ndarray, e: np.ndarray, x: float) -> int:
    """How many eigenvalues of the tridiagonal matrix lie below ``x``."""
    tiny = np.finfo(float).tiny * 4
    count, pivot = 0, 1.0
    for i in range(len(d)):
        pivot = d[i] - x - (e[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, count: int) -> list[float]:
    """The ``count`` largest eigenvalues, falling, each bisected until its bracket holds no double between its ends."""
    n = len(d)
    reach = np.abs(np.concatenate(([0.0], e))) + np.abs(np.concatenate((e, [0.0])))
    low0, high0 = float((d - reach).min()), float((d + reach).max())
    pad = max(abs(low0), abs(high0), 1.0) * 1e-15
    out = []
    for i in range(min(count, n)):
        low, high = low0 - pad, high0 + pad
        for _ in range(2000):
            mid = low + (high - low) / 2
            if mid <= low or mid >= high:
                break
            if sturm_count(d, e, mid) <= n - 1 - i:
                low = mid
            else:
                high = mid
        out.append(low + (high - low) / 2)
    return out


def _solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """Solve (T - shift) x = b for tridiagonal T by elimination with partial pivoting."""
    n = len(d)
    main, up, up2, x = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        below = e[i]
        if abs(below) > abs(main[i]):
            factor = main[i] / below
            main[i], main[i + 1], up[i], up[i + 1], up2[i] = below, up[i] - factor * main[i + 1], main[i + 1], -factor * up[i + 1], up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if main[i] == 0.0:
                main[i] = tiny
            factor = below / main[i]
            main[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        if abs(main[i]) < tiny:
            main[i] = np.copysign(tiny, main[i])
        s = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = s / main[i]
    return x


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for falling ``values``.

    Vectors of values closer than a thousandth of the norm form a cluster and are made orthogonal to one another at each step.
    """
    n = len(d)
    norm = max(float(np.abs(d).max(initial=0.0) + 2 * np.abs(e).max(initial=0.0)), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    out = np.zeros((n, len(values)))
    cluster = 0
    shift = np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            cluster = j
        # equal values get shifts a few units apart, else each would give the same vector
        shift = min(value, shift - 4 * eps * norm)
        x = np.random.default_rng(j + 1).standard_normal(n)
        for _ in range(6):
            for other in range(cluster, j):
                x -= (out[:, other] @ x) * out[:, other]
            x = _solve_shifted(d, e, shift, x / np.linalg.norm(x), eps * norm)
            x /= np.abs(x).max()
        for _ in range(2):
            for other in range(cluster, j):
                x -= (out[:, other] @ x) * out[:, other]
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_eigenpairs(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the ``count`` largest eigenvalues of a symmetric matrix, values falling.

    The sign of a vector makes its entry of greatest magnitude positive.
    """
    scale = float(np.abs(a).max(initial=0.0)) or 1.0
    d, e, q = tridiagonal(a / scale)
    values = leading_eigenvalues(d, e, count)
    vectors = q @ inverse_iteration(d, e, values)
    # Rayleigh quotients on the given matrix take off the rounding of the tridiagonal form
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    vectors, values = vectors[:, order], values[order]
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)


# --- distributed part -----------------------------------------------------------------------------

def scaled_rows(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the rows kept, their integers): rows of ``dims`` finite, non-null entries."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(sizes, 0))
    at = np.flatnonzero(sizes == dims)
    x = values[(ends[at] - dims)[:, None] + np.arange(dims)] if len(at) else np.empty((0, dims))
    fine = np.isfinite(x).all(axis=1)
    at, x = at[fine], np.floor(x[fine] * float(scale))
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        raise OverflowError("an entry times the scale does not fit in a long")
    return at, x.astype(np.int64)


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row in the least width that holds it; equal rows have equal bytes."""
    top = np.abs(x).max(axis=1, initial=0)
    out: list[bytes] = [b""] * len(x)
    below = np.zeros(len(x), bool)
    for kind, mark in _WIDTHS:
        fits = (top <= np.iinfo(kind).max) & ~below
        below |= fits
        raw = np.ascontiguousarray(x[fits].astype(kind))
        for i, row in zip(np.flatnonzero(fits).tolist(), raw):
            out[i] = mark + row.tobytes()
    return out


def _unpack(column: pa.Array, dims: int) -> np.ndarray:
    kinds = {mark[0]: kind for kind, mark in _WIDTHS}
    rows = [np.frombuffer(b, kinds[b[0]], offset=1) for b in column.to_pylist()]
    return np.stack(rows).astype(np.int64) if rows else np.empty((0, dims), np.int64)


def dimension(vectors: DataFrame) -> int:
    """The length of most vectors that are whole and finite (ties: the greater length); 0 if there is none."""
    fine = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    sizes = vectors.where(F.col("embedding").isNotNull() & fine).groupBy(F.size("embedding").alias("dims")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("dims")).first()
    return top["dims"] if top else 0


def fit_list(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(x): each distinct integer vector once, packed. Repeats go before the shuffle, as in any ``distinct``."""

    def run(batch: pa.RecordBatch):
        return [pa.array(_pack(scaled_rows(batch.column(0), dims, scale)[1]), pa.binary())]

    return map_arrow(vectors.select("embedding"), run, "x binary").distinct()


def _exact_products(y: np.ndarray) -> list[list[int]]:
    """``y.T @ y`` in exact integers: by doubles where no partial sum can leave 53 bits, else in Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return [[int(v) for v in row] for row in f.T @ f]
    o = y.astype(object)
    return [[int(v) for v in row] for row in o.T @ o]


def _pieces(rows: Iterator[pa.RecordBatch], dims: int, at_once: int = 4096):
    for batch in rows:
        for at in range(0, batch.num_rows, at_once):
            x = _unpack(batch.column(0).slice(at, at_once), dims)
            if len(x):
                yield x


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def sums(fitted: DataFrame, dims: int) -> tuple[int, list[int]]:
    """(n, per-dimension sums) of the fit list; a task gives one row a dimension."""

    def run(rows):
        n, total = 0, [0] * dims
        for x in _pieces(rows, dims):
            n += len(x)
            total = [t + int(v) for t, v in zip(total, x.astype(object).sum(axis=0) if np.abs(x).max() >> 40 else x.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), _decimals(total)],
                                         names=["i", "n", "s"])

    got = fitted.mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    total = [0] * dims
    for r in got:
        total[r["i"]] = int(r["s"])
    return (got[0]["n"] if got else 0), total


def covariance(fitted: DataFrame, dims: int, n: int, s: list[int]) -> np.ndarray:
    """The covariance (divisor n) of the fit list: exact sums of centred products, one rounding at the end."""
    centre = [(2 * v + n) // (2 * n) for v in s]  # the whole number nearest to the mean

    def run(rows):
        total = [[0] * dims for _ in range(dims)]
        c = np.array(centre, np.int64)
        for x in _pieces(rows, dims):
            part = _exact_products(x - c)
            total = [[a + b for a, b in zip(r, p)] for r, p in zip(total, part)]
        cells = [(i, j) for i in range(dims) for j in range(i + 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in cells], pa.int32()), pa.array([j for _, j in cells], pa.int32()),
             _decimals([total[i][j] for i, j in cells])], names=["i", "j", "p"])

    out = np.zeros((dims, dims))
    left = [Fraction(v, n) - c for v, c in zip(s, centre)]
    for r in fitted.mapInArrow(run, "i int, j int, p decimal(38,0)").groupBy("i", "j").agg(F.sum("p").alias("p")).collect():
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = float(Fraction(int(r["p"]), n) - left[i] * left[j])
    return out


class Whitening:
    """n, sums, trace, eigenvalues (falling) and the dims x components projection of a fit."""

    def __init__(self, dims: int, scale: int, n: int, s: list[int], cov: np.ndarray, components: int):
        self.dims, self.scale, self.n, self.s = dims, scale, n, s
        self.trace = float(np.trace(cov)) if dims else 0.0
        values, vectors = leading_eigenpairs(cov, min(components, dims)) if dims else (np.zeros(0), np.zeros((0, 0)))
        # a direction without variance cannot be scaled to unit variance
        real = values > max(self.trace, 0.0) * 1e-12
        self.values, self.vectors = values[real], vectors[:, real]
        self.mean = np.array([float(Fraction(v, n)) for v in s]) if n else np.zeros(dims)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of each row of integers."""
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - s)^2, exact."""
        top = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.s), default=0)
        kind = np.int64 if top * top * self.dims < 1 << 63 else object
        diff = x.astype(kind) * self.n - np.array(self.s, kind)
        return [int(v) for v in (diff * diff).sum(axis=1)]


def fit(vectors: DataFrame, components: int = 4, scale: int = 256) -> tuple[Whitening, DataFrame]:
    """(whitening, stored fit list). Vectors of another length than most are left out."""
    dims = dimension(vectors)
    fitted = stored(fit_list(vectors, dims, scale), "fit")
    n, s = sums(fitted, dims) if dims else (0, [])
    cov = covariance(fitted, dims, n, s) if n else np.zeros((dims, dims))
    return Whitening(dims, scale, n, s, cov, components), fitted


def identity_error(fitted: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance (divisor n, centred first) minus the identity."""
    k = len(w.values)

    def means(rows):
        total = np.zeros(k)
        for x in _pieces(rows, w.dims):
            total += w.project(x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], names=["i", "s"])

    centre = np.zeros(k)
    for r in fitted.mapInArrow(means, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        centre[r["i"]] = r["s"] / w.n

    def products(rows):
        total = np.zeros((k, k))
        for x in _pieces(rows, w.dims):
            z = w.project(x) - centre
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k, dtype=np.int32), k)),
                                          pa.array(np.tile(np.arange(k, dtype=np.int32), k)), pa.array(total.ravel())], names=["i", "j", "p"])

    worst = 0.0
    for r in fitted.mapInArrow(products, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p")).collect():
        worst = max(worst, abs(r["p"] / w.n - (r["i"] == r["j"])))
    return worst


def whitened(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Null vectors and vectors that hold a null or non-finite entry have no row; nor have vectors of
    another length than most (all have one length in a sound table). Rows that repeat each have their
    rows but count once in the fit. Rows without vec_id keep the null. Directions without variance give no
    component, so one distinct vector, or an empty table, gives an empty result. ``deviation`` is a
    decimal, as it may outgrow a long. Other columns are ignored, whatever their names.
    """
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    w, fitted = fit(slim, components, scale)
    k = len(w.values)
    error = identity_error(fitted, w) if k else 0.0
    explained = [float(v) / w.trace for v in w.values]

    def run(rows):
        for batch in rows:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                kept, x = scaled_rows(piece.column(1), w.dims, w.scale)
                m = len(kept)
                if not m or not k:
                    continue
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(kept)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array([w.n] * (m * k), pa.int64()), _decimals(w.deviation(x)).take(each), pa.array(w.project(x).ravel()),
                     pa.array(np.tile(explained, m)), pa.array([error] * (m * k))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return slim.mapInArrow(run, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")

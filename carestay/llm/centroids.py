"""Centroid clustering (k-means in integers) with a Walsh-Hadamard progressive nearest-centroid search.

Vectors and centroids are integers. The Walsh-Hadamard transform ``H`` of 64 components is an exact
integer butterfly and ``|H(x - c)|^2 = 64 |x - c|^2``, so squared coefficient differences, taken in
sequency order from coarse to fine, add up to 64 times the squared distance, and every partial sum is a lower
bound of it. After a level the nearest-looking centroid is finished for an upper bound, and
centroids whose partial sum is strictly above the bound cannot be nearest: they are dropped. The
others are finished over all 64 coefficients, so distances and ties are exact.

A round is one pass over the vectors: a task adds up its vectors by centroid, Spark sums those few
rows, and only centroid sums (clusters x 64) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import stored

DIM = 64
#: Ends of the coefficient blocks of the search, coarse to fine.
LEVELS = (1, 2, 4, 8, 16, 32, 64)
#: Up to this magnitude 64 squared coefficient differences fit in 64 bits; beyond it Python integers are used.
FITS = 1 << 24


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row (64 integers) in sequency order, exact; dtype is kept."""
    out = x
    width = 1
    while width < DIM:
        pairs = out.reshape(len(x), DIM // (2 * width), 2, width)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack((a + b, a - b), axis=2).reshape(len(x), DIM)
        width *= 2
    return out[:, _SEQUENCY]


def _sequency_order() -> np.ndarray:
    """Natural-order row of each Walsh function by its number of sign changes: bit-reversed Gray code."""
    gray = [i ^ (i >> 1) for i in range(DIM)]
    return np.array([int(f"{g:06b}"[::-1], 2) for g in gray])


_SEQUENCY = _sequency_order()


def integers(batch_column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the rows kept, their integers floor(scale * x)): rows of exactly 64 finite, non-null entries."""
    flat = batch_column.flatten()
    sizes = batch_column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    ok = sizes == DIM
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls come as NaN
    ends = np.cumsum(np.maximum(sizes, 0))
    at = np.flatnonzero(ok)
    if not len(at):
        return at, np.empty((0, DIM), np.int64)
    x = values[(ends[at] - DIM)[:, None] + np.arange(DIM)]
    fine = np.isfinite(x).all(axis=1)
    at, x = at[fine], x[fine]
    with np.errstate(over="ignore"):
        scaled = np.floor(x * float(scale))
    if scaled.size and (np.abs(scaled) >= FITS).any():
        # exact for any finite value: a product of a double and an integer, in Python integers
        exact = [[_floor(v, scale) for v in row] for row in x.tolist()]
        return at, np.array(exact, dtype=object).reshape(len(exact), DIM)
    return at, scaled.astype(np.int64)


def _floor(v: float, scale: int) -> int:
    n, d = v.as_integer_ratio()
    return n * scale // d


def nearest(x: np.ndarray, centroids: np.ndarray, levels: tuple[int, ...] = LEVELS) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid of each row, squared distance, coefficient differences spent); ties go to the smaller number."""
    if x.dtype != centroids.dtype or len(centroids) and x.dtype != object and np.abs(centroids).max() >= FITS:
        x, centroids = x.astype(object), centroids.astype(object)
    wx, wc = hadamard(x), hadamard(centroids)
    n, k = len(x), len(centroids)
    rows = np.arange(n)
    partial = np.zeros((n, k), x.dtype)
    alive = np.ones((n, k), bool)
    best = None  # 64 times the least distance known of each row
    spent, start = 0, 0
    for end in levels:
        i, c = np.nonzero(alive)
        diff = wx[i, start:end] - wc[c, start:end]
        partial[i, c] += (diff * diff).sum(axis=1)
        spent += len(i) * (end - start)
        start = end
        if end == DIM:
            break
        if best is None:
            # the nearest-looking centroid of the coarsest block, finished: every other must beat it or tie with it
            first = partial.argmin(axis=1)
            rest = wx[:, end:] - wc[first, end:]
            best = partial[rows, first] + (rest * rest).sum(axis=1)
            spent += n * (DIM - end)
        alive &= ~(partial > best[:, None])
    least = np.where(alive, partial, partial.max() + 1 if partial.size else 0)
    chosen = least.argmin(axis=1)
    return chosen, least[rows, chosen] // DIM, spent


def _batches(rows: Iterator[pa.RecordBatch], scale: int, rows_at_once: int = 4096):
    """(batch, indices kept, integers) in pieces of bounded size."""
    for batch in rows:
        for at in range(0, batch.num_rows, rows_at_once):
            piece = batch.slice(at, rows_at_once)
            kept, x = integers(piece.column(piece.num_columns - 1), scale)
            if len(kept):
                yield piece, kept, x


def first_centroids(vectors: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The kept vectors with the least sha256 of ``seed:<vec_id>``, in that order.

    Ties (rows that repeat a vec_id) go by the vector, rows without vec_id come last. Each task keeps
    its least ``clusters`` rows, so no task or driver holds more.
    """
    keep = F.size("embedding") == DIM
    fine = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ranked = vectors.where(keep & fine).select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "embedding")
    top = ranked.orderBy(F.asc_nulls_last("h"), "embedding").limit(clusters).collect()
    return [[_floor(float(v), scale) for v in r["embedding"]] for r in top]


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    big = any(abs(v) >= FITS for c in centroids for v in c)
    return np.array(centroids, dtype=object if big else np.int64).reshape(len(centroids), DIM)


def next_centroids(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """One round: assign every vector, then the exact floored means; empty centroids stay."""
    now = _as_array(centroids)

    def sums(rows: Iterator[pa.RecordBatch]):
        count = [0] * len(now)
        total = [[0] * DIM for _ in now]
        for _, _, x in _batches(rows, scale):
            chosen, _, _ = nearest(x, now)
            for c in np.unique(chosen).tolist():
                mine = x[chosen == c]
                count[c] += len(mine)
                total[c] = [t + int(v) for t, v in zip(total[c], mine.sum(axis=0))]
        used = [c for c, n in enumerate(count) if n]
        cells = [(c, d, count[c], Decimal(total[c][d])) for c in used for d in range(DIM)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in cells], pa.int32()), pa.array([r[1] for r in cells], pa.int32()),
             pa.array([r[2] for r in cells], pa.int64()), pa.array([r[3] for r in cells], pa.decimal128(38, 0))],
            names=["cluster", "dim", "n", "total"])

    parts = vectors.select("embedding").mapInArrow(sums, "cluster int, dim int, n long, total decimal(38,0)")
    out = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return out


def fit(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024) -> list[list[int]]:
    """Final centroids (lists of 64 integers). ``vectors`` has ``vec_id`` and ``embedding`` and is read once a round.

    No kept vector gives no centroid; fewer kept vectors than ``clusters`` give as many centroids as vectors.
    """
    centroids = first_centroids(vectors, clusters, seed, scale)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(vectors, centroids, scale)
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]], scale: int = 1024) -> DataFrame:
    """(vec_id, cluster, distance) of each kept vector; distance is squared, a long (beyond a long: an error)."""
    now = _as_array(centroids)

    def run(rows: Iterator[pa.RecordBatch]):
        for piece, kept, x in _batches(rows, scale):
            chosen, distance, _ = nearest(x, now)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(kept)), pa.array(chosen.astype(np.int32)), pa.array([int(d) for d in distance], pa.int64())],
                names=["vec_id", "cluster", "distance"])

    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return slim.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Kept are vectors of exactly 64 components, none null or non-finite; null, shorter and longer
    vectors have no row. Rows that repeat (whole or by vec_id) and rows without vec_id each count and
    have a row of their own. An empty table gives an empty result. Columns other than ``vec_id``
    and ``embedding`` are ignored, whatever their names.
    """
    slim = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = fit(slim, clusters, rounds, seed, scale)
    if not centroids:
        return slim.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    placed = stored(assign(slim, centroids, scale), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in
            placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    about = slim.sparkSession.createDataFrame(
        [(c, sums[c], sum(sums.values()), digests[c]) for c in sorted(sums)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster: bounded by ``clusters``
    return placed.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

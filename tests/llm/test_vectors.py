"""Centroid clustering and whitening against brute force, SQL and numpy's eigensolver."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from carestay.llm import centroids, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, n string, x string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d", "e") for i, v in rows], SCHEMA)


def vectors(seed=3, n=60, dims=64, spread=1.0):
    rnd = random.Random(seed)
    rows = [(i, [round(rnd.gauss(0, spread), 3) for _ in range(dims)]) for i in range(n)]
    rows += [(n, None), (n + 1, [1.0] * (dims - 1)), (n + 2, [None] + [0.5] * (dims - 1)), (n + 3, [float("nan")] * dims),
             (n + 4, [float("inf")] + [0.0] * (dims - 1)), (n + 5, []), (None, rows[0][1]), (4, rows[-1][1]), (4, rows[0][1])]
    return rows


def kept(rows, dims=64):
    return [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def brute_clusters(rows, clusters=8, rounds=10):
    pts = [(i, [math.floor(1024 * x) for x in v]) for i, v in kept(rows)]
    raw = [v for _, v in kept(rows)]
    order = sorted(range(len(pts)), key=lambda j: (pts[j][0] is None, hashlib.sha256(f"3:{pts[j][0]}".encode()).hexdigest()
                                                   if pts[j][0] is not None else "", raw[j]))
    cs = [pts[j][1] for j in order[:clusters]]

    def place():
        out = []
        for _, x in pts:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cs]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = place()
        for c in range(len(cs)):
            mine = [x for (_, x), (k, _) in zip(pts, at) if k == c]
            if mine:
                cs[c] = [sum(col) // len(mine) for col in zip(*mine)]
    at = place()
    sums = [sum(d for k, d in at if k == c) for c in range(len(cs))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((str(i), k, d, sums[k], sum(sums), sha[k]) for (i, _), (k, d) in zip(pts, at)))


def got_clusters(df):
    return sorted((str(r["vec_id"]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("spread", [0.2, 2e4])  # coefficient sums of the second do not fit in 64 bits
def test_clusters_equal_brute_force(spark, spread):
    rows = vectors(spread=spread)
    assert got_clusters(centroids.clustered(frame(spark, rows), rounds=4)) == brute_clusters(rows, rounds=4)


def test_clusters_with_ties_few_and_no_vectors(spark):
    same = [(i, [float(i % 2)] * 64) for i in range(9)]  # two places for eight centroids: all but two stay empty
    assert got_clusters(centroids.clustered(frame(spark, same), rounds=2)) == brute_clusters(same, rounds=2)
    few = vectors(n=3)[:3]
    assert got_clusters(centroids.clustered(frame(spark, few), rounds=2)) == brute_clusters(few, rounds=2)
    for rows in ([], [(1, None)]):
        out = centroids.clustered(frame(spark, rows))
        assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_hadamard_is_exact_and_orthogonal():
    h = centroids.hadamard(np.eye(64, dtype=np.int64))
    assert (h @ h.T == 64 * np.eye(64)).all() and set(np.unique(h)) == {-1, 1}
    changes = (np.diff(h.T, axis=1) != 0).sum(axis=1)  # row j of the transposed transform is Walsh function j
    assert changes.tolist() == list(range(64))


def test_search_drops_centroids_yet_finds_the_nearest():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-500, 500, (500, 64)), rng.integers(-500, 500, (40, 64))
    x[:100] = c[rng.integers(0, 40, 100)]
    c[7] = c[3]  # a tie: the smaller number
    full = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    chosen, distance, spent = centroids.nearest(x, c)
    assert (chosen == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert spent < 500 * 40 * 64


def test_cluster_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(E.oracle_sql()["op11_centroids"])
    cols = [d[0] for d in want.description]
    df = E.queries()["op11_centroids"](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == sorted(want.fetchall())


def brute_whitening(rows, dims=64, scale=256, k=4):
    pts = [(i, [math.floor(scale * x) for x in v]) for i, v in kept(rows, dims)]
    fit = np.array(sorted({tuple(x) for _, x in pts}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    y = fit - s / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return pts, n, s, values[::-1][:k], vectors[:, ::-1][:, :k], values.sum()


def test_whitening_equals_numpy(spark):
    rows = vectors(n=150)
    for j in range(150):
        rows[j][1][5] *= 9
        rows[j][1][11] = rows[j][1][5] / 2 + rows[j][1][11] * 3
    pts, n, s, values, axes, trace = brute_whitening(rows)
    out = whitening.whitened(frame(spark, rows)).collect()
    assert len(out) == 4 * len(pts)
    by = {}
    for r in out:
        by.setdefault(str(r["vec_id"]), []).append(r)
    for i, x in pts:
        for c in range(4):
            z = abs((np.array(x) - s / n) @ axes[:, c] / np.sqrt(values[c]))
            dev = sum((n * a - int(b)) ** 2 for a, b in zip(x, s))
            assert any(r["component"] == c + 1 and r["n"] == n and int(r["deviation"]) == dev and abs(abs(r["whitened"]) - z) < 1e-8
                       and abs(r["explained"] - values[c] / trace) < 1e-10 for r in by[str(i)])
    assert {r["identity_error"] for r in out} == {out[0]["identity_error"]} and out[0]["identity_error"] < 1e-9


def test_whitening_of_few_or_no_directions(spark):
    cols = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [])]):
        out = whitening.whitened(frame(spark, rows))
        assert out.columns == cols and out.count() == 0
    line = whitening.whitened(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    # equal eigenvalues: any orthonormal axes whiten
    cube = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2 & 1)]) for i in range(8)]
    got = whitening.whitened(frame(spark, cube * 2)).collect()
    assert len(got) == 48 and {r["n"] for r in got} == {8} and got[0]["identity_error"] < 1e-9
    odd = whitening.whitened(frame(spark, [*cube, (99, [1.0, 2.0])])).collect()
    assert len(odd) == 24


@pytest.mark.parametrize("kind", ["random", "diagonal", "twins", "low rank", "huge"])
def test_eigenpairs_equal_numpy(kind):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((20, 20))
    a = a @ a.T
    if kind == "diagonal":
        a = np.diag(np.arange(20.0))
    elif kind == "twins":
        q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
        a = q @ np.diag([9, 9, 9 - 1e-13, 4, 4] + [1.0] * 15) @ q.T
        a = (a + a.T) / 2
    elif kind == "low rank":
        b = rng.standard_normal((20, 2))
        a = b @ b.T
    elif kind == "huge":
        a = a * 1e30
    values, vectors = whitening.leading_eigenpairs(a, 5)
    want = np.linalg.eigvalsh(a)[::-1][:5]
    size = want[0]
    assert np.allclose(values, want, atol=1e-12 * size)
    assert np.abs(vectors.T @ vectors - np.eye(5)).max() < 1e-10
    assert np.abs(a @ vectors - vectors * values).max() < 1e-10 * size
    d, e, q = whitening.tridiagonal(a / size)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.abs(q @ t @ q.T - a / size).max() < 1e-12
    assert whitening.sturm_count(d, e, 0.5) == (np.linalg.eigvalsh(t) < 0.5).sum()


def test_exact_products_beyond_doubles():
    y = np.array([[1 << 40, 3], [-(1 << 40) + 1, 5]])
    want = [[(1 << 80) + ((1 << 40) - 1) ** 2, 3 * (1 << 40) - 5 * ((1 << 40) - 1)], [3 * (1 << 40) - 5 * ((1 << 40) - 1), 34]]
    assert whitening._exact_products(y) == want


def test_packed_vectors_come_back():
    x = np.array([[1, -2], [300, 4], [1 << 20, 0], [-(1 << 40), 7], [0, 0], [-128, 127]])
    assert (whitening._unpack(pa.array(whitening._pack(x), pa.binary()), 2) == x).all()

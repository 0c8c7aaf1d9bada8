"""Exact neighbours: brute force on uniform and clumped vectors, and how many pairs are looked at."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabiya.operators import metric as M


def brute(x, k):
    n = np.linalg.norm(x, axis=1)
    u = np.divide(x, n[:, None], out=np.zeros_like(x), where=n[:, None] > 0)
    out = []
    for i in range(0, len(x), 500):
        d = np.round(1 - u[i:i + 500] @ u.T, 9)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        near = np.argpartition(d, k + 12, axis=1)[:, :k + 12] if len(x) > k + 13 else np.tile(np.arange(len(x)), (len(d), 1))
        for r, c in zip(d, near):
            # ties beyond the candidates: all rows as near as the k-th
            bound = np.sort(r[c])[k - 1]
            c = np.flatnonzero(r <= bound)
            out.append([int(j) for j in c[np.lexsort((c, r[c]))][:k]])
    return out


def vectors(spark, x):
    return spark.createDataFrame(pa.table({"player": np.arange(len(x)), "vec": pa.array(x.tolist(), pa.list_(pa.float64()))}))


def some(kind, n, seed=0):
    rng = np.random.default_rng(seed)
    if kind == "uniform":
        return rng.normal(0, 1, (n, 7))
    # three quarters in a few clumps, a tenth of all equal
    centre = rng.normal(0, 1, (6, 7))
    x = rng.normal(0, 1, (n, 7))
    clumped = rng.random(n) < 0.75
    x[clumped] = centre[rng.integers(0, 6, clumped.sum())] + rng.normal(0, 0.02, (clumped.sum(), 7))
    x[rng.random(n) < 0.1] = centre[0]
    return x


@pytest.mark.parametrize("kind", ["uniform", "clumped"])
def test_neighbours_are_exact_and_pairs_grow_slower_than_rows(spark, kind):
    looked = {}
    for n in (1500, 6000, 24000):
        x = some(kind, n)
        v = vectors(spark, x)
        if n < 24000:
            got = {}
            for r in M.knn_neighbours(v, 5).orderBy("player", "rank").collect():
                got.setdefault(r.player, []).append(r.neighbour)
            want = brute(x, 5)
            wrong = [i for i in range(n) if got[i] != want[i]]
            # a distance within an ulp of a rounding border may fall on either side of it
            assert len(wrong) <= n // 1000, wrong[:5]
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        u = np.unique(u, axis=0)
        points = spark.createDataFrame(pa.table({"pid": np.arange(len(u)), "ids": pa.array([[i] for i in range(len(u))]), **{f"u{i}": u[:, i] for i in range(7)}}))
        pts, tree, cells = M.partition(points, 7, 5)
        looked[n] = M.near_leaves(pts, tree, cells, 7, 5).agg(F.sum("size")).first()[0] / len(u)
    assert looked[24000] < 0.5 * 16 * looked[1500] and looked[24000] < 24000 / 4, looked


def test_few_rows_zero_vectors_and_repeats(spark):
    x = np.array([[0.0] * 7, [1, 0, 0, 0, 0, 0, 0], [2, 0, 0, 0, 0, 0, 0], [0.0] * 7, [0, 1, 0, 0, 0, 0, 0], [-1, 0, 0, 0, 0, 0, 0]], float)
    got = {}
    for r in M.knn_neighbours(vectors(spark, x), 3).orderBy("player", "rank").collect():
        got.setdefault(r.player, []).append((r.neighbour, r.distance))
    assert got[0] == [(1, 1.0), (2, 1.0), (3, 1.0)] and got[3] == [(0, 1.0), (1, 1.0), (2, 1.0)]
    assert got[1] == [(2, 0.0), (0, 1.0), (3, 1.0)] and got[5] == [(0, 1.0), (3, 1.0), (4, 1.0)]
    assert M.knn_neighbours(vectors(spark, x[:1]), 3).count() == 0
    assert M.knn_neighbours(vectors(spark, x).limit(0), 3).count() == 0

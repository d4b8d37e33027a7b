"""Clustering against plain rounds over all centroids; bounds that certify, and bounds that never decide a tie."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from trackloom.llm import clustering as cl

SCHEMA = "vec_id long, embedding array<float>, cluster int"


def plain(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(1024 * x) < cl.LARGEST for x in v)]
    starts = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in starts[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), c in zip(kept, own, strict=True) if c == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    last = [nearest(v) for _, v in kept]
    by = {n: sum(d for d, c in last if c == n) for n in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, by[c], sum(by.values()), sha[c]) for (i, _), (d, c) in zip(kept, last, strict=True)), key=str)


def got(df, **params):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r[c] for c in columns) for r in cl.cluster_vectors(df, **params).collect()), key=str)


def test_against_loops(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(260, 64)).astype(np.float32)
    x[60:150] = x[60]  # a third are copies
    x[150:200] = x[150] + rng.normal(scale=0.05, size=(50, 64))
    rows = [(i, x[i].tolist()) for i in range(260)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (300, None), (301, []), (302, rows[1][1][:63]), (303, [*rows[1][1], 0.0]), (304, [None, *rows[1][1][1:]]), (305, [float("nan"), *rows[1][1][1:]]), (306, [float("-inf"), *rows[1][1][1:]]), (307, [1e30, *rows[1][1][1:]]), (-4, rows[9][1])]
    df = spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)
    want = plain(rows)
    assert got(df) == want and got(df.repartition(6), near=1) == want and got(df, near=7) == want


@pytest.mark.parametrize(("k", "near", "rounds"), [(1, 3, 2), (2, 3, 5), (8, 3, 0), (8, 2, 10), (20, 4, 6)])
def test_ties_go_to_the_smaller_number(spark, k, near, rounds):
    rng = np.random.default_rng(k)
    rows = [(i, rng.integers(-1, 2, 3).astype(float).tolist()) for i in range(90)]  # few places, so that equal distances abound
    df = spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)
    assert got(df, k=k, near=near, rounds=rounds, dims=3) == plain(rows, k, rounds, 3)


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0] * 64), (2, [0.5] * 64), (None, [0.0] * 64)]
    assert got(spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)) == plain(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == [] and got(spark.createDataFrame([(1, None, 1)], SCHEMA)) == []


def test_bounds_spare_most_scans():
    rng = np.random.default_rng(2)
    middles = rng.integers(-4000, 4000, (8, 64))
    vectors = np.concatenate([m + rng.integers(-300, 300, (200, 64)) for m in middles]).astype(np.int64)
    bounds, whole = cl.Bounds(vectors, 8, 3), []
    centroids = vectors[::200].copy()
    for _ in range(4):
        whole.append(bounds.assign(centroids))
        assert (bounds.cluster == np.argmin([cl.squared(vectors, c) for c in centroids], axis=0)).all()
        moved = np.array([vectors[bounds.cluster == c].sum(axis=0) // max(1, (bounds.cluster == c).sum()) for c in range(8)])
        bounds.moved(np.sqrt(cl.squared(centroids, moved)) * (1 + cl.MARGIN))
        centroids = moved
    assert whole[0] == 1600 and sum(whole[1:]) < 160

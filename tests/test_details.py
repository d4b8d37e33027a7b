"""General cameras, shifts, turned rasters and missed rows against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.functions import geometry as G
from trackloom.operators import grids


def test_ground_point(spark):
    rng = np.random.default_rng(2)
    rows, want = [], []
    for _ in range(60):
        k = np.array([[rng.uniform(80, 120), rng.uniform(-2, 2), 90], [rng.uniform(-1, 1), rng.uniform(80, 120), 50], [0, 0, rng.uniform(0.8, 1.2)]])
        q = np.linalg.qr(rng.normal(size=(3, 3)))[0] * rng.choice([-1, 1], 3)
        t, (u, v), z = rng.normal(size=3), rng.uniform(0, 150, 2), float(rng.normal())
        at, way = -q.T @ t, q.T @ np.linalg.solve(k, [u, v, 1.0])
        far = (z - at[2]) / way[2]
        want.append((at + far * way)[:2] if way[2] < -1e-6 and far > 0 else None)
        rows.append((k.tolist(), q.tolist(), t.tolist(), float(u), float(v)))
        rows[-1] = (*rows[-1], z)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k array<array<double>>, q array<array<double>>, t array<double>, u double, v double, z double")
    m = lambda c: [[F.col(c)[i][j] for j in range(3)] for i in range(3)]
    x, y = G.ground_point(F.col("u"), F.col("v"), m("k"), m("q"), [F.col("t")[i] for i in range(3)], F.col("z"))
    got = [(r["x"], r["y"]) for r in df.select("i", x.alias("x"), y.alias("y")).orderBy("i").collect()]
    assert sum(w is not None for w in want) > 8 and sum(w is None for w in want) > 8
    for (a, b), w in zip(got, want, strict=True):
        assert (a, b) == (None, None) if w is None else (a, b) == pytest.approx(tuple(w))
    flat = spark.range(1).select(*[c.alias(f"c{i}{j}") for i, row in enumerate(G.inverse3([[F.lit(float(x)) for x in row] for row in ([1, 2, 3], [2, 4, 6], [0, 1, 1])])) for j, c in enumerate(row)]).first()
    assert set(flat) == {None}


def test_fit_is_a_turn_even_of_mirrored_points(spark):
    rng = np.random.default_rng(4)
    p = rng.normal(size=(40, 2)) * [5, 1] + [30, -2]
    turn = np.array([[math.cos(0.7), -math.sin(0.7)], [math.sin(0.7), math.cos(0.7)]])
    for q in (p @ turn.T + [4, 9], p * [1, -1] + [4, 9] + rng.normal(size=(40, 2)) * 0.1):
        src, dst = p - p.mean(0), q - q.mean(0)
        u, _, vt = np.linalg.svd(src.T @ dst)
        best = vt.T @ np.diag([1.0, np.sign(np.linalg.det(vt.T @ u.T))]) @ u.T  # the guard: a proper turn
        df = spark.createDataFrame([(*map(float, a), *map(float, b)) for a, b in zip(p, q, strict=True)], "x double, y double, u double, v double")
        angle, tx, ty = df.agg(*[c.alias(n) for c, n in zip(G.fitted_shift("x", "y", "u", "v"), ("a", "tx", "ty"), strict=True)]).first()
        assert [[math.cos(angle), -math.sin(angle)], [math.sin(angle), math.cos(angle)]] == [pytest.approx(row) for row in best.tolist()]
        assert (tx, ty) == pytest.approx(tuple(q.mean(0) - best @ p.mean(0)))


def test_rotated(spark):
    rng = random.Random(1)
    image = {(r, c): rng.randint(1, 9) for r in range(11) for c in range(17) if rng.random() < 0.7}
    df = spark.createDataFrame([(3, r, c, v) for (r, c), v in image.items()], "frame long, r int, c int, label int")
    for degrees in (0.0, 90.0, -33.0, 180.0):
        a, b = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
        want = {}
        for r in range(11):
            for c in range(17):
                sr, sc = round(round(5 + b * (c - 8) + a * (r - 5), 9)), round(round(8 + a * (c - 8) - b * (r - 5), 9))
                want[r, c] = image.get((sr, sc), 0) if 0 <= sr < 11 and 0 <= sc < 17 else 255
        assert {(x["r"], x["c"]): x["label"] for x in grids.rotated(df, degrees, (5.0, 8.0), (11, 17), 255).collect()} == want


def test_rows_met_and_missed(spark):
    rng = random.Random(5)
    cells = lambda k, p: {(f, r, c) for f in (1, 2) for r in range(30) for c in range(8) if rng.random() < p and r % 7 != k}
    truth, said = cells(3, 0.2), cells(9, 0.05)
    df = lambda own: spark.createDataFrame(sorted(own), "frame long, r int, c int")
    rows = grids.row_continuity(df(truth), df(said))
    want = {(f, r): any((f, r + a, c + b) in said for _, _, c in [p for p in truth if p[:2] == (f, r)] for a in (-1, 0, 1) for b in (-1, 0, 1)) for f, r, _ in truth}
    assert {(x["frame"], x["r"]): x["hit"] for x in rows.collect()} == want
    lengths = []
    for f in (1, 2):
        n = 0
        for r in range(31):
            if want.get((f, r), True):
                lengths += [n] if n else []
                n = 0
            else:
                n += 1
    assert sorted(x["n"] for x in grids.missed_runs(rows).collect()) == sorted(lengths)

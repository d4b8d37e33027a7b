"""Reports against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import evaluation as E


def plain_corners(x, y, l, w, yaw):  # noqa: E741
    turn = np.array([[math.cos(yaw), -math.sin(yaw)], [math.sin(yaw), math.cos(yaw)]])
    return np.array([(l / 2, w / 2), (l / 2, -w / 2), (-l / 2, -w / 2), (-l / 2, w / 2)]) @ turn.T + [x, y]


def test_detection_report(spark):
    rng = random.Random(7)
    box = lambda i: (rng.choice([1, 2]), i, rng.choice("ab"), rng.uniform(-100, 100), rng.uniform(-30, 30), rng.uniform(1, 5), rng.uniform(1, 3), rng.uniform(-3, 3))
    truth, pred = [box(i) for i in range(120)], [box(i) for i in range(100, 220)]
    pred += [(f, 1000 + i, c, x + 0.3, y, l + 0.2, w, yaw + math.pi) for f, i, c, x, y, l, w, yaw in truth[:60]]
    matched = [(f, 1000 + i, i, 0.3) for f, i, *_ in truth[:60]] + [(f, None, i, None) for f, i, *_ in truth[60:]] + [(p[0], p[1], None, None) for p in pred[:120]]
    kind = "frame long, id long, cls string, x double, y double, l double, w double, yaw double"
    got = E.detection_report(spark.createDataFrame(matched, "frame long, pred long, truth long, distance double"), spark.createDataFrame(pred, kind), spark.createDataFrame(truth, kind)).collect()
    zone = lambda x: "ahead" if 0 <= x < 40 else "far ahead" if 40 <= x <= 80 else "behind" if -40 < x < 0 else "far behind" if -80 <= x <= -40 else None
    hits, missed, false = truth[:60], truth[60:], pred[:120]
    assert {(r["cls"], r["zone"]) for r in got} >= {(c, z) for c in "ab" for z in ("all", "ahead", "behind")}
    for r in got:
        own = lambda rows: [b for b in rows if b[2] == r["cls"] and r["zone"] in ("all", zone(b[3]))]  # noqa: B023, E731
        tp, fn, fp = own(hits), own(missed), own(false)
        assert (r["tp"], r["fn"], r["fp"]) == (len(tp), len(fn), len(fp)) and r["precision"] == pytest.approx(len(tp) / max(len(tp) + len(fp), 1))
        if tp:
            wrong = []
            for _, _, _, x, y, l, w, yaw in tp:
                p, t = plain_corners(x + 0.3, y, l + 0.2, w, yaw + math.pi), plain_corners(x, y, l, w, yaw)
                wrong.append(min(np.linalg.norm(p - np.roll(t, k, axis=0), axis=1).mean() for k in range(4)))
            assert (r["length"], r["width"], r["flipped"]) == pytest.approx((0.2, 0, 1)) and r["yaw"] == pytest.approx(0, abs=1e-6) and r["corner"] == pytest.approx(np.mean(wrong))
        near = lambda rows: sum(b[3] ** 2 + b[4] ** 2 < 900 and abs(b[4]) < 12 for b in rows)
        assert r["recall_near"] == pytest.approx(near(tp) / max(near(tp) + near(fn), 1))


def test_plan_report(spark):
    rng = random.Random(1)
    modes = [(s, m, float(rng.randint(0, 3)), h, rng.uniform(0, 9), rng.uniform(-4, 4)) for s in range(30) for m in range(3) for h in range(1, 7)]
    speed = {s: rng.choice([0.5, 2.0, 5.0, 9.0, 20.0]) for s in range(30)}
    score = {(s, m): rng.randint(0, 2) for s in range(30) for m in range(3)}
    modes = [(s, m, float(score[s, m]), h, x, y) for s, m, _, h, x, y in modes]
    truth = {(s, h): (rng.uniform(0, 9), rng.uniform(-4, 4)) for s in range(30) for h in range(1, 7)}
    got = E.plan_report(spark.createDataFrame(modes, "sample int, mode int, score double, h int, x double, y double"), spark.createDataFrame([(s, h, *p, speed[s]) for (s, h), p in truth.items()], "sample int, h int, x double, y double, v double"), 6, 0.5).first()
    at = {(s, m, h): (x, y) for s, m, _, h, x, y in modes}
    off = lambda s, m: [math.dist(at[s, m, h], truth[s, h]) for h in range(1, 7)]
    best = {s: min(range(3), key=lambda m: (-score[s, m], m)) for s in range(30)}
    ade = {s: np.mean(off(s, best[s])) for s in range(30)}
    some = lambda keep: np.mean([ade[s] for s in range(30) if keep(s)])
    want = {
        "ade": some(lambda s: True), "fde": np.mean([off(s, best[s])[-1] for s in range(30)]), "oracle": np.mean([min(np.mean(off(s, m)) for m in range(3)) for s in range(30)]),
        "cv": np.mean([math.dist((speed[s] * h * 0.5, 0), truth[s, h]) for s in range(30) for h in range(1, 7)]), "moving": some(lambda s: speed[s] > 2), "stopped": some(lambda s: speed[s] <= 2),
        "curve": some(lambda s: abs(truth[s, 6][1]) > 2), "bias": np.mean([at[s, best[s], 1][0] - truth[s, 1][0] for s in range(30) if 8 <= speed[s] < 15]), "n": 30,
    }
    assert got.asDict() == {k: pytest.approx(v) for k, v in want.items()}


def test_class_report_and_boundaries(spark):
    rows = [("a", "a"), ("a", "b"), (None, "b"), ("c", None), ("b", "b"), ("a", None), (None, None), (None, "d")]
    got = {r["cls"]: tuple(r)[1:] for r in E.class_report(spark.createDataFrame(rows, "truth string, said string")).collect()}
    assert got == {"a": (1, 0, 2, 1.0, pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(1 / 3)), "b": (1, 2, 0, pytest.approx(1 / 3), 1.0, 3.0, 3.0), "c": (0, 0, 1, 0.0, 0.0, 0.0, 0.0), "d": (0, 1, 0, 0.0, 0.0, 1.0, None)}
    lanes = spark.createDataFrame([(1, 2), (2, 3), (None, 2), (9, None)], "left long, right long")
    kinds = E.boundary_kinds(lanes, spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "boundary long"))
    assert {tuple(r) for r in kinds.collect()} == {(1, 1, "outer"), (2, 3, "inner"), (3, 1, "outer")}


def test_chain_drift(spark):
    rows = [("s", n, n != 14, 1.0, 0.0, 0.0, 0.0) for n in range(27)] + [("t", n, True, 0.0, 2.0, 0.0, 0.0) for n in range(4)]
    got = {r["place"]: (r["drift"], r["n"]) for r in E.chain_drift(spark.createDataFrame(rows, "scene string, n int, valid boolean, px double, py double, gx double, gy double"), 2, 3).collect()}
    # Rows 0, 2, ... 26 are 14 steps: chains from step 0, 3, 6 and 9 (14 - 3 = 11 is their end); that from 6 ends at row 14, its second.
    assert got == {1: (1.0, 4), 2: (2.0, 3), 3: (3.0, 3)}
    values = spark.createDataFrame([(-0.5, 0.5), (0.0, 0.5), (-0.25, 0.5), (9.0, 1.0)], "y double, o double").select(E.recovery(F.col("y"), F.col("o")).alias("r"))
    assert [r["r"] for r in values.collect()] == [1.0, 0.0, 0.5, -0.5]


def test_lamp_elements(spark):
    data = spark.createDataFrame([("p1", "x/FRONT/0042.jpg", 200, 100), ("p2", "x/SIDE/7.jpg", 200, 100), ("p3", "x/FRONT/late.jpg", 200, 100), ("p4", "REAR_7", 10, 10), ("p5", "x/REAR/8", 10, 10)], "token string, filename string, width int, height int")
    names = spark.createDataFrame([(1, "red"), (2, "green_arrow_pedestrian"), (3, "pole_red")], "token int, name string")
    objects = [(p, c, [20.0, 10.0, 40.0, 30.0], None if p == "p1" else 0.5) for p in ("p1", "p2", "p3", "p4", "p5") for c in (1, 2, 3, 4)]
    got = sorted(map(tuple, E.lamp_elements(spark.createDataFrame(objects, "sample_data string, category int, bbox array<double>, orientation double"), names, data, ["FRONT", "REAR"]).collect()))
    red, arrow = (1, 0, 0, 0, 0), (0, 0, 1, 1, 1)
    turn = (pytest.approx(math.sin(0.5)), pytest.approx(math.cos(0.5)))
    assert got == [(8, 1, 2.0, 1.0, 4.0, 3.0, *arrow, *turn), (8, 1, 2.0, 1.0, 4.0, 3.0, *red, *turn), (42, 0, 0.1, 0.1, 0.2, 0.3, *arrow, 0.0, 0.0), (42, 0, 0.1, 0.1, 0.2, 0.3, *red, 0.0, 0.0)]

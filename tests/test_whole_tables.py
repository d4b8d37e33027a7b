"""Queries that have no oracle, on every frame of the smallest tables, against plain versions."""

from __future__ import annotations

from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

import trackloom.plans  # noqa: F401
from trackloom.operators import rasters
from trackloom.plans import registry
from trackloom.plans.grid_queries import cells

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def by_frame(df):
    out = defaultdict(set)
    for row in df.select("frame", "r", "c").collect():
        out[row["frame"]].add((row["r"], row["c"]))
    return dict(out)


def reach(start, allowed, steps):
    seen, todo = {start}, [start]
    while todo:
        r, c = todo.pop()
        new = {(r + a, c + b) for a, b in steps} & allowed - seen
        seen |= new
        todo += new
    return seen


FOUR = [(0, 1), (0, -1), (1, 0), (-1, 0)]
EIGHT = [*FOUR, (1, 1), (1, -1), (-1, 1), (-1, -1)]


def filled(own):
    rows, columns = [r for r, _ in own], [c for _, c in own]
    free = {(r, c) for r in range(min(rows) - 1, max(rows) + 2) for c in range(min(columns) - 1, max(columns) + 2)} - own
    free -= reach((min(rows) - 1, min(columns) - 1), free, FOUR)
    return own | {p for p in free if len(reach(p, free, FOUR)) <= 4}


def region(own):
    part = reach((3, 5), own, EIGHT) if (3, 5) in own else set()
    return part if len(part) >= 0.3 * len(own) and part else own


def thin(own):
    r0, c0 = min(r for r, _ in own), min(c for _, c in own)
    mask = np.zeros((max(r for r, _ in own) - r0 + 1, max(c for _, c in own) - c0 + 1), bool)
    for r, c in own:
        mask[r - r0, c - c0] = True
    return {(int(r) + r0, int(c) + c0) for r, c in zip(*np.nonzero(rasters.thinned(mask)), strict=True)}


@pytest.mark.parametrize(("name", "plain"), [("r5_filled_holes", filled), ("r6_connected_region", region), ("r16_skeleton", thin)])
def test_every_frame(spark, name, plain):
    whole = by_frame(cells(spark, FOLDER))
    assert len(whole) == 50
    want = {frame: found for frame, own in whole.items() if (found := plain(own))}
    assert by_frame(registry.queries()[name](spark, FOLDER)) == want


def test_union_reads_every_customer(spark, tmp_path):
    spark.createDataFrame([(7, "a"), (90, "b")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(3, "b"), (2, "c")], "p_partkey long, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.queries()["u1_ordered_union_distinct"](spark, str(tmp_path)).collect()
    assert sorted((r["place"], r["v"]) for r in got) == [(1, "a"), (2, "b"), (3, "c")]


def overlap(a, b):
    """Area that two rotated boxes (x, y, l, w, yaw) share: the hull of their corners in each other and of where their edges cross."""

    def shape(x, y, length, width, yaw):
        c, s = np.cos(yaw), np.sin(yaw)
        return [(x + c * i * length / 2 - s * j * width / 2, y + s * i * length / 2 + c * j * width / 2) for i, j in ((1, 1), (-1, 1), (-1, -1), (1, -1))]

    def local(p, x, y, length, width, yaw):
        dx, dy = p[0] - x, p[1] - y
        return abs(np.cos(yaw) * dx + np.sin(yaw) * dy) <= length / 2 + 1e-9 and abs(np.cos(yaw) * dy - np.sin(yaw) * dx) <= width / 2 + 1e-9

    pa, pb = shape(*a), shape(*b)
    points = [p for p in pa if local(p, *b)] + [p for p in pb if local(p, *a)]
    for p, q in zip(pa, pa[1:] + pa[:1], strict=True):
        for r, s in zip(pb, pb[1:] + pb[:1], strict=True):
            d = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
            if abs(d) > 1e-12:
                t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / d
                u = ((r[0] - p[0]) * (q[1] - p[1]) - (r[1] - p[1]) * (q[0] - p[0])) / d
                if 0 <= t <= 1 and 0 <= u <= 1:
                    points.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    if len(points) < 3:
        return 0.0
    mx, my = np.mean(points, axis=0)
    points.sort(key=lambda p: np.arctan2(p[1] - my, p[0] - mx))
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1], strict=True))) / 2


def test_rotated_suppression_of_every_frame(spark):
    """T8 on the smallest table, every pair of a frame compared."""
    from trackloom.plans.kernel_queries import framed

    frames = defaultdict(list)
    for r in framed(spark, FOLDER).collect():
        frames[r["frame"]].append((-r["score"], r["box"], (r["x"], r["y"], r["l"], r["w"], r["score"])))
    want, pairs = [], 0
    for frame, own in frames.items():
        kept = []
        for _, box, shape in sorted(own):
            clear = True
            for other in kept:
                both = overlap(shape, other)
                one, two = shape[2] * shape[3], other[2] * other[3]
                clear &= not (both / max(one + two - both, 1e-12) >= 0.3 or both / max(min(one, two), 1e-12) >= 0.7)
                pairs += both > 0
            if clear:
                kept.append(shape)
                want.append((frame, box))
    assert sorted((r["frame"], r["box"]) for r in registry.queries()["t8_rotated_nms"](spark, FOLDER).collect()) == sorted(want)
    assert pairs > 100 and len(want) < sum(map(len, frames.values()))

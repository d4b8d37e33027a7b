"""Triangles, skeleton graphs, splines, hulls, shapes and alignment against plain versions that don't call the implementation."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

import trackloom.plans  # noqa: F401
from trackloom.operators import alignment as A
from trackloom.operators import densify as D
from trackloom.operators import vectorise as V
from trackloom.operators.sequences import parabolas
from trackloom.plans import registry
from trackloom.plans.grid_queries import cells

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def cross(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def circle(a, b, c):
    """Centre and squared radius, exact."""
    d = 2 * cross(a, b, c)
    bx, by, cx, cy = b[0] - a[0], b[1] - a[1], c[0] - a[0], c[1] - a[1]
    x, y = Fraction(cy * (bx**2 + by**2) - by * (cx**2 + cy**2), d), Fraction(bx * (cx**2 + cy**2) - cx * (bx**2 + by**2), d)
    return a[0] + x, a[1] + y, x**2 + y**2


def plain_hull(points):
    """Corners: points that are no convex combination of two or three others."""
    out = set()
    for p in points:
        rest = [q for q in points if q != p]
        on = any(cross(a, b, p) == 0 and min(a, b) < p < max(a, b) for a, b in combinations(rest, 2))
        within = any(cross(a, b, c) and len({cross(a, b, p) > 0, cross(b, c, p) > 0, cross(c, a, p) > 0}) == 1 and 0 not in (cross(a, b, p), cross(b, c, p), cross(c, a, p)) for a, b, c in combinations(rest, 3))
        if not on and not within:
            out.add(p)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_delaunay(seed):
    rng = random.Random(seed)
    size = rng.choice([2, 4, 9, 30])
    points = sorted({(rng.randint(0, size), rng.randint(0, size)) for _ in range(rng.randint(0, 16))})
    rng.shuffle(points)
    found = D.delaunay(points)
    whole = [p for p in points if p in plain_hull(points)]
    if len(points) < 3 or all(cross(points[0], points[1], p) == 0 for p in points):
        assert found == []
        return
    middle = (sum(p[0] for p in whole) / len(whole), sum(p[1] for p in whole) / len(whole))
    whole.sort(key=lambda p: math.atan2(p[1] - middle[1], p[0] - middle[0]))
    assert sum(cross(*[points[k] for k in t]) for t in found) == sum(cross((0, 0), a, b) for a, b in zip(whole, whole[1:] + whole[:1], strict=True))
    for t in found:  # no point inside any triangle's circle
        assert cross(*[points[k] for k in t]) > 0
        x, y, r = circle(*[points[k] for k in t])
        assert all((p[0] - x) ** 2 + (p[1] - y) ** 2 >= r for p in points)


def test_every_step_of_filling(spark):
    """A slope of ground, an object, a post with too few samples, sky and the ego vehicle."""
    rng = random.Random(4)
    seg = {(r, c): "G" if r < 6 else "X" if c < 6 else "Y" if c < 7 else "S" for r in range(9) for c in range(12)}
    seg |= {(8, 11): None, (8, 5): "X"}
    plane = {p: 10 + 0.5 * p[0] - 0.25 * p[1] for p in seg}
    seen = {p: plane[p] for p in seg if seg[p] == "G" and rng.random() < 0.2 and p[1] < 9} | {(7, 1): 3.0, (7, 3): 4.5, (8, 3): 7.0, (6, 6): 2.0, (8, 9): 1.0}
    frame = spark.createDataFrame([(5, r, c, s, (r, c) in {(0, 0), (0, 1)}) for (r, c), s in seg.items()], "frame long, r int, c int, seg string, ego boolean")
    given = spark.createDataFrame([(5, r, c, z) for (r, c), z in seen.items()], "frame long, r int, c int, z double")
    rows = {(x["r"], x["c"]): (x["z"], x["source"]) for x in D.densified(frame, given, ["G"], {"ego": 0.5, "S": 80.0}).collect()}
    assert {s for _, s in rows.values()} == {"seen", "triangle", "plane", "nearest", "override", "median"}
    for p, (z, source) in rows.items():
        if p in {(0, 0), (0, 1)}:
            assert (z, source) == (0.5, "override")
        elif seg[p] == "S":
            assert (z, source) == (80.0, "override")
        elif seg[p] == "G":  # samples of a plane: triangles and the fitted plane give it back
            assert z == pytest.approx(plane[p]) and source in ("seen", "triangle", "plane")
            assert (source == "seen") == (p in seen)
        elif p in seen:
            assert (z, source) == (seen[p], "seen")
    known = {p: z for p, (z, s) in rows.items() if s in ("seen", "triangle", "plane")} | {p: plane[p] for p in ((0, 0), (0, 1))} | {(8, 9): 1.0}
    for p, (z, source) in rows.items():
        if source in ("nearest", "median"):
            near = min(known, key=lambda q: ((q[0] - p[0]) ** 2 + (q[1] - p[1]) ** 2, q))
            assert (source == "nearest") == (seg[near] == seg[p]) and (source != "nearest" or z == known[near])
    assert (8, 11) not in rows


def test_nearest_known(spark):
    rng = random.Random(9)
    known = [(f, rng.randint(0, 20), rng.randint(0, 15)) for f in (1, 2) for _ in range(9)]
    cells_ = sorted({(f, rng.randint(-3, 24), rng.randint(-2, 20)) for f in (1, 2, 3) for _ in range(60)} - set(known))
    got = D.nearest_known(spark.createDataFrame(cells_, "frame long, r int, c int"), spark.createDataFrame(sorted(set(known)), "frame long, r int, c int"))
    want = {}
    for f, r, c in cells_:
        if own := [k for k in known if k[0] == f]:
            want[f, r, c] = min(((a - r) ** 2 + (b - c) ** 2, a, b) for _, a, b in own)[1:]
    assert {(x["frame"], x["r"], x["c"]): (x["nr"], x["nc"]) for x in got.collect()} == want


def test_planes(spark):
    rng = np.random.default_rng(0)
    rows = [(k, int(r), int(c), float(z)) for k in range(3) for r, c, z in zip(rng.integers(0, 9, 12), rng.integers(0, 9, 12), rng.normal(size=12), strict=True)]
    rows += [(9, k, 2 * k, 1.0) for k in range(5)]  # on a line
    got = {x["k"]: x for x in D.planes(spark.createDataFrame(rows, "k int, r int, c int, z double"), ["k"]).collect()}
    assert set(got) == {0, 1, 2}
    for k, x in got.items():
        own = np.array([row[1:] for row in rows if row[0] == k])
        fit = np.linalg.lstsq(np.column_stack([np.ones(len(own)), own[:, :2]]), own[:, 2], rcond=None)[0]
        assert np.allclose([x["p0"], x["pr"], x["pc"]], fit)


def plain_thin(own):
    """Zhang and Suen's passes over a set of pixels."""
    own = set(own)
    around = [(-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1)]
    while True:
        before = len(own)
        for first in (True, False):
            gone = set()
            for r, c in own:
                n = [(r + a, c + b) in own for a, b in around]
                turns = sum(not x and y for x, y in zip(n, n[1:] + n[:1], strict=True))
                if 2 <= sum(n) <= 6 and turns == 1 and not (n[0] and n[2] and n[4] if first else n[0] and n[2] and n[6]) and not (n[2] and n[4] and n[6] if first else n[0] and n[4] and n[6]):
                    gone.add((r, c))
            own -= gone
        if len(own) == before:
            return own


def plain_links(pixels):
    out = set()
    for p, q in combinations(sorted(pixels), 2):
        dr, dc = q[0] - p[0], q[1] - p[1]
        if max(abs(dr), abs(dc)) == 1 and (dr == 0 or dc == 0 or ((p[0] + dr, p[1]) not in pixels and (p[0], p[1] + dc) not in pixels)):
            out.add((p, q))
    return out


def degrees(links):
    return Counter(p for link in links for p in link)


def hold_lines(pixels, lines):
    """Every link in one line; places inside lines have two links, and their ends another number, or meet."""
    links = plain_links(pixels)
    n = degrees(links)
    walked = Counter(tuple(sorted(pair)) for line in lines for pair in zip(line, line[1:], strict=False))
    assert walked == Counter(links)
    for line in lines:
        assert all(n[p] == 2 for p in line[1:-1])
        assert (n[line[0]] != 2 and n[line[-1]] != 2) or line[0] == line[-1]


@pytest.mark.parametrize("seed", range(25))
def test_traced(seed):
    rng = random.Random(seed)
    pixels = {(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(0, 60))}
    hold_lines(pixels, V.traced(pixels))
    hold_lines(plain_thin(pixels), V.traced(plain_thin(pixels)))


def test_pruned():
    line = {(5, c) for c in range(20)}
    spur, arm = {(4, 8), (3, 8)}, {(r, 12) for r in range(6, 12)}
    assert V.pruned(line | spur | arm, 2) == line | arm and V.pruned(line | spur | arm, 1) == line | spur | arm
    assert V.pruned(line | spur | arm, 6) == line
    plus = {(0, 0), (1, 0), (-1, 0), (-2, 0), (0, 1), (0, 2), (0, -1)}
    assert V.pruned(plus, 9) == {(0, 0), (-1, 0), (-2, 0), (0, 1), (0, 2)}  # the two longest arms stay
    ring = {(0, 1), (0, 2), (1, 0), (1, 3), (2, 1), (2, 2)}
    assert V.pruned(ring | {(1, 4), (1, 5)}, 5) == ring and V.pruned(set(), 3) == set() and V.pruned({(1, 1)}, 3) == {(1, 1)}


@tables
def test_skeleton_lines_of_every_frame(spark):
    marks = defaultdict(set)
    for x in cells(spark, FOLDER).filter("cls = 'NF' and z > 1.0").select("frame", "r", "c").collect():
        marks[x["frame"]].add((x["r"], x["c"]))
    lines = defaultdict(lambda: defaultdict(list))
    for x in registry.queries()["r16_skeleton_lines"](spark, FOLDER).orderBy("frame", "line", "n").collect():
        lines[x["frame"]][x["line"]].append((x["r"], x["c"]))
    assert len(marks) == 50 and sum(map(len, lines.values())) > 40
    for frame, own in marks.items():
        thin, got = plain_thin(own), list(lines[frame].values())
        left = {p for line in got for p in line}
        for p in thin - left:  # gone are single pixels, and ends of at most two pixels at a junction
            assert not any(p in link for link in plain_links(thin)) or any(max(abs(p[0] - q[0]), abs(p[1] - q[1])) <= 2 for q in thin - {p})
        hold_lines(left, got)


def dense_spline(at, xy, intervals, bound):
    n = intervals + 3
    b = np.zeros((len(at), n))
    for i, t in enumerate(at * intervals):
        for j in range(n):  # the uniform cubic B-spline that begins at knot j - 3
            u = t - (j - 3)
            if 0 <= u < 1:
                b[i, j] = u**3 / 6
            elif 1 <= u < 2:
                b[i, j] = (-3 * (u - 1) ** 3 + 3 * (u - 1) ** 2 + 3 * (u - 1) + 1) / 6
            elif 2 <= u < 3:
                b[i, j] = (3 * (u - 2) ** 3 - 6 * (u - 2) ** 2 + 4) / 6
            elif 3 <= u <= 4:
                b[i, j] = (1 - (u - 3)) ** 3 / 6
    rough = np.diff(np.eye(n), 2, axis=0)
    lo, hi = -8.0, 8.0
    solve = lambda w: np.linalg.solve(b.T @ b + 10.0**w * rough.T @ rough, b.T @ xy)
    for _ in range(40):
        w = (lo + hi) / 2
        lo, hi = (w, hi) if ((b @ solve(w) - xy) ** 2).sum() <= bound else (lo, w)
    return solve(lo), b


def test_spline_equals_a_dense_solver():
    rng = np.random.default_rng(3)
    for n, intervals in ((30, 6), (60, 12), (9, 9), (200, 5)):
        at = np.sort(np.concatenate([[0, 1], rng.random(n - 2)]))
        xy = np.column_stack([50 * at, 5 * np.sin(7 * at)]) + rng.normal(scale=0.1, size=(n, 2))
        for tolerance in (0.05, 0.2, 3.0):
            want, b = dense_spline(at, xy, intervals, n * tolerance**2)
            got = V.spline(at, xy, intervals, n * tolerance**2)
            assert np.allclose(b @ got, b @ want, atol=1e-5)
    band = np.zeros((4, 30))
    a = rng.normal(size=(30, 30))
    a = a @ a.T + 30 * np.eye(30)
    a[np.abs(np.subtract.outer(range(30), range(30))) > 3] = 0
    for j in range(4):
        band[j, : 30 - j] = np.diag(a, -j)
    right = rng.normal(size=(30, 2))
    assert np.allclose(V.banded_solve(band, right), np.linalg.solve(a, right))


def test_smoothed_line():
    rng = np.random.default_rng(8)
    s = np.arange(0, 30, 1.5)
    xy = np.column_stack([s, 0.01 * s**2]) + rng.normal(scale=0.05, size=(len(s), 2))
    got = V.smoothed_line(xy)
    along = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(xy, axis=0).T))])
    at = np.linspace(0, along[-1], len(got))
    assert np.allclose(got, np.column_stack([np.polyval(np.polyfit(along, xy[:, k], 3), at) for k in (0, 1)])) and len(got) == math.ceil(along[-1]) + 1
    s = np.arange(0, 200, 2.0)
    true = np.column_stack([s, 6 * np.sin(s / 25)])
    noisy = true + rng.normal(scale=0.15, size=true.shape)
    got = V.smoothed_line(noisy)
    off = [np.hypot(*(true - p).T).min() for p in got]
    assert max(off) < 1.2 and np.median(off) < 0.6 and np.abs(np.diff(got, 2, axis=0)).max() < np.abs(np.diff(noisy, 2, axis=0)).max() / 4
    for short in ([[0, 0]], [[0, 0], [0, 0], [0, 0]], [[0, 0], [0.1, 0], [0.2, 0.1]], [[1, 2], [9, 9]]):
        assert len(V.smoothed_line(np.array(short, float))) <= len(short)


def test_parabolas(spark):
    rng = np.random.default_rng(1)
    rows = [(k, i, float(x)) for k, n in enumerate((1, 2, 3, 4, 9, 40)) for i, x in enumerate(rng.normal(size=n))]
    got = {(x["k"], x["i"]): x["sx"] for x in parabolas(spark.createDataFrame(rows, "k int, i int, x double"), ["k"], ["i"], ["x"]).collect()}
    for k, i, _ in rows:
        own = [x for j, _, x in rows if j == k]
        lo, hi = max(0, i - 3), min(len(own), i + 4)
        assert got[k, i] == pytest.approx(np.polyfit(np.arange(lo, hi) - i, own[lo:hi], min(2, hi - lo - 1))[-1])


@pytest.mark.parametrize("seed", range(30))
def test_hull_and_rectangle(seed):
    rng = random.Random(seed)
    points = sorted({(rng.randint(0, 8), rng.randint(0, 8)) for _ in range(rng.randint(1, 14))})
    corners = V.hull(np.array(points, float))
    if len(corners) < 3:
        assert all(cross(points[0], points[-1], p) == 0 for p in points)
        return
    assert {tuple(map(int, p)) for p in corners} == plain_hull(points) and V.area(corners) > 0
    sizes = []
    for a, b in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        d = (b - a) / np.hypot(*(b - a))
        along, across = np.array(points) @ d, np.array(points) @ np.array([-d[1], d[0]])
        sizes.append(np.ptp(along) * np.ptp(across))
    box, one, two = V.rectangle(corners)
    assert one * two == pytest.approx(min(sizes)) and V.area(box) == pytest.approx(one * two)
    assert all(cross(p, q, c) >= -1e-9 for p, q in zip(box, np.roll(box, -1, axis=0), strict=True) for c in points)
    assert len(V.fewer_corners(corners, 4)) <= 4 and V.area(V.fewer_corners(corners, 4)) <= V.area(corners)


def test_shapes(spark):
    square = [(1, r, c) for r in range(5) for c in range(3, 12)]
    tilted = [(2, r, c) for r in range(12) for c in range(30) if abs(r - 6 + (c - 10) * 0.5) < 3 and abs((c - 10) - (r - 6) * 0.5) < 9]
    half = [(3, r, c) for r in range(12) for c in range(r + 1)]
    bent = [(4, r, c) for r in range(20) for c in range(20) if r < 3 or c < 3]
    line, dot = [(5, 2, c) for c in range(9)], [(6, 1, 1)]
    rows = [(7, *p) for p in square + tilted + half + bent + line + dot]
    got = {x["part"]: x for x in V.fitted_shapes(spark.createDataFrame(rows, "frame long, part int, r int, c int"), 1.2, 0.55).collect()}
    assert set(got) == {1, 2, 3, 4} and [got[k]["kind"] for k in (1, 2, 3)] == ["rectangle", got[2]["kind"], "triangle"]
    assert got[1]["iou"] == got[3]["iou"] == 1.0 and got[2]["iou"] > 0.85 and got[4]["kind"] == "hull" and len(got[4]["corners"]) <= 6
    for k, x in got.items():
        own, corners = {(r, c) for p, r, c in square + tilted + half + bent if p == k}, [(p["r"], p["c"]) for p in x["corners"]]
        inside = {(r, c) for r in range(-2, 32) for c in range(-2, 32) if all(cross(a, b, (r, c)) >= -1e-7 for a, b in zip(corners, corners[1:] + corners[:1], strict=True))}
        assert x["iou"] == pytest.approx(len(own & inside) / len(own | inside))


def test_alignment_is_the_best_of_all_and_looks_at_few(spark):
    rng = random.Random(5)
    shape = {(r, 0) for r in range(-10, 11)} | {(-4, c) for c in range(-9, 10)} | {(7, c) for c in range(0, 9)}
    turns = [-0.1, -0.05, 0.0, 0.05, 0.1]
    masks, onto = [], []
    for frame, (dr, dc, t) in enumerate([(5, -7, 0.05), (-11, 9, 0.0), (0, 0, -0.1), (15, -16, 0.1)]):
        masks += [(frame, r, c) for r, c in shape]
        onto += [(frame, round(math.cos(t) * r - math.sin(t) * c) + dr, round(math.sin(t) * r + math.cos(t) * c) + dc) for r, c in shape if rng.random() < 0.8]
        onto += [(frame, rng.randint(-25, 25), rng.randint(-25, 25)) for _ in range(15)]
    kind = "frame long, r int, c int"
    best, tried = A.aligned(spark.createDataFrame(masks, kind), spark.createDataFrame(sorted(set(onto)), kind), 4, turns)
    got = {x["frame"]: tuple(x)[1:] for x in best.collect()}
    for frame in range(4):
        own = [p[1:] for p in onto if p[0] == frame]
        weight = {(r, c): max((4 - (r - a) ** 2 - (c - b) ** 2 for a, b in own if (r - a) ** 2 + (c - b) ** 2 <= 1), default=0) for r in range(-45, 46) for c in range(-45, 46)}
        scores = []
        for t in turns:
            moved = {(round(math.cos(t) * r - math.sin(t) * c), round(math.sin(t) * r + math.cos(t) * c)) for r, c in shape}
            scores += [(sum(weight.get((r + dr, c + dc), 0) for r, c in moved), -abs(dr) - abs(dc), dr, dc, t) for dr in range(-16, 16) for dc in range(-16, 16)]
        score, _, dr, dc, t = max(scores)
        assert got[frame] == (dr, dc, t, score)
    looked = sum(level.count() for level in tried)
    assert looked < 0.1 * 4 * len(turns) * 32 * 32


def test_patches_equal_direct_sums(spark):
    from trackloom.operators import stereo as S

    rng = np.random.default_rng(6)
    a = rng.integers(0, 50, (9, 14))
    b = np.roll(a, 3, axis=1) + rng.integers(0, 3, a.shape)
    a[:4, :4] = 7  # flat
    rows = lambda x: spark.createDataFrame([(1, r, c, int(v)) for (r, c), v in np.ndenumerate(x) if v], "frame long, r int, c int, v long")
    image, other = S.dense_image(rows(a), 9, 14), S.dense_image(rows(b), 9, 14)
    for reach in (1, 2):
        got = {(x["r"], x["c"]): (x["depth"], x["ncc"]) for x in S.matched_depth(image, other, [2.0, 4.0, 3.0, 50.0], 12.0, reach).collect()}
        want = {}
        for r, c in np.ndindex(a.shape):
            for z, s in ((2.0, 6), (4.0, 3), (3.0, 4), (50.0, 0)):
                if reach <= r < 9 - reach and reach <= c and c + s < 14 - reach:
                    p, q = (x[r - reach : r + reach + 1, k - reach : k + reach + 1].astype(float) for x, k in ((a, c), (b, c + s)))
                    p, q = p - p.mean(), q - q.mean()
                    if p.any() and q.any():
                        ncc = round(float((p * q).sum() / np.sqrt((p * p).sum() * (q * q).sum())), 9)
                        want[r, c] = max(want.get((r, c), (-9, 0)), (ncc, z))
        assert set(got) == set(want) and all(got[k][0] == z and got[k][1] == pytest.approx(ncc, abs=1e-6) for k, (ncc, z) in want.items())
        assert Counter(z for z, _ in got.values()).most_common(1)[0][0] == 4.0


def test_paint_is_told_apart(spark):
    from trackloom.operators import paint as P

    bars = {(r, c) for r in (10, 13, 16, 19) for c in range(20, 30)}
    stop, lane, far_bar = {(31, c) for c in range(20, 31)}, {(r, 4) for r in range(0, 22)} | {(r, 4) for r in range(30, 45)}, {(80, c) for c in range(3, 14)}
    mask = spark.createDataFrame([(3, r, c) for r, c in bars | stop | lane | far_bar], "frame long, r int, c int")
    votes = P.ballots(mask, 36)
    lines = P.supported(votes, P.maxima(votes, 36, 8), 3.0, 6.0)
    kinds = P.named(lines, P.stripes(lines, 36, 10.0, 25.0, 1.5, 3, (3.0, 12.0)), 13.0, (6.0, 30.0)).collect()
    covers = lambda kind: {(r, c) for x in kinds if x["kind"] == kind for r, c in bars | stop | lane | far_bar if min(x["r0"], x["r1"]) <= r <= max(x["r0"], x["r1"]) and min(x["c0"], x["c1"]) <= c <= max(x["c0"], x["c1"])}
    assert {r for r, _ in covers("stripe")} >= {10, 13, 16, 19} and len(covers("stripe") & bars) >= 36
    assert len(covers("stop") & stop) >= 9 and not covers("stop") & far_bar and len(covers("lane") & lane) >= 15
    assert max(x["length"] for x in kinds if x["kind"] == "lane") <= 22  # a gap ends a run


def plain_render(label, extent, strip, most_hole, share=0.3):
    """The composition over dictionaries of one frame, with sets alone."""
    height, width = extent
    square = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    shift = lambda p, s: (p[0] + s[0], p[1] + s[1])
    erode = lambda own: {p for p in own if all(shift(p, s) in own for s in square)}
    dilate = lambda own, k: own if not k else dilate({shift(p, s) for p in own for s in square}, k - 1)

    def reach(start, allowed, steps):
        seen, todo = set(start), list(start)
        while todo:
            p = todo.pop()
            new = {shift(p, s) for s in steps} & allowed - seen
            seen |= new
            todo += new
        return seen

    def holes(own, most):
        if not own:
            return set()
        rows, columns = [r for r, _ in own], [c for _, c in own]
        free = {(r, c) for r in range(min(rows) - 1, max(rows) + 2) for c in range(min(columns) - 1, max(columns) + 2)} - own
        four = [(0, 1), (0, -1), (1, 0), (-1, 0)]
        free -= reach([(min(rows) - 1, min(columns) - 1)], free, four)
        return {p for p in free if len(reach([p], free, four)) <= most}

    road = {p for p, v in label.items() if v in ("road", "crossing", "line", "divider")}
    thin = erode(road)
    near = dilate(reach([p for p in thin if strip[0] <= p[1] <= strip[1]], thin, square), 2) & road
    region = near if len(near) >= share * len(road) else road
    out = {p: v for p, v in label.items() if p not in road or p in region}
    out |= {p: "road" for p in holes(region, most_hole) if p not in out}
    road = {p for p, v in out.items() if v in ("road", "crossing", "line", "divider")}
    closed = erode(dilate(road, 1))
    whole = closed | holes(closed, height * width)
    land = {(r, c) for r in range(height) for c in range(width)} - whole
    beyond = dilate(erode(land), 2)
    return out | {p: "edge" for p in whole - erode(whole) if 0 < p[0] < height - 1 and p in beyond}


def test_composed_render(spark, tmp_path):
    from functools import partial

    from trackloom.operators import render as N
    from trackloom.sources import publish

    rng = random.Random(12)
    area = {(r, c): "road" for r in range(20) for c in range(8, 20) if rng.random() < 0.95} | {(r, c): "road" for r in range(20) for c in range(26, 31)} | {(r, c): "walk" for r in range(20) for c in range(20, 23)}
    area |= {(9, c): "road" for c in range(20, 27)}  # a narrow bridge to the other road
    wide = {k: {(r, c): "road" if c % 3 else "walk" for r in range(20) for c in range(5, 25)} if k == 2 else area for k in (1, 2)}
    kinds = "frame long, r int, c int, label string"
    base = spark.createDataFrame([(k, *p, v) for k, own in wide.items() for p, v in own.items()], kinds)
    crossings, lines = {(r, c): "crossing" for r in (4, 5) for c in range(9, 18)}, {(r, 13): "line" for r in range(-2, 25)}
    layer = lambda own: spark.createDataFrame([(k, *p, v) for k in (1, 2) for p, v in own.items()], kinds)
    got = N.composed(base, layer(crossings), layer(lines), ["road", "crossing", "line", "divider"], (20, 40), (13, 14), 4, partial(publish.written, folder=f"file://{tmp_path}/r"))
    rows = defaultdict(dict)
    for x in got.collect():
        rows[x["frame"]][x["r"], x["c"]] = x["label"]
    for k, own in wide.items():
        label = {p: v for p, v in (own | crossings | lines).items() if 0 <= p[0] < 20 and 0 <= p[1] < 40}
        assert rows[k] == plain_render(label, (20, 40), (13, 14), 4)
    assert (3, 28) not in rows[1] and rows[1][4, 10] == "crossing" and "edge" in rows[1].values()

"""From masks to lines and shapes: the graph of a skeleton, its spurs cut and its lines traced; smoothing splines; hulls, rectangles and fitted shapes.

A frame's skeleton, a line and a component are a task's work each; what is compared cell by cell or line by line is joined outside.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.rasters import dense, thinned

Pixel = tuple[int, int]


def links(pixels: set[Pixel]) -> dict[Pixel, list[Pixel]]:
    """Each pixel's neighbours: those beside it, and diagonal ones that no pixel beside both of them connects already."""
    out: dict[Pixel, list[Pixel]] = {}
    for r, c in pixels:
        near = [p for p in ((r - 1, c), (r, c - 1), (r, c + 1), (r + 1, c)) if p in pixels]
        near += [(r + a, c + b) for a in (-1, 1) for b in (-1, 1) if (r + a, c + b) in pixels and (r + a, c) not in pixels and (r, c + b) not in pixels]
        out[r, c] = sorted(near)
    return out


def traced(pixels: set[Pixel]) -> list[list[Pixel]]:
    """Lines of pixels between ends and junctions (all that don't have two neighbours), and closed ones, whose first pixel is their last as well.

    Every link of two pixels is in exactly one line. Lines start at the smaller of their ends, closed ones at their smallest pixel; pixels
    without neighbours make no line.
    """
    near = links(pixels)
    nodes = {p for p, n in near.items() if len(n) != 2}
    seen: set[tuple[Pixel, Pixel]] = set()
    out = []

    def walk(a: Pixel, b: Pixel, ends: set[Pixel]) -> list[Pixel]:
        line = [a, b]
        while line[-1] not in ends:
            one, two = near[line[-1]]
            line.append(two if one == line[-2] else one)
        seen.update(zip(line, line[1:], strict=False))
        seen.update(zip(line[1:], line, strict=False))
        return line

    for a in sorted(nodes):
        out += [walk(a, b, nodes) for b in near[a] if (a, b) not in seen]
    for a in sorted(pixels - nodes):
        if (a, near[a][0]) not in seen:
            out.append(walk(a, near[a][0], {a}))
    return out


def pruned(pixels: set[Pixel], longest: int, rounds: int = 3) -> set[Pixel]:
    """The pixels without spurs: lines from an end to a junction of at most `longest` pixels before it. A junction keeps two of its lines, the
    longest, so that what is all spurs doesn't vanish. Cutting makes new lines, so it is done in rounds."""
    for _ in range(rounds):
        near, spurs = links(pixels), {}
        for line in traced(pixels):
            a, b = line[0], line[-1]
            for own in (line, line[::-1]):
                if len(near[own[0]]) == 1 and len(near[own[-1]]) > 2 and a != b and len(line) - 1 <= longest:
                    spurs.setdefault(own[-1], []).append(own[:-1])
        gone: set[Pixel] = set()
        for junction, own in spurs.items():
            own.sort(key=lambda line: (len(line), line))
            for line in own[: len(near[junction]) - 2]:
                gone.update(line)
        if not gone:
            break
        pixels = pixels - gone
    return pixels


LINES = "frame long, line int, closed boolean, n int, r int, c int"


def skeleton_lines(cells: DataFrame, longest_spur: int) -> DataFrame:
    """frame, line, closed, n, r, c: the lines of each frame's skeleton, n counting their pixels from 0; lines are numbered by their first two pixels."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask, r0, c0 = dense(rows)
        pixels = {(int(r) + r0, int(c) + c0) for r, c in zip(*np.nonzero(thinned(mask)), strict=True)}
        frame, out = rows["frame"].iloc[0], []
        for k, line in enumerate(sorted(traced(pruned(pixels, longest_spur)))):
            out += [(frame, k, line[0] == line[-1], n, r, c) for n, (r, c) in enumerate(line)]
        return pd.DataFrame(out, columns=["frame", "line", "closed", "n", "r", "c"])

    return cells.groupBy("frame").applyInPandas(one, LINES)


def banded_solve(band: np.ndarray, right: np.ndarray) -> np.ndarray:
    """x of A x = right for a symmetric positive definite A in lower bands: band[j, i] is A[i + j, i]. By Cholesky, in one pass each way."""
    width, n = band.shape
    low, x = band.astype(float).copy(), right.astype(float).copy()
    for i in range(n):
        low[0, i] = np.sqrt(low[0, i])
        reach = min(width, n - i)
        low[1:reach, i] /= low[0, i]
        x[i] /= low[0, i]
        for j in range(1, reach):
            low[: reach - j, i + j] -= low[j, i] * low[j:reach, i]
            x[i + j] -= low[j, i] * x[i]
    for i in range(n - 1, -1, -1):
        reach = min(width, n - i)
        x[i] = (x[i] - low[1:reach, i] @ x[i + 1 : i + reach]) / low[0, i]
    return x


def basis(at: np.ndarray, intervals: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): the four cubic B-splines over uniform knots that differ from 0 at each place in [0, 1]."""
    t = at * intervals
    first = np.minimum(t.astype(int), intervals - 1)
    u = t - first
    values = np.stack([(1 - u) ** 3, 3 * u**3 - 6 * u**2 + 4, -3 * u**3 + 3 * u**2 + 3 * u + 1, u**3], axis=1) / 6
    return first, values


def spline(at: np.ndarray, xy: np.ndarray, intervals: int, bound: float, steps: int = 40) -> np.ndarray:
    """Coefficients of the smoothest cubic spline whose squared residuals sum to `bound` at most: the largest weight of squared second
    differences that still meets it, found by halving; the least weight where none does."""
    n = intervals + 3
    first, values = basis(at, intervals)
    fit, right, rough = np.zeros((4, n)), np.zeros((n, xy.shape[1])), np.zeros((4, n))
    for a in range(4):
        np.add.at(right, first + a, values[:, a, None] * xy)
        for b in range(a, 4):
            np.add.at(fit[b - a], first + a, values[:, a] * values[:, b])
    for a, p in enumerate((1.0, -2.0, 1.0)):
        for b, q in list(enumerate((1.0, -2.0, 1.0)))[a:]:
            rough[b - a, a : a + n - 2] += p * q

    def solved(log_weight: float) -> tuple[np.ndarray, float]:
        x = banded_solve(fit + 10.0**log_weight * rough, right)
        back = sum(values[:, a, None] * x[first + a] for a in range(4))
        return x, float(((back - xy) ** 2).sum())

    lo, hi = -8.0, 8.0
    for _ in range(steps):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if solved(middle)[1] <= bound else (lo, middle)
    return solved(lo)[0]


def smoothed_line(xy: np.ndarray, step: float = 1.0, spline_from: float = 40.0, tolerance: float = 0.15, knot: float = 5.0) -> np.ndarray:
    """A line's points at about `step` along it: a cubic in the arc length by least squares for short lines, a smoothing spline for those from
    spline_from on, whose mean squared residual is tolerance^2 at most. Points that repeat the one before go; lines of two points or of half a
    metre stay as they are."""
    xy = xy[np.concatenate([[True], np.hypot(*np.diff(xy, axis=0).T) > 1e-6])]
    along = np.concatenate([[0.0], np.cumsum(np.hypot(*np.diff(xy, axis=0).T))])
    length = along[-1]
    if len(xy) < 3 or length < 0.5:
        return xy
    out = np.linspace(0, 1, max(int(np.ceil(length / step)) + 1, 2))
    if length < spline_from or len(xy) < 8:
        power = np.arange(min(3, len(xy) - 1) + 1)
        fit = np.linalg.lstsq((along[:, None] / length) ** power, xy, rcond=None)[0]
        return out[:, None] ** power @ fit
    intervals = int(min(max(1, np.ceil(length / knot)), len(xy)))
    x = spline(along / length, xy, intervals, len(xy) * tolerance**2)
    first, values = basis(out, intervals)
    return sum(values[:, a, None] * x[first + a] for a in range(4))


def smoothed_lines(points: DataFrame, **how: float) -> DataFrame:
    """frame, line, n, x, y: each line of points (frame, line, n, x, y) as smoothed_line() gives it."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        xy = smoothed_line(rows[["x", "y"]].to_numpy(float), **how)
        return pd.DataFrame({"frame": rows["frame"].iloc[0], "line": rows["line"].iloc[0], "n": np.arange(len(xy), dtype=np.int32), "x": xy[:, 0], "y": xy[:, 1]})

    return points.groupBy("frame", "line").applyInPandas(one, "frame long, line int, n int, x double, y double")


def turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull, turning left; points on its edges are none. One or two points where all lie on a line."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points
    halves = []
    for order in (points, points[::-1]):
        chain: list[np.ndarray] = []
        for p in order:
            while len(chain) > 1 and turn(chain[-2], chain[-1], p) <= 0:
                chain.pop()
            chain.append(p)
        halves.append(chain[:-1])
    return np.array(halves[0] + halves[1])


def area(corners: np.ndarray) -> float:
    after = np.roll(corners, -1, axis=0)
    return float((corners[:, 0] * after[:, 1] - corners[:, 1] * after[:, 0]).sum()) / 2


def rectangle(corners: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(corners, side, side) of the smallest rectangle about a convex hull, by rotating calipers: an edge of it lies on one of the hull's, and the
    farthest corners along and across move on, never back, from edge to edge. Of equals the first edge's."""
    n, best = len(corners), None
    right = far = left = 0
    for k in range(n):
        a = corners[k]
        along = (corners[(k + 1) % n] - a) / np.hypot(*(corners[(k + 1) % n] - a))
        across = np.array([-along[1], along[0]])
        at = lambda i, d: float((corners[i % n] - a) @ d)  # noqa: B023, E731
        right = max(right, k + 1)
        while at(right + 1, along) > at(right, along):
            right += 1
        far = max(far, right)
        while at(far + 1, across) > at(far, across):
            far += 1
        left = max(left, far)
        while at(left + 1, along) < at(left, along):
            left += 1
        lo, hi, up = at(left, along), at(right, along), at(far, across)
        if best is None or (hi - lo) * up < best[1] * best[2] * (1 - 1e-12):
            best = (np.array([a + x * along + y * across for x, y in ((lo, 0), (hi, 0), (hi, up), (lo, up))]), hi - lo, up)
    return best


def fewer_corners(corners: np.ndarray, most: int) -> np.ndarray:
    """The hull with the corners gone that cost the least area, one after another, until `most` are left; of equals the first."""
    corners = corners.copy()
    while len(corners) > most:
        cost = [turn(corners[k - 1], corners[k], corners[(k + 1) % len(corners)]) for k in range(len(corners))]
        corners = np.delete(corners, int(np.argmin(cost)), axis=0)
    return corners


SHAPES = "frame long, part int, n int, hull_area double, rect_area double, short_side double, kind string, corners array<struct<r: double, c: double>>"


def candidate_shapes(parts: DataFrame) -> DataFrame:
    """The smallest rectangle about each component (frame, part, r, c), and its hull with four, three and six corners at most, as shapes.

    Components on a line have no area and no shape but their hull, of one or two corners.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        corners = hull(rows[["r", "c"]].to_numpy(float))
        shapes, sides = {"hull": corners}, (0.0, 0.0)
        if len(corners) > 2:
            box, *sides = rectangle(corners)
            shapes = {"rectangle": box, "triangle": fewer_corners(corners, 3), "hull": fewer_corners(corners, 6)}
            if len(corners) > 3:
                shapes["quad"] = fewer_corners(corners, 4)
        named = [(k, [{"r": float(r), "c": float(c)} for r, c in s]) for k, s in shapes.items()]
        return pd.DataFrame([(rows["frame"].iloc[0], rows["part"].iloc[0], len(rows), area(corners) if len(corners) > 2 else 0.0, sides[0] * sides[1], min(sides), *s) for s in named], columns=["frame", "part", "n", "hull_area", "rect_area", "short_side", "kind", "corners"])

    return parts.select("frame", "part", "r", "c").groupBy("frame", "part").applyInPandas(one, SHAPES)


def covered(shapes: DataFrame) -> DataFrame:
    """shapes with r, c: the cells in or on each convex shape, cell centres being at whole numbers; a row for each row of cells first, cut to its span."""
    after = F.concat(F.slice("corners", F.lit(2), F.size("corners")), F.slice("corners", 1, 1))
    rows = shapes.withColumn("edges", F.zip_with("corners", after, lambda p, q: F.struct(p.alias("p"), q.alias("q"))))
    ends = lambda pick, f: pick(F.transform("corners", f))
    slack = 1e-9
    rows = rows.withColumn("r", F.explode(F.sequence(F.ceil(ends(F.array_min, lambda p: p["r"]) - slack).cast("int"), F.floor(ends(F.array_max, lambda p: p["r"]) + slack).cast("int"))))

    def meets(e: Column) -> Column:
        p, q = e["p"], e["q"]
        level = F.abs(q["r"] - p["r"]) < slack
        part = F.least(F.greatest((F.col("r") - p["r"]) / F.when(level, F.lit(1.0)).otherwise(q["r"] - p["r"]), F.lit(0.0)), F.lit(1.0))
        return F.when(level, F.array(p["c"], q["c"])).otherwise(F.array(p["c"] + part * (q["c"] - p["c"])))

    here = F.filter("edges", lambda e: (F.least(e["p"]["r"], e["q"]["r"]) - slack <= F.col("r")) & (F.col("r") <= F.greatest(e["p"]["r"], e["q"]["r"]) + slack))
    rows = rows.withColumn("xs", F.flatten(F.transform(here, meets))).filter(F.size("xs") > 0)
    lo, hi = F.ceil(F.array_min("xs") - slack).cast("int"), F.floor(F.array_max("xs") + slack).cast("int")
    return rows.withColumn("lo", lo).withColumn("hi", hi).filter("lo <= hi").withColumn("c", F.explode(F.sequence("lo", "hi"))).drop("edges", "xs", "lo", "hi")


def fitted_shapes(parts: DataFrame, least_side: float, accept: float) -> DataFrame:
    """frame, part, n, hull_area, rect_area, kind, corners, iou: for each component the rectangle, quadrilateral or triangle that covers its cells best,
    by intersection over union; the hull of at most six corners if none reaches `accept`. Components with a shorter side under least_side
    are slivers and go. Of equals the rectangle wins over the quadrilateral, and that over the triangle."""
    shapes = candidate_shapes(parts).filter(F.col("short_side") >= least_side)
    inside = covered(shapes.select("frame", "part", "kind", "corners")).join(parts.select("frame", "part", "r", "c", F.lit(1).alias("own")), ["frame", "part", "r", "c"], "left")
    counts = inside.groupBy("frame", "part", "kind").agg(F.count("own").alias("both"), F.count(F.lit(1)).alias("size"))
    scored = shapes.join(counts, ["frame", "part", "kind"]).withColumn("iou", F.col("both") / (F.col("size") + F.col("n") - F.col("both")))
    rank = F.when((F.col("kind") == "hull") | (F.col("iou") < accept), F.lit(-1.0)).otherwise(F.col("iou"))
    order = F.when(F.col("kind") == "rectangle", 0).when(F.col("kind") == "quad", 1).when(F.col("kind") == "triangle", 2)
    best = Window.partitionBy("frame", "part").orderBy(F.desc("rank"), F.when(F.col("rank") < 0, F.when(F.col("kind") == "hull", 0).otherwise(1)), order)
    return scored.withColumn("rank", rank).withColumn("k", F.row_number().over(best)).filter("k = 1").select("frame", "part", "n", "hull_area", "rect_area", "kind", "corners", "iou")

"""Dense depth from sparse samples: Delaunay triangles, planes of segments, nearest of the same segment, medians, and overrides.

Only the triangulation of a frame's samples runs in a grouped map; triangles are rows then, and the cells that they cover, like every
later step, are columns and joins that keep to a frame's raster.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Point = tuple[int, int]
#: Stands for the point at infinity that closes the hull.
FAR = -1


def cross(a: Point, b: Point, c: Point) -> int:
    """Twice the area of a triangle; positive if it turns left."""
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def nudge(p: Point) -> int:
    """How four points on one circle are told apart: a small, fixed height for each place, as if points were lifted by it beside x^2 + y^2."""
    return ((p[0] * 7919 + p[1] * 104729) * (p[0] * 31 + p[1] * 17 + 5)) % 10007


def in_circle(a: Point, b: Point, c: Point, p: Point) -> bool:
    """Whether p lies in the circle of a left-turning triangle; exact, and of points on the circle those that nudge() puts below."""
    main = rest = 0
    for u, v, w in ((a, b, c), (b, c, a), (c, a, b)):
        area = (v[0] - p[0]) * (w[1] - p[1]) - (v[1] - p[1]) * (w[0] - p[0])
        main += ((u[0] - p[0]) ** 2 + (u[1] - p[1]) ** 2) * area
        rest += (nudge(u) - nudge(p)) * area
    return (main, rest) > (0, 0)


def delaunay(points: list[Point]) -> list[tuple[int, int, int]]:
    """Triangles (places in `points`, turning left) of distinct integer points; none if all lie on a line.

    Points come in from left to right, so the last one is always on the hull, and the hull's edges at it tell where the next one lies. What a new
    point's circle test gives up is one region; its border gets the new point as apex. Edges know their triangle's third corner; FAR closes the hull.
    """
    order = sorted(range(len(points)), key=points.__getitem__)
    third = next((k for k in range(2, len(order)) if cross(points[order[0]], points[order[1]], points[order[k]])), None)
    if third is None:
        return []
    apex: dict[tuple[int, int], int] = {}

    def add(a: int, b: int, c: int) -> None:
        apex[a, b], apex[b, c], apex[c, a] = c, a, b

    chain, top = order[:third], order[third]
    left = cross(points[chain[0]], points[chain[1]], points[top]) > 0
    for a, b in zip(chain, chain[1:], strict=False):
        add(*((a, b, top) if left else (b, a, top)))
    for a, b in [e for e in apex if (e[1], e[0]) not in apex]:
        add(b, a, FAR)

    def gives_way(a: int, b: int, c: int, p: Point) -> bool:
        if FAR not in (a, b, c):
            return in_circle(points[a], points[b], points[c], p)
        a, b = {a: (b, c), b: (c, a), c: (a, b)}[FAR]
        side = cross(points[a], points[b], p)
        return side > 0 or (side == 0 and min(points[a], points[b]) < p < max(points[a], points[b]))

    last = top
    for new in order[third + 1 :]:
        p = points[new]
        before = apex[last, FAR]  # the hull's corner beside the last one; the other side's is found through it
        start = next(t for t in ((last, FAR, before), (FAR, last, apex[FAR, last])) if gives_way(*t, p))
        gone, todo, border = set(), [start], []
        while todo:
            a, b, c = todo.pop()
            if (a, b) in gone:
                continue
            gone |= {(a, b), (b, c), (c, a)}
            for u, v in ((a, b), (b, c), (c, a)):
                w = apex[v, u]
                if (v, u) in gone:
                    continue
                if gives_way(v, u, w, p):
                    todo.append((v, u, w))
                else:
                    border.append((u, v))
        border = [e for e in border if (e[1], e[0]) not in gone]
        for e in gone:
            del apex[e]
        for u, v in border:
            add(u, v, new)
        last = new
    return [(a, b, c) for (a, b), c in apex.items() if FAR not in (a, b, c) and a < b and a < c]


TRIANGLES = "frame long, ar int, ac int, az double, br int, bc int, bz double, cr int, cc int, cz double"


def triangles(samples: DataFrame) -> DataFrame:
    """The Delaunay triangles of each frame's samples (frame, r, c, z), one sample a cell. A frame's samples are one task's work."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["r", "c"], ignore_index=True)
        points = list(zip(rows["r"].tolist(), rows["c"].tolist(), strict=True))
        z, out = rows["z"].tolist(), []
        for t in delaunay(points):
            out.append([rows["frame"].iloc[0], *[v for k in t for v in (*points[k], z[k])]])
        return pd.DataFrame(out, columns=[c.split()[0] for c in TRIANGLES.split(", ")])

    return samples.select("frame", "r", "c", "z").groupBy("frame").applyInPandas(one, TRIANGLES)


def between_samples(found: DataFrame) -> DataFrame:
    """frame, r, c, z: the cells in or on triangles, linear between their corners. Each row of a triangle is a span of cells."""
    corners = [(F.col(f"{k}r"), F.col(f"{k}c"), F.col(f"{k}z")) for k in "abc"]
    rows = found.withColumn("r", F.explode(F.sequence(F.least("ar", "br", "cr"), F.greatest("ar", "br", "cr"))))

    def area(p: tuple[Column, ...], q: tuple[Column, ...], r: Column, c: Column) -> Column:
        return (q[0] - p[0]) * (c - p[1]) - (q[1] - p[1]) * (r - p[0])

    ups, downs, fits = [], [], F.lit(True)
    for p, q in zip(corners, corners[1:] + corners[:1], strict=True):
        step, at_zero = q[0] - p[0], area(p, q, F.col("r"), F.lit(0))
        ups.append(F.when(step > 0, F.ceil(-at_zero / step)))
        downs.append(F.when(step < 0, F.floor(-at_zero / step)))
        fits = fits & ((step != 0) | (at_zero >= 0))
    spans = rows.filter(fits).withColumn("lo", F.greatest(*ups).cast("int")).withColumn("hi", F.least(*downs).cast("int")).filter("lo <= hi")
    cells = spans.withColumn("c", F.explode(F.sequence("lo", "hi")))
    weights = [area(corners[(k + 1) % 3], corners[(k + 2) % 3], F.col("r"), F.col("c")) for k in range(3)]
    z = sum((w * corner[2] for w, corner in zip(weights, corners, strict=True)), F.lit(0.0)) / area(corners[0], corners[1], corners[2][0], corners[2][1])
    return cells.select("frame", "r", "c", z.alias("z")).groupBy("frame", "r", "c").agg(F.min("z").alias("z"))


def planes(samples: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pr, pc, p0: z = p0 + pr * r + pc * c with the least squared error; no row where the samples lie on a line."""
    m = samples.groupBy(*keys).agg(
        F.avg("r").alias("mr"),
        F.avg("c").alias("mc"),
        F.avg("z").alias("mz"),
        *[F.covar_pop(a, b).alias(f"v{a}{b}") for a, b in ("rr", "rc", "cc", "rz", "cz")],
    )
    det = F.expr("vrr * vcc - vrc * vrc")
    pr, pc = F.expr("(vrz * vcc - vcz * vrc)") / F.col("det"), F.expr("(vcz * vrr - vrz * vrc)") / F.col("det")
    m = m.withColumn("det", det).filter("det > 1e-9").withColumn("pr", pr).withColumn("pc", pc)
    return m.select(*keys, "pr", "pc", F.expr("mz - pr * mr - pc * mc").alias("p0"))


def nearest_known(cells: DataFrame, known: DataFrame) -> DataFrame:
    """frame, r, c, nr, nc: for each cell the nearest known one (frame, r, c), of equals the one above, then left.

    First up and down each column, then along the row over the columns' finds: a cell meets twice its raster's width and not its raster.
    """
    rows = cells.select("frame", "r").distinct()
    columns = known.select("frame", "c").distinct()
    k = known.select("frame", "r", "c", F.col("r").alias("k"))
    grid = rows.join(columns, "frame").join(k, ["frame", "r", "c"], "left")
    column = Window.partitionBy("frame", "c").orderBy("r")
    up = F.last("k", ignorenulls=True).over(column.rowsBetween(Window.unboundedPreceding, 0))
    down = F.first("k", ignorenulls=True).over(column.rowsBetween(0, Window.unboundedFollowing))
    # A known cell may lie above or below every row that asks, so rows of known cells take part too.
    grid = grid.unionByName(known.join(rows, ["frame", "r"], "left_anti").select("frame", "r", "c", F.col("r").alias("k")))
    ends = grid.withColumn("up", up).withColumn("down", down).select("frame", "r", F.col("c").alias("nc"), F.explode(F.array_distinct(F.array("up", "down"))).alias("nr")).filter("nr is not null")
    pairs = cells.select("frame", "r", "c").join(ends, ["frame", "r"])
    best = F.min(F.struct(F.expr("(nr - r) * (nr - r) + (nc - c) * (nc - c)").alias("d"), "nr", "nc"))
    return pairs.groupBy("frame", "r", "c").agg(best.alias("b")).select("frame", "r", "c", "b.nr", "b.nc")


def densified(image: DataFrame, samples: DataFrame, ground: list[str], overrides: dict[str, float], least: int = 3) -> DataFrame:
    """frame, r, c, z, source of every cell of image(frame, r, c, seg, ego) whose depth is known or can be filled, in this order:

    seen: a sample (frame, r, c, z); triangle: ground inside the ground samples' hull; plane: ground elsewhere, where the plane of its frame's ground
    samples is in front of the camera; nearest: the nearest known cell, if it is of the same segment; median: that of the segment, with at
    least `least` known cells. Overrides come last: ego cells, and segments that have a fixed depth. overrides["ego"] is that of ego cells.
    """
    cells = image.join(samples.select("frame", "r", "c", F.col("z").alias("seen")), ["frame", "r", "c"], "left").withColumn("ground", F.coalesce(F.col("seg").isin(ground), F.lit(False)))
    road = cells.filter("ground and seen is not null").select("frame", "r", "c", F.col("seen").alias("z"))
    inside = between_samples(triangles(road)).withColumnRenamed("z", "linear")
    cells = cells.join(inside, ["frame", "r", "c"], "left").join(planes(road, ["frame"]), "frame", "left")
    plane = F.expr("p0 + pr * r + pc * c")
    z = F.when(F.col("seen").isNotNull(), F.col("seen")).when(F.col("ground"), F.coalesce("linear", F.when(plane > 0, plane)))
    source = F.when(F.col("seen").isNotNull(), "seen").when(F.col("ground") & F.col("linear").isNotNull(), "triangle").when(F.col("ground") & (plane > 0), "plane")
    cells = cells.select("frame", "r", "c", "seg", "ego", z.alias("z"), source.alias("source"))

    known = cells.filter("z is not null").select("frame", "r", "c", "z", "seg")
    near = nearest_known(cells.filter("z is null and seg is not null"), known)
    near = near.join(known.toDF("frame", "nr", "nc", "near_z", "near_seg"), ["frame", "nr", "nc"]).select("frame", "r", "c", "near_z", "near_seg")
    cells = cells.join(near, ["frame", "r", "c"], "left").withColumn("own", F.coalesce(F.col("near_seg") == F.col("seg"), F.lit(False)))
    cells = cells.withColumn("source", F.coalesce("source", F.when(F.col("own"), "nearest"))).withColumn("z", F.coalesce("z", F.when(F.col("own"), F.col("near_z"))))

    medians = cells.filter("z is not null and seg is not null").groupBy("frame", "seg").agg(F.percentile("z", F.lit(0.5)).alias("median"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    cells = cells.join(medians.drop("n"), ["frame", "seg"], "left")
    fixed = F.when(F.col("ego"), F.lit(overrides["ego"]))
    for seg, depth in overrides.items():
        fixed = F.coalesce(fixed, F.when(F.col("seg") == seg, F.lit(depth)))
    source = F.when(fixed.isNotNull(), "override").otherwise(F.coalesce("source", F.when(F.col("median").isNotNull(), "median")))
    return cells.select("frame", "r", "c", F.coalesce(fixed, "z", "median").alias("z"), source.alias("source")).filter("z is not null")

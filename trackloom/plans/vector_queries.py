"""Rasters made dense, and rasters made lines and shapes: triangulated depth, skeleton graphs, smoothing splines, fitted shapes, refined alignment."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.scalars import r6
from trackloom.operators import alignment as A
from trackloom.operators import densify as D
from trackloom.operators import grids as G
from trackloom.operators import paint as P
from trackloom.operators import rasters as R
from trackloom.operators import render as N
from trackloom.operators import stereo as S
from trackloom.operators import vectorise as V
from trackloom.plans.grid_queries import CELLS, ORDER, RANK, RC, cells
from trackloom.plans.registry import register
from trackloom.plans.stream_queries import work_folder
from trackloom.sources import publish
from trackloom.sources.tables import read

GROUND = ["AF", "RF", "NO"]
OVERRIDES = {"ego": 0.5, "RO": 80.0}
IMAGE = f"""{CELLS}, n AS (SELECT frame, r, c, cls, count(*) AS n FROM cells GROUP BY ALL), image AS (SELECT frame, r, c, max_by(cls, (n, {RANK})) AS seg, r = 0 AND c BETWEEN 8 AND 14 AS ego FROM n GROUP BY frame, r, c),
samples AS (SELECT frame, r, c, min(z) AS z FROM cells WHERE z > 1.6 GROUP BY ALL)"""


def image(spark: SparkSession, d: str) -> DataFrame:
    """frame, r, c, seg, ego: each cell's majority class as its segment; the middle of the first row is the ego vehicle."""
    seg = G.majority(G.histogram(cells(spark, d), ["frame", *RC]), ["frame", *RC], ORDER)
    return seg.select("frame", *RC, F.col("cls").alias("seg"), F.expr("r = 0 and c between 8 and 14").alias("ego"))


def samples(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).filter("z > 1.6").groupBy("frame", *RC).agg(F.min("z").alias("z"))


_NUDGE = "((({v}.r * 7919 + {v}.c * 104729) * ({v}.r * 31 + {v}.c * 17 + 5)) % 10007)"


def _circle(lifted: str) -> str:
    """The sum of each corner's height over p times the area of the other two with p; lifted says what a height is."""
    parts = [(u, v, w) for u, v, w in (("x", "y", "w"), ("y", "w", "x"), ("w", "x", "y"))]
    return " + ".join(f"({lifted.format(u=u)}) * (({v}.r - p.r) * ({w}.c - p.c) - ({v}.c - p.c) * ({w}.r - p.r))" for u, v, w in parts)


_MAIN = _circle("({u}.r - p.r) * ({u}.r - p.r) + ({u}.c - p.c) * ({u}.c - p.c)")
_REST = _circle(f"{_NUDGE.replace('{v}', '{u}')} - {_NUDGE.format(v='p')}")


@register("r13_triangulated_depth", f"""WITH {IMAGE}, cell AS MATERIALIZED (SELECT i.*, s.z AS seen, coalesce(seg IN ('AF', 'RF', 'NO'), false) AS ground FROM image i LEFT JOIN samples s USING (frame, r, c)),
road AS MATERIALIZED (SELECT frame, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, seen AS z FROM cell WHERE ground AND seen IS NOT NULL),
tri AS MATERIALIZED (SELECT x.frame, x.r AS xr, x.c AS xc, x.z AS xz, y.r AS yr, y.c AS yc, y.z AS yz, w.r AS wr, w.c AS wc, w.z AS wz FROM road x JOIN road y ON y.frame = x.frame AND (y.r, y.c) > (x.r, x.c) JOIN road w ON w.frame = x.frame AND (w.r, w.c) > (x.r, x.c) AND (y.r - x.r) * (w.c - x.c) - (y.c - x.c) * (w.r - x.r) > 0
 WHERE NOT EXISTS (SELECT 1 FROM road p WHERE p.frame = x.frame AND (({_MAIN}) > 0 OR (({_MAIN}) = 0 AND ({_REST}) > 0)))),
inside AS (SELECT i.frame, i.r, i.c, min((k0 * xz + k1 * yz + k2 * wz) / (k0 + k1 + k2)) AS z FROM (SELECT i.frame, i.r, i.c, t.*, (wr - yr) * (i.c - yc) - (wc - yc) * (i.r - yr) AS k0, (xr - wr) * (i.c - wc) - (xc - wc) * (i.r - wr) AS k1, (yr - xr) * (i.c - xc) - (yc - xc) * (i.r - xr) AS k2 FROM cell i JOIN (SELECT frame AS f, xr, xc, xz, yr, yc, yz, wr, wc, wz FROM tri) t ON t.f = i.frame) i WHERE k0 >= 0 AND k1 >= 0 AND k2 >= 0 GROUP BY ALL),
mo AS (SELECT frame, avg(r) AS mr, avg(c) AS mc, avg(z) AS mz, covar_pop(r, r) AS vrr, covar_pop(r, c) AS vrc, covar_pop(c, c) AS vcc, covar_pop(r, z) AS vrz, covar_pop(c, z) AS vcz FROM road GROUP BY frame),
pl AS (SELECT *, (vrz * vcc - vcz * vrc) / (vrr * vcc - vrc * vrc) AS pr, (vcz * vrr - vrz * vrc) / (vrr * vcc - vrc * vrc) AS pc FROM mo WHERE vrr * vcc - vrc * vrc > 0.000000001::DOUBLE),
one AS (SELECT c.frame, c.r, c.c, c.seg, c.ego, c.seen, c.ground, i.z AS linear, CASE WHEN mz + pr * (c.r - mr) + pc * (c.c - mc) > 0 THEN mz + pr * (c.r - mr) + pc * (c.c - mc) END AS plane FROM cell c LEFT JOIN inside i ON i.frame = c.frame AND i.r = c.r AND i.c = c.c LEFT JOIN pl ON pl.frame = c.frame),
two AS MATERIALIZED (SELECT frame, r, c, seg, ego, CASE WHEN seen IS NOT NULL THEN seen WHEN ground THEN coalesce(linear, plane) END AS z, CASE WHEN seen IS NOT NULL THEN 'seen' WHEN ground AND linear IS NOT NULL THEN 'triangle' WHEN ground AND plane IS NOT NULL THEN 'plane' END AS source FROM one),
near AS (SELECT a.frame, a.r, a.c, arg_min(b.z, ((b.r - a.r) ** 2 + (b.c - a.c) ** 2, b.r, b.c)) AS z, arg_min(b.seg, ((b.r - a.r) ** 2 + (b.c - a.c) ** 2, b.r, b.c)) AS seg FROM two a JOIN two b ON a.frame = b.frame AND a.z IS NULL AND b.z IS NOT NULL GROUP BY ALL),
three AS (SELECT t.frame, t.r, t.c, t.seg, ego, coalesce(t.z, CASE WHEN n.seg = t.seg THEN n.z END) AS z, coalesce(source, CASE WHEN n.seg = t.seg THEN 'nearest' END) AS source FROM two t LEFT JOIN near n ON n.frame = t.frame AND n.r = t.r AND n.c = t.c),
med AS (SELECT frame, seg, quantile_cont(z, 0.5) AS mid FROM three WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
four AS (SELECT t.frame, r, c, CASE WHEN ego THEN 0.5::DOUBLE WHEN t.seg = 'RO' THEN 80.0::DOUBLE ELSE coalesce(z, mid) END AS z, CASE WHEN ego OR t.seg = 'RO' THEN 'override' WHEN source IS NULL AND mid IS NOT NULL THEN 'median' ELSE source END AS source FROM three t LEFT JOIN med ON med.frame = t.frame AND med.seg = t.seg)
SELECT frame, r, c, round(z, 6) AS z, source FROM four WHERE z IS NOT NULL""")
def r13_triangulated(spark: SparkSession, d: str) -> DataFrame:
    """Depth of every cell of a frame's image: linear in the Delaunay triangles of the ground's samples, on their plane beyond the hull, as the nearest
    cell of the same segment, or the segment's median; ego and sky are fixed."""
    return D.densified(image(spark, d), samples(spark, d), GROUND, OVERRIDES).select("frame", *RC, r6("z").alias("z"), "source")


def _marks(spark: SparkSession, d: str) -> DataFrame:
    """The high cells of one class: a mask of lines and blobs."""
    return cells(spark, d).filter("cls = 'NF' and z > 1.0").select("frame", *RC).distinct()


MARKS = f"{CELLS}, marks AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF' AND z > 1.0)"
PARTS = f"""{MARKS}, walk(frame, r, c, sr, sc) AS (SELECT frame, r, c, r, c FROM marks UNION SELECT w.frame, n.r, n.c, w.sr, w.sc FROM walk w JOIN marks n ON n.frame = w.frame AND abs(n.r - w.r) <= 1 AND abs(n.c - w.c) <= 1),
p AS MATERIALIZED (SELECT frame, r, c, min(sr * 1000 + sc) AS root FROM walk GROUP BY ALL)"""


@register("r16_skeleton_lines")
def r16_lines(spark: SparkSession, d: str) -> DataFrame:
    """The skeletons of each frame's marks as lines between ends and junctions, without spurs of up to two cells."""
    return V.skeleton_lines(_marks(spark, d), 2)


@register("r17_smooth_lines")
def r17_smooth(spark: SparkSession, d: str) -> DataFrame:
    """Those lines in metres (a cell has four), smoothed: cubics for short ones, splines for those of 40 m or more, a point every metre."""
    lines = r16_lines(spark, d).select("frame", "line", "n", (F.col("c") * 4.0).alias("x"), (F.col("r") * 4.0).alias("y"))
    return V.smoothed_lines(lines, tolerance=1.0).select("frame", "line", "n", r6("x").alias("x"), r6("y").alias("y"))


@register("r19_hull_rectangles", f"""WITH RECURSIVE {PARTS}, n AS (SELECT frame, root, count(*) AS n FROM p GROUP BY ALL),
e AS (SELECT a.frame, a.root, a.r AS ar, a.c AS ac, b.r AS br, b.c AS bc FROM p a JOIN p b ON a.frame = b.frame AND a.root = b.root AND (a.r, a.c) <> (b.r, b.c)
 WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.frame = a.frame AND q.root = a.root AND ((b.r - a.r) * (q.c - a.c) - (b.c - a.c) * (q.r - a.r) < 0
  OR ((b.r - a.r) * (q.c - a.c) - (b.c - a.c) * (q.r - a.r) = 0 AND (q.r - a.r) * (q.r - b.r) + (q.c - a.c) * (q.c - b.c) > 0)))),
h AS (SELECT frame, root, sum(ar * bc - ac * br) / 2.0::DOUBLE AS hull_area FROM e GROUP BY ALL),
x AS (SELECT e.frame, e.root, ar, ac, br, bc, (max((q.r - ar) * (br - ar) + (q.c - ac) * (bc - ac)) - min((q.r - ar) * (br - ar) + (q.c - ac) * (bc - ac))) / sqrt((br - ar) ** 2 + (bc - ac) ** 2) AS along, max((br - ar) * (q.c - ac) - (bc - ac) * (q.r - ar)) / sqrt((br - ar) ** 2 + (bc - ac) ** 2) AS across FROM e JOIN p q ON q.frame = e.frame AND q.root = e.root GROUP BY e.frame, e.root, ar, ac, br, bc)
SELECT x.frame, x.root, n.n, round(h.hull_area, 6) AS hull_area, round(min(along * across), 6) AS rect_area FROM x JOIN h USING (frame, root) JOIN n USING (frame, root) WHERE h.hull_area > 0 GROUP BY x.frame, x.root, n.n, h.hull_area""")
def r19_hulls(spark: SparkSession, d: str) -> DataFrame:
    """Each component of the marks that isn't a line, with the area of its hull and of the smallest rectangle about it."""
    parts = R.components(_marks(spark, d))
    roots = parts.groupBy("frame", "part").agg(F.min(F.expr("r * 1000 + c")).alias("root"))
    shapes = V.candidate_shapes(parts).filter("kind = 'rectangle'").join(roots, ["frame", "part"])
    return shapes.select("frame", "root", F.col("n").cast("long").alias("n"), r6("hull_area").alias("hull_area"), r6("rect_area").alias("rect_area"))


@register("r19_shapes")
def r19_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Each component of the marks as the rectangle, quadrilateral or triangle that covers it best, or its hull; slivers are left out."""
    shapes = V.fitted_shapes(R.components(_marks(spark, d)), 1.2, 0.55)
    corners = F.transform("corners", lambda p: F.struct(F.round(p["r"], 6).alias("r"), F.round(p["c"], 6).alias("c")))
    return shapes.select("frame", "part", "n", "kind", r6("iou").alias("iou"), corners.alias("corners"))


LEVELS, TURNS = 3, [-0.15, -0.1, -0.05, 0.0, 0.05, 0.1, 0.15]


@register("r22_refined_alignment", f"""WITH {CELLS}, a AS MATERIALIZED (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF' AND z > 1.6),
fd AS MATERIALIZED (SELECT frame - 1 AS frame, CAST(r + i AS INT) AS r, CAST(c + j AS INT) AS c, max(4 - i * i - j * j) AS w FROM a, range(-1, 2) p(i), range(-1, 2) q(j) WHERE i * i + j * j <= 1 GROUP BY ALL),
t AS (SELECT DISTINCT frame, turn, CAST(round_even(cos(turn) * r - sin(turn) * c, 0) AS INT) AS r, CAST(round_even(sin(turn) * r + cos(turn) * c, 0) AS INT) AS c FROM a, (VALUES {", ".join(f"({t!r}::DOUBLE)" for t in TURNS)}) v(turn)),
s AS (SELECT t.frame, turn, CAST(f.r - t.r AS INT) AS dr, CAST(f.c - t.c AS INT) AS dc, sum(w) AS score FROM t JOIN fd f ON f.frame = t.frame WHERE f.r - t.r BETWEEN -8 AND 7 AND f.c - t.c BETWEEN -8 AND 7 GROUP BY ALL)
SELECT frame, arg_max(dr, (score, -abs(dr) - abs(dc), dr, dc, turn)) AS dr, arg_max(dc, (score, -abs(dr) - abs(dc), dr, dc, turn)) AS dc, arg_max(turn, (score, -abs(dr) - abs(dc), dr, dc, turn)) AS turn, CAST(max(score) AS BIGINT) AS score FROM s GROUP BY frame""")
def r22_refined(spark: SparkSession, d: str) -> DataFrame:
    """The shift of up to eight cells and the turn that lay a frame's high obstacles best on the next frame's, found from coarse to fine."""
    a = cells(spark, d).filter("cls = 'NF' and z > 1.6").select("frame", *RC).distinct()
    best, _ = A.aligned(a, a.withColumn("frame", F.col("frame") - 1), LEVELS, TURNS)
    return best.filter("score > 0")


HEIGHT, WIDTH, DEPTHS, REACH = 12, 24, [2.0, 2.5, 4.0, 8.0, 40.0], 1
_PIXELS = f"{CELLS}, px AS (SELECT frame, r, c, sum(CAST(floor(z * 50) AS BIGINT)) AS v FROM cells GROUP BY ALL), im AS MATERIALIZED (SELECT f.frame, CAST(r AS INT) AS r, CAST(c AS INT) AS c, CAST(coalesce(v, 0) AS BIGINT) AS v FROM (SELECT DISTINCT frame FROM px) f CROSS JOIN range(0, {HEIGHT}) a(r) CROSS JOIN range(0, {WIDTH}) b(c) LEFT JOIN px USING (frame, r, c))"
_HYPOTHESES = ", ".join(f"({z!r}::DOUBLE, {round(8.0 / z)})" for z in DEPTHS)


@register("x16_patch_depth", f"""WITH {_PIXELS}, h AS (SELECT a.frame, z AS depth, a.r, a.c, a.v AS a, b.v AS b FROM im a CROSS JOIN (VALUES {_HYPOTHESES}) t(z, s) JOIN im b ON b.frame = a.frame + 1 AND b.r = a.r AND b.c = a.c + s),
s AS (SELECT m.frame, m.depth, m.r, m.c, count(*) AS n, CAST(sum(w.a) AS BIGINT) AS a, CAST(sum(w.a * w.a) AS BIGINT) AS aa, CAST(sum(w.b) AS BIGINT) AS b, CAST(sum(w.b * w.b) AS BIGINT) AS bb, CAST(sum(w.a * w.b) AS BIGINT) AS ab
 FROM h m JOIN h w ON w.frame = m.frame AND w.depth = m.depth AND w.r BETWEEN m.r - {REACH} AND m.r + {REACH} AND w.c BETWEEN m.c - {REACH} AND m.c + {REACH} GROUP BY m.frame, m.depth, m.r, m.c HAVING count(*) = {(2 * REACH + 1) ** 2}),
k AS (SELECT frame, r, c, depth, round((n * ab - a * b) / sqrt(CAST(n * aa - a * a AS DOUBLE) * CAST(n * bb - b * b AS DOUBLE)), 9) AS ncc FROM s WHERE n * aa - a * a > 0 AND n * bb - b * b > 0)
SELECT frame, r, c, arg_max(depth, (ncc, depth)) AS depth, round(max(ncc), 6) AS ncc FROM k GROUP BY frame, r, c""")
def x16_patches(spark: SparkSession, d: str) -> DataFrame:
    """For every pixel of a frame's image the depth at which the patch about it agrees best with the next frame's."""
    pixels = cells(spark, d).groupBy("frame", *RC).agg(F.sum(F.floor(F.col("z") * 50)).alias("v"))
    image_ = S.dense_image(pixels, HEIGHT, WIDTH)
    return S.matched_depth(image_, image_.withColumn("frame", F.col("frame") - 1), DEPTHS, 8.0, REACH)


N_ANGLES = 18
_NORMALS = ", ".join(f"({k}, {a!r}::DOUBLE)" for k, a in P.normals(N_ANGLES))
_HALF = "abs(({a}) - ({b}) - floor((({a}) - ({b}) + pi() / 2) / pi()) * pi())"


@register("r34_paint_lines", f"""WITH {MARKS}, v AS MATERIALIZED (SELECT frame, r, c, k AS angle, a, CAST(round_even(r * cos(a) + c * sin(a), 0) AS INT) AS rho FROM marks, (VALUES {_NORMALS}) t(k, a)),
t AS MATERIALIZED (SELECT frame, angle, rho, count(*) AS votes FROM v GROUP BY ALL HAVING count(*) >= 3),
pk AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM t o WHERE o.frame = t.frame AND (o.angle, o.rho) <> (t.angle, t.rho)
 AND ((abs(o.angle - t.angle) <= 1 AND abs(o.rho - t.rho) <= 1) OR (abs(o.angle - t.angle) = {N_ANGLES - 1} AND abs(o.rho + t.rho) <= 1)) AND (o.votes, -o.angle, -o.rho) > (t.votes, -t.angle, -t.rho))),
o AS (SELECT v.*, round(c * cos(a) - r * sin(a), 9) AS t FROM v JOIN pk USING (frame, angle, rho)),
g AS (SELECT *, CASE WHEN t - lag(t) OVER w <= 2 THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY frame, angle, rho ORDER BY t, r, c)),
u AS (SELECT *, CAST(sum(new) OVER (PARTITION BY frame, angle, rho ORDER BY t, r, c) - 1 AS INT) AS run FROM g),
l AS MATERIALIZED (SELECT frame, angle, rho, run, arg_min(r, (t, r, c)) AS r0, arg_min(c, (t, r, c)) AS c0, arg_max(r, (t, r, c)) AS r1, arg_max(c, (t, r, c)) AS c1, count(*) AS cells FROM u GROUP BY frame, angle, rho, run),
ln AS MATERIALIZED (SELECT *, sqrt(CAST((r1 - r0) * (r1 - r0) + (c1 - c0) * (c1 - c0) AS DOUBLE)) AS length, (r0 + r1) / 2.0::DOUBLE AS y, (c0 + c1) / 2.0::DOUBLE AS x, pi() - (angle + 0.5::DOUBLE) * (pi() / {N_ANGLES}) AS h FROM l WHERE (r1 - r0) * (r1 - r0) + (c1 - c0) * (c1 - c0) >= 4),
tv AS (SELECT * FROM ln WHERE abs(c1 - c0) >= 1.4::DOUBLE * abs(r1 - r0)),
nr AS MATERIALIZED (SELECT s.frame, s.angle AS sa, s.rho AS sr, s.run AS sn, m.angle, m.rho, m.run, m.y, m.x, m.h FROM tv s JOIN tv m ON m.frame = s.frame AND sqrt((m.y - s.y) ** 2 + (m.x - s.x) ** 2) <= 6 AND {_HALF.format(a="m.h", b="s.h")} <= radians(25) + 0.000000001::DOUBLE),
gm AS (SELECT frame, sa, sr, sn, atan2(sum(sin(2 * h)), sum(cos(2 * h))) / 2 AS h FROM nr GROUP BY ALL),
of AS (SELECT nr.frame, sa, sr, sn, nr.angle, nr.rho, nr.run, round(y * cos(gm.h) - x * sin(gm.h), 6) AS o FROM nr JOIN gm USING (frame, sa, sr, sn)),
ok AS (SELECT frame, sa, sr, sn FROM of GROUP BY ALL HAVING count(DISTINCT round_even(round(o / 1.5, 6), 0)) >= 3 AND round(max(o) - min(o), 6) BETWEEN 2 AND 9),
st AS (SELECT DISTINCT of.frame, of.angle, of.rho, of.run FROM of JOIN ok USING (frame, sa, sr, sn)),
mk AS (SELECT ln.*, st.frame IS NOT NULL AS striped FROM ln LEFT JOIN st ON st.frame = ln.frame AND st.angle = ln.angle AND st.rho = ln.rho AND st.run = ln.run)
SELECT frame, angle, rho, run, r0, c0, r1, c1, cells, CASE WHEN striped THEN 'stripe' WHEN abs(r1 - r0) >= 2 * greatest(abs(c1 - c0), 1) THEN 'lane'
 WHEN abs(c1 - c0) >= 2 * greatest(abs(r1 - r0), 1) AND length BETWEEN 3 AND 12 AND EXISTS (SELECT 1 FROM mk z WHERE z.frame = mk.frame AND z.striped AND sqrt((z.y - mk.y) ** 2 + (z.x - mk.x) ** 2) <= 5) THEN 'stop' ELSE 'other' END AS kind FROM mk""")
def r34_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of each frame's marks with the runs that support them: stripes of crossings, stop bars near them, lanes, and others."""
    votes = P.ballots(_marks(spark, d), N_ANGLES)
    lines = P.supported(votes, P.maxima(votes, N_ANGLES, 3), 2.0, 2.0)
    crossing = P.stripes(lines, N_ANGLES, 6.0, 25.0, 1.5, 3, (2.0, 9.0))
    return P.named(lines, crossing, 5.0, (3.0, 12.0)).select("frame", "angle", "rho", "run", "r0", "c0", "r1", "c1", "cells", "kind")


_SEGMENTS = "sg AS (SELECT l_orderkey % 50 AS frame, CAST(l_linenumber % 2 AS INT) AS layer, CAST(l_partkey % 13 AS DOUBLE) AS y0, CAST(l_suppkey % 25 AS DOUBLE) AS x0, CAST(l_partkey % 13 AS DOUBLE) + l_quantity / 10 - 2.5 AS y1, CAST(l_suppkey % 25 AS DOUBLE) + l_extendedprice / 20000 - 2.5 AS x1 FROM lineitem WHERE l_returnflag = 'A' AND l_discount > 0.085)"
HALF = 0.7


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """Lane lines of two layers in every frame."""
    return read(spark, d, "lineitem").filter("l_returnflag = 'A' and l_discount > 0.085").selectExpr("l_orderkey % 50 as frame", "cast(l_linenumber % 2 as int) as layer", "cast(l_partkey % 13 as double) as y0", "cast(l_suppkey % 25 as double) as x0", "cast(l_partkey % 13 as double) + l_quantity / 10 - 2.5 as y1", "cast(l_suppkey % 25 as double) + l_extendedprice / 20000 - 2.5 as x1")


@register("r28_thick_lines", f"""WITH {_SEGMENTS}, g AS (SELECT sg.*, CAST(i AS INT) AS r, CAST(j AS INT) AS c FROM sg, range(-5, 19) a(i), range(-5, 32) b(j) WHERE i BETWEEN least(y0, y1) - 2 AND greatest(y0, y1) + 2 AND j BETWEEN least(x0, x1) - 2 AND greatest(x0, x1) + 2),
t AS (SELECT *, coalesce(greatest(least(((c + 0.5::DOUBLE - x0) * (x1 - x0) + (r + 0.5::DOUBLE - y0) * (y1 - y0)) / nullif((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0), 0), 1.0::DOUBLE), 0.0::DOUBLE), 0.0::DOUBLE) AS t FROM g)
SELECT frame, r, c, max(layer) AS layer FROM t WHERE (c + 0.5::DOUBLE - x0 - t * (x1 - x0)) ** 2 + (r + 0.5::DOUBLE - y0 - t * (y1 - y0)) ** 2 <= {HALF * HALF!r}::DOUBLE GROUP BY frame, r, c""")
def r28_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lane lines with a width, as cells."""
    return N.thick_lines(_segments(spark, d), HALF)


@register("r28_composed_render")
def r28_composed(spark: SparkSession, d: str) -> DataFrame:
    """Each frame's map from its area majority, crossing polygons and lane lines, with the ego vehicle's road alone, small holes filled and its edge."""
    area = G.majority(G.histogram(cells(spark, d), ["frame", *RC]), ["frame", *RC], ORDER)
    label = F.when(F.col("cls").isin("AF", "RF", "NO", "AO"), "road").when(F.col("cls") == "RO", "walk").otherwise("other")
    corners = F.posexplode(F.expr("array(struct(r0 as y, c0 as x), struct(r0 + 2 as y, c0 as x), struct(r0 + 2 as y, c0 + 3 as x), struct(r0 as y, c0 + 3 as x))")).alias("seq", "p")
    q = read(spark, d, "lineitem").filter("l_returnflag = 'R' and l_discount > 0.095").selectExpr("l_orderkey % 50 as frame", "l_orderkey * 10 + l_linenumber as poly", "1 as layer", "cast(l_partkey % 11 as double) as r0", "cast(l_suppkey % 22 as double) as c0")
    crossings = R.filled_polygons(q.select("frame", "poly", "layer", corners).select("frame", "poly", "layer", "seq", "p.y", "p.x"))
    lines = N.thick_lines(_segments(spark, d), HALF).select("frame", *RC, F.when(F.col("layer") == 0, "line").otherwise("divider").alias("label"))
    return N.composed(area.select("frame", *RC, label.alias("label")), crossings.select("frame", *RC, F.lit("crossing").alias("label")), lines, ["road", "crossing", "line", "divider"], (HEIGHT, WIDTH), (11, 12), 4, partial(publish.written, folder=work_folder(spark)))

"""Plans, rasters and lines that need several steps: plan headings, back-projection, densified depth, alignment, linking, depth by correlation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import commands as C
from trackloom.functions.scalars import r6
from trackloom.operators import grids as G
from trackloom.operators import matching as M
from trackloom.operators import rasters as R
from trackloom.plans.grid_queries import CELLS, ORDER, RANK, RC, cells
from trackloom.plans.more_queries import POLYLINES, polylines
from trackloom.plans.oracle import POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import pose_track, read

PLANS = """o AS (SELECT o_orderkey, 1 + o_totalprice / 50000 AS v, (o_custkey % 7 - 3) * 0.15::DOUBLE AS c, CAST(o_orderkey * 3 % 11 AS DOUBLE) AS l0, CAST(o_orderkey * 10 % 11 AS DOUBLE) AS l1, CAST(o_orderkey * 17 % 11 AS DOUBLE) AS l2, o_orderkey % 2 = 1 AS hold FROM orders),
b AS (SELECT *, CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS m FROM o),
six AS (SELECT o_orderkey, hold, i, i * v AS x, (m - 1) * c * i * i AS y FROM b, range(1, 7) t(i)),
ends AS (SELECT o_orderkey, hold, max(x) FILTER (i = 6) AS x6, max(y) FILTER (i = 6) AS y6, max(x) FILTER (i = 5) AS x5, max(y) FILTER (i = 5) AS y5 FROM six GROUP BY ALL),
p AS (SELECT o_orderkey, i, x, y FROM six UNION ALL SELECT o_orderkey, 6 + k, CASE WHEN hold THEN x6 ELSE x6 + k * (x6 - x5) END, CASE WHEN hold THEN y6 ELSE y6 + k * (y6 - y5) END FROM ends, range(1, 3) t(k))"""


@register("p22_plan_headings", f"""WITH {PLANS}, d AS (SELECT *, x - coalesce(lag(x) OVER w, 0) AS dx, y - coalesce(lag(y) OVER w, 0) AS dy FROM p WINDOW w AS (PARTITION BY o_orderkey ORDER BY i)),
h AS (SELECT *, coalesce(last_value(CASE WHEN sqrt(dx * dx + dy * dy) > 0.0001 THEN atan2(dy, dx) END IGNORE NULLS) OVER (PARTITION BY o_orderkey ORDER BY i), 0) AS raw FROM d),
s AS (SELECT *, coalesce(raw - lag(raw) OVER (PARTITION BY o_orderkey ORDER BY i), raw) AS step, i > 1 AS later FROM h),
u AS (SELECT *, sum(CASE WHEN later THEN (step + pi()) - floor((step + pi()) / (2 * pi())) * 2 * pi() - pi() ELSE step END) OVER (PARTITION BY o_orderkey ORDER BY i) AS heading FROM s)
SELECT o_orderkey, CAST(i AS INT) AS i, round(x, 7) + 0.0::DOUBLE AS x, round(y, 7) + 0.0::DOUBLE AS y, round(heading, 5) + 0.0::DOUBLE AS heading FROM u""")
def p22(spark: SparkSession, d: str) -> DataFrame:
    """The likeliest of three plans of six points, longer by two (its last step repeated, or held), with headings without jumps."""
    o = read(spark, d, "orders")
    key = F.col("o_orderkey")
    v, c = 1 + F.col("o_totalprice") / 50000, (F.col("o_custkey") % 7 - 3) * 0.15
    logits = F.array(*[(key * k % 11).cast("double") for k in (3, 10, 17)])
    o = o.select("o_orderkey", v.alias("v"), c.alias("c"), C.best_mode(logits, F.array(*map(F.lit, range(3)))).alias("m"))
    six = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.struct((i * F.col("v")).alias("x"), ((F.col("m") - 1) * F.col("c") * i * i).alias("y")))
    longer = F.when(key % 2 == 1, C.extended(F.col("p"), 2, True)).otherwise(C.extended(F.col("p"), 2))
    #: Each explode ends a projection, so that Catalyst doesn't copy what stands before it into every use.
    plan = o.select("o_orderkey", F.explode(F.array(six)).alias("p")).select("o_orderkey", F.explode(F.array(longer)).alias("p"))
    poses = plan.select("o_orderkey", F.posexplode(C.poses(F.col("p"))).alias("k", "q"))
    return poses.select("o_orderkey", (F.col("k") + 1).alias("i"), *[(F.round(f"q.{n}", k) + 0.0).alias(n) for n, k in (("x", 7), ("y", 7), ("heading", 5))])


PITCH = 0.04
_SEEN = "SELECT p_partkey, (p_partkey * 7 % 192 + 0.5 - 96) / 110.0::DOUBLE * z AS xc, (p_partkey * 13 % 108 + 0.5 - 54) / 112.0::DOUBLE * z AS yc, z FROM (SELECT p_partkey, p_retailprice / 50 AS z FROM part)"


@register("r35_back_projection", f"""WITH c AS ({_SEEN}), e AS (SELECT p_partkey, cos({PITCH}::DOUBLE) * z - sin({PITCH}::DOUBLE) * yc + 1.2 AS ex, -xc AS ey, 1.5 - (sin({PITCH}::DOUBLE) * z + cos({PITCH}::DOUBLE) * yc) AS ez FROM c)
SELECT p_partkey, round(ex, 5) AS ex, round(ey, 5) AS ey FROM e WHERE ez > -0.55 AND ez < 0.45 AND ex > -20 AND ex < 80 AND abs(ey) < 50""")
def r35(spark: SparkSession, d: str) -> DataFrame:
    """Pixels with a depth, carried into the ego frame by the camera's pose; only what lies about the ground stays."""
    p = read(spark, d, "part").select("p_partkey", (F.col("p_partkey") * 7 % 192).alias("u"), (F.col("p_partkey") * 13 % 108).alias("v"), (F.col("p_retailprice") / 50).alias("z"))
    turn = [[0.0, -math.sin(PITCH), math.cos(PITCH)], [-1.0, 0.0, 0.0], [0.0, -math.cos(PITCH), -math.sin(PITCH)]]
    x, y, z = back_projected(F.col("u"), F.col("v"), F.col("z"), (110.0, 112.0, 96.0, 54.0), turn, (1.2, 0.0, 1.5))
    e = p.select("p_partkey", x.alias("ex"), y.alias("ey"), z.alias("ez"))
    return e.filter("ez > -0.55 and ez < 0.45 and ex > -20 and ex < 80 and abs(ey) < 50").select("p_partkey", F.round("ex", 5).alias("ex"), F.round("ey", 5).alias("ey"))


def back_projected(u: Column, v: Column, z: Column, intrinsics: tuple[float, float, float, float], turn: list[list[float]], at: tuple[float, float, float]) -> list[Column]:
    """Ego x, y, z of pixel (u, v), its centre, at depth z; intrinsics are (fx, fy, cx, cy), turn and at the camera's pose."""
    fx, fy, cx, cy = intrinsics
    camera = ((u + 0.5 - cx) / fx * z, (v + 0.5 - cy) / fy * z, z)
    return [sum((c * k for c, k in zip(camera, row, strict=True) if k), F.lit(0.0)) + offset for row, offset in zip(turn, at, strict=True)]


@register("r13_dense_depth", f"""WITH {CELLS}, k AS (SELECT frame, r, c, min(z) AS z, min_by(cls, (z, cls)) AS seg FROM cells WHERE cls LIKE 'A%' OR cls LIKE 'R%' GROUP BY ALL), e AS (SELECT frame, r, min(c) AS lo, max(c) AS hi FROM k GROUP BY ALL),
g AS (SELECT e.frame, e.r, CAST(j AS INT) AS c FROM e, range(0, 60) t(j) WHERE j BETWEEN lo AND hi), m AS (SELECT frame, seg, quantile_cont(z, 0.5) AS mid FROM k GROUP BY ALL),
w AS (SELECT g.frame, g.r, g.c, k.z, last_value(k.c IGNORE NULLS) OVER b AS c0, last_value(k.z IGNORE NULLS) OVER b AS z0, last_value(k.seg IGNORE NULLS) OVER b AS s0, first_value(k.c IGNORE NULLS) OVER a AS c1, first_value(k.z IGNORE NULLS) OVER a AS z1, first_value(k.seg IGNORE NULLS) OVER a AS s1
 FROM g LEFT JOIN k USING (frame, r, c) WINDOW b AS (PARTITION BY g.frame, g.r ORDER BY g.c ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY g.frame, g.r ORDER BY g.c ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT w.frame, r, c, round(CASE WHEN z IS NOT NULL THEN z WHEN s0 = s1 AND c1 - c0 <= 3 THEN z0 + (c - c0) / (c1 - c0) * (z1 - z0) WHEN c - c0 <= c1 - c THEN least(z0, m.mid) ELSE least(z1, m.mid) END, 6) AS z, CASE WHEN z IS NOT NULL THEN 'seen' WHEN s0 = s1 AND c1 - c0 <= 3 THEN 'between' ELSE 'segment' END AS source
FROM w JOIN m ON m.frame = w.frame AND m.seg = CASE WHEN c - c0 <= c1 - c THEN s0 ELSE s1 END""")
def r13(spark: SparkSession, d: str) -> DataFrame:
    """Depth of every cell of a row's extent: as seen; else linear between two near neighbours of one segment; else of the nearer
    neighbour's segment, at most its median."""
    k = cells(spark, d).filter("cls like 'A%' or cls like 'R%'").groupBy("frame", *RC).agg(F.min("z").alias("z"), F.min_by("cls", F.struct("z", "cls")).alias("seg"))
    grid = k.groupBy("frame", "r").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).select("frame", "r", F.explode(F.sequence("lo", "hi")).alias("c"))
    known = grid.join(k.withColumn("own", F.struct("c", "z", "seg")), ["frame", *RC], "left").select("frame", *RC, "z", "own")
    back, ahead = (Window.partitionBy("frame", "r").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("c"), F.desc("c")))
    w = known.withColumn("a", F.last("own", ignorenulls=True).over(back)).withColumn("b", F.last("own", ignorenulls=True).over(ahead))
    near = F.when(F.expr("c - a.c <= b.c - c"), F.col("a")).otherwise(F.col("b"))
    mid = k.groupBy("frame", F.col("seg").alias("of")).agg(F.percentile("z", F.lit(0.5)).alias("mid"))
    w = w.withColumn("near", near).withColumn("of", F.col("near.seg")).join(mid, ["frame", "of"])
    between = F.expr("a.seg = b.seg and b.c - a.c <= 3")
    z = F.when(F.col("z").isNotNull(), F.col("z")).when(between, F.expr("a.z + (c - a.c) / (b.c - a.c) * (b.z - a.z)")).otherwise(F.least("near.z", "mid"))
    source = F.when(F.col("z").isNotNull(), "seen").when(between, "between").otherwise("segment")
    return w.select("frame", *RC, r6(z).alias("z"), source.alias("source"))


@register("r14_temporal_votes", f"""WITH {CELLS}, o AS (SELECT DISTINCT frame, r, c, cls[1] AS k FROM cells), occ AS (SELECT DISTINCT frame, r, c FROM o WHERE k = 'A'),
v AS (SELECT o.frame + CAST(t AS INT) AS frame, r, c, count(*) FILTER (k = 'N') AS road, count(*) FILTER (k = 'R') AS side FROM o, range(-2, 3) x(t) WHERE t <> 0 AND o.frame + t BETWEEN 0 AND 49 GROUP BY ALL)
SELECT frame, r, c, CASE WHEN road >= 2 AND road > side THEN 'road' ELSE 'side' END AS label FROM v WHERE ((road >= 2 AND road > side) OR (side >= 2 AND side > road)) AND NOT EXISTS (SELECT 1 FROM occ WHERE occ.frame = v.frame AND occ.r = v.r AND occ.c = v.c)""")
def r14_votes(spark: SparkSession, d: str) -> DataFrame:
    """Cells without a measurement take what two frames either side say of them: at least two votes, and strictly more than the rival's."""
    o = cells(spark, d).select("frame", *RC, F.substring("cls", 1, 1).alias("k")).distinct()
    spread = o.withColumn("t", F.explode(F.array(*map(F.lit, (-2, -1, 1, 2))))).withColumn("frame", F.col("frame") + F.col("t")).filter("frame between 0 and 49")
    v = spread.groupBy("frame", *RC).agg(F.count_if(F.col("k") == "N").alias("road"), F.count_if(F.col("k") == "R").alias("side"))
    label = F.when(F.expr("road >= 2 and road > side"), "road").when(F.expr("side >= 2 and side > road"), "side")
    return v.select("frame", *RC, label.alias("label")).filter("label is not null").join(o.filter("k = 'A'"), ["frame", *RC], "left_anti")


@register("r17_simplified_lines")
def r17(spark: SparkSession, d: str) -> DataFrame:
    """The points of each track that stay within 25 m of it as straight pieces, and the track smoothed by local parabolas."""
    n = pose_track(spark, d).select("scene", (F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid")) - 1).cast("long").alias("n"), "x", "y")
    return R.simplified_lines(n, 25.0).select("scene", "n", "kept", F.round("sx", 5).alias("sx"), F.round("sy", 5).alias("sy"))


_WRAPPED = "abs(({h}) - floor((({h}) + pi()) / (2 * pi())) * 2 * pi())"


@register("r18_linked_ends", f"""WITH RECURSIVE {POLYLINES}, en AS (SELECT scene, line, 0 AS side, xs[1] AS x, ys[1] AS y, atan2(ys[1] - ys[2], xs[1] - xs[2]) AS h FROM v UNION ALL SELECT scene, line, 1, xs[4], ys[4], atan2(ys[4] - ys[3], xs[4] - xs[3]) FROM v),
e AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY line, side) AS i FROM en),
p AS (SELECT a.scene, a.i, b.i AS j, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS dist FROM e a JOIN e b ON a.scene = b.scene AND a.i < b.i AND a.line <> b.line WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 25 AND {_WRAPPED.format(h="abs(a.h - b.h) - pi()")} <= radians(40)),
q AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY dist, i, j) AS k FROM p),
walk(scene, k, used, i, j) AS (SELECT scene, 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT FROM (SELECT DISTINCT scene FROM q)
 UNION ALL SELECT w.scene, q.k, CASE WHEN list_contains(w.used, q.i) OR list_contains(w.used, q.j) THEN w.used ELSE list_concat(w.used, [q.i, q.j]) END, CASE WHEN list_contains(w.used, q.i) OR list_contains(w.used, q.j) THEN NULL ELSE q.i END, q.j FROM walk w JOIN q ON q.scene = w.scene AND q.k = w.k + 1)
SELECT w.scene, a.line AS line_a, a.side AS side_a, b.line AS line_b, b.side AS side_b FROM walk w JOIN e a ON a.scene = w.scene AND a.i = w.i JOIN e b ON b.scene = w.scene AND b.i = w.j""")
def r18(spark: SparkSession, d: str) -> DataFrame:
    """Ends of different lines joined by falling closeness, each end once, that lie within 25 m and face each other within 40 degrees."""
    v = polylines(spark, d)
    p = lambda k: F.col("p")[k]
    end = lambda side, a, b: F.struct(F.lit(side).alias("side"), p(a)["x"].alias("x"), p(a)["y"].alias("y"), F.atan2(p(a)["y"] - p(b)["y"], p(a)["x"] - p(b)["x"]).alias("heading"))
    ends = v.select("scene", "line", F.explode(F.array(end(0, 0, 1), end(1, 3, 2))).alias("e")).select("scene", "line", "e.*")
    return R.linked_lines(ends, 25.0, 40.0)


@register("r22_alignment", f"""WITH {CELLS}, a AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF'), n AS (SELECT frame, count(*) AS n FROM a GROUP BY frame),
s AS (SELECT CAST(x AS INT) AS dr, CAST(y AS INT) AS dc, k * 0.05::DOUBLE AS turn FROM range(-2, 3) p(x), range(-2, 3) q(y), range(-1, 2) t(k)),
m AS (SELECT DISTINCT frame, dr, dc, turn, CAST(round_even(cos(turn) * r - sin(turn) * c, 0) AS INT) + dr AS r, CAST(round_even(sin(turn) * r + cos(turn) * c, 0) AS INT) + dc AS c FROM a, s),
h AS (SELECT m.frame, dr, dc, turn, count(*) AS hits FROM m JOIN a b ON b.frame = m.frame + 1 AND b.r = m.r AND b.c = m.c GROUP BY ALL),
u AS (SELECT h.frame, dr, dc, turn, hits, round(hits / (x.n + y.n - hits), 9) AS iou FROM h JOIN n x ON x.frame = h.frame JOIN n y ON y.frame = h.frame + 1)
SELECT frame, arg_max(dr, (iou, -abs(dr) - abs(dc), dr, dc, turn)) AS dr, arg_max(dc, (iou, -abs(dr) - abs(dc), dr, dc, turn)) AS dc, round(arg_max(turn, (iou, -abs(dr) - abs(dc), dr, dc, turn)), 6) AS turn, round(max(iou), 6) AS iou, max(iou) >= 0.15 AS accepted FROM u GROUP BY frame""")
def r22(spark: SparkSession, d: str) -> DataFrame:
    """The shift and turn that lay a frame's obstacles best on the next frame's, by intersection over union, and whether that is enough."""
    a = cells(spark, d).filter("cls = 'NF'").select("frame", *RC).distinct()
    n = a.groupBy("frame").agg(F.count(F.lit(1)).alias("n"))
    moves = F.explode(F.array(*[F.struct(F.lit(x).alias("dr"), F.lit(y).alias("dc"), F.lit(k * 0.05).alias("turn")) for x, y in G.square(2) for k in (-1, 0, 1)]))
    m = a.withColumn("s", moves).select("frame", "s.*", *RC)
    m = m.select("frame", "dr", "dc", "turn", (F.rint(F.expr("cos(turn) * r - sin(turn) * c")).cast("int") + F.col("dr")).alias("r"), (F.rint(F.expr("sin(turn) * r + cos(turn) * c")).cast("int") + F.col("dc")).alias("c")).distinct()
    hits = m.join(a.withColumn("frame", F.col("frame") - 1), ["frame", *RC]).groupBy("frame", "dr", "dc", "turn").agg(F.count(F.lit(1)).alias("hits"))
    u = hits.join(n, "frame").join(n.select((F.col("frame") - 1).alias("frame"), F.col("n").alias("n2")), "frame").withColumn("iou", F.round(F.expr("hits / (n + n2 - hits)"), 9))
    best = u.groupBy("frame").agg(F.max(F.struct("iou", F.expr("-abs(dr) - abs(dc)").alias("near"), "dr", "dc", "turn")).alias("b"))
    return best.select("frame", "b.dr", "b.dc", r6("b.turn").alias("turn"), r6("b.iou").alias("iou"), (F.col("b.iou") >= 0.15).alias("accepted"))


@register("r28_hybrid_render", f"""WITH {CELLS}, n AS (SELECT frame, r, c, cls, count(*) AS n FROM cells GROUP BY ALL), a AS (SELECT frame, r, c, max_by(cls, (n, {RANK})) AS area, coalesce(sum(n) FILTER (cls = 'NF'), 0) > 0 AS line FROM n GROUP BY ALL),
x AS (SELECT a.*, count(b.frame) AS around FROM a LEFT JOIN a b ON b.frame = a.frame AND abs(b.r - a.r) + abs(b.c - a.c) = 1 AND b.area = a.area GROUP BY ALL)
SELECT frame, r, c, CASE WHEN line THEN 'line' WHEN around = 0 THEN 'edge' ELSE area END AS label FROM x""")
def r28(spark: SparkSession, d: str) -> DataFrame:
    """Areas by majority, lines drawn over them, and cells without a neighbour of their area as edge."""
    n = G.histogram(cells(spark, d), ["frame", *RC])
    area = G.majority(n, ["frame", *RC], ORDER).select("frame", *RC, F.col("cls").alias("area"))
    lines = n.filter("cls = 'NF'").select("frame", *RC, F.lit(True).alias("line"))
    beside = G.offsets(area, [(0, 1), (0, -1), (1, 0), (-1, 0)]).distinct().withColumn("beside", F.lit(True))
    x = area.join(lines, ["frame", *RC], "left").join(beside, ["frame", *RC, "area"], "left")
    return x.select("frame", *RC, F.when(F.col("line"), "line").when(F.col("beside").isNull(), "edge").otherwise(F.col("area")).alias("label"))


ANGLES = [math.radians(15 * (k + 0.5)) for k in range(12)]
_ANGLES = ", ".join(f"({k}, {a!r}::DOUBLE)" for k, a in enumerate(ANGLES))


@register("r34_line_votes", f"""WITH {CELLS}, m AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF'), v AS (SELECT frame, k AS angle, CAST(round_even(r * cos(a) + c * sin(a), 0) AS INT) AS rho, count(*) AS votes FROM m, (VALUES {_ANGLES}) t(k, a) GROUP BY ALL HAVING count(*) >= 3),
s AS (SELECT frame, angle, count(*) AS stripes FROM v GROUP BY ALL) SELECT v.frame, angle, rho, votes, stripes >= 3 AS crossing FROM v JOIN s USING (frame, angle)""")
def r34(spark: SparkSession, d: str) -> DataFrame:
    """Lines by their votes in angle and distance, modulo half a turn; three or more parallel ones are a crossing."""
    m = cells(spark, d).filter("cls = 'NF'").select("frame", *RC).distinct()
    turns = F.explode(F.array(*[F.struct(F.lit(k).alias("angle"), F.lit(a).alias("a")) for k, a in enumerate(ANGLES)]))
    rho = F.rint(F.col("r") * F.cos("s.a") + F.col("c") * F.sin("s.a")).cast("int")
    v = m.withColumn("s", turns).groupBy("frame", F.col("s.angle").alias("angle"), rho.alias("rho")).agg(F.count(F.lit(1)).alias("votes")).filter("votes >= 3")
    stripes = F.count(F.lit(1)).over(Window.partitionBy("frame", "angle"))
    return v.select("frame", "angle", "rho", "votes", (stripes >= 3).alias("crossing"))


BLOBS = f"""{CELLS}, gt AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF'), pr AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'RF' AND z > 1.4),
wg(frame, r, c, sr, sc) AS (SELECT frame, r, c, r, c FROM gt UNION SELECT w.frame, n.r, n.c, w.sr, w.sc FROM wg w JOIN gt n ON n.frame = w.frame AND abs(n.r - w.r) <= 1 AND abs(n.c - w.c) <= 1),
wp(frame, r, c, sr, sc) AS (SELECT frame, r, c, r, c FROM pr UNION SELECT w.frame, n.r, n.c, w.sr, w.sc FROM wp w JOIN pr n ON n.frame = w.frame AND abs(n.r - w.r) <= 1 AND abs(n.c - w.c) <= 1),
cg AS (SELECT frame, root, avg(r) AS y, avg(c) AS x FROM (SELECT frame, r, c, min(sr * 1000 + sc) AS root FROM wg GROUP BY ALL) GROUP BY ALL),
cp AS (SELECT frame, root, avg(r) AS y, avg(c) AS x FROM (SELECT frame, r, c, min(sr * 1000 + sc) AS root FROM wp GROUP BY ALL) GROUP BY ALL HAVING count(*) >= 2),
a AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY root) AS k FROM cp WHERE x < 18), o AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY root) AS j FROM cg),
c AS (SELECT a.frame, a.k, list(o.j ORDER BY sqrt((a.x - o.x) ** 2 + (a.y - o.y) ** 2), o.j) AS may FROM a JOIN o ON a.frame = o.frame WHERE sqrt((a.x - o.x) ** 2 + (a.y - o.y) ** 2) < 2.5 GROUP BY a.frame, a.k),
walk(frame, k, used, j) AS (SELECT frame, 0::BIGINT, []::BIGINT[], NULL::BIGINT FROM (SELECT DISTINCT frame FROM a)
 UNION ALL SELECT frame, k, CASE WHEN j IS NULL THEN used ELSE list_append(used, j) END, j FROM (SELECT w.frame, w.k + 1 AS k, w.used, list_filter(c.may, lambda m: NOT list_contains(w.used, m))[1] AS j FROM walk w JOIN a ON a.frame = w.frame AND a.k = w.k + 1 LEFT JOIN c ON c.frame = w.frame AND c.k = w.k + 1)),
t AS (SELECT o.*, EXISTS (SELECT 1 FROM walk w WHERE w.frame = o.frame AND w.j = o.j) AS hit FROM o)"""


@register("a31_blob_metrics", f"""WITH RECURSIVE {BLOBS} SELECT (SELECT count(*) FROM a) AS said, count(*) AS truths, count(*) FILTER (hit) AS tp, round(count(*) FILTER (hit) / (SELECT greatest(count(*), 1) FROM a), 6) AS precision, round(count(*) FILTER (hit) / greatest(count(*), 1), 6) AS recall, round(count(*) FILTER (hit AND y > 6) / greatest(count(*) FILTER (y > 6), 1), 6) AS far_recall FROM t""")
def a31(spark: SparkSession, d: str) -> DataFrame:
    """Blobs of two masks matched by their centroids, in scan order, each truth once. Predictions of one cell are noise, and those in
    the columns from 18 on are neither right nor wrong."""
    every = cells(spark, d)
    masks = {"truth": (every.filter("cls = 'NF'"), 1), "said": (every.filter("cls = 'RF' and z > 1.4"), 2)}
    blob = lambda df, least: R.components(df.select("frame", *RC).distinct(), least).groupBy("frame", F.col("part").alias("id")).agg(F.avg("r").alias("y"), F.avg("c").alias("x"))
    found = {name: blob(*mask).select("frame", "id", F.lit("").alias("cls"), F.lit(0.0).alias("score"), "x", "y", F.lit(0.0).alias("w"), F.lit(0.0).alias("l")) for name, mask in masks.items()}
    said = found["said"].filter("x < 18")
    hits = M.match(said, found["truth"], M.listed_order, 2.5).filter("truth is not null")
    t = hits.select("frame", F.col("truth").alias("id"), F.col("pred").isNotNull().alias("hit")).join(found["truth"].select("frame", "id", "y"), ["frame", "id"])
    out = t.agg(F.count(F.lit(1)).alias("truths"), F.count_if("hit").alias("tp"), F.count_if(F.expr("hit and y > 6")).alias("far"), F.count_if(F.col("y") > 6).alias("fars"))
    out = out.join(said.agg(F.count(F.lit(1)).alias("said")))  # one row each
    one = F.lit(1)
    return out.select("said", "truths", "tp", r6(F.col("tp") / F.greatest("said", one)).alias("precision"), r6(F.col("tp") / F.greatest("truths", one)).alias("recall"), r6(F.col("far") / F.greatest("fars", one)).alias("far_recall"))


@register("a42_model_average", "SELECT label, list(m ORDER BY i) AS mean FROM (SELECT label, i, round(avg(embedding[i]::DOUBLE), 6) AS m FROM embeddings, range(1, 65) t(i) WHERE i <= len(embedding) GROUP BY ALL) GROUP BY label")
def a42(spark: SparkSession, d: str) -> DataFrame:
    """Element-wise mean of the vectors of each label: partial sums by element first, so no task holds all vectors."""
    e = read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    per = e.groupBy("label", "i").agg(r6(F.avg(F.col("v").cast("double"))).alias("m"))
    return per.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))


@register("x16_depth_by_correlation", f"""WITH {POSE}, n AS (SELECT scene, x, y, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS n FROM pose),
k AS (SELECT a.scene, a.n // 8 AS patch, d AS shift, round(corr(a.x, b.y), 9) AS ncc FROM n a, range(0, 5) t(d), n b WHERE b.scene = a.scene AND b.n = a.n + d GROUP BY ALL HAVING count(*) = 8)
SELECT scene, patch, arg_max(shift, (ncc, -shift)) AS shift, round(max(ncc), 6) AS ncc FROM k WHERE ncc IS NOT NULL GROUP BY scene, patch""")
def x16(spark: SparkSession, d: str) -> DataFrame:
    """For every patch of one signal the shift at which another agrees with it best, by normalised cross-correlation."""
    n = pose_track(spark, d).select("scene", "x", "y", (F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid")) - 1).cast("long").alias("n"))
    a = n.select("scene", "x", F.expr("n div 8").alias("patch"), "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("shift")).withColumn("n", F.col("n") + F.col("shift"))
    k = a.join(n.select("scene", "n", F.col("y").alias("other")), ["scene", "n"]).groupBy("scene", "patch", "shift").agg(F.covar_pop("x", "other").alias("both"), (F.stddev_pop(F.when(F.col("other").isNotNull(), F.col("x"))) * F.stddev_pop(F.when(F.col("x").isNotNull(), F.col("other")))).alias("apart"), F.count(F.lit(1)).alias("size"))
    # A flat side has no correlation: NaN, which like in SQL is larger than all numbers. F.corr would divide by zero.
    ncc = F.when(F.col("apart") == 0, float("nan")).otherwise(F.round(F.try_divide("both", "apart"), 9))
    best = k.filter("size = 8").withColumn("ncc", ncc).filter("ncc is not null").groupBy("scene", "patch").agg(F.max(F.struct("ncc", (-F.col("shift")).alias("s"))).alias("b"))
    top = F.col("b.ncc")
    six = F.signum(top) * F.floor(F.abs(top) * 1e6 + 0.5) / 1e6 + 0.0  # in doubles, as in SQL: nine decimals that end in 500 are no ties there
    return best.select("scene", "patch", (-F.col("b.s")).alias("shift"), F.when(F.isnan(top), top).otherwise(six).alias("ncc"))


TRIES, NEAR_TRIES, STRIDE = 64, 6, 1009


@register("q15_retry_walk", f"""WITH n AS (SELECT max(event_id) + 1 AS n FROM events), bad AS (SELECT event_id FROM events WHERE event_type = 'error'), w AS (SELECT bad.event_id, k, (bad.event_id + k * {STRIDE}) % n.n AS other FROM bad, n, range(1, {TRIES}) t(k))
SELECT w.event_id, min(k) AS tries, arg_min(other, k) AS taken FROM w JOIN events e ON e.event_id = w.other AND e.event_type <> 'error' GROUP BY w.event_id""")
def q15(spark: SparkSession, d: str) -> DataFrame:
    """What stands in for a sample that can't be read: the first readable one on a walk of fixed stride."""
    e = read(spark, d, "events")
    n = e.agg((F.max("event_id") + 1).alias("n"))  # one row
    bad, fine = e.filter("event_type = 'error'").select("event_id"), e.filter("event_type <> 'error'").select(F.col("event_id").alias("other"))

    def walked(left: DataFrame, first: int, last: int) -> DataFrame:
        steps = F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long")))
        walk = left.join(F.broadcast(n)).withColumn("k", steps).withColumn("other", (F.col("event_id") + F.col("k") * STRIDE) % F.col("n"))
        return walk.join(fine.hint("merge"), "other").groupBy("event_id").agg(F.min("k").alias("tries"), F.min_by("other", "k").alias("taken"))

    # Few walks are long: the rest of the steps is made for those alone that have found nothing in the first.
    near = walked(bad, 1, NEAR_TRIES)
    return near.unionByName(walked(bad.join(near.select("event_id").hint("merge"), "event_id", "left_anti"), NEAR_TRIES + 1, TRIES - 1))

"""Evaluation in full: detection by class and zone with shape errors (A23), plans taken apart (A25), classes (A32), chains (A38), boundaries (A45), lamps (A47)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import r6
from trackloom.operators import evaluation as E
from trackloom.operators import grids as G
from trackloom.operators import matching as M
from trackloom.plans.grid_queries import CELLS, ORDER, RANK, RC, cells
from trackloom.plans.kernel_queries import FRAMED, NEAR, ORDERS, framed, greedy
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import pose_track, read

_ONE = f"{BOXES}, fr AS (SELECT frame // {ORDERS} AS frame, box AS id, min(cls) AS cls, min(score) AS score, min(x) AS x, min(y) AS y, min(w) AS w, min(l) AS l FROM boxes GROUP BY 1, 2)"
_YAW = "((id * 37) % 63) * 0.1::DOUBLE - 3.1::DOUBLE"
_CORNER = [f"({{b}}x + {a} * {{b}}l / 2 * cos({{b}}yaw) - {c} * {{b}}w / 2 * sin({{b}}yaw), {{b}}y + {a} * {{b}}l / 2 * sin({{b}}yaw) + {c} * {{b}}w / 2 * cos({{b}}yaw))" for a, c in ((1, 1), (1, -1), (-1, -1), (-1, 1))]


def _corner_sql() -> str:
    px = [c.format(b="p.")[1:-1].split(", ") for c in _CORNER]
    tx = [c.format(b="t.")[1:-1].split(", ") for c in _CORNER]
    turns = [" + ".join(f"sqrt(({px[i][0]} - ({tx[(i - k) % 4][0]})) ** 2 + ({px[i][1]} - ({tx[(i - k) % 4][1]})) ** 2)" for i in range(4)) for k in range(4)]
    return "least(" + ", ".join(f"({t}) / 4" for t in turns) + ")"


_DY = "abs((p.yaw - t.yaw + pi()) - floor((p.yaw - t.yaw + pi()) / (2 * pi())) * 2 * pi() - pi())"
_X, _Y = "coalesce(t.x, p.x)", "coalesce(t.y, p.y)"


@register("a23_shape_errors", greedy("1", "score DESC, ", NEAR, f"{NEAR} < 20").replace(FRAMED, _ONE) + f""", g AS (SELECT *, {_YAW} AS yaw FROM fr),
r AS (SELECT coalesce(t.cls, p.cls) AS cls, CASE WHEN {_X} >= 0 AND {_X} < 40 THEN 'ahead' WHEN {_X} >= 40 AND {_X} <= 80 THEN 'far ahead' WHEN {_X} < 0 AND {_X} > -40 THEN 'behind' WHEN {_X} <= -40 AND {_X} >= -80 THEN 'far behind' END AS at_, mine IS NOT NULL AND other IS NOT NULL AS tp, other IS NULL AS fp, mine IS NULL AS fn, distance AS centre,
 abs(p.l - t.l) AS length, abs(p.w - t.w) AS width, degrees(least({_DY}, pi() - {_DY})) AS yaw, CASE WHEN {_DY} > pi() / 2 THEN 1.0::DOUBLE WHEN {_DY} <= pi() / 2 THEN 0.0::DOUBLE END AS flipped, CASE WHEN mine IS NOT NULL AND other IS NOT NULL THEN {_corner_sql()} END AS corner,
 {_X} ** 2 + {_Y} ** 2 < 2500 AS in_50, {_X} ** 2 + {_Y} ** 2 < 900 AND abs({_Y}) < 12 AS near FROM every e LEFT JOIN g p ON p.frame = e.frame AND p.id = e.mine LEFT JOIN g t ON t.frame = e.frame AND t.id = e.other),
z AS (SELECT *, at_ AS zone FROM r WHERE at_ IS NOT NULL UNION ALL SELECT *, 'all' FROM r)
SELECT cls, zone, count(*) FILTER (tp) AS tp, count(*) FILTER (fp) AS fp, count(*) FILTER (fn) AS fn, round(count(*) FILTER (tp) / greatest(count(*) FILTER (tp OR fp), 1), 6) AS precision, round(count(*) FILTER (tp) / greatest(count(*) FILTER (tp OR fn), 1), 6) AS recall, round(avg(centre), 4) AS centre, round(avg(length), 4) AS length, round(avg(width), 4) AS width, round(avg(yaw), 4) AS yaw, round(avg(flipped), 4) AS flipped, round(avg(corner), 4) AS corner,
 round(count(*) FILTER (tp AND in_50) / greatest(count(*) FILTER (in_50 AND NOT fp), 1), 6) AS recall_50, round(count(*) FILTER (tp AND near) / greatest(count(*) FILTER (near AND NOT fp), 1), 6) AS recall_near FROM z GROUP BY cls, zone""")
def a23_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Matched, false and missed boxes by class and zone, with what the matched ones get wrong in place, size, yaw and corners."""
    one = framed(spark, d).groupBy("frame", F.col("box").alias("id")).agg(*[F.min(c).alias(c) for c in ("cls", "score", "x", "y", "w", "l")])
    one = one.withColumn("yaw", F.expr("(id * 37) % 63 * 0.1D - 3.1D"))
    pred, truth = one.filter("id % 2 = 1"), one.filter("id % 2 = 0")
    report = E.detection_report(M.match(pred, truth, M.score_first, 20.0), pred, truth)
    rates = [r6(c).alias(c) for c in ("precision", "recall", "recall_50", "recall_near")]
    return report.select("cls", "zone", "tp", "fp", "fn", *rates, *[F.round(c, 4).alias(c) for c in ("centre", "length", "width", "yaw", "flipped", "corner")])


_PLAN = """m AS (SELECT o_orderkey AS sample, k AS mode, CAST(o_orderkey * (3 + 7 * k) % 11 AS DOUBLE) AS score, h, h * 0.5 * (o_custkey % 17 + k * 0.3::DOUBLE) AS x, (k - 1) * h * h * 0.05::DOUBLE AS y FROM orders, range(0, 3) a(k), range(1, 7) b(h)),
t AS (SELECT o_orderkey AS sample, h, h * 0.5::DOUBLE * (o_custkey % 17) * (1 + o_orderkey % 3 * 0.02::DOUBLE) AS x, (o_custkey % 5 - 2) * h * h * 0.04::DOUBLE AS y, CAST(o_custkey % 17 AS DOUBLE) AS v FROM orders, range(1, 7) b(h))"""


@register("a25_plan_report", f"""WITH {_PLAN}, e AS (SELECT m.*, t.x AS tx, t.y AS ty, v, sqrt((m.x - t.x) ** 2 + (m.y - t.y) ** 2) AS e FROM m JOIN t USING (sample, h)),
p AS (SELECT sample, mode, max(score) AS score, avg(e) AS ade, max(e) FILTER (h = 6) AS fde, max(x - tx) FILTER (h = 1) AS ahead, avg(sqrt((v * h * 0.5 - tx) ** 2 + ty ** 2)) AS cv, max(v) AS v, max(ty) FILTER (h = 6) AS aside FROM e GROUP BY sample, mode),
s AS (SELECT *, min(ade) OVER (PARTITION BY sample) AS oracle, row_number() OVER (PARTITION BY sample ORDER BY score DESC, mode) AS place FROM p)
SELECT round(avg(ade), 6) AS ade, round(avg(fde), 6) AS fde, round(avg(oracle), 6) AS oracle, round(avg(cv), 6) AS cv, round(avg(ade) FILTER (v > 2), 6) AS moving, round(avg(ade) FILTER (v <= 2), 6) AS stopped, round(avg(ade) FILTER (abs(aside) > 2), 6) AS curve, round(avg(ahead) FILTER (v >= 8 AND v < 15), 6) AS bias, count(*) AS n FROM s WHERE place = 1""")
def a25_report(spark: SparkSession, d: str) -> DataFrame:
    """Three plans an order against its path: the chosen one, the best one, going straight on, and parts of the samples."""
    o = read(spark, d, "orders").withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(6))))
    truth = o.selectExpr("o_orderkey as sample", "h", "h * 0.5D * (o_custkey % 17) * (1 + o_orderkey % 3 * 0.02D) as x", "(o_custkey % 5 - 2) * h * h * 0.04D as y", "cast(o_custkey % 17 as double) as v")
    modes = o.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2)))).selectExpr("o_orderkey as sample", "k as mode", "cast(o_orderkey * (3 + 7 * k) % 11 as double) as score", "h", "h * 0.5D * (o_custkey % 17 + k * 0.3D) as x", "(k - 1) * h * h * 0.05D as y")
    report = E.plan_report(modes, truth, 6, 0.5)
    return report.select(*[r6(c).alias(c) for c in ("ade", "fde", "oracle", "cv", "moving", "stopped", "curve", "bias")], "n")


@register("a32_class_report", f"""WITH {CELLS}, n AS (SELECT frame, r, c, cls, count(*) AS n FROM cells GROUP BY ALL), m AS (SELECT frame, r, c, max_by(cls, (n, {RANK})) AS cls FROM n GROUP BY frame, r, c),
b AS (SELECT a.cls AS truth, b.cls AS said FROM m a FULL JOIN (SELECT frame - 1 AS frame, r, c, cls FROM m) b ON b.frame = a.frame AND b.r = a.r AND b.c = a.c), k AS (SELECT DISTINCT cls FROM m),
x AS (SELECT k.cls, count(*) FILTER (truth = k.cls AND said = k.cls) AS tp, count(*) FILTER (said = k.cls AND truth IS DISTINCT FROM k.cls) AS fp, count(*) FILTER (truth = k.cls AND said IS DISTINCT FROM k.cls) AS fn FROM b, k GROUP BY k.cls)
SELECT cls, tp, fp, fn, round(tp / greatest(tp + fp, 1), 6) AS precision, round(tp / greatest(tp + fn, 1), 6) AS recall, round((tp + fp) / greatest(tp + fn, 1), 6) AS ratio, round((tp + fp) / nullif(tp + fn, 0), 6) AS thickness FROM x""")
def a32_report(spark: SparkSession, d: str) -> DataFrame:
    """Each frame's classes against the next one's: precision, recall and how much area the latter has."""
    m = G.majority(G.histogram(cells(spark, d), ["frame", *RC]), ["frame", *RC], ORDER)
    truth, said = m.select("frame", *RC, F.col("cls").alias("truth")), m.select((F.col("frame") - 1).alias("frame"), *RC, F.col("cls").alias("said"))
    report = E.class_report(truth.join(said, ["frame", *RC], "full"))
    return report.select("cls", "tp", "fp", "fn", *[r6(c).alias(c) for c in ("precision", "recall", "ratio", "thickness")])


CHAIN = 4


@register("a38_chains_and_recovery", f"""WITH {POSE}, s AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS n FROM pose), k AS (SELECT *, n // 2 AS k, max(n // 2) OVER (PARTITION BY scene) + 1 AS size FROM s WHERE n % 2 = 0),
f AS (SELECT *, k // {CHAIN} * {CHAIN} AS first FROM k), c AS (SELECT a.scene, a.first, a.k - a.first + 1 AS place, bool_and(b.kind <> 'error') AS whole, sum(b.x * 0.1 - b.y * 0.1) AS dx, sum(b.y * 0.05 - b.x * 0.02) AS dy FROM f a JOIN f b ON b.scene = a.scene AND b.first = a.first AND b.k <= a.k WHERE a.first < a.size - {CHAIN} GROUP BY a.scene, a.first, a.k),
d AS (SELECT 'drift ' || place AS part, round(avg(sqrt(dx * dx + dy * dy)), 5) AS value, count(*) AS n FROM c WHERE whole GROUP BY place),
r AS (SELECT 'recovery ' || o AS part, round(avg(1 - least(abs((y - 60) * 0.01::DOUBLE + o) / o, 1.5::DOUBLE)), 5) AS value, count(*) AS n FROM pose, (VALUES (0.5::DOUBLE), (1.0::DOUBLE)) t(o) WHERE kind <> 'error' GROUP BY o),
v AS (SELECT 'verdict ' || kind AS part, round(count(*) / (SELECT count(*) FROM pose), 5) AS value, count(*) AS n FROM pose GROUP BY kind) SELECT * FROM d UNION ALL SELECT * FROM r UNION ALL SELECT * FROM v""")
def a38_chains(spark: SparkSession, d: str) -> DataFrame:
    """How far chained plans run off, what part of an offset plans take back, and how often each verdict falls."""
    p = pose_track(spark, d)
    n = F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid")) - 1
    steps = p.select("scene", n.alias("n"), (F.col("kind") != "error").alias("valid"), F.expr("x * 0.1D as px"), F.expr("y * 0.05D as py"), F.expr("y * 0.1D as gx"), F.expr("x * 0.02D as gy"))
    drift = E.chain_drift(steps, 2, CHAIN).select(F.concat(F.lit("drift "), F.col("place").cast("int")).alias("part"), F.round("drift", 5).alias("value"), "n")
    off = p.filter("kind <> 'error'").withColumn("off", F.explode(F.array(F.lit(0.5), F.lit(1.0))))
    back = off.groupBy("off").agg(F.round(F.avg(E.recovery((F.col("y") - 60) * 0.01, F.col("off"))), 5).alias("value"), F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("recovery "), F.col("off").cast("string")).alias("part"), "value", "n")
    verdicts = p.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    total = verdicts.agg(F.sum("n").alias("all"))  # one row
    shares = verdicts.join(F.broadcast(total)).select(F.concat(F.lit("verdict "), "kind").alias("part"), F.round(F.col("n") / F.col("all"), 5).alias("value"), "n")
    return drift.unionByName(back).unionByName(shares)


@register("a45_boundary_kinds", "WITH r AS (SELECT unnest([l_partkey % 500, CASE WHEN l_linenumber < 3 THEN l_suppkey * 7 % 500 END]) AS b FROM lineitem WHERE l_orderkey % 40 = l_linenumber), n AS (SELECT b, count(*) AS n FROM r WHERE b IS NOT NULL GROUP BY b) SELECT CASE WHEN n >= 2 THEN 'inner' ELSE 'outer' END AS kind, count(*) AS boundaries, CAST(sum(n) AS BIGINT) AS refs FROM n JOIN (SELECT DISTINCT p_partkey % 500 AS b FROM part) USING (b) GROUP BY 1")
def a45_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Boundaries that two lanes or more refer to, and those of one. Lanes are line items by a rule of their order and number."""
    lanes = read(spark, d, "lineitem").filter("l_orderkey % 40 = l_linenumber").selectExpr("l_partkey % 500 as left", "case when l_linenumber < 3 then l_suppkey * 7 % 500 end as right")
    kinds = E.boundary_kinds(lanes, read(spark, d, "part").selectExpr("p_partkey % 500 as boundary"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("boundaries"), F.sum("n").alias("refs"))


NAMES = ["red", "yellow_pedestrian", "green_arrow", "blue_x", "red_arrow_left", "green", "pole"]
CAMERAS = ["FRONT", "LEFT", "REAR"]


@register("a47_lamp_elements", f"""WITH o AS (SELECT l_orderkey, l_linenumber, ([{", ".join(repr(n) for n in NAMES)}])[CAST(l_partkey % 7 AS INT) + 1] AS name, ('[cam]' || ['FRONT', 'LEFT', 'REAR', 'TOP'][CAST(l_suppkey % 4 AS INT) + 1]) AS folder, l_quantity AS q, l_extendedprice / 100 AS e, CASE WHEN l_linenumber % 3 <> 0 THEN l_discount * 10 END AS turn FROM lineitem WHERE l_orderkey % 5 <> 0),
s AS (SELECT *, string_split(name, '_')[1] AS colour, CASE WHEN contains(name, '_') THEN name ELSE 'circle' END AS shape FROM o)
SELECT l_orderkey AS keyframe, CASE WHEN contains(folder, 'FRONT') THEN 0 WHEN contains(folder, 'LEFT') THEN 1 ELSE 2 END AS camera, round(q / 1920, 9) AS x1, round(e / 1080, 9) AS y1, round((q + 20) / 1920, 9) AS x2, round((e + 40) / 1080, 9) AS y2, CAST(colour = 'red' AS INT) AS red, CAST(colour = 'yellow' AS INT) AS yellow, CAST(colour = 'green' AS INT) AS green, CAST(contains(shape, 'pedestrian') AS INT) AS pedestrian, CAST(contains(shape, 'arrow') AS INT) AS arrow, round(coalesce(sin(turn), 0), 6) AS sin, round(coalesce(cos(turn), 0), 6) AS cos
FROM s WHERE colour IN ('red', 'yellow', 'green') AND NOT contains(folder, 'TOP')""")
def a47_lamps(spark: SparkSession, d: str) -> DataFrame:
    """Lamps by keyframe and camera with their flags, boxes and directions. Pictures without a number as their stem, or of another camera, have none."""
    li = read(spark, d, "lineitem").withColumn("picture", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    objects = li.selectExpr("picture as sample_data", "l_partkey % 7 as category", "array(l_quantity, l_extendedprice / 100, l_quantity + 20, l_extendedprice / 100 + 40) as bbox", "case when l_linenumber % 3 <> 0 then l_discount * 10 end as orientation")
    folder = F.get(F.lit(["FRONT", "LEFT", "REAR", "TOP"]), (F.col("l_suppkey") % 4).cast("int"))
    stem = F.when(F.col("l_orderkey") % 5 == 0, F.lit("x")).otherwise(F.col("l_orderkey").cast("string"))
    data = li.select(F.col("picture").alias("token"), F.concat(F.lit("[cam]"), folder, F.lit("/"), stem, F.lit(".jpg")).alias("filename"), F.lit(1920).alias("width"), F.lit(1080).alias("height")).dropDuplicates(["token"])
    names = spark.createDataFrame(list(enumerate(NAMES)), "token long, name string")
    found = E.lamp_elements(objects, names, data, CAMERAS)
    return found.select("keyframe", "camera", *[F.round(c, 9).alias(c) for c in ("x1", "y1", "x2", "y2")], r6("sin").alias("sin"), r6("cos").alias("cos"), "red", "yellow", "green", "pedestrian", "arrow")

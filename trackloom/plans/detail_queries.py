"""What earlier queries of the same rows leave out: general cameras (P8), shifts (R21), turned rasters (R30), continuity (X7), matrices and contests (X18, X19), CSV (S15), camera minima (K6)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import geometry as GEO
from trackloom.functions.scalars import band, r6
from trackloom.operators import grids as G
from trackloom.operators import metrics as M
from trackloom.plans.grid_queries import CELLS, ORDER, RANK, RC, cells
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.plans.stream_queries import work_folder
from trackloom.sources.tables import boxes, pose_track, read

CAMERA = [[110.0, 0.7, 96.0], [0.0, 112.0, 54.0], [0.0, 0.0, 1.0]]
TILT = 0.06
TURN = [[0.0, -1.0, 0.0], [-float(np.sin(TILT)), 0.0, -float(np.cos(TILT))], [float(np.cos(TILT)), 0.0, -float(np.sin(TILT))]]
SHIFT = [0.1, 1.4, -0.8]


def _ground_sql() -> str:
    """The ray's direction and the camera's place as numbers: what the columns get from cofactors comes from numpy here."""
    way, at = np.array(TURN).T @ np.linalg.inv(np.array(CAMERA)), -np.array(TURN).T @ np.array(SHIFT)
    d = [f"({row[0]!r}::DOUBLE * u + {row[1]!r}::DOUBLE * v + {row[2]!r}::DOUBLE)" for row in way.tolist()]
    return f"""WITH p AS (SELECT p_partkey, CAST(p_partkey * 7 % 192 AS DOUBLE) AS u, CAST(p_partkey * 13 % 108 AS DOUBLE) AS v FROM part), d AS (SELECT p_partkey, {d[0]} AS dx, {d[1]} AS dy, {d[2]} AS dz FROM p),
f AS (SELECT *, (0 - {at.tolist()[2]!r}::DOUBLE) / dz AS far FROM d WHERE dz < -0.000001::DOUBLE) SELECT p_partkey, round({at.tolist()[0]!r}::DOUBLE + far * dx, 5) AS x, round({at.tolist()[1]!r}::DOUBLE + far * dy, 5) AS y FROM f WHERE far > 0"""


@register("p8_ground_point", _ground_sql())
def p8_point(spark: SparkSession, d: str) -> DataFrame:
    """Where the rays through pixels of a tilted camera with skewed axes meet the road; those over the horizon don't."""
    p = read(spark, d, "part").select("p_partkey", (F.col("p_partkey") * 7 % 192).cast("double").alias("u"), (F.col("p_partkey") * 13 % 108).cast("double").alias("v"))
    lit = lambda m: [[F.lit(x) for x in row] for row in m]
    x, y = GEO.ground_point(F.col("u"), F.col("v"), lit(CAMERA), lit(TURN), [F.lit(x) for x in SHIFT])
    return p.select("p_partkey", F.round(x, 5).alias("x"), F.round(y, 5).alias("y")).filter("x is not null")


@register("r21_fit_with_shift", f"""WITH {POSE}, q AS (SELECT scene, x, y, CAST(t % 97 AS DOUBLE) AS u, CAST(eid % 89 AS DOUBLE) AS v FROM pose), m AS (SELECT scene, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv FROM q GROUP BY scene),
a AS (SELECT scene, any_value(mx) AS mx, any_value(my) AS my, any_value(mu) AS mu, any_value(mv) AS mv, atan2(sum((x - mx) * (v - mv) - (y - my) * (u - mu)), sum((x - mx) * (u - mu) + (y - my) * (v - mv))) AS th FROM q JOIN m USING (scene) GROUP BY scene),
s AS (SELECT scene, th, mu - (cos(th) * mx - sin(th) * my) AS tx, mv - (sin(th) * mx + cos(th) * my) AS ty FROM a)
SELECT scene, round(any_value(th), 5) AS theta, round(any_value(tx), 3) AS tx, round(any_value(ty), 3) AS ty, round(avg((abs(cos(th) * x - sin(th) * y + tx - u) + abs(sin(th) * x + cos(th) * y + ty - v)) / 2), 3) AS error FROM q JOIN s USING (scene) GROUP BY scene""")
def r21_shift(spark: SparkSession, d: str) -> DataFrame:
    """The turn and shift of the least-squares fit of each track to another, and how far off it leaves them on average."""
    p = pose_track(spark, d).select("scene", "x", "y", (F.col("t") % 97).cast("double").alias("u"), (F.col("eid") % 89).cast("double").alias("v"))
    angle, tx, ty = GEO.fitted_shift("x", "y", "u", "v")
    fit = p.groupBy("scene").agg(angle.alias("th"), tx.alias("tx"), ty.alias("ty"))
    off = F.expr("(abs(cos(th) * x - sin(th) * y + tx - u) + abs(sin(th) * x + cos(th) * y + ty - v)) / 2")
    first = lambda c, n: F.round(F.first(c), n)
    return p.join(fit, "scene").groupBy("scene").agg(first("th", 5).alias("theta"), first("tx", 3).alias("tx"), first("ty", 3).alias("ty"), F.round(F.avg(off), 3).alias("error"))


BIAS = 7.0
_A, _B = float(np.cos(np.radians(BIAS))), float(np.sin(np.radians(BIAS)))


@register("r30_rotated_raster", f"""WITH {CELLS}, n AS (SELECT frame, r, c, cls, count(*) AS n FROM cells GROUP BY ALL), m AS (SELECT frame, r, c, 1 - {RANK.replace("cls", "max_by(cls, (n, " + RANK + "))", 1)} AS label FROM n GROUP BY frame, r, c),
g AS (SELECT f.frame, CAST(i AS INT) AS r, CAST(j AS INT) AS c FROM (SELECT DISTINCT frame FROM m) f CROSS JOIN range(0, 12) a(i) CROSS JOIN range(0, 24) b(j)),
s AS (SELECT *, CAST(round_even(round(6 + {_B!r}::DOUBLE * (c - 12) + {_A!r}::DOUBLE * (r - 6), 9), 0) AS INT) AS sr, CAST(round_even(round(12 + {_A!r}::DOUBLE * (c - 12) - {_B!r}::DOUBLE * (r - 6), 9), 0) AS INT) AS sc FROM g)
SELECT s.frame, s.r, s.c, CASE WHEN sr NOT BETWEEN 0 AND 11 OR sc NOT BETWEEN 0 AND 23 THEN 255 ELSE coalesce(m.label, 0) END AS label FROM s LEFT JOIN m ON m.frame = s.frame AND m.r = sr AND m.c = sc""")
def r30_raster(spark: SparkSession, d: str) -> DataFrame:
    """Each frame's classes, by number, turned about the raster's middle by a bias."""
    m = G.majority(G.histogram(cells(spark, d), ["frame", *RC]), ["frame", *RC], ORDER)
    label = F.coalesce(*[F.when(F.col("cls") == k, F.lit(n)) for n, k in enumerate(ORDER, 1)])
    return G.rotated(m.select("frame", *RC, label.alias("label")), BIAS, (6.0, 12.0), (12, 24), 255)


_MASKS = f"{CELLS}, gt AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF' AND z > 1.0), pr AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'RF' AND z > 1.6)"


@register("x7_row_continuity", f"""WITH {_MASKS}, h AS (SELECT g.frame, g.r, bool_or(EXISTS (SELECT 1 FROM pr p WHERE p.frame = g.frame AND abs(p.r - g.r) <= 1 AND abs(p.c - g.c) <= 1)) AS hit FROM gt g GROUP BY g.frame, g.r),
s AS (SELECT frame, r, r - row_number() OVER (PARTITION BY frame ORDER BY r) AS run FROM h WHERE NOT hit), u AS (SELECT frame, run, count(*) AS n FROM s GROUP BY frame, run)
SELECT round((SELECT count(*) FILTER (hit) / greatest(count(*), 1) FROM h), 6) AS recall, round((SELECT count(*) FILTER (hit AND r > 6) / greatest(count(*) FILTER (r > 6), 1) FROM h), 6) AS far, count(*) AS gaps, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.95), 6) AS p95, max(n) AS longest FROM u""")
def x7_continuity(spark: SparkSession, d: str) -> DataFrame:
    """In how many rows the truth is met within a cell, near and far, and how long the stretches are that miss it."""
    c = cells(spark, d)
    rows = G.row_continuity(c.filter("cls = 'NF' and z > 1.0"), c.filter("cls = 'RF' and z > 1.6"))
    far = F.col("r") > 6
    met = rows.agg(r6(M.guarded(F.count_if("hit"), F.count(F.lit(1)))).alias("recall"), r6(M.guarded(F.count_if(F.col("hit") & far), F.count_if(far))).alias("far"))
    runs = G.missed_runs(rows)
    told = runs.agg(F.count(F.lit(1)).alias("gaps"), r6(F.avg("n")).alias("mean"), F.max("n").alias("longest"))
    high = M.quantiles(runs, "n", {"p95": 0.95}).select(r6("p95").alias("p95"))
    return met.join(told).join(high)  # one row each


DISTANCES, ROWS = [0, 8, 16, 32], [0, 3, 6, 12]


@register("x18_distance_by_band", f"""WITH {CELLS}, k AS (SELECT frame, min(r) * 4 AS near FROM cells WHERE cls = 'NF' AND z > 1.9 GROUP BY frame), f AS (SELECT frame, CASE WHEN near < 8 THEN 0 WHEN near < 16 THEN 1 WHEN near < 32 THEN 2 ELSE 3 END AS distance FROM (SELECT DISTINCT frame FROM cells) LEFT JOIN k USING (frame)),
c AS (SELECT frame, CASE WHEN r < 3 THEN 0 WHEN r < 6 THEN 1 ELSE 2 END AS band, count(DISTINCT r * 100 + c) FILTER (cls LIKE 'A%') AS said, count(DISTINCT r * 100 + c) FILTER (cls LIKE 'R%') AS truth FROM cells WHERE r < 12 GROUP BY ALL),
b AS (SELECT distance, band, said / CASE band WHEN 2 THEN 144.0::DOUBLE ELSE 72.0::DOUBLE END AS said, truth / CASE band WHEN 2 THEN 144.0::DOUBLE ELSE 72.0::DOUBLE END AS truth FROM f JOIN c USING (frame)),
g AS (SELECT distance, band, round(avg(said), 6) AS said, round(avg(truth), 6) AS truth, count(*) AS n FROM b GROUP BY distance, band HAVING count(*) >= 3)
SELECT distance, max(said) FILTER (band = 0) AS said0, max(truth) FILTER (band = 0) AS truth0, max(said) FILTER (band = 1) AS said1, max(truth) FILTER (band = 1) AS truth1, max(said) FILTER (band = 2) AS said2, max(truth) FILTER (band = 2) AS truth2, max(n) AS n FROM g GROUP BY distance""")
def x18_matrix(spark: SparkSession, d: str) -> DataFrame:
    """How much of each band of rows two sources cover, by how near the frame's nearest mark is; parts of fewer than three frames are left out."""
    c = cells(spark, d)
    near = c.filter("cls = 'NF' and z > 1.9").groupBy("frame").agg((F.min("r") * 4).alias("near"))
    frames = c.select("frame").distinct().join(near, "frame", "left").select("frame", F.coalesce(band(F.col("near"), DISTANCES), F.lit(3)).alias("distance"))
    place = F.expr("r * 100 + c")
    n = c.filter("r < 12").groupBy("frame", band(F.col("r"), ROWS).alias("band")).agg(F.count_distinct(F.when(F.col("cls").startswith("A"), place)).alias("said"), F.count_distinct(F.when(F.col("cls").startswith("R"), place)).alias("truth"))
    size = F.when(F.col("band") == 2, 144.0).otherwise(72.0)
    b = frames.join(n, "frame").groupBy("distance", "band").agg(r6(F.avg(F.col("said") / size)).alias("said"), r6(F.avg(F.col("truth") / size)).alias("truth"), F.count(F.lit(1)).alias("n")).filter("n >= 3")
    wide = [F.max(F.when(F.col("band") == k, F.col(v))).alias(f"{v}{k}") for k in range(3) for v in ("said", "truth")]
    return b.groupBy("distance").agg(*wide, F.max("n").alias("n"))


@register("x19_two_estimators", f"""WITH {BOXES}, e AS (SELECT CASE WHEN l < 3 THEN 0 WHEN l < 6 THEN 1 WHEN l < 11 THEN 2 END AS band, abs(w * 1.5::DOUBLE + score * 2 - l) AS geo, abs(score * 8 + w * 0.2::DOUBLE - l) AS pred FROM boxes),
m AS (SELECT band, count(*) AS n, quantile_cont(geo, 0.5) AS geo, quantile_cont(pred, 0.5) AS pred FROM e WHERE band IS NOT NULL GROUP BY band) SELECT band, n, round(geo, 6) AS geo, round(pred, 6) AS pred, CASE WHEN geo < pred THEN 'geo' ELSE 'pred' END AS winner, round(abs(geo - pred), 6) AS apart FROM m""")
def x19_contest(spark: SparkSession, d: str) -> DataFrame:
    """Two estimates of a length by band: the median errors, which is less, and by how much."""
    e = boxes(spark, d).select(band(F.col("l"), [0, 3, 6, 11]).alias("band"), F.expr("abs(w * 1.5D + score * 2 - l) as geo"), F.expr("abs(score * 8 + w * 0.2D - l) as pred")).filter("band is not null")
    m = M.with_quantiles(e, ["band"], "geo", {"g": 0.5}, F.count(F.lit(1)).alias("n")).join(M.quantiles(e, "pred", {"p": 0.5}, ["band"]), "band")
    return m.select("band", "n", r6("g").alias("geo"), r6("p").alias("pred"), F.when(F.col("g") < F.col("p"), "geo").otherwise("pred").alias("winner"), r6(F.abs(F.col("g") - F.col("p"))).alias("apart"))


@register("s15_taxonomy_csv", "WITH t AS (SELECT n_regionkey AS id, n_name AS name, n_nationkey * 9 % 256 AS red, n_nationkey * 5 % 256 AS green, n_nationkey * 3 % 256 AS blue, n_nationkey FROM nation), f AS (SELECT id, arg_min(red, n_nationkey) AS red, arg_min(green, n_nationkey) AS green, arg_min(blue, n_nationkey) AS blue FROM t WHERE red + green + blue > 0 GROUP BY id) SELECT c_custkey, t.id, f.red, f.green, f.blue FROM customer JOIN nation n ON n.n_nationkey = c_nationkey JOIN t ON t.name = n.n_name LEFT JOIN f ON f.id = t.id")
def s15_csv(spark: SparkSession, d: str) -> DataFrame:
    """A taxonomy as CSV: each category's class by name, and each class's colour from its first line that has one."""
    folder = work_folder(spark)
    nation = read(spark, d, "nation")
    rows = nation.orderBy("n_nationkey").coalesce(1).selectExpr("n_regionkey as id", "n_name as name", "n_nationkey * 9 % 256 as red", "n_nationkey * 5 % 256 as green", "n_nationkey * 3 % 256 as blue", "n_nationkey as line")
    rows.write.option("header", "true").csv(folder)
    t = spark.read.schema("id int, name string, red int, green int, blue int, line int").option("header", "true").option("mode", "FAILFAST").csv(folder)
    colour = t.filter("red + green + blue > 0").groupBy("id").agg(F.min_by(F.struct("red", "green", "blue"), "line").alias("k")).select("id", "k.*")
    named = read(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("name"))
    classed = named.join(F.broadcast(t.select("id", "name")), "name").join(F.broadcast(colour), "id", "left")  # a line for each category
    return classed.select("c_custkey", "id", "red", "green", "blue")


@register("k6_export_by_minima", """WITH f AS (SELECT o_custkey AS scene, o_orderkey AS frame, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders), g AS (SELECT scene, f.frame, n, l_linenumber AS cam, l_returnflag FROM f JOIN lineitem ON l_orderkey = f.frame),
s AS (SELECT scene FROM g GROUP BY scene HAVING count(DISTINCT frame) >= 8 AND count(DISTINCT cam) >= 6 ORDER BY scene LIMIT 1) SELECT g.scene, g.frame, count(*) AS images FROM g JOIN s USING (scene) WHERE n <= 6 GROUP BY g.scene, g.frame HAVING bool_and(l_returnflag <> 'R')""")
def k6_minima(spark: SparkSession, d: str) -> DataFrame:
    """Of the first scene with enough frames and cameras, those of its first frames whose images are all there."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    f = read(spark, d, "orders").select(F.col("o_custkey").alias("scene"), F.col("o_orderkey").alias("frame"), n.alias("n"))
    g = f.join(read(spark, d, "lineitem").select(F.col("l_orderkey").alias("frame"), F.col("l_linenumber").alias("cam"), "l_returnflag"), "frame")
    enough = g.groupBy("scene").agg(F.count_distinct("frame").alias("frames"), F.count_distinct("cam").alias("cams")).filter("frames >= 8 and cams >= 6")
    first = enough.orderBy("scene").limit(1).select("scene")
    kept = g.filter("n <= 6").join(F.broadcast(first), "scene").groupBy("scene", "frame").agg(F.count(F.lit(1)).alias("images"), F.bool_and(F.col("l_returnflag") != "R").alias("whole"))
    return kept.filter("whole").drop("whole")

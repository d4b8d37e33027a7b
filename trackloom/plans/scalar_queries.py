"""Projection queries (P rows): geometry and scalar expressions on columns alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions import angles as A
from trackloom.functions import geometry as G
from trackloom.functions import scalars as C
from trackloom.functions.scalars import r6
from trackloom.operators.joins import neighbours
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import boxes, micros, pose_track, read

#: A unit quaternion from two angles, by event.
QUAT = f"{POSE}, a AS (SELECT eid, x, y, x * 0.01 AS p, y * 0.03 AS q FROM pose), quat AS (SELECT *, cos(p) * cos(q) AS qw, sin(p) * cos(q) AS qx, cos(p) * sin(q) * 0.6 AS qy0, cos(p) * sin(q) * 0.8 AS qz0, sin(p) * sin(q) AS rest FROM a), n AS (SELECT eid, x, y, qw / m AS w, qx / m AS qx, qy0 / m AS qy, qz0 / m AS qz FROM (SELECT *, sqrt(qw * qw + qx * qx + qy0 * qy0 + qz0 * qz0) AS m FROM quat))"


def quats(spark: SparkSession, d: str) -> tuple[DataFrame, A.Quaternion]:
    p, q = F.col("x") * 0.01, F.col("y") * 0.03
    raw = [F.cos(p) * F.cos(q), F.sin(p) * F.cos(q), F.cos(p) * F.sin(q) * 0.6, F.cos(p) * F.sin(q) * 0.8]
    df = pose_track(spark, d).select("eid", "x", "y", *[c.alias(n) for c, n in zip(raw, ("w", "qx", "qy", "qz"), strict=True)])
    m = F.sqrt(F.expr("w * w + qx * qx + qy * qy + qz * qz"))
    df = df.select("eid", "x", "y", *[(F.col(n) / m).alias(n) for n in ("w", "qx", "qy", "qz")])
    return df, tuple(F.col(n) for n in ("w", "qx", "qy", "qz"))


@register("p1_quaternion_yaw", f"WITH {QUAT} SELECT eid, round(atan2(2 * (w * qz + qx * qy), 1 - 2 * (qy * qy + qz * qz)), 6) AS yaw, round(1 - 2 * (qy * qy + qz * qz), 6) AS r00, round(2 * (qx * qy - w * qz), 6) + 0.0 AS r01 FROM n")
def p1(spark: SparkSession, d: str) -> DataFrame:
    df, q = quats(spark, d)
    m = A.rotation(q)
    return df.select("eid", r6(A.yaw(q)).alias("yaw"), r6(m[0][0]).alias("r00"), r6(m[0][1]).alias("r01"))


@register("p2_quaternion_product", f"WITH {QUAT} SELECT eid, round(w * w - qx * qx - qy * qy - qz * qz, 6) AS pw, round(2 * w * qx, 6) AS px FROM n")
def p2(spark: SparkSession, d: str) -> DataFrame:
    df, q = quats(spark, d)
    p = A.product(q, q)
    return df.select("eid", r6(p[0]).alias("pw"), r6(p[1]).alias("px"))


@register("p3_rigid_round_trip", f"WITH {QUAT} SELECT eid, round(x, 5) AS x, round(y, 5) AS y, true AS same FROM n")
def p3(spark: SparkSession, d: str) -> DataFrame:
    """A point into the world and back is the point."""
    df, q = quats(spark, d)
    m, t = A.rotation(q), (F.lit(3.0), F.lit(-2.0), F.lit(0.5))
    there = A.transform(m, t, (F.col("x"), F.col("y"), F.lit(1.0)))
    back = A.inverse_transform(m, t, there)
    return df.select("eid", F.round(back[0], 5).alias("x"), F.round(back[1], 5).alias("y"), (F.abs(back[2] - 1) < 1e-9).alias("same"))


@register("p4_world_to_ego", f"WITH {BOXES} SELECT frame, box, round(cos(l) * x + sin(l) * y, 6) + 0.0 AS ex, round(cos(l) * y - sin(l) * x, 6) + 0.0 AS ey FROM boxes")
def p4(spark: SparkSession, d: str) -> DataFrame:
    x, y = A.to_local(F.col("x"), F.col("y"), F.col("l"))
    return boxes(spark, d).select("frame", "box", r6(x).alias("ex"), r6(y).alias("ey"))


@register("p5_relative_pose", f"""WITH {POSE}, l AS (SELECT scene, eid, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, lag(y) OVER w * 0.05 AS h FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)) SELECT scene, eid, round(cos(h) * dx + sin(h) * dy, 6) AS ahead, round(cos(h) * dy - sin(h) * dx, 6) AS aside FROM l WHERE dx IS NOT NULL""")
def p5(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.operators.sequences import along

    w = along(["scene"], ["t", "eid"])
    l = pose_track(spark, d).select("scene", "eid", (F.col("x") - F.lag("x").over(w)).alias("dx"), (F.col("y") - F.lag("y").over(w)).alias("dy"), (F.lag("y").over(w) * 0.05).alias("h"))  # noqa: E741
    a, b = A.to_local(F.col("dx"), F.col("dy"), F.col("h"))
    return l.filter("dx is not null").select("scene", "eid", r6(a).alias("ahead"), r6(b).alias("aside"))


@register("p6_pinhole", f"WITH {BOXES}, p AS (SELECT frame, box, y * 100 / (x + 45) + 320 AS u, l * 100 / (x + 45) + 240 AS v, x + 45 AS z FROM boxes) SELECT frame, box, round(u + 1e-8, 5) AS u, round(v + 1e-8, 5) AS v FROM p WHERE z > 0.5 AND u >= 0 AND u < 640 AND v >= 0 AND v < 480")
def p6(spark: SparkSession, d: str) -> DataFrame:
    u, v, inside = G.pinhole(F.col("y"), F.col("l"), F.col("x") + 45, 100.0, 100.0, 320.0, 240.0, 640, 480)
    return boxes(spark, d).filter(inside).select("frame", "box", F.round(u + 1e-8, 5).alias("u"), F.round(v + 1e-8, 5).alias("v"))


@register("p7_fisheye", f"WITH {BOXES}, p AS (SELECT frame, box, y, l, x, sqrt(y * y + l * l) AS r, atan2(sqrt(y * y + l * l), x) AS th FROM boxes), q AS (SELECT *, th * (1 + 0.01 * th ** 2 - 0.002 * th ** 4) AS td FROM p WHERE th < radians(87)) SELECT frame, box, round(td * y / greatest(r, 1e-9) * 100 + 320, 4) AS u FROM q")
def p7(spark: SparkSession, d: str) -> DataFrame:
    u, _, ok = G.fisheye(F.col("y"), F.col("l"), F.col("x"), 100.0, 100.0, 320.0, 240.0, (0.01, -0.002, 0.0, 0.0))
    return boxes(spark, d).filter(ok).select("frame", "box", F.round(u, 4).alias("u"))


@register("p8_ground_ray", f"WITH {BOXES}, r AS (SELECT frame, box, (y * 10) / 100 AS rx, (l + 1) / 10 AS ry FROM boxes) SELECT frame, box, round(1.5 / ry, 5) AS ahead, round(1.5 / ry * rx, 5) AS aside FROM r WHERE ry > 0")
def p8(spark: SparkSession, d: str) -> DataFrame:
    ahead, aside = G.ground_ray(F.col("y") * 10 / 100, (F.col("l") + 1) / 10, 1.5)
    return boxes(spark, d).filter((F.col("l") + 1) / 10 > 0).select("frame", "box", F.round(ahead, 5).alias("ahead"), F.round(aside, 5).alias("aside"))


@register("p9_footprint_corners", f"WITH {BOXES}, s AS (SELECT * FROM boxes, (VALUES (0, 1, 1), (1, 1, -1), (2, -1, -1), (3, -1, 1)) v(k, sx, sy)) SELECT frame, box, k, round(x + cos(score) * sx * l / 2 - sin(score) * sy * w / 2 + 1e-9, 6) AS cx, round(y + sin(score) * sx * l / 2 + cos(score) * sy * w / 2 + 1e-9, 6) AS cy FROM s")
def p9(spark: SparkSession, d: str) -> DataFrame:
    c = boxes(spark, d).select("frame", "box", F.posexplode(G.footprint(*map(F.col, ("x", "y", "l", "w", "score")))).alias("k", "p"))
    return c.select("frame", "box", "k", r6(F.col("p.x") + 1e-9).alias("cx"), r6(F.col("p.y") + 1e-9).alias("cy"))


@register("p10_point_in_box", f"WITH {BOXES} SELECT frame, box FROM boxes WHERE abs(cos(score) * (3 - x) + sin(score) * (2 - y)) <= l / 2 AND abs(cos(score) * (2 - y) - sin(score) * (3 - x)) <= w / 2")
def p10(spark: SparkSession, d: str) -> DataFrame:
    return boxes(spark, d).filter(G.inside_box(F.lit(3.0), F.lit(2.0), *map(F.col, ("x", "y", "l", "w", "score")))).select("frame", "box")


@register("p11_range_filters", f"WITH {BOXES} SELECT frame, box FROM boxes WHERE sqrt(x * x + y * y) BETWEEN 3 AND 25 AND l < 4 AND NOT (x BETWEEN -5 AND 5 AND abs(y) < 2)")
def p11(spark: SparkSession, d: str) -> DataFrame:
    return boxes(spark, d).filter("sqrt(x * x + y * y) between 3 and 25 and l < 4 and not (x between -5 and 5 and abs(y) < 2)").select("frame", "box")


@register("p13_class_map", "WITH m AS (SELECT * FROM (VALUES ('ECONOMY', 1), ('SMALL', 2), ('STANDARD', 1)) v(t, k)) SELECT p_partkey, k FROM part LEFT JOIN m ON t = p_type")
def p13(spark: SparkSession, d: str) -> DataFrame:
    m = spark.createDataFrame([("ECONOMY", 1), ("SMALL", 2), ("STANDARD", 1)], "t string, k int")
    return read(spark, d, "part").join(F.broadcast(m), F.col("p_type") == F.col("t"), "left").select("p_partkey", "k")


@register("p14_intrinsic_rescale", "SELECT p_partkey, round(1000.0::DOUBLE * (640 + p_size) / 1920, 6) AS fx, round((960 + 0.5) * (640 + p_size) / 1920 - 0.5, 6) AS cx FROM part")
def p14(spark: SparkSession, d: str) -> DataFrame:
    width = F.lit(640) + F.col("p_size")
    return read(spark, d, "part").select("p_partkey", r6(F.lit(1000.0) * width / 1920).alias("fx"), r6(F.lit(960.5) * width / 1920 - 0.5).alias("cx"))


@register("p15_enu", """WITH g AS (SELECT event_id, radians(35 + value / 10000) AS lat, radians(139 + event_id / 1e6) AS lon FROM events), e AS (SELECT event_id, 6378137.0 / sqrt(1 - 0.0066943799901413165 * sin(lat) ** 2) AS n, lat, lon FROM g),
c AS (SELECT event_id, n * cos(lat) * cos(lon) AS x, n * cos(lat) * sin(lon) AS y, n * (1 - 0.0066943799901413165) * sin(lat) AS z FROM e), o AS (SELECT radians(35.0::DOUBLE) AS lat, radians(139.0::DOUBLE) AS lon, 6378137.0 / sqrt(1 - 0.0066943799901413165 * sin(radians(35.0::DOUBLE)) ** 2) AS n)
SELECT event_id, round(-sin(lon) * (x - n * cos(lat) * cos(lon)) + cos(lon) * (y - n * cos(lat) * sin(lon)), 3) AS east, round(-sin(lat) * cos(lon) * (x - n * cos(lat) * cos(lon)) - sin(lat) * sin(lon) * (y - n * cos(lat) * sin(lon)) + cos(lat) * (z - n * (1 - 0.0066943799901413165) * sin(lat)), 3) AS north FROM c, o""")
def p15(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    east, north, _ = G.enu(35 + F.col("value") / 10000, 139 + F.col("event_id") / 1e6, F.lit(0.0), F.lit(35.0), F.lit(139.0), F.lit(0.0))
    return e.select("event_id", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


@register("p16_metres_per_degree", "SELECT event_id, round(111132.92 - 559.82 * cos(2 * r) + 1.175 * cos(4 * r) - 0.0023 * cos(6 * r), 4) AS lat_m, round(111412.84 * cos(r) - 93.5 * cos(3 * r) + 0.118 * cos(5 * r), 4) AS lon_m FROM (SELECT event_id, radians(value / 10) AS r FROM events)")
def p16(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = G.metres_per_degree(F.col("value") / 10)
    return read(spark, d, "events").select("event_id", F.round(lat, 4).alias("lat_m"), F.round(lon, 4).alias("lon_m"))


@register("p17_gps_time", "SELECT event_id, (315964800 + (2000 + event_id % 300) * 604800 - 18 + CAST(floor(value * 1000) AS BIGINT)) * 1000000000 + CAST(round_even((value * 1000 - floor(value * 1000)) * 1e9, 0) AS BIGINT) AS ns FROM events")
def p17(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", C.gps_nanos(2000 + F.col("event_id") % 300, F.col("value") * 1000).alias("ns"))


@register("p18_steering_flags", f"WITH {POSE} SELECT eid, round(atan2(2.7 * (y - 50) * 0.01, greatest(x, 1)), 6) AS steer, x < 50 AND y < 20 AS brake, CASE WHEN x >= 5 THEN true ELSE false END AS moving FROM pose")
def p18(spark: SparkSession, d: str) -> DataFrame:
    return pose_track(spark, d).select("eid", r6(F.atan2(2.7 * (F.col("y") - 50) * 0.01, F.greatest("x", F.lit(1.0)))).alias("steer"), F.expr("x < 50 and y < 20").alias("brake"), (F.col("x") >= 5).alias("moving"))


@register("p19_quarter_turns", f"WITH {POSE} SELECT eid, round_even((y * 9 - 450) / 90, 0) * 90 + 0 AS turn FROM pose")
def p19(spark: SparkSession, d: str) -> DataFrame:
    return pose_track(spark, d).select("eid", (A.quarter_turns(F.col("y") * 9 - 450) + F.lit(0.0)).alias("turn"))


@register("p20_command_onehot", "SELECT event_id, CASE event_type WHEN 'click' THEN '010' WHEN 'view' THEN '100' WHEN 'purchase' THEN '001' ELSE '000' END AS code FROM events")
def p20(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.functions.commands import reordered

    said = F.array(*[(F.col("event_type") == k).cast("int") for k in ("click", "view", "purchase")], F.lit(0))
    return read(spark, d, "events").select("event_id", F.array_join(F.transform(reordered(said), lambda v: v.cast("string")), "").alias("code"))


@register("p21_pseudo_intent", f"WITH {BOXES}, a AS (SELECT frame, max(y) AS hi, min(y) AS lo FROM boxes GROUP BY frame) SELECT frame, CASE WHEN hi > 10 THEN 'left' WHEN lo < -10 THEN 'right' ELSE 'straight' END AS intent FROM a")
def p21(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.functions.commands import intent

    return boxes(spark, d).groupBy("frame").agg(F.collect_list("y").alias("ys")).select("frame", intent(F.col("ys"), 10.0).alias("intent"))


@register("p23_plan_at_time", f"WITH {POSE}, p AS (SELECT eid, x, y, (eid % 25) / 10.0::DOUBLE AS q FROM pose) SELECT eid, round(x + (y - x) * least(q / 2.4, 1), 6) AS v FROM p")
def p23(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.functions.commands import plan_at

    p = pose_track(spark, d).select("eid", F.array("x", F.expr("x + (y - x) / 2"), "y").alias("plan"), (F.col("eid") % 25 / 10).alias("q"))
    return p.select("eid", r6(plan_at(F.col("plan"), F.col("q"), 1.2)).alias("v"))


@register("p24_transform_validity", f"WITH {QUAT} SELECT eid, abs(x) < 300 AS ok FROM n")
def p24(spark: SparkSession, d: str) -> DataFrame:
    df, q = quats(spark, d)
    return df.select("eid", (G.valid_rotation(A.rotation(q)) & (F.abs("x") < 300)).alias("ok"))


@register("p25_name_parsing", r"SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '://([^/]+)', 1) AS host, regexp_replace(regexp_extract(url, '://[^/]+(/[^?#]*)', 1), '/+$', '') AS path FROM pages")
def p25(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return read(spark, d, "pages").select("page_id", F.regexp_extract(u, "^(https?)://", 1).alias("scheme"), F.regexp_extract(u, "://([^/]+)", 1).alias("host"), F.regexp_replace(F.regexp_extract(u, "://[^/]+(/[^?#]*)", 1), "/+$", "").alias("path"))


@register("p26_path_safety", r"WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN '/' || url WHEN 2 THEN 'a/../b' ELSE 'a..b/c' END AS p FROM pages) SELECT page_id, p <> '' AND p NOT LIKE '/%' AND NOT regexp_matches(p, '(^|/)\.\.(/|$)') AS safe FROM p")
def p26(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id") % 4
    p = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("/"), "url")).when(k == 2, "a/../b").otherwise("a..b/c")
    return read(spark, d, "pages").select("page_id", C.safe_path(p).alias("safe"))


@register("p27_hash_bucket", "SELECT c_custkey, sha256(c_name) AS sha, CAST(('0x' || substr(sha1(c_name), 1, 8)) AS BIGINT) % 20 AS bucket FROM customer")
def p27(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", F.sha2("c_name", 256).alias("sha"), C.bucket(F.col("c_name"), 20).alias("bucket"))


@register("p28_sigmoid_softmax", "SELECT event_id, round(1 / (1 + exp(-(value - 50) / 10)), 6) AS s, round(exp(value / 100) / (exp(value / 100) + exp(0.5) + 1), 6) AS p FROM events")
def p28(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value") / 100
    return read(spark, d, "events").select("event_id", r6(C.sigmoid((F.col("value") - 50) / 10)).alias("s"), r6(C.softmax(F.array(v, F.lit(0.5), F.lit(0.0)))[0]).alias("p"))


@register("p29_constant_velocity", f"WITH {POSE}, l AS (SELECT scene, eid, x, x - lag(x) OVER w AS vx FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)) SELECT scene, eid, h, round(x + h * vx, 6) AS px FROM l, range(1, 4) r(h) WHERE vx IS NOT NULL")
def p29(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.operators.sequences import along

    l = pose_track(spark, d).select("scene", "eid", "x", (F.col("x") - F.lag("x").over(along(["scene"], ["t", "eid"]))).alias("vx"))  # noqa: E741
    return l.filter("vx is not null").withColumn("h", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long")))).select("scene", "eid", "h", r6(F.expr("x + h * vx")).alias("px"))


@register("f_json_and_time", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, epoch_us(ts) AS us, lpad(CAST(event_id % 1000 AS VARCHAR), 5, '0') AS padded FROM events")
def json_and_time(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), micros(F.col("ts")).alias("us"), F.lpad((F.col("event_id") % 1000).cast("string"), 5, "0").alias("padded"))


#: Boxes of a task, about; each has 49 cells.
LOBES = 250_000


@register("r15_risk_lobes", f"""WITH b AS (SELECT l_orderkey // 64 AS frame, l_partkey % 20 AS bx, l_suppkey % 20 AS by_, l_quantity / 25 AS s, l_returnflag = 'R' AS moving FROM lineitem), g AS (SELECT frame, bx + i AS r, by_ + j AS c, CASE WHEN moving THEN exp(-(i * i + j * j) / (2 * s * s)) ELSE greatest(0, 0.5 - 0.2 * sqrt(i * i + j * j)) END AS v FROM b, range(-3, 4) x(i), range(-3, 4) y(j))
SELECT frame, r, c, CASE WHEN abs(r - 10) <= 1 AND abs(c - 10) <= 1 THEN 0 ELSE round(least(sum(v), 8), 4) END AS risk FROM g GROUP BY frame, r, c""")
def r15(spark: SparkSession, d: str) -> DataFrame:
    """Gaussian lobes of moving boxes and a linear falloff of still ones, summed, saturated, and zero around the own vehicle; 64 orders are a frame."""
    b = read(spark, d, "lineitem").select(F.expr("l_orderkey div 64").alias("frame"), (F.col("l_partkey") % 20).alias("bx"), (F.col("l_suppkey") % 20).alias("by"), (F.col("l_quantity") / 25).alias("s"), (F.col("l_returnflag") == "R").alias("moving"))
    i, j = (F.explode(F.sequence(F.lit(-3).cast("long"), F.lit(3).cast("long"))) for _ in range(2))
    lobe, falloff = F.exp(F.expr("-(i * i + j * j) / (2 * s * s)")), F.greatest(F.lit(0.0), 0.5 - 0.2 * F.sqrt(F.expr("i * i + j * j")))
    # Frames meet before their lobes are spread, so that a shuffle has one row a box and the sums need no other; LOBES keeps a task's cells few.
    b = b.repartition(1 + b.count() // LOBES, "frame")
    g = b.withColumn("i", i).withColumn("j", j).select("frame", F.expr("bx + i").alias("r"), F.expr("by + j").alias("c"), F.when(F.col("moving"), lobe).otherwise(falloff).alias("v"))
    risk = g.groupBy("frame", "r", "c").agg(F.round(F.least(F.sum("v"), F.lit(8.0)), 4).alias("risk"))
    return risk.withColumn("risk", F.when(F.expr("abs(r - 10) <= 1 and abs(c - 10) <= 1"), 0.0).otherwise(F.col("risk")))


LINE_ENDS = """p AS (SELECT p_partkey AS id, p_partkey // 8 AS chain, p_partkey * 37 % 211 + 211 * (p_partkey // 1500) + 0.0::DOUBLE AS x0, p_partkey * p_partkey % 197 + 0.0::DOUBLE AS y0, p_partkey * 37 % 211 + 211 * (p_partkey // 1500) + 0.1::DOUBLE * p_size AS x1, p_partkey * p_partkey % 197 + 0.2::DOUBLE * (p_partkey % 7) AS y1 FROM part)"""


@register("r20_adjacency", f"WITH {LINE_ENDS} SELECT i.id AS i, j.id AS j FROM p i JOIN p j ON i.id <> j.id AND ((i.chain = j.chain AND j.id = i.id + 1) OR (i.x1 - j.x0) ** 2 + (i.y1 - j.y0) ** 2 < 1)")
def r20(spark: SparkSession, d: str) -> DataFrame:
    """Pieces i and j follow each other if j is the next of i's chain, or starts less than a metre from i's end."""
    k = F.col("p_partkey")
    x, y = (k * 37 % 211 + 211 * F.expr("p_partkey div 1500")).cast("double"), (k * k % 197).cast("double")
    p = read(spark, d, "part").select(k.alias("id"), F.expr("p_partkey div 8").alias("chain"), x.alias("x0"), y.alias("y0"), (x + 0.1 * F.col("p_size")).alias("x1"), (y + 0.2 * (k % 7)).alias("y1"))
    ends = p.select(F.col("id").alias("i"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    starts = p.select(F.col("id").alias("j"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    close = neighbours(ends, starts, [], "x", "y", 1.0, "_b").filter("distance < 1 and i <> j_b").select("i", F.col("j_b").alias("j"))
    after = p.select(F.col("id").alias("i"), "chain", (F.col("id") + 1).alias("j")).join(p.select(F.col("id").alias("j"), "chain").hint("merge"), ["j", "chain"]).select("i", "j")
    return close.unionByName(after).distinct()


@register("r21_similarity_fit", f"WITH {POSE}, m AS (SELECT scene, avg(x) AS mx, avg(y) AS my, avg(t % 97) AS mu, avg(eid % 89) AS mv FROM pose GROUP BY scene) SELECT p.scene, round(atan2(sum((x - mx) * (eid % 89 - mv) - (y - my) * (t % 97 - mu)), sum((x - mx) * (t % 97 - mu) + (y - my) * (eid % 89 - mv))), 5) AS theta FROM pose p JOIN m ON p.scene = m.scene GROUP BY p.scene")
def r21(spark: SparkSession, d: str) -> DataFrame:
    """Rotation of the least-squares fit (x, y) -> (u, v) with scale 1: sums and one arctangent, no collect."""
    p = pose_track(spark, d).withColumn("u", F.col("t") % 97).withColumn("v", F.col("eid") % 89)
    return p.groupBy("scene").agg(F.round(G.fit_rotation("x", "y", "u", "v"), 5).alias("theta"))

"""Join queries (J rows) and set operations (U rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import bucket, r6
from trackloom.operators import joins as J
from trackloom.operators.sequences import along
from trackloom.operators.metrics import cumulated
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import boxes, pose_track, read

HOUR = 3_600_000_000


@register("j1_token_lookup", """SELECT o_orderkey, c_name, n_name, coalesce(r_name, 'none') AS r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def j1(spark: SparkSession, d: str) -> DataFrame:
    o, c, n, r = (read(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    joined = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    return joined.select("o_orderkey", "c_name", "n_name", F.coalesce("r_name", F.lit("none")).alias("r_name"))


@register("j2_one_to_many", """SELECT o_orderkey, count(l_linenumber) AS n, string_agg(l_returnflag, '' ORDER BY l_returnflag) AS flags FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def j2(spark: SparkSession, d: str) -> DataFrame:
    o, li = read(spark, d, "orders"), read(spark, d, "lineitem")
    grouped = o.join(li, o.o_orderkey == li.l_orderkey, "left").groupBy("o_orderkey").agg(F.count("l_linenumber").alias("n"), F.sort_array(F.collect_list("l_returnflag")).alias("f"))
    return grouped.select("o_orderkey", "n", F.when(F.size("f") > 0, F.array_join("f", "")).alias("flags"))


@register("j3_linked_list", """WITH RECURSIVE link AS (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations),
walk(conv_id, turn, depth) AS (SELECT conv_id, min(turn), 1::BIGINT FROM conversations GROUP BY conv_id UNION ALL SELECT l.conv_id, l.nxt, w.depth + 1 FROM walk w JOIN link l ON w.conv_id = l.conv_id AND w.turn = l.turn WHERE l.nxt IS NOT NULL AND w.depth < 100)
SELECT conv_id, max(depth) AS length FROM walk GROUP BY conv_id""")
def j3(spark: SparkSession, d: str) -> DataFrame:
    turns = read(spark, d, "conversations").select("conv_id", "turn")
    turns.withColumn("nxt", F.lead("turn").over(along(["conv_id"], ["turn"]))).createOrReplaceTempView("_link")
    return spark.sql("""WITH RECURSIVE walk(conv_id, turn, depth) AS (SELECT conv_id, min(turn), 1L FROM _link GROUP BY conv_id
      UNION ALL SELECT l.conv_id, l.nxt, w.depth + 1 FROM walk w JOIN _link l ON w.conv_id = l.conv_id AND w.turn = l.turn WHERE l.nxt IS NOT NULL AND w.depth < 100)
      SELECT conv_id, max(depth) AS length FROM walk GROUP BY conv_id""")


SPLIT = f"{POSE}, a AS (SELECT * FROM pose WHERE kind = 'click'), b AS (SELECT scene, t, max(x) AS x FROM pose WHERE kind = 'view' GROUP BY scene, t)"


def split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = pose_track(spark, d)
    return p.filter("kind = 'click'"), p.filter("kind = 'view'").groupBy("scene", "t").agg(F.max("x").alias("x"))


BRACKET = """p AS (SELECT a.scene, a.eid, a.t, b.t AS bt, b.x AS bx FROM a ASOF LEFT JOIN b ON a.scene = b.scene AND a.t >= b.t),
q AS (SELECT p.*, b.t AS at_, b.x AS ax FROM p ASOF LEFT JOIN b ON p.scene = b.scene AND p.t <= b.t)"""


@register("j4_nearest_in_time", f"""WITH {SPLIT}, {BRACKET}, n AS (SELECT *, CASE WHEN bt IS NULL OR at_ - t < t - bt THEN at_ ELSE bt END AS nt FROM q)
SELECT scene, eid, nt AS nearest, abs(t - nt) AS gap, coalesce(abs(t - nt) <= {2 * HOUR}, false) AS within FROM n""")
def j4(spark: SparkSession, d: str) -> DataFrame:
    a, b = split(spark, d)
    return J.nearest(a, b, ["scene"], "t", ["x"], 2 * HOUR).select("scene", "eid", F.col("nearest.t").alias("nearest"), "gap", "within")


@register("j5_nearest_of_streams", f"""WITH {POSE}, a AS (SELECT * FROM pose WHERE kind = 'error'), b AS (SELECT scene, t, min(kind) AS kind FROM pose WHERE kind IN ('click', 'view') GROUP BY ALL),
p AS (SELECT a.scene, a.eid, a.t, b.t AS bt, b.kind AS bk FROM a ASOF LEFT JOIN b ON a.scene = b.scene AND a.t >= b.t), q AS (SELECT p.*, b.t AS at_, b.kind AS ak FROM p ASOF LEFT JOIN b ON p.scene = b.scene AND p.t <= b.t)
SELECT scene, eid, CASE WHEN bt IS NULL OR at_ - t < t - bt THEN ak ELSE bk END AS source FROM q""")
def j5(spark: SparkSession, d: str) -> DataFrame:
    p = pose_track(spark, d)
    b = p.filter("kind in ('click', 'view')").groupBy("scene", "t").agg(F.min("kind").alias("kind"))
    return J.nearest(p.filter("kind = 'error'"), b, ["scene"], "t", ["kind"], HOUR).select("scene", "eid", F.col("nearest.kind").alias("source"))


@register("j6_bracketed_interpolation", f"""WITH {SPLIT}, {BRACKET} SELECT scene, eid, round(CASE WHEN at_ - bt <= {24 * HOUR} THEN bx + CASE WHEN at_ = bt THEN 0 ELSE (t - bt) / (at_ - bt) END * (ax - bx) END, 5) AS x FROM q""")
def j6(spark: SparkSession, d: str) -> DataFrame:
    a, b = split(spark, d)
    return J.interpolated(a.select("scene", "eid", "t"), b, ["scene"], "t", ["x"], 24 * HOUR).select("scene", "eid", F.round("x", 5).alias("x"))


@register("j7_future_poses", f"""WITH {POSE}, hs AS (SELECT scene, eid, h, t + h * {HOUR} AS t FROM pose, range(1, 4) r(h)), b AS (SELECT scene, t, max(x) AS x FROM pose GROUP BY scene, t),
p AS (SELECT a.*, b.t AS bt, b.x AS bx FROM hs a ASOF LEFT JOIN b ON a.scene = b.scene AND a.t >= b.t), q AS (SELECT p.*, b.t AS at_, b.x AS ax FROM p ASOF LEFT JOIN b ON p.scene = b.scene AND p.t <= b.t)
SELECT scene, eid, CAST(h AS INT) AS h, round(bx + CASE WHEN at_ = bt THEN 0 ELSE (t - bt) / (at_ - bt) END * (ax - bx), 5) AS x FROM q""")
def j7(spark: SparkSession, d: str) -> DataFrame:
    p = pose_track(spark, d)
    ahead = J.horizons(p.select("scene", "eid", "t"), "t", [HOUR, 2 * HOUR, 3 * HOUR]).select("scene", "eid", "h", F.col("at").alias("t"))
    known = p.groupBy("scene", "t").agg(F.max("x").alias("x"))
    return J.interpolated(ahead, known, ["scene"], "t", ["x"]).select("scene", "eid", "h", F.round("x", 5).alias("x"))


@register("j8_track_at_row_offset", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n FROM pose)
SELECT a.scene, a.eid, h, round(b.x - a.x, 6) AS dx FROM n a, range(1, 4) r(h), n b WHERE a.scene = b.scene AND b.n = a.n + 5 * h""")
def j8(spark: SparkSession, d: str) -> DataFrame:
    n = pose_track(spark, d).withColumn("n", F.row_number().over(along(["scene"], ["t", "eid"])).cast("long"))
    ahead = J.horizons(n, "n", [5, 10, 15])
    later = n.select("scene", F.col("n").alias("at"), F.col("x").alias("bx"))
    return ahead.join(later, ["scene", "at"]).select("scene", "eid", F.col("h").cast("long").alias("h"), r6(F.col("bx") - F.col("x")).alias("dx"))


@register("j9_track_at_nearest_time", f"""WITH {POSE}, hs AS (SELECT scene, eid, t AS t0, h, t + h * {4 * HOUR} AS at_ FROM pose, range(1, 3) r(h)),
m AS (SELECT a.scene, a.eid, a.h, b.eid AS hit, row_number() OVER (PARTITION BY a.scene, a.eid, a.h ORDER BY abs(b.t - a.at_), b.t, b.eid) AS rn FROM hs a JOIN pose b ON a.scene = b.scene AND b.t > a.t0 AND abs(b.t - a.at_) <= {HOUR})
SELECT scene, eid, CAST(h AS INT) AS h, hit FROM m WHERE rn = 1""")
def j9(spark: SparkSession, d: str) -> DataFrame:
    p = pose_track(spark, d)
    ahead = J.horizons(p.select("scene", "eid", F.col("t").alias("t0")), "t0", [4 * HOUR, 8 * HOUR])
    ahead = ahead.withColumn("_b", F.floor(F.col("at") / HOUR))
    later = p.select("scene", F.col("t").alias("t1"), F.col("eid").alias("hit"), F.explode(F.array(*[F.floor(F.col("t") / HOUR) + k for k in (-1, 0, 1)])).alias("_b"))
    off = F.abs(F.col("t1") - F.col("at"))
    near = ahead.join(later.hint("merge"), ["scene", "_b"]).filter((F.col("t1") > F.col("t0")) & (off <= HOUR))
    return near.groupBy("scene", "eid", "h").agg(F.min(F.struct(off.alias("off"), "t1", "hit"))["hit"].alias("hit"))


@register("j10_track_continuity", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER w AS n, t - lag(t) OVER w AS gap, kind <> lag(kind) OVER w AS switched FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid))
SELECT a.scene, a.eid, bool_and(b.gap <= {12 * HOUR}) AS gapless, bool_and(NOT b.switched) AS same_kind FROM n a JOIN n b ON a.scene = b.scene AND b.n BETWEEN a.n + 1 AND a.n + 3 GROUP BY a.scene, a.eid HAVING count(*) = 3""")
def j10(spark: SparkSession, d: str) -> DataFrame:
    w = along(["scene"], ["t", "eid"])
    n = pose_track(spark, d).select("scene", "eid", "t", (F.col("t") - F.lag("t").over(w)).alias("gap"), (F.col("kind") != F.lag("kind").over(w)).alias("switched"))
    ahead = w.rowsBetween(1, 3)
    kept = n.select("scene", "eid", F.bool_and(F.col("gap") <= 12 * HOUR).over(ahead).alias("gapless"), F.bool_and(~F.col("switched")).over(ahead).alias("same_kind"), F.count(F.lit(1)).over(ahead).alias("n"))
    return kept.filter("n = 3").drop("n")


@register("j11_validity_interval", """WITH p AS (SELECT p_partkey AS id, p_partkey * 7 AS a, p_partkey * 7 + p_size AS b FROM part), o AS (SELECT o_orderkey, o_custkey * 3 AS at_ FROM orders)
SELECT o_orderkey, count(id) AS n, CASE count(id) WHEN 1 THEN 'one' WHEN 0 THEN 'none' ELSE 'several' END AS status FROM o LEFT JOIN p ON a <= at_ AND at_ < b GROUP BY o_orderkey""")
def j11(spark: SparkSession, d: str) -> DataFrame:
    periods = read(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 7).alias("a"), (F.col("p_partkey") * 7 + F.col("p_size")).alias("b"))
    orders = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") * 3).alias("at"))
    hits = J.valid_interval(orders, periods, "at", "a", "b", 64)
    every = orders.select("o_orderkey").join(hits.select("o_orderkey", "id"), "o_orderkey", "left")
    return J.exactly_one(every, ["o_orderkey"], F.col("id").isNotNull())


@register("j12_exact_stamp_sync", """WITH a AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events WHERE event_type = 'click'), b AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events WHERE event_type = 'view')
SELECT user_id, count(*) FILTER (b.day IS NOT NULL) AS synced, count(*) FILTER (b.day IS NULL) AS missing FROM a LEFT JOIN b USING (user_id, day) GROUP BY user_id""")
def j12(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    a, b = (e.filter(F.col("event_type") == k).select("user_id", "day").distinct() for k in ("click", "view"))
    both = a.join(b.withColumn("hit", F.lit(True)), ["user_id", "day"], "left")
    return both.groupBy("user_id").agg(F.count_if(F.col("hit").isNotNull()).alias("synced"), F.count_if(F.col("hit").isNull()).alias("missing"))


@register("j13_overlap_visibility", f"""WITH {BOXES} SELECT DISTINCT a.frame, a.box FROM boxes a JOIN boxes b ON a.frame = b.frame AND a.cls = b.cls AND a.box <> b.box
  AND greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.l, b.y + b.l) - greatest(a.y, b.y)) > 0.05 * least(a.w * a.l, b.w * b.l)""")
def j13(spark: SparkSession, d: str) -> DataFrame:
    a = boxes(spark, d)
    b = a.select(*[F.col(c).alias(f"{c}_b") for c in a.columns])
    inter = F.greatest(F.lit(0.0), F.least(F.expr("x + w"), F.expr("x_b + w_b")) - F.greatest("x", "x_b")) * F.greatest(F.lit(0.0), F.least(F.expr("y + l"), F.expr("y_b + l_b")) - F.greatest("y", "y_b"))
    on = (a.frame == b.frame_b) & (a.cls == b.cls_b) & (a.box != b.box_b) & (inter > 0.05 * F.least(F.expr("w * l"), F.expr("w_b * l_b")))
    return a.join(b, on, "left_semi").select("frame", "box").distinct()


@register("j14_point_raster_lookup", """WITH ras AS (SELECT p_size AS c, p_partkey % 20 AS r, min(p_brand) AS label FROM part GROUP BY ALL)
SELECT l_returnflag, label, count(*) AS n FROM lineitem LEFT JOIN ras ON c = CAST(trunc(l_quantity) AS INT) AND r = l_partkey % 20 GROUP BY ALL""")
def j14(spark: SparkSession, d: str) -> DataFrame:
    raster = read(spark, d, "part").groupBy(F.col("p_size").alias("c"), F.pmod("p_partkey", F.lit(20)).alias("r")).agg(F.min("p_brand").alias("label"))
    li = read(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("int").alias("c"), F.pmod("l_partkey", F.lit(20)).alias("r"))
    return li.join(raster, ["c", "r"], "left").groupBy("l_returnflag", "label").agg(F.count(F.lit(1)).alias("n"))


@register("j15_depth_tolerance", """WITH dep AS (SELECT p_partkey, p_retailprice / 20 AS depth FROM part) SELECT l_returnflag, count(*) AS n, count(*) FILTER (abs(l_quantity - depth) <= greatest(0.8, 0.03 * depth)) AS kept FROM lineitem JOIN dep ON l_partkey = p_partkey GROUP BY l_returnflag""")
def j15(spark: SparkSession, d: str) -> DataFrame:
    depth = read(spark, d, "part").select("p_partkey", (F.col("p_retailprice") / 20).alias("depth"))
    li = read(spark, d, "lineitem").join(depth, F.col("l_partkey") == F.col("p_partkey"))
    close = F.abs(F.col("l_quantity") - F.col("depth")) <= F.greatest(F.lit(0.8), 0.03 * F.col("depth"))
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(close).alias("kept"))


#: Every 1500 parts lie on a tile of their own, so that places are as dense on a large table as on a small one.
TILE = 1500
PLACES = f"place AS (SELECT p_partkey AS id, CAST(p_partkey * 37 % 211 + 211 * (p_partkey // {TILE}) AS DOUBLE) AS x, CAST(p_partkey * p_partkey % 197 AS DOUBLE) AS y FROM part)"


def tiled(key: str, place: str) -> Column:
    return F.expr(f"cast({place} + 211 * ({key} div {TILE}) as double)")


def places(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), tiled("p_partkey", "p_partkey * 37 % 211").alias("x"), (F.col("p_partkey") * F.col("p_partkey") % 197).cast("double").alias("y"))


@register("j16_geometry_in_window", f"WITH {PLACES} SELECT o_orderkey, count(*) AS n FROM (SELECT o_orderkey, CAST(o_custkey % 200 + 211 * (o_custkey // {TILE}) AS DOUBLE) AS cx, CAST(o_orderkey % 190 AS DOUBLE) AS cy FROM orders) JOIN place ON abs(x - cx) <= 6 AND abs(y - cy) <= 6 GROUP BY o_orderkey")
def j16(spark: SparkSession, d: str) -> DataFrame:
    windows = read(spark, d, "orders").select("o_orderkey", tiled("o_custkey", "o_custkey % 200").alias("x"), (F.col("o_orderkey") % 190).cast("double").alias("y"))
    near = J.neighbours(windows, places(spark, d), [], "x", "y", 8.5)  # 6 * sqrt(2), rounded up: the square's own circle
    return near.filter((F.abs(F.col("x") - F.col("x_b")) <= 6) & (F.abs(F.col("y") - F.col("y_b")) <= 6)).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@register("j17_radius_pairs", f"WITH {PLACES} SELECT a.id AS id_a, b.id AS id_b, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS distance FROM place a JOIN place b ON a.id < b.id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 9")
def j17(spark: SparkSession, d: str) -> DataFrame:
    p = places(spark, d)
    return J.neighbours(p, p, [], "x", "y", 3.0).filter("id < id_b").select(F.col("id").alias("id_a"), "id_b", r6("distance").alias("distance"))


@register("j18_nearest_capped", f"WITH {PLACES}, q AS (SELECT s_suppkey, CAST(s_suppkey * 29 % 240 + 211 * (s_suppkey // {TILE}) AS DOUBLE) AS sx, CAST(s_suppkey * 31 % 230 AS DOUBLE) AS sy FROM supplier) SELECT s_suppkey, min_by(id, (sqrt((x - sx) ** 2 + (y - sy) ** 2), id)) AS id, round(min(sqrt((x - sx) ** 2 + (y - sy) ** 2)), 6) AS distance FROM q JOIN place ON sqrt((x - sx) ** 2 + (y - sy) ** 2) <= 30 GROUP BY s_suppkey")
def j18(spark: SparkSession, d: str) -> DataFrame:
    q = read(spark, d, "supplier").select("s_suppkey", tiled("s_suppkey", "s_suppkey * 29 % 240").alias("x"), (F.col("s_suppkey") * 31 % 230).cast("double").alias("y"))
    best = J.neighbours(q, places(spark, d), [], "x", "y", 30.0).groupBy("s_suppkey").agg(F.min(F.struct("distance", "id_b")).alias("m"))
    return best.select("s_suppkey", F.col("m.id_b").alias("id"), r6("m.distance").alias("distance"))


@register("j19_any_within_radius", f"WITH {PLACES}, q AS (SELECT s_suppkey, CAST(s_suppkey * 29 % 240 + 211 * (s_suppkey // {TILE}) AS DOUBLE) AS sx, CAST(s_suppkey * 31 % 230 AS DOUBLE) AS sy FROM supplier) SELECT s_suppkey FROM q WHERE EXISTS (SELECT 1 FROM place WHERE (x - sx) ** 2 + (y - sy) ** 2 <= 4)")
def j19(spark: SparkSession, d: str) -> DataFrame:
    q = read(spark, d, "supplier").select("s_suppkey", tiled("s_suppkey", "s_suppkey * 29 % 240").alias("x"), (F.col("s_suppkey") * 31 % 230).cast("double").alias("y"))
    return J.neighbours(q, places(spark, d), [], "x", "y", 2.0).select("s_suppkey").distinct()


@register("j22_run_join_drift", f"""WITH {BOXES}, one AS (SELECT frame, box, cls, avg(x) AS x, max(score) AS yaw FROM boxes WHERE score > 0.2 GROUP BY ALL), two AS (SELECT frame, box, cls, avg(x + (box % 5 - 2) * 0.3::DOUBLE) AS x, max(score + (box % 3) * 0.05::DOUBLE) AS yaw FROM boxes WHERE l > 2 GROUP BY ALL)
SELECT one.cls, count(*) AS both_runs, count(*) FILTER (abs(one.x - two.x) > 0.5) AS drifted, round(avg(two.yaw - one.yaw), 6) AS turn FROM one JOIN two ON one.frame = two.frame AND one.box = two.box AND one.cls = two.cls GROUP BY one.cls""")
def j22(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over the same frames, each with the boxes that it kept and where it put them: what both have, and how much of that moved."""
    b = boxes(spark, d)
    keys = ["frame", "box", "cls"]
    one = b.filter("score > 0.2").groupBy(*keys).agg(F.avg("x").alias("x"), F.max("score").alias("yaw"))
    two = b.filter("l > 2").groupBy(*keys).agg(F.avg(F.expr("x + (box % 5 - 2) * 0.3d")).alias("x2"), F.max(F.expr("score + (box % 3) * 0.05d")).alias("yaw2"))
    both = one.join(two, keys)
    return both.groupBy("cls").agg(F.count(F.lit(1)).alias("both_runs"), F.count_if(F.abs(F.expr("x - x2")) > 0.5).alias("drifted"), r6(F.avg(F.expr("yaw2 - yaw"))).alias("turn"))


@register("j24_frame_offsets", f"""WITH {POSE}, f AS (SELECT scene, eid // 20 AS frame, max(x) AS x FROM pose GROUP BY ALL)
SELECT a.scene, a.frame, round(a.x - b.x, 6) AS d2, round(a.x - c.x, 6) AS d6 FROM f a LEFT JOIN f b ON a.scene = b.scene AND b.frame = a.frame - 2 LEFT JOIN f c ON a.scene = c.scene AND c.frame = a.frame - 6""")
def j24(spark: SparkSession, d: str) -> DataFrame:
    f = pose_track(spark, d).groupBy("scene", F.expr("eid div 20").alias("frame")).agg(F.max("x").alias("x"))
    out = f
    for k in (2, 6):
        out = out.join(f.select("scene", (F.col("frame") + k).alias("frame"), F.col("x").alias(f"x{k}")), ["scene", "frame"], "left")
    return out.select("scene", "frame", r6(F.col("x") - F.col("x2")).alias("d2"), r6(F.col("x") - F.col("x6")).alias("d6"))


@register("j25_cell_lookup", f"""WITH {BOXES}, m AS (SELECT CAST(trunc((x + 40) / 4) AS INT) AS r, CAST(trunc((y + 25) / 4) AS INT) AS c, max(score) AS top FROM boxes GROUP BY ALL)
SELECT frame, box, max(round(top, 6)) AS top FROM boxes JOIN m ON r = CAST(trunc((x + 40) / 4) AS INT) AND c = CAST(trunc((y + 25) / 4) AS INT) GROUP BY frame, box""")
def j25(spark: SparkSession, d: str) -> DataFrame:
    b = boxes(spark, d).withColumn("r", ((F.col("x") + 40) / 4).cast("int")).withColumn("c", ((F.col("y") + 25) / 4).cast("int"))
    m = b.groupBy("r", "c").agg(F.max("score").alias("top"))
    return b.join(m, ["r", "c"]).groupBy("frame", "box").agg(F.max(r6("top")).alias("top"))


@register("j26_set_filters", """SELECT doc_id, lang FROM documents WHERE source NOT IN (SELECT DISTINCT source FROM documents WHERE doc_id % 97 = 0) AND doc_id IN (SELECT doc_id FROM labels)""")
def j26(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "lang", "source")
    held = docs.filter("doc_id % 97 = 0").select("source").distinct()
    return docs.join(held, "source", "left_anti").join(read(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang")


@register("u1_ordered_union_distinct", """WITH a AS (SELECT c_mktsegment AS v, 0 AS part, min(c_custkey) AS ord FROM customer GROUP BY 1), b AS (SELECT p_type AS v, 1 AS part, min(p_partkey) AS ord FROM part GROUP BY 1)
SELECT v, row_number() OVER (ORDER BY part, ord) AS place FROM (SELECT v, min(part) AS part, min_by(ord, part) AS ord FROM (FROM a UNION ALL FROM b) GROUP BY v)""")
def u1(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("v")).agg(F.min("c_custkey").alias("ord")).withColumn("part", F.lit(0))
    b = read(spark, d, "part").groupBy(F.col("p_type").alias("v")).agg(F.min("p_partkey").alias("ord")).withColumn("part", F.lit(1))
    first = a.unionByName(b).groupBy("v").agg(F.min(F.struct("part", "ord")).alias("s")).select("v", "s.part", "s.ord", F.lit(1).alias("one"))
    placed = cumulated(first, "ord", {"place": "one"}, keys=["part"])  # places within each list, by ranges
    before = first.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select((F.col("part") + 1).alias("part"), "n")  # a row for each list
    return placed.join(F.broadcast(before), "part", "left").select("v", (F.col("place") + F.coalesce("n", F.lit(0))).alias("place"))


@register("u2_set_audit", """SELECT 'only_documents' AS part, count(*) AS n FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)""")
def u2(spark: SparkSession, d: str) -> DataFrame:
    a, b = read(spark, d, "documents").select("doc_id"), read(spark, d, "labels").select("doc_id")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return count(a.exceptAll(b).distinct(), "only_documents").unionByName(count(a.intersect(b), "both"))


@register("u3_registry_union", "SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM documents WHERE n_chars < 200")
def u3(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "labels").filter("toxic = 1").select("doc_id").union(read(spark, d, "documents").filter("n_chars < 200").select("doc_id")).distinct()


@register("u4_later_wins", "SELECT l_orderkey, max_by(l_returnflag, (l_shipdate, l_partkey, l_suppkey, l_linenumber)) AS flag FROM lineitem GROUP BY l_orderkey")
def u4(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max_by("l_returnflag", F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")).alias("flag"))


@register("u5_hash_split", """WITH b AS (SELECT source, CAST(('0x' || substr(sha1(source), 1, 8)) AS BIGINT) % 10 AS k, source IN ('src0', 'src1') AS protected FROM (SELECT DISTINCT source FROM documents))
SELECT source, CASE WHEN k < 2 AND NOT protected THEN 'test' ELSE 'train' END AS split FROM b""")
def u5(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").select("source").distinct()
    held = (bucket(F.col("source"), 10) < 2) & ~F.col("source").isin("src0", "src1")
    return s.select("source", F.when(held, "test").otherwise("train").alias("split"))


@register("u6_stratified_by_mass", """WITH s AS (SELECT lang, source, count(*) AS n, sha1(source || lang) AS h FROM documents GROUP BY ALL), r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY lang ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_, sum(n) OVER (PARTITION BY lang) AS total FROM s)
SELECT lang, source, before_ < 0.2 * total AS held FROM r""")
def u6(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.sha1(F.concat("source", "lang")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return s.select("lang", "source", (before < 0.2 * F.sum("n").over(Window.partitionBy("lang"))).alias("held"))


@register("u7_date_split", "SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'val' ELSE 'test' END AS split FROM orders")
def u7(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return read(spark, d, "orders").select("o_orderkey", F.when(day < F.lit("1999-01-01").cast("date"), "train").when(day < F.lit("2000-01-01").cast("date"), "val").otherwise("test").alias("split"))


@register("u8_leak_check", """WITH s AS (SELECT o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 0 ELSE 1 END AS late FROM orders) SELECT o_custkey FROM s GROUP BY o_custkey HAVING count(DISTINCT late) > 1""")
def u8(spark: SparkSession, d: str) -> DataFrame:
    late = (F.col("o_orderdate").cast("date") >= F.lit("1999-01-01").cast("date")).cast("int")
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.min(late).alias("a"), F.max(late).alias("b")).filter("a < b").select("o_custkey")


@register("u9_weighted_sample", """WITH k AS (SELECT doc_id, -ln((CAST(('0x' || substr(sha1('epoch1:' || doc_id), 1, 8)) AS BIGINT) + 1) / 4294967297.0::DOUBLE) / (1 + n_chars) AS k FROM documents),
r AS (SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) - 1 AS place FROM k) SELECT doc_id, place, place % 4 AS shard FROM r WHERE place < 100""")
def u9(spark: SparkSession, d: str) -> DataFrame:
    """Efraimidis-Spirakis keys: the smallest -ln(u)/w are a weighted sample without replacement; dealt to four ranks in turn."""
    u = (F.conv(F.substring(F.sha1(F.concat(F.lit("epoch1:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long") + 1) / F.lit(4294967297.0)
    picked = read(spark, d, "documents").select("doc_id", (-F.log(u) / (1 + F.col("n_chars"))).alias("k")).orderBy("k", "doc_id").limit(100)
    place = F.row_number().over(Window.orderBy("k", "doc_id")).cast("long") - 1
    return picked.withColumn("place", place).select("doc_id", "place", (F.col("place") % 4).alias("shard"))


@register("u10_oversample_weight", "SELECT doc_id, greatest(1.0::DOUBLE, CASE WHEN toxic = 1 THEN 4.0 ELSE 1.0 END, CASE WHEN n_chars > 5000 THEN 2.5 ELSE 1.0 END)::DOUBLE AS weight FROM documents LEFT JOIN labels USING (doc_id)")
def u10(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", "n_chars").join(read(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.greatest(F.lit(1.0), F.when(F.col("toxic") == 1, 4.0).otherwise(1.0), F.when(F.col("n_chars") > 5000, 2.5).otherwise(1.0)).alias("weight"))

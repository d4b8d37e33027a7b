"""Diagnostics by band and threshold, flow and line metrics, map rasters, and incremental work lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import band, r6
from trackloom.operators import grids as G
from trackloom.operators import metrics as M
from trackloom.operators.joins import neighbours
from trackloom.operators.matching import by_frame, whole_frames
from trackloom.plans.grid_queries import CELLS, OCC, RC, cells, occupied
from trackloom.plans.metric_queries import SCORED, scored
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import boxes, pose_track, read

PAIRS = f"{BOXES}, fr AS (SELECT *, frame // 16 AS f FROM boxes), near AS (SELECT t.f, t.box AS truth, t.x AS tx, t.y AS ty, p.box AS pred, p.x - t.x AS dx, p.y - t.y AS dy, sqrt((p.x - t.x) ** 2 + (p.y - t.y) ** 2) AS dist, p.score FROM fr t JOIN fr p ON t.f = p.f AND t.cls = p.cls AND t.box % 2 = 0 AND p.box % 2 = 1)"


#: Score thresholds of the recall curve, each with the distance within which a prediction counts.
LIMITS = ((0.2, 6.0), (0.5, 4.0), (0.8, 2.0))


def truths(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    """frame, the keys (truth, or truth, tx, ty), dx, dy, dist and hits of each truth that has predictions of its frame and class: where the nearest lies (of
    equals the first by number, score and place), and whether any is a hit by each of LIMITS. 16 orders are a frame, which holds some 64 boxes
    whatever the table's size; boxes go once by frame, and pairs are made and reduced batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, v, bounds in whole_frames(batches):
            number = np.repeat(np.arange(len(bounds)), [b - a for a, b in bounds])
            group = number * (int(v["cls"].max()) + 1) + v["cls"]
            order = np.argsort(group, kind="stable")
            t, p = order[v["box"][order] % 2 == 0], order[v["box"][order] % 2 == 1]
            lo, hi = np.searchsorted(group[p], group[t]), np.searchsorted(group[p], group[t], "right")
            n = hi - lo
            i, j = np.repeat(t, n), p[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            if not len(i):
                continue
            dx, dy, pred, score = v["x"][j] - v["x"][i], v["y"][j] - v["y"][i], v["box"][j], v["score"][j]
            dist = np.sqrt(dx * dx + dy * dy)
            own = [{"truth": v["box"], "tx": v["x"], "ty": v["y"]}[k][i] for k in keys]
            by = np.lexsort((dy, dx, score, pred, dist, *own[::-1], number[i]))
            first = np.flatnonzero(np.concatenate([[True], np.any([np.diff(x[by]) != 0 for x in (number[i], *own)], axis=0)]))
            at = by[first]
            hits = np.stack([np.logical_or.reduceat(((score > s) & (dist < m))[by], first) for s, m in LIMITS], 1)
            hits = pa.FixedSizeListArray.from_arrays(pa.array(hits.ravel()), len(LIMITS)).cast(pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (v["frame"][i[at]], *(k[at] for k in own), dx[at], dy[at], dist[at])] + [hits], names=["frame", *keys, "dx", "dy", "dist", "hits"])

    b = boxes(spark, d).select(F.expr("frame div 16").alias("frame"), "cls", "box", "x", "y", "score").dropna(subset=["frame", "cls", "box"])
    kinds = {"truth": "long", "tx": "double", "ty": "double"}
    return by_frame(b, [], run, ", ".join(["frame long", *(f"{k} {kinds[k]}" for k in keys), "dx double, dy double, dist double, hits array<boolean>"]))


@register("x1_nearest_error_by_band", f"WITH {PAIRS}, n AS (SELECT f, truth, tx, ty, arg_min(dx, (dist, pred, score, dx, dy)) AS dx, arg_min(dy, (dist, pred, score, dx, dy)) AS dy FROM near GROUP BY f, truth, tx, ty) SELECT CASE WHEN abs(tx) < 10 THEN 0 WHEN abs(tx) < 25 THEN 1 ELSE 2 END AS band, count(*) AS n, round(avg(dx), 5) AS ahead, round(avg(dy), 5) AS aside FROM n GROUP BY 1")
def x1(spark: SparkSession, d: str) -> DataFrame:
    n = truths(spark, d, "truth", "tx", "ty")
    b = F.when(F.abs("tx") < 10, 0).when(F.abs("tx") < 25, 1).otherwise(2)
    return n.groupBy(b.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("dx"), 5).alias("ahead"), F.round(F.avg("dy"), 5).alias("aside"))


@register("x4_recall_curve", f"WITH {PAIRS}, th AS (SELECT CAST(v AS DOUBLE) AS threshold, CAST(lim AS DOUBLE) AS lim FROM (VALUES (0.2, 6), (0.5, 4), (0.8, 2)) v(v, lim)) SELECT threshold, count(DISTINCT (f, truth)) FILTER (score > threshold AND dist < lim) AS found, count(DISTINCT (f, truth)) AS truths FROM near, th GROUP BY threshold")
def x4(spark: SparkSession, d: str) -> DataFrame:
    counts = truths(spark, d, "truth").agg(F.count(F.lit(1)).alias("truths"), *[F.count_if(F.col("hits")[k]).alias(f"n{k}") for k in range(len(LIMITS))])
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("threshold"), F.col(f"n{k}").alias("found")) for k, (s, _) in enumerate(LIMITS)]))
    return counts.filter("truths > 0").select("truths", rows.alias("l")).select("l.threshold", "l.found", "truths")


@register("x3_recall_by_side_and_band", f"WITH {PAIRS}, n AS (SELECT f, truth, tx, ty, min(dist) < 4 AS hit FROM near GROUP BY f, truth, tx, ty) SELECT ty >= 0 AS left_side, CASE WHEN abs(tx) < 10 THEN 0 WHEN abs(tx) < 25 THEN 1 ELSE 2 END AS band, count(*) AS n, count(*) FILTER (hit) AS hits FROM n GROUP BY 1, 2")
def x3(spark: SparkSession, d: str) -> DataFrame:
    n = truths(spark, d, "truth", "tx", "ty").withColumn("hit", F.col("dist") < 4)
    b = F.when(F.abs("tx") < 10, 0).when(F.abs("tx") < 25, 1).otherwise(2)
    return n.groupBy((F.col("ty") >= 0).alias("left_side"), b.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))


@register("x9_line_in_row_window", f"WITH {OCC} SELECT a.frame, a.r, a.c, min(abs(b.c - a.c)) AS distance FROM occ a JOIN occ b ON a.frame = b.frame AND abs(a.r - b.r) <= 2 AND NOT (a.r = b.r AND a.c = b.c) GROUP BY ALL")
def x9(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    lines = G.offsets(occ.select("frame", *RC, F.col("r").alias("r0"), F.col("c").alias("c0")), [(k, 0) for k in range(-2, 3)])
    near = occ.select("frame", "r", F.col("c").alias("cc")).join(lines, ["frame", "r"]).filter("not (r = r0 and cc = c0)")
    return near.groupBy("frame", "r", F.col("cc").alias("c")).agg(F.min(F.abs(F.expr("c0 - cc"))).alias("distance"))


@register("x10_offset_rank_on_verify", f"""WITH {SCORED}, g AS (SELECT CAST(a AS DOUBLE) / 20 AS off FROM range(-6, 7) t(a)), m AS (SELECT off, count(*) FILTER (doc_id % 2 = 0 AND (score + off > 0.5) = (truth = 1)) AS fit, count(*) FILTER (doc_id % 2 = 1 AND (score + off > 0.5) = (truth = 1)) AS verify FROM scored, g GROUP BY off)
SELECT off, fit, verify, row_number() OVER (ORDER BY verify DESC, off) AS place FROM m""")
def x10(spark: SparkSession, d: str) -> DataFrame:
    g = scored(spark, d).withColumn("off", F.explode(F.array(*[F.lit(a / 20) for a in range(-6, 7)])))
    right = (F.col("score") + F.col("off") > 0.5) == (F.col("truth") == 1)
    even = F.col("doc_id") % 2 == 0
    m = g.groupBy("off").agg(F.count_if(right & even).alias("fit"), F.count_if(right & ~even).alias("verify"))
    return m.withColumn("place", F.row_number().over(Window.orderBy(F.desc("verify"), "off")).cast("long"))  # thirteen rows


@register("x13_hit_rates_by_range", f"WITH {BOXES} SELECT CASE WHEN l < 2 THEN 0 WHEN l < 5 THEN 1 WHEN l < 11 THEN 2 END AS band, round(avg(CASE WHEN score >= 0.2 THEN 1.0::DOUBLE ELSE 0 END), 6) AS at_2, round(avg(CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0 END), 6) AS at_5 FROM boxes GROUP BY 1")
def x13(spark: SparkSession, d: str) -> DataFrame:
    rate = lambda t: r6(F.avg((F.col("score") >= t).cast("double")))
    return boxes(spark, d).groupBy(band(F.col("l"), [0, 2, 5, 11]).alias("band")).agg(rate(0.2).alias("at_2"), rate(0.5).alias("at_5"))


@register("x17_mode_histogram", f"WITH {BOXES}, m AS (SELECT frame, arg_max(cls, (score, l, box)) AS mode, arg_min(cls, (l, box, score)) AS best, max(l) - min(l) AS loss FROM boxes GROUP BY frame) SELECT mode, count(*) AS n, count(*) FILTER (mode = best) AS hits, round(avg(loss), 5) AS loss FROM m GROUP BY mode")
def x17(spark: SparkSession, d: str) -> DataFrame:
    m = boxes(spark, d).groupBy("frame").agg(F.max_by("cls", F.struct("score", "l", "box")).alias("mode"), F.min_by("cls", F.struct("l", "box", "score")).alias("best"), (F.max("l") - F.min("l")).alias("loss"))
    return m.groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("mode = best")).alias("hits"), F.round(F.avg("loss"), 5).alias("loss"))


NEXT = f"{POSE}, n AS (SELECT *, lead(x, 3) OVER w - x AS moved, x - lag(x) OVER w AS v, lead(y) OVER w - y AS turn FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid))"


def following(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("t", "eid")
    return pose_track(spark, d).select("*", (F.lead("x", 3).over(w) - F.col("x")).alias("moved"), (F.col("x") - F.lag("x").over(w)).alias("v"), (F.lead("y").over(w) - F.col("y")).alias("turn"))


@register("x22_flow_against_velocity", f"WITH {NEXT} SELECT kind, count(*) AS n, round(avg(abs(moved - 3 * v)), 5) AS flow_error, round(avg(abs(moved)), 5) AS still_error FROM n WHERE moved IS NOT NULL AND v IS NOT NULL GROUP BY kind")
def x22(spark: SparkSession, d: str) -> DataFrame:
    n = following(spark, d).filter("moved is not null and v is not null")
    return n.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.expr("moved - 3 * v"))), 5).alias("flow_error"), F.round(F.avg(F.abs("moved")), 5).alias("still_error"))


@register("x23_straight_and_turning", f"WITH {NEXT} SELECT abs(turn) > 20 AS turning, count(*) AS n, round(avg(moved), 5) AS bias, round(stddev_pop(moved), 5) AS sd FROM n WHERE moved IS NOT NULL AND turn IS NOT NULL GROUP BY 1")
def x23(spark: SparkSession, d: str) -> DataFrame:
    n = following(spark, d).filter("moved is not null and turn is not null")
    return n.groupBy((F.abs("turn") > 20).alias("turning")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("moved"), 5).alias("bias"), F.round(F.stddev_pop("moved"), 5).alias("sd"))


@register("a29_flow_endpoint_error", f"WITH {NEXT} SELECT round(avg(abs(moved - v)) FILTER (abs(v) > 10), 5) AS moving, round(avg(abs(moved - v)) FILTER (abs(v) <= 10), 5) AS still FROM n WHERE moved IS NOT NULL AND v IS NOT NULL")
def a29(spark: SparkSession, d: str) -> DataFrame:
    n, e = following(spark, d).filter("moved is not null and v is not null"), F.abs(F.expr("moved - v"))
    return n.agg(F.round(F.avg(F.when(F.abs("v") > 10, e)), 5).alias("moving"), F.round(F.avg(F.when(F.abs("v") <= 10, e)), 5).alias("still"))


@register("a32_class_area_ratio", f"WITH {CELLS}, k AS (SELECT DISTINCT r, c, frame < 25 AS early, cls FROM cells) SELECT cls, count(*) FILTER (early) AS truths, count(*) FILTER (NOT early) AS saids, round(count(*) FILTER (NOT early) / greatest(count(*) FILTER (early), 1), 6) AS ratio FROM k GROUP BY cls")
def a32(spark: SparkSession, d: str) -> DataFrame:
    k = cells(spark, d).select(*RC, (F.col("frame") < 25).alias("early"), "cls").distinct()
    said, truth = F.count_if(~F.col("early")), F.count_if("early")
    return k.groupBy("cls").agg(truth.alias("truths"), said.alias("saids"), r6(M.guarded(said, truth)).alias("ratio"))


@register("r23_layered_map", "WITH m AS (SELECT p_partkey % 30 AS r, p_size AS c, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 ELSE 3 END AS layer FROM part), w AS (SELECT i AS r, j AS c FROM range(0, 30) a(i), range(0, 60) b(j)) SELECT w.r, w.c, max(layer) AS layer FROM w LEFT JOIN m ON m.r = w.r AND m.c = w.c GROUP BY w.r, w.c")
def r23(spark: SparkSession, d: str) -> DataFrame:
    """Every cell of the window: the highest layer there, null where the map has none."""
    layer = F.when(F.col("p_type") == "ECONOMY", 1).when(F.col("p_type") == "SMALL", 2).otherwise(3)
    m = read(spark, d, "part").groupBy((F.col("p_partkey") % 30).alias("r"), F.col("p_size").cast("long").alias("c")).agg(F.max(layer).alias("layer"))
    window = spark.range(30).withColumnRenamed("id", "r").withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(59).cast("long"))))
    return window.join(m, ["r", "c"], "left")


@register("r30_rotate_points", f"WITH {BOXES} SELECT frame, box, round(cos(0.02) * x - sin(0.02) * y, 5) AS rx, round(sin(0.02) * x + cos(0.02) * y, 5) AS ry FROM boxes")
def r30(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.functions.angles import to_world

    rx, ry = to_world(F.col("x"), F.col("y"), F.lit(0.02))
    return boxes(spark, d).select("frame", "box", F.round(rx, 5).alias("rx"), F.round(ry, 5).alias("ry"))


POLYLINES = f"""{POSE}, pn AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS n FROM pose),
v AS (SELECT scene, n // 4 AS line, list(x ORDER BY n) AS xs, list(y ORDER BY n) AS ys FROM pn GROUP BY scene, n // 4 HAVING count(*) = 4)"""
_GAP = "list_avg(list_transform(range(1, 5), lambda i: sqrt((a.xs[i] - b.xs[{j}]) ** 2 + (a.ys[i] - b.ys[{j}]) ** 2)))"
FORWARD, BACKWARD = _GAP.format(j="i"), _GAP.format(j="5 - i")


def polylines(spark: SparkSession, d: str) -> DataFrame:
    """scene, line, p (four points) and their centroid: every four poses of a track are a line."""
    n = pose_track(spark, d).withColumn("n", F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid")) - 1)
    v = n.groupBy("scene", F.expr("n div 4").cast("long").alias("line")).agg(F.sort_array(F.collect_list(F.struct("n", "x", "y"))).alias("p"), F.avg("x").alias("x"), F.avg("y").alias("y")).filter(F.size("p") == 4)
    return v.select("scene", "line", "p", "x", "y")


def line_pairs(a: DataFrame, b: DataFrame, limit: float) -> DataFrame:
    """Pairs of lines of a scene with their mean gap in the same and in the opposite direction.

    The gap of two lines is at least that of their centroids, so only lines whose centroids lie within the limit are compared.
    """
    near = neighbours(a, b, ["scene"], "x", "y", limit)
    mean = lambda q: F.aggregate(F.zip_with("p", q, lambda s, t: F.sqrt((s["x"] - t["x"]) * (s["x"] - t["x"]) + (s["y"] - t["y"]) * (s["y"] - t["y"]))), F.lit(0.0), lambda s, x: s + x) / 4
    return near.select("scene", F.col("line").alias("a"), F.col("line_b").alias("b"), mean("p_b").alias("fwd"), mean(F.reverse("p_b")).alias("rev"))


@register("j23_polyline_match", f"""WITH {POLYLINES}, dd AS (SELECT a.scene, a.line AS a, b.line AS b, least({FORWARD}, {BACKWARD}) AS gap FROM v a JOIN v b ON a.scene = b.scene AND a.line < b.line) SELECT scene, a, b, round(gap, 5) AS distance FROM dd WHERE gap < 30""")
def j23(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of lines whose points lie close on average, in either direction of travel."""
    v = polylines(spark, d)
    return line_pairs(v, v, 30.0).filter("a < b and least(fwd, rev) < 30").select("scene", "a", "b", F.round(F.least("fwd", "rev"), 5).alias("distance"))


@register("a30_line_precision_recall", f"""WITH {POLYLINES}, m AS (SELECT a.scene, a.line AS said, b.line AS truth FROM v a JOIN v b ON a.scene = b.scene AND a.line % 2 = 0 AND b.line % 2 = 1 AND {FORWARD} < 40),
k AS (SELECT count(*) FILTER (line % 2 = 0) AS said, count(*) FILTER (line % 2 = 1) AS truths FROM v), h AS (SELECT count(DISTINCT (scene, said)) AS hits, count(DISTINCT (scene, truth)) AS found FROM m),
nx AS (SELECT count(*) AS pairs, count(*) FILTER (EXISTS (SELECT 1 FROM m n WHERE n.scene = m.scene AND n.said = m.said + 2 AND n.truth = m.truth + 2)) AS kept FROM m)
SELECT said, truths, round(hits / said, 6) AS precision, round(found / truths, 6) AS recall, round(kept / greatest(pairs, 1), 6) AS adjacency FROM k, h, nx""")
def a30(spark: SparkSession, d: str) -> DataFrame:
    """Even lines are said, odd ones true: precision, recall, and how many matches have a match of both lines' successors."""
    v = polylines(spark, d)
    m = line_pairs(v.filter("line % 2 = 0"), v.filter("line % 2 = 1"), 40.0).filter("fwd < 40").select("scene", F.col("a").alias("said"), F.col("b").alias("truth"))
    count = lambda key: m.select("scene", key).distinct().agg(F.count(F.lit(1)).alias("n"))
    sizes = v.agg(F.count_if(F.expr("line % 2 = 0")).alias("said"), F.count_if(F.expr("line % 2 = 1")).alias("truths"))
    after = m.select("scene", (F.col("said") - 2).alias("said"), (F.col("truth") - 2).alias("truth"), F.lit(1).alias("next"))
    kept = m.join(after, ["scene", "said", "truth"], "left").agg((F.count("next") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("adjacency"))
    out = sizes.join(count("said").withColumnRenamed("n", "hits")).join(count("truth").withColumnRenamed("n", "found")).join(kept)  # one row each
    return out.select("said", "truths", r6(F.expr("hits / said")).alias("precision"), r6(F.expr("found / truths")).alias("recall"), r6("adjacency").alias("adjacency"))


@register("m5_incremental_repair", "WITH done AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) SELECT d.doc_id, CASE WHEN done.doc_id IS NULL THEN 'new' ELSE 'repair' END AS work FROM documents d LEFT JOIN done USING (doc_id) WHERE done.doc_id IS NULL OR q = 0")
def m5(spark: SparkSession, d: str) -> DataFrame:
    done = read(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    every = read(spark, d, "documents").select("doc_id").join(done, "doc_id", "left")
    return every.filter("q is null or q = 0").select("doc_id", F.when(F.col("q").isNull(), "new").otherwise("repair").alias("work"))


@register("s15_taxonomy", "SELECT p_partkey, n_name AS colour_name FROM part LEFT JOIN nation ON n_nationkey = p_size % 30")
def s15(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").join(read(spark, d, "nation"), F.col("n_nationkey") == F.col("p_size") % 30, "left").select("p_partkey", F.col("n_name").alias("colour_name"))


@register("s17_profile_json", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 AS layer, round(sum(value), 3) AS total FROM events GROUP BY 1 ORDER BY total DESC, layer LIMIT 5")
def s17(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.from_json("props", "k long")["k"].alias("k"), "value")
    return e.groupBy(F.expr("k div 10").alias("layer")).agg(F.round(F.sum("value"), 3).alias("total")).orderBy(F.desc("total"), "layer").limit(5)

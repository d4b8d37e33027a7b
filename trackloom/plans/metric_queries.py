"""Ranking (T), evaluation (A20-A47) and diagnostic (X) queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import band, first_reason, r6
from trackloom.operators import metrics as M
from trackloom.operators import ranking as R
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import boxes, pose_track, read

SCORED = "scored AS (SELECT doc_id, quality AS truth, toxic, CAST((n_chars * 31 + doc_id) % 1000 AS DOUBLE) / 1000 * 0.5 + quality * 0.25::DOUBLE AS score, n_chars, lang FROM documents JOIN labels USING (doc_id))"


def scored(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id")
    score = ((F.col("n_chars") * 31 + F.col("doc_id")) % 1000).cast("double") / 1000 * 0.5 + F.col("quality") * 0.25
    return rows.select("doc_id", F.col("quality").alias("truth"), "toxic", score.alias("score"), "n_chars", "lang")


@register("t1_nearest_k", f"WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY x * x + y * y, box, l, w, score) - 1 AS slot FROM boxes WHERE x > -30) SELECT frame, CAST(slot AS INT) AS slot, box FROM r WHERE slot < 3")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k(boxes(spark, d).filter("x > -30"), 3, ["frame"], [F.expr("x * x + y * y"), "box", "l", "w", "score"]).select("frame", "slot", "box")


@register("t2_largest_k", f"WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY w * l DESC, x DESC, y DESC, box DESC, score DESC) - 1 AS slot FROM boxes) SELECT frame, CAST(slot AS INT) AS slot, box FROM r WHERE slot < 2")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k(boxes(spark, d), 2, ["frame"], [F.desc(F.expr("w * l")), F.desc("x"), F.desc("y"), F.desc("box"), F.desc("score")]).select("frame", "slot", "box")


@register("t3_nearest_pieces", """WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY abs(embedding[1]), vec_id) - 1 AS slot FROM embeddings) SELECT label, CAST(slot AS INT) AS slot, vec_id FROM r WHERE slot < 24""")
def t3(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k(read(spark, d, "embeddings"), 24, ["label"], [F.abs(F.element_at("embedding", 1)), "vec_id"]).select("label", "slot", "vec_id")


@register("t4_visible_first", f"WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY CASE WHEN score > 0.5 THEN 0 ELSE 1 END, x * x + y * y, box, l, w, score) - 1 AS slot FROM boxes) SELECT frame, CAST(slot AS INT) AS slot, box FROM r WHERE slot < 4")
def t4(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k(boxes(spark, d), 4, ["frame"], [F.when(F.col("score") > 0.5, 0).otherwise(1), F.expr("x * x + y * y"), "box", "l", "w", "score"]).select("frame", "slot", "box")


@register("t5_preferred_then_largest", f"WITH {BOXES} SELECT frame, arg_max(box, (CASE cls WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END, w * l, box)) AS box FROM boxes GROUP BY frame")
def t5(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("cls") == "R", 2).when(F.col("cls") == "A", 1).otherwise(0)
    return R.best(boxes(spark, d), ["frame"], F.struct(rank, F.expr("w * l"), "box"), ["box"])


PEAK = f"{BOXES}, g AS (SELECT frame // 16 AS frame, CAST(x AS INT) AS r, CAST(y AS INT) AS c, max(score) AS s FROM boxes GROUP BY ALL)"


@register("t6_peak_nms", f"WITH {PEAK}, p AS (SELECT a.frame, a.r, a.c, a.s FROM g a JOIN g b ON a.frame = b.frame AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY ALL HAVING max(b.s) <= a.s), k AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY s DESC, r, c) AS rn FROM p WHERE s > 0.3) SELECT frame, r, c, round(s, 6) AS s FROM k WHERE rn <= 20")
def t6(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.operators.grids import peaks

    values = boxes(spark, d).select(F.expr("frame div 16").alias("frame"), F.col("x").cast("int").alias("r"), F.col("y").cast("int").alias("c"), F.col("score").alias("s"))
    return peaks(values, 0.3, 20).select("frame", "r", "c", r6("s").alias("s"))


@register("t9_multi_scale_peaks", f"""WITH {BOXES}, s AS (SELECT frame // 16 AS frame, CAST(k AS INT) AS k, CAST(trunc(x / k) AS INT) AS r, CAST(trunc(y / k) AS INT) AS c, max(score) AS s FROM boxes, (VALUES (2), (4), (8)) v(k) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY frame, k ORDER BY s DESC, r, c) AS rn FROM s) SELECT frame, k, r, c, round(s, 6) AS s FROM r WHERE rn <= 5""")
def t9(spark: SparkSession, d: str) -> DataFrame:
    spread = boxes(spark, d).select(F.expr("frame div 16").alias("frame"), F.explode(F.array(F.lit(2), F.lit(4), F.lit(8))).alias("k"), "x", "y", "score")
    g = spread.groupBy("frame", "k", (F.col("x") / F.col("k")).cast("int").alias("r"), (F.col("y") / F.col("k")).cast("int").alias("c")).agg(F.max("score").alias("s"))
    return R.top_k(g, 5, ["frame", "k"], [F.desc("s"), "r", "c"]).select("frame", "k", "r", "c", r6("s").alias("s"))


@register("t10_worst_share", "WITH s AS (SELECT source, avg(n_chars) AS m FROM documents GROUP BY source), r AS (SELECT *, row_number() OVER (ORDER BY m, source) AS rn, count(*) OVER () AS n FROM s) SELECT source, round(m, 6) AS m FROM r WHERE rn <= greatest(1, CAST(floor(n * 0.3) AS BIGINT))")
def t10(spark: SparkSession, d: str) -> DataFrame:
    means = read(spark, d, "documents").groupBy("source").agg(F.avg("n_chars").alias("m"))
    return R.worst_share(means, 0.3, ["m", "source"]).select("source", r6("m").alias("m"))


@register("t11_gated_winner", f"WITH {SCORED}, r AS (SELECT lang, avg(score) AS s, count(*) FILTER (truth = 1) / count(*) AS rate FROM scored GROUP BY lang) SELECT lang, round(s, 6) AS s, rate >= 0.8 AS gated FROM r ORDER BY rate >= 0.8 DESC, s DESC, lang LIMIT 1")
def t11(spark: SparkSession, d: str) -> DataFrame:
    r = scored(spark, d).groupBy("lang").agg(F.avg("score").alias("s"), (F.count_if(F.col("truth") == 1) / F.count(F.lit(1))).alias("rate"))
    return R.gated(r, F.col("rate") >= 0.8, [F.desc("s"), F.col("lang")]).select("lang", r6("s").alias("s"), "gated")


@register("t12_best_of_k", f"WITH {BOXES} SELECT frame, arg_max(box, (round(score - 0.2 * l, 9), -box)) AS box, round(max(score - 0.2 * l), 6) AS value FROM boxes GROUP BY frame")
def t12(spark: SparkSession, d: str) -> DataFrame:
    value = F.expr("score - 0.2 * l")
    return boxes(spark, d).groupBy("frame").agg(F.max_by("box", F.struct(F.round(value, 9), -F.col("box"))).alias("box"), r6(F.max(value)).alias("value"))


@register("t13_first_meeting", "WITH s AS (SELECT source, min(doc_id) AS ord, count(*) AS n, count(DISTINCT lang) AS langs FROM documents GROUP BY source) SELECT source, n FROM s WHERE n >= 20 AND langs >= 3 ORDER BY ord LIMIT 1")
def t13(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").groupBy("source").agg(F.min("doc_id").alias("ord"), F.count(F.lit(1)).alias("n"), F.countDistinct("lang").alias("langs"))
    return s.filter("n >= 20 and langs >= 3").orderBy("ord").limit(1).select("source", "n")


@register("t14_first_by_priority", f"WITH {POSE} SELECT scene, arg_min(eid, (CASE kind WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, t, eid)) AS eid FROM pose GROUP BY scene")
def t14(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("kind") == "error", 0).when(F.col("kind") == "purchase", 1).when(F.col("kind") == "click", 2).otherwise(3)
    return pose_track(spark, d).groupBy("scene").agg(F.min_by("eid", F.struct(p, "t", "eid")).alias("eid"))


@register("t15_strided_slice", f"WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS n FROM pose) SELECT scene, eid FROM n WHERE n % 7 = 0")
def t15(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("t", "eid")
    return pose_track(spark, d).withColumn("n", F.row_number().over(w) - 1).filter("n % 7 = 0").select("scene", "eid")


@register("a20_reason_counts", "WITH r AS (SELECT CASE WHEN n_chars < 50 THEN 'short' WHEN n_chars > 10000 THEN 'long' WHEN text LIKE '%###%' THEN 'junk' ELSE 'ok' END AS reason FROM documents) SELECT reason, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM r GROUP BY reason")
def a20(spark: SparkSession, d: str) -> DataFrame:
    reason = F.coalesce(first_reason(("short", F.col("n_chars") < 50), ("long", F.col("n_chars") > 10000), ("junk", F.col("text").contains("###"))), F.lit("ok"))
    counts = read(spark, d, "documents").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("reason", "n", r6(F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


CONF = "count(*) FILTER (truth = 1 AND score > {t}) AS tp, count(*) FILTER (truth = 0 AND score > {t}) AS fp, count(*) FILTER (truth = 1 AND NOT score > {t}) AS fn, count(*) FILTER (truth = 0 AND NOT score > {t}) AS tn"


@register("a24_threshold_counts", f"WITH {SCORED}, t AS (SELECT CAST(v AS DOUBLE) AS threshold FROM (VALUES (0.2), (0.3), (0.4), (0.5), (0.6)) x(v)) SELECT threshold, {CONF.format(t='threshold')} FROM scored, t GROUP BY threshold")
def a24(spark: SparkSession, d: str) -> DataFrame:
    return M.at_thresholds(scored(spark, d), "score", "truth", [0.2, 0.3, 0.4, 0.5, 0.6])


@register("a27_class_recall", f"WITH {SCORED} SELECT lang, round(count(*) FILTER ((score > 0.4) = (truth = 1)) / count(*), 6) AS accuracy, round(count(*) FILTER (truth = 1 AND score > 0.4) / greatest(count(*) FILTER (truth = 1), 1), 6) AS recall FROM scored GROUP BY lang")
def a27(spark: SparkSession, d: str) -> DataFrame:
    hit, true = F.col("score") > 0.4, F.col("truth") == 1
    return scored(spark, d).groupBy("lang").agg(r6(F.count_if(hit == true) / F.count(F.lit(1))).alias("accuracy"), r6(M.guarded(F.count_if(hit & true), F.count_if(true))).alias("recall"))


@register("a28_l1_high_part", f"WITH {SCORED} SELECT lang, round(avg(abs(score - truth)), 6) AS l1, round(avg(abs(score - truth)) FILTER (score > 0.5), 6) AS l1_high FROM scored GROUP BY lang")
def a28(spark: SparkSession, d: str) -> DataFrame:
    off = F.abs(F.col("score") - F.col("truth"))
    return scored(spark, d).groupBy("lang").agg(r6(F.avg(off)).alias("l1"), r6(F.avg(F.when(F.col("score") > 0.5, off))).alias("l1_high"))


@register("a25_displacement_errors", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER w AS n, x - lag(x) OVER w AS vx, y - lag(y) OVER w AS vy FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)),
e AS (SELECT a.scene, a.eid, h, sqrt((a.x + h * a.vx - b.x) ** 2 + (a.y + h * a.vy - b.y) ** 2) AS e, abs(a.vx) + abs(a.vy) > 10 AS moving FROM n a, range(1, 4) t(h), n b WHERE a.scene = b.scene AND b.n = a.n + h AND a.vx IS NOT NULL)
SELECT moving, round(avg(e), 4) AS ade, round(avg(e) FILTER (h = 3), 4) AS fde, count(*) AS n FROM e GROUP BY moving""")
def a25(spark: SparkSession, d: str) -> DataFrame:
    """Constant velocity against what came: averages over horizons (ADE), of the last one (FDE), by motion."""
    w = Window.partitionBy("scene").orderBy("t", "eid")
    n = pose_track(spark, d).select("scene", "eid", "x", "y", F.row_number().over(w).alias("n"), (F.col("x") - F.lag("x").over(w)).alias("vx"), (F.col("y") - F.lag("y").over(w)).alias("vy"))
    ahead = n.filter("vx is not null").withColumn("h", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("n", F.col("n") + F.col("h"))
    later = n.select("scene", "n", F.col("x").alias("bx"), F.col("y").alias("by"))
    e = ahead.join(later, ["scene", "n"]).select("h", F.hypot(F.expr("x + h * vx - bx"), F.expr("y + h * vy - by")).alias("e"), F.expr("abs(vx) + abs(vy) > 10").alias("moving"))
    return e.groupBy("moving").agg(F.round(F.avg("e"), 4).alias("ade"), F.round(F.avg(F.when(F.col("h") == 3, F.col("e"))), 4).alias("fde"), F.count(F.lit(1)).alias("n"))


@register("a26_forecast_error_by_horizon", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n FROM pose), e AS (SELECT h, a.kind, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS e FROM n a, range(1, 4) t(h), n b WHERE a.scene = b.scene AND b.n = a.n + h)
SELECT CAST(h AS INT) AS h, kind, round(avg(e), 4) AS error, round(avg(CASE WHEN e < 20 THEN 1.0::DOUBLE ELSE 0 END), 6) AS still FROM e GROUP BY h, kind""")
def a26(spark: SparkSession, d: str) -> DataFrame:
    n = pose_track(spark, d).withColumn("n", F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid")))
    ahead = n.withColumn("h", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("n", F.col("n") + F.col("h"))
    e = ahead.join(n.select("scene", "n", F.col("x").alias("bx"), F.col("y").alias("by")), ["scene", "n"]).withColumn("e", F.hypot(F.expr("x - bx"), F.expr("y - by")))
    return e.groupBy("h", "kind").agg(F.round(F.avg("e"), 4).alias("error"), r6(F.avg((F.col("e") < 20).cast("double"))).alias("still"))


@register("a33_threshold_sweep", f"""WITH {SCORED}, p AS (SELECT score AS threshold, sum(truth) AS p, sum(1 - truth) AS n FROM scored GROUP BY score), r AS (SELECT threshold, sum(p) OVER w AS tp, sum(n) OVER w AS fp, (SELECT sum(p) FROM p) AS ap, (SELECT sum(n) FROM p) AS an FROM p WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
m AS (SELECT *, tp / ap AS recall, 1 - fp / an AS spec FROM r) SELECT 'balanced' AS pick, threshold, round(recall, 6) AS recall FROM (SELECT * FROM m ORDER BY round((recall + spec) / 2, 9) DESC, threshold DESC LIMIT 1) UNION ALL SELECT 'safe', threshold, round(recall, 6) FROM (SELECT * FROM m WHERE spec >= 0.95 ORDER BY round(recall, 9) DESC, threshold DESC LIMIT 1)""")
def a33(spark: SparkSession, d: str) -> DataFrame:
    m = M.derived(M.sweep(scored(spark, d), "score", "truth"), ["threshold"])
    pick = lambda df, name, by: df.orderBy(F.desc(F.round(by, 9)), F.desc("threshold")).limit(1).select(F.lit(name).alias("pick"), "threshold", r6("recall").alias("recall"))
    return pick(m, "balanced", "balanced").unionByName(pick(m.filter("specificity >= 0.95"), "safe", "recall"))


@register("a34_confusion_metrics", f"WITH {SCORED}, k AS (SELECT lang, {CONF.format(t='0.45')} FROM scored GROUP BY lang) SELECT lang, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tn / nullif(tn + fp, 0), 6) AS specificity, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM k")
def a34(spark: SparkSession, d: str) -> DataFrame:
    k = scored(spark, d).groupBy("lang").agg(*M.binary_counts(F.col("truth") == 1, F.col("score") > 0.45))
    return M.derived(k, ["lang"]).select("lang", r6("precision").alias("precision"), r6("specificity").alias("specificity"), r6("f1").alias("f1"))


@register("a35_band_statistics", f"WITH {BOXES}, b AS (SELECT CASE WHEN r < 10 THEN 0 WHEN r < 20 THEN 1 WHEN r < 40 THEN 2 END AS band, score, y FROM (SELECT *, sqrt(x * x + y * y) AS r FROM boxes)) SELECT band, count(*) AS n, round(avg(y), 6) AS mean, round(stddev_pop(y), 6) AS sd, round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.95), 6) AS p95 FROM b WHERE band IS NOT NULL GROUP BY band")
def a35(spark: SparkSession, d: str) -> DataFrame:
    b = boxes(spark, d).withColumn("band", band(F.sqrt(F.expr("x * x + y * y")), [0, 10, 20, 40])).filter("band is not null")
    k = M.with_quantiles(b, ["band"], "score", {"median": 0.5, "p95": 0.95}, F.count(F.lit(1)).alias("n"), r6(F.avg("y")).alias("mean"), r6(F.stddev_pop("y")).alias("sd"))
    return k.withColumn("median", r6("median")).withColumn("p95", r6("p95"))


@register("a23_grouping_sets", f"WITH {BOXES}, b AS (SELECT cls, CASE WHEN x >= 0 THEN 'front' ELSE 'rear' END AS zone, score > 0.5 AS hit FROM boxes) SELECT coalesce(cls, 'all') AS cls, coalesce(zone, 'all') AS zone, count(*) AS n, count(*) FILTER (hit) AS hits FROM b GROUP BY GROUPING SETS ((cls, zone), (cls), (zone), ())")
def a23(spark: SparkSession, d: str) -> DataFrame:
    b = boxes(spark, d).select("cls", F.when(F.col("x") >= 0, "front").otherwise("rear").alias("zone"), (F.col("score") > 0.5).alias("hit"))
    return b.cube("cls", "zone").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits")).select(F.coalesce("cls", F.lit("all")).alias("cls"), F.coalesce("zone", F.lit("all")).alias("zone"), "n", "hits")


@register("a36_correlation_quartiles", f"""WITH {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS rn, count(*) OVER (PARTITION BY lang) // 4 AS q, count(*) OVER (PARTITION BY lang) AS n FROM scored)
SELECT lang, round(corr(score, n_chars), 6) AS r, round(avg(score) FILTER (rn > n - q) - avg(score) FILTER (rn <= q), 6) AS contrast FROM r GROUP BY lang""")
def a36(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("lang")
    r = scored(spark, d).withColumn("rn", F.row_number().over(w.orderBy("n_chars", "doc_id"))).withColumn("n", F.count(F.lit(1)).over(w)).withColumn("q", F.expr("n div 4"))
    return r.groupBy("lang").agg(r6(F.corr("score", "n_chars")).alias("r"), r6(F.avg(F.when(F.expr("rn > n - q"), F.col("score"))) - F.avg(F.when(F.expr("rn <= q"), F.col("score")))).alias("contrast"))


@register("a37_offset_grid", f"""WITH {SCORED}, g AS (SELECT CAST(a AS DOUBLE) / 10 AS off FROM range(-3, 4) t(a)), m AS (SELECT off, doc_id % 2 AS part, count(*) FILTER ((score + off > 0.5) = (truth = 1)) / count(*) AS acc FROM scored, g GROUP BY ALL)
SELECT f.off, round(f.acc, 6) AS fit, round(v.acc, 6) AS verify FROM m f JOIN m v ON f.off = v.off AND f.part = 0 AND v.part = 1""")
def a37(spark: SparkSession, d: str) -> DataFrame:
    """A grid of offsets scored on even rows (fit) and odd ones (verify), in one pass over the rows."""
    g = scored(spark, d).withColumn("off", F.explode(F.array(*[F.lit(a / 10) for a in range(-3, 4)])))
    right = (F.col("score") + F.col("off") > 0.5) == (F.col("truth") == 1)
    even = F.col("doc_id") % 2 == 0
    return g.groupBy("off").agg(r6(F.count_if(right & even) / F.count_if(even)).alias("fit"), r6(F.count_if(right & ~even) / F.count_if(~even)).alias("verify"))


@register("a38_chain_drift", f"WITH {POSE}, s AS (SELECT *, sum(y - 50) OVER (PARTITION BY scene ORDER BY t, eid ROWS UNBOUNDED PRECEDING) AS drift FROM pose) SELECT scene, round(max(abs(drift)), 4) AS worst, round(arg_max(drift, (t, eid)), 4) AS final, count(*) FILTER (abs(drift) > 100) AS lost FROM s GROUP BY scene")
def a38(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("t", "eid").rowsBetween(Window.unboundedPreceding, 0)
    s = pose_track(spark, d).withColumn("drift", F.sum(F.col("y") - 50).over(w))
    return s.groupBy("scene").agg(F.round(F.max(F.abs("drift")), 4).alias("worst"), F.round(F.max_by("drift", F.struct("t", "eid")), 4).alias("final"), F.count_if(F.abs("drift") > 100).alias("lost"))


@register("a39_command_spread", f"WITH {BOXES}, p AS (SELECT frame, max(y) FILTER (cls = 'A') AS a, max(y) FILTER (cls = 'N') AS n, max(y) FILTER (cls = 'R') AS r FROM boxes GROUP BY frame) SELECT frame, round(greatest(a, n, r) - least(a, n, r), 6) AS spread, sign(a) * sign(r) < 0 AS reversed FROM p WHERE a IS NOT NULL AND n IS NOT NULL AND r IS NOT NULL")
def a39(spark: SparkSession, d: str) -> DataFrame:
    p = boxes(spark, d).groupBy("frame").pivot("cls", ["A", "N", "R"]).agg(F.max("y")).dropna()
    return p.select("frame", r6(F.greatest("A", "N", "R") - F.least("A", "N", "R")).alias("spread"), (F.signum("A") * F.signum("R") < 0).alias("reversed"))


@register("a40_time_by_pattern_diff", """WITH g AS (SELECT CASE WHEN p_name LIKE '%widget%' THEN 'widget' WHEN regexp_matches(p_name, '^(red|blue)') THEN 'coloured' ELSE 'other' END AS grp, p_type, p_retailprice FROM part), a AS (SELECT grp, sum(p_retailprice) AS s FROM g WHERE p_type = 'ECONOMY' GROUP BY grp), b AS (SELECT grp, sum(p_retailprice) AS s FROM g WHERE p_type = 'SMALL' GROUP BY grp)
SELECT grp, round(coalesce(a.s, 0), 2) AS one, round(coalesce(b.s, 0), 2) AS two, round(coalesce(b.s, 0) - coalesce(a.s, 0), 2) AS diff FROM a FULL JOIN b USING (grp)""")
def a40(spark: SparkSession, d: str) -> DataFrame:
    grp = F.when(F.col("p_name").contains("widget"), "widget").when(F.col("p_name").rlike("^(red|blue)"), "coloured").otherwise("other")
    part = read(spark, d, "part").withColumn("grp", grp)
    one, two = (part.filter(F.col("p_type") == k).groupBy("grp").agg(F.sum("p_retailprice").alias(n)) for k, n in (("ECONOMY", "a"), ("SMALL", "b")))
    a, b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return one.join(two, "grp", "full").select("grp", F.round(a, 2).alias("one"), F.round(b, 2).alias("two"), F.round(b - a, 2).alias("diff"))


@register("a41_latency_statistics", "SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, min(value) AS low, round(1000 / avg(value), 6) AS per_second FROM events GROUP BY event_type")
def a41(spark: SparkSession, d: str) -> DataFrame:
    k = M.with_quantiles(read(spark, d, "events"), ["event_type"], "value", {"p50": 0.5, "p90": 0.9}, r6(F.avg("value")).alias("mean"), F.min("value").alias("low"), r6(1000 / F.avg("value")).alias("per_second"))
    return k.withColumn("p50", r6("p50")).withColumn("p90", r6("p90"))


@register("a43_channel_moments", "SELECT label, i AS channel, round(avg(embedding[i]::DOUBLE), 6) AS mean, round(var_pop(embedding[i]::DOUBLE), 6) AS variance FROM embeddings, range(1, 65) t(i) WHERE i <= len(embedding) GROUP BY ALL")
def a43(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("p", "v"))
    return e.groupBy("label", (F.col("p") + 1).cast("long").alias("channel")).agg(r6(F.avg(F.col("v").cast("double"))).alias("mean"), r6(F.var_pop(F.col("v").cast("double"))).alias("variance"))


@register("a44_segment_median_fill", f"WITH {POSE}, h AS (SELECT *, CASE WHEN eid % 3 <> 0 THEN x END AS v FROM pose), m AS (SELECT scene, kind, quantile_cont(v, 0.5) AS med FROM h GROUP BY ALL) SELECT scene, eid, round(coalesce(v, med), 6) AS filled FROM h LEFT JOIN m USING (scene, kind)")
def a44(spark: SparkSession, d: str) -> DataFrame:
    h = pose_track(spark, d).withColumn("v", F.when(F.col("eid") % 3 != 0, F.col("x")))
    med = h.groupBy("scene", "kind").agg(F.percentile("v", F.lit(0.5)).alias("med"))
    return h.join(med, ["scene", "kind"], "left").select("scene", "eid", r6(F.coalesce("v", "med")).alias("filled"))


@register("a45_node_degree", "WITH e AS (SELECT l_partkey AS a, l_suppkey AS b FROM lineitem), n AS (SELECT a AS node FROM e UNION ALL SELECT b + 1000000 FROM e) SELECT node, count(*) AS degree FROM n GROUP BY node HAVING count(*) >= 3")
def a45(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "lineitem")
    n = e.select(F.explode(F.array(F.col("l_partkey"), F.col("l_suppkey") + 1000000)).alias("node"))
    return n.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).filter("degree >= 3")


@register("a46_duplicate_stamps", "SELECT user_id, CAST(ts::DATE AS VARCHAR) AS day, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY ALL HAVING count(*) > 1 AND count(DISTINCT event_type) > 1")
def a46(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("kinds"))
    return e.filter("n > 1 and kinds > 1")


@register("a47_elements_per_frame", "SELECT l_orderkey * 2 AS key, string_agg(l_returnflag || ':' || CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber, l_returnflag) AS elements FROM lineitem GROUP BY l_orderkey")
def a47(spark: SparkSession, d: str) -> DataFrame:
    said = F.struct("l_linenumber", "l_returnflag", F.concat_ws(":", "l_returnflag", F.col("l_linenumber").cast("string")).alias("said"))
    g = read(spark, d, "lineitem").groupBy((F.col("l_orderkey") * 2).alias("key")).agg(F.sort_array(F.collect_list(said)).alias("e"))
    return g.select("key", F.array_join(F.transform("e", lambda x: x["said"]), ",").alias("elements"))


@register("x2_distance_histogram", f"WITH {BOXES}, b AS (SELECT CASE WHEN r < 10 THEN '0' WHEN r < 25 THEN '1' WHEN r < 45 THEN '2' ELSE 'none' END AS bucket FROM (SELECT sqrt(x * x + y * y) AS r FROM boxes)) SELECT bucket, count(*) AS n FROM b GROUP BY bucket")
def x2(spark: SparkSession, d: str) -> DataFrame:
    b = F.coalesce(band(F.sqrt(F.expr("x * x + y * y")), [0, 10, 25, 45]).cast("string"), F.lit("none"))
    return boxes(spark, d).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@register("x8_nearest_left_right", f"WITH {BOXES} SELECT frame, round(max(y) FILTER (y < 0), 6) AS right_y, round(min(y) FILTER (y > 0), 6) AS left_y, round((max(y) FILTER (y < 0) + min(y) FILTER (y > 0)) / 2, 6) AS middle FROM boxes GROUP BY frame")
def x8(spark: SparkSession, d: str) -> DataFrame:
    right, left = F.max(F.when(F.col("y") < 0, F.col("y"))), F.min(F.when(F.col("y") > 0, F.col("y")))
    return boxes(spark, d).groupBy("frame").agg(r6(right).alias("right_y"), r6(left).alias("left_y"), r6((right + left) / 2).alias("middle"))


@register("x11_inlier_definition", f"WITH {SCORED} SELECT lang, CASE WHEN avg(CASE WHEN abs(score - truth) < 0.5 THEN 1.0::DOUBLE ELSE 0 END) >= 0.4 THEN 'planar' ELSE 'radial' END AS pick, round(quantile_cont(score - truth, 0.5) FILTER (abs(score - truth) < 0.5), 6) AS bias FROM scored GROUP BY lang")
def x11(spark: SparkSession, d: str) -> DataFrame:
    off = F.col("score") - F.col("truth")
    close = F.abs(off) < 0.5
    rows = scored(spark, d).withColumn("inlier", F.when(close, off))
    return M.with_quantiles(rows, ["lang"], "inlier", {"bias": 0.5}, F.when(F.avg(close.cast("double")) >= 0.4, "planar").otherwise("radial").alias("pick")).withColumn("bias", r6("bias"))


@register("x12_paired_arms", f"WITH {POSE}, f AS (SELECT scene, t // 86400000000 AS day, avg(x) FILTER (kind = 'click') AS a, avg(x) FILTER (kind = 'view') AS b FROM pose GROUP BY ALL) SELECT round(avg(a - b), 5) AS mean, round(stddev_pop(a - b), 5) AS sd, count(*) AS n FROM f WHERE a IS NOT NULL AND b IS NOT NULL")
def x12(spark: SparkSession, d: str) -> DataFrame:
    f = pose_track(spark, d).groupBy("scene", F.expr("t div 86400000000").alias("day")).pivot("kind", ["click", "view"]).agg(F.avg("x")).dropna()
    off = F.col("click") - F.col("view")
    return f.agg(F.round(F.avg(off), 5).alias("mean"), F.round(F.stddev_pop(off), 5).alias("sd"), F.count(F.lit(1)).alias("n"))


@register("x14_policy_comparison", f"WITH {BOXES}, p AS (SELECT frame, arg_max(l, (score, box, l)) AS chosen, min(l) AS oracle, max(l) AS worst, avg(l) AS fixed FROM boxes GROUP BY frame) SELECT round(avg(chosen), 5) AS chosen, round(avg(oracle), 5) AS oracle, round(avg(worst), 5) AS worst, round((avg(fixed) - avg(chosen)) / nullif(avg(fixed) - avg(oracle), 0), 5) AS recovered FROM p")
def x14(spark: SparkSession, d: str) -> DataFrame:
    p = boxes(spark, d).groupBy("frame").agg(F.max_by("l", F.struct("score", "box", "l")).alias("chosen"), F.min("l").alias("oracle"), F.max("l").alias("worst"), F.avg("l").alias("fixed"))
    a = {k: F.avg(k) for k in ("chosen", "oracle", "worst", "fixed")}
    return p.agg(F.round(a["chosen"], 5).alias("chosen"), F.round(a["oracle"], 5).alias("oracle"), F.round(a["worst"], 5).alias("worst"), F.round((a["fixed"] - a["chosen"]) / F.nullif(a["fixed"] - a["oracle"], F.lit(0.0)), 5).alias("recovered"))


@register("x15_grade_line_fit", f"""WITH {POSE}, b AS (SELECT scene, CAST(trunc(x / 20) AS INT) AS bin, quantile_cont(y, 0.2) AS h FROM pose GROUP BY ALL), f AS (SELECT scene, regr_slope(h, bin) AS s, regr_intercept(h, bin) AS i FROM b GROUP BY scene), r AS (SELECT b.*, abs(h - (s * bin + i)) AS res FROM b JOIN f USING (scene)),
k AS (SELECT *, quantile_cont(res, 0.5) OVER (PARTITION BY scene) AS med FROM r) SELECT scene, round(regr_slope(h, bin), 5) AS slope, count(*) AS kept FROM k WHERE res < greatest(0.2, 2 * med) GROUP BY scene""")
def x15(spark: SparkSession, d: str) -> DataFrame:
    b = pose_track(spark, d).groupBy("scene", (F.col("x") / 20).cast("int").alias("bin")).agg(F.percentile("y", F.lit(0.2)).alias("h"))
    f = b.groupBy("scene").agg(F.regr_slope("h", "bin").alias("s"), F.regr_intercept("h", "bin").alias("i"))
    # Residuals to nine decimals, and slopes to twelve before five: those that are equal, or halfway, don't hang on the order of sums, and
    # twelve are enough for slopes that are only close to halfway.
    r = b.join(f, "scene").withColumn("res", F.round(F.abs(F.expr("h - (s * bin + i)")), 9))
    r = r.join(r.groupBy("scene").agg(F.percentile("res", F.lit(0.5)).alias("med")), "scene").filter("res < greatest(0.2, 2 * med)")
    return r.groupBy("scene").agg(F.round(F.round(F.regr_slope("h", "bin"), 12), 5).alias("slope"), F.count(F.lit(1)).alias("kept"))


@register("x18_split_by_p75", f"WITH {SCORED}, c AS (SELECT quantile_cont(n_chars, 0.75) AS p75 FROM scored) SELECT n_chars > p75 AS high, count(*) AS n, round(avg(score), 6) AS mean FROM scored, c GROUP BY 1")
def x18(spark: SparkSession, d: str) -> DataFrame:
    rows = scored(spark, d)
    cut = M.quantiles(rows, "n_chars", {"p75": 0.75})
    return rows.join(F.broadcast(cut)).groupBy((F.col("n_chars") > F.col("p75")).alias("high")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("score")).alias("mean"))


@register("x19_distribution_statistics", "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda v: exp(v::DOUBLE)) AS g FROM embeddings), p AS (SELECT vec_id, label, list_transform(g, lambda v: v / list_sum(g)) AS p FROM e) SELECT label, round(avg(-list_sum(list_transform(p, lambda v: v * ln(v)))), 6) AS entropy, round(avg(list_max(p)), 6) AS top FROM p GROUP BY label")
def x19(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.functions.scalars import entropy, softmax

    p = read(spark, d, "embeddings").select("label", softmax(F.transform("embedding", lambda v: v.cast("double"))).alias("p"))
    return p.groupBy("label").agg(r6(F.avg(entropy(F.col("p")))).alias("entropy"), r6(F.avg(F.array_max("p"))).alias("top"))


@register("x20_outlier_ratio", "SELECT event_type, round(max(value) / quantile_cont(value, 0.999), 6) AS ratio FROM events GROUP BY event_type")
def x20(spark: SparkSession, d: str) -> DataFrame:
    k = M.with_quantiles(read(spark, d, "events"), ["event_type"], "value", {"high": 0.999}, F.max("value").alias("top"))
    return k.select("event_type", r6(F.col("top") / F.col("high")).alias("ratio"))


@register("x21_folded_angles", f"WITH {POSE}, a AS (SELECT kind, x * 0.1 AS a, y * 0.1 AS b FROM pose), f AS (SELECT kind, least(abs(d), pi() - abs(d)) AS e FROM (SELECT kind, (a - b + pi()) - floor((a - b + pi()) / (2 * pi())) * 2 * pi() - pi() AS d FROM a)) SELECT kind, round(quantile_cont(e, 0.5), 6) AS median, round(avg(CASE WHEN e < 0.3 THEN 1.0::DOUBLE ELSE 0 END), 6) AS close FROM f GROUP BY kind")
def x21(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.functions.angles import axis_error

    f = pose_track(spark, d).select("kind", axis_error(F.col("x") * 0.1, F.col("y") * 0.1).alias("e"))
    return M.with_quantiles(f, ["kind"], "e", {"median": 0.5}, r6(F.avg((F.col("e") < 0.3).cast("double"))).alias("close")).withColumn("median", r6("median"))


@register("x25_frozen_output", f"WITH {POSE}, l AS (SELECT scene, abs(x - lag(x) OVER (PARTITION BY scene ORDER BY t, eid)) AS step, x FROM pose) SELECT scene, round(stddev_pop(x), 5) AS sd, round(max(step), 6) AS top, stddev_pop(x) < 5 OR max(step) < 1 AS frozen FROM l GROUP BY scene")
def x25(spark: SparkSession, d: str) -> DataFrame:
    l = pose_track(spark, d).withColumn("step", F.abs(F.col("x") - F.lag("x").over(Window.partitionBy("scene").orderBy("t", "eid"))))  # noqa: E741
    return l.groupBy("scene").agg(F.round(F.stddev_pop("x"), 5).alias("sd"), r6(F.max("step")).alias("top"), ((F.stddev_pop("x") < 5) | (F.max("step") < 1)).alias("frozen"))


@register("x26_band_error_with_counts", f"WITH {SCORED} SELECT lang, CASE WHEN n_chars < 1000 THEN 0 WHEN n_chars < 5000 THEN 1 ELSE 2 END AS band, count(*) AS n, round(avg(abs(score - truth)), 6) AS mae, round(quantile_cont(score, 0.5) FILTER (truth = 1), 6) AS hit_median FROM scored GROUP BY ALL")
def x26(spark: SparkSession, d: str) -> DataFrame:
    b = F.when(F.col("n_chars") < 1000, 0).when(F.col("n_chars") < 5000, 1).otherwise(2)
    rows = scored(spark, d).withColumn("band", b).withColumn("hit", F.when(F.col("truth") == 1, F.col("score")))
    return M.with_quantiles(rows, ["lang", "band"], "hit", {"hit_median": 0.5}, F.count(F.lit(1)).alias("n"), r6(F.avg(F.abs(F.col("score") - F.col("truth")))).alias("mae")).withColumn("hit_median", r6("hit_median"))

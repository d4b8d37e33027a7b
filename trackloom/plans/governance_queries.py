"""Quality gates, validation and label parsing (Q, S and K rows that are tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import first_reason, r6
from trackloom.operators import gates as G
from trackloom.operators.metrics import quantiles, with_quantiles
from trackloom.plans.oracle import BOXES, POSE
from trackloom.plans.registry import register
from trackloom.sources.parsers import label_lines
from trackloom.sources.tables import boxes, pose_track, read


@register("q1_accept_gate", "SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN n_chars < 60 THEN 'short' WHEN lang NOT IN ('en', 'de') THEN 'language' WHEN n_chars > 12000 THEN 'long' END AS reason FROM documents")
def q1(spark: SparkSession, d: str) -> DataFrame:
    reason = first_reason(("empty", F.coalesce(F.col("text") == "", F.lit(True))), ("short", F.col("n_chars") < 60), ("language", ~F.col("lang").isin("en", "de")), ("long", F.col("n_chars") > 12000))
    return read(spark, d, "documents").select("doc_id", reason.alias("reason"))


@register("q2_group_gates", "WITH s AS (SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, sum(n_chars) / nullif(max(n_chars), 0) AS ratio FROM documents GROUP BY source) SELECT source, n, CASE WHEN n < 20 THEN 'few' WHEN langs < 4 THEN 'languages' WHEN ratio < 5 THEN 'dominated' END AS reason FROM s")
def q2(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("lang").alias("langs"), (F.sum("n_chars") / F.nullif(F.max("n_chars"), F.lit(0))).alias("ratio"))
    return s.select("source", "n", first_reason(("few", F.col("n") < 20), ("languages", F.col("langs") < 4), ("dominated", F.col("ratio") < 5)).alias("reason"))


@register("q3_frame_gate", f"WITH {BOXES}, have AS (SELECT frame, count(DISTINCT cls) AS k FROM boxes GROUP BY frame), need AS (SELECT frame % 100 AS scene, max(k) AS need FROM have GROUP BY ALL) SELECT frame FROM have JOIN need ON scene = frame % 100 WHERE k = need")
def q3(spark: SparkSession, d: str) -> DataFrame:
    have = boxes(spark, d).groupBy("frame").agg(F.countDistinct("cls").alias("k")).withColumn("scene", F.col("frame") % 100)
    return have.join(have.groupBy("scene").agg(F.max("k").alias("need")), "scene").filter("k = need").select("frame")


@register("q4_substitution", f"WITH {BOXES}, h AS (SELECT DISTINCT frame, cls FROM boxes), want AS (SELECT DISTINCT frame, v.want, v.alt, v.ord FROM boxes, (VALUES ('A', 'A', 0), ('A', 'N', 1), ('A', 'R', 2), ('R', 'R', 0), ('R', 'A', 1)) v(want, alt, ord)) SELECT w.frame, want, arg_min(alt, ord) AS used FROM want w JOIN h ON h.frame = w.frame AND h.cls = alt GROUP BY ALL")
def q4(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([("A", "A", 0), ("A", "N", 1), ("A", "R", 2), ("R", "R", 0), ("R", "A", 1)], "want string, cls string, ord int")
    have = boxes(spark, d).select("frame", "cls").distinct()
    return have.join(F.broadcast(rules), "cls").groupBy("frame", "want").agg(F.min_by("cls", "ord").alias("used"))


@register("q5_quarantine", "SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'no_customer' WHEN n IS NULL THEN 'no_lines' WHEN o_totalprice < 1000 THEN 'cheap' WHEN n > 9 THEN 'crowded' ELSE 'ok' END AS status FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def q5(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    reason = first_reason(("no_customer", F.col("c_custkey").isNull()), ("no_lines", F.col("n").isNull()), ("cheap", F.col("o_totalprice") < 1000), ("crowded", F.col("n") > 9))
    return o.select("o_orderkey", F.coalesce(reason, F.lit("ok")).alias("status"))


@register("q6_box_sanity", f"WITH {BOXES} SELECT CASE WHEN w <= 0.5 THEN 'thin' WHEN l > 9 THEN 'long' WHEN score = 0 THEN 'unscored' ELSE 'ok' END AS status, CASE WHEN score > 0.7 THEN 'strong' WHEN score > 0.3 THEN 'weak' ELSE 'none' END AS tier, count(*) AS n FROM boxes GROUP BY ALL")
def q6(spark: SparkSession, d: str) -> DataFrame:
    status = F.coalesce(first_reason(("thin", F.col("w") <= 0.5), ("long", F.col("l") > 9), ("unscored", F.col("score") == 0)), F.lit("ok"))
    tier = F.when(F.col("score") > 0.7, "strong").when(F.col("score") > 0.3, "weak").otherwise("none")
    return boxes(spark, d).groupBy(status.alias("status"), tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@register("q7_violations", """SELECT 'orphan_line' AS rule, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'bad_discount', count(*) FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 1 UNION ALL SELECT 'repeated_line', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""")
def q7(spark: SparkSession, d: str) -> DataFrame:
    li, o = read(spark, d, "lineitem"), read(spark, d, "orders")
    return G.violations({
        "orphan_line": li.join(o, li.l_orderkey == o.o_orderkey, "left_anti"),
        "bad_discount": li.filter("l_discount not between 0 and 1"),
        "repeated_line": li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
    })


@register("q8_plausibility", f"WITH {POSE}, l AS (SELECT scene, x, abs(x - lag(x) OVER (PARTITION BY scene ORDER BY t, eid)) AS step FROM pose) SELECT scene, count(*) FILTER (x > 60) AS fast, count(*) FILTER (step > 40) AS jerky, count(*) FILTER (x <= 60 AND coalesce(step, 0) <= 40) AS fine FROM l GROUP BY scene")
def q8(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("t", "eid")
    l = pose_track(spark, d).withColumn("step", F.abs(F.col("x") - F.lag("x").over(w)))  # noqa: E741
    return l.groupBy("scene").agg(F.count_if(F.expr("x > 60")).alias("fast"), F.count_if(F.coalesce(F.expr("step > 40"), F.lit(False))).alias("jerky"), F.count_if(F.expr("x <= 60 and coalesce(step, 0) <= 40")).alias("fine"))


@register("q9_static_calibration", f"WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n, count(*) OVER (PARTITION BY scene) AS c FROM pose), p AS (SELECT scene, y FROM n WHERE n IN (1, (c + 1) // 2, c)) SELECT scene, max(y) - min(y) <= 40 AS static FROM p GROUP BY scene")
def q9(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene")
    n = pose_track(spark, d).withColumn("n", F.row_number().over(w.orderBy("t", "eid"))).withColumn("c", F.count(F.lit(1)).over(w))
    return n.filter("n in (1, (c + 1) div 2, c)").groupBy("scene").agg((F.max("y") - F.min("y") <= 40).alias("static"))


@register("q10_all_or_nothing", "WITH s AS (SELECT source, bool_and(n_chars > 0 AND text IS NOT NULL) AS ready FROM documents GROUP BY source) SELECT source, ready, (SELECT bool_and(ready) FROM s) AS promoted FROM s")
def q10(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").groupBy("source").agg(F.bool_and((F.col("n_chars") > 0) & F.col("text").isNotNull()).alias("ready"))
    return s.join(F.broadcast(s.agg(F.bool_and("ready").alias("promoted"))))


@register("q11_reference_check", "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)")
def q11(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "labels").join(read(spark, d, "documents").filter("n_chars > 500"), "doc_id", "left_anti").select("doc_id")


@register("q13_remaining_work", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q13(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left_anti").select("doc_id")


@register("q14_forbidden_keys", "SELECT event_id, json_extract_string(props, '$.k') AS v FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) > 90")
def q14(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("v")).filter("cast(v as int) > 90")


@register("q16_recomputed_totals", "SELECT lang, count(*) AS n, sum(CASE WHEN length(text) = n_chars THEN 1 ELSE 0 END)::BIGINT AS equal FROM documents GROUP BY lang")
def q16(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("text") == F.col("n_chars")).alias("equal"))


@register("q17_target_shapes", "SELECT count(*) FILTER (len(embedding) <> 64) AS shape, count(*) FILTER (list_max(list_transform(embedding, lambda v: abs(v))) > 1) AS bound, count(*) FILTER (label IS NULL) AS unlabelled FROM embeddings")
def q17(spark: SparkSession, d: str) -> DataFrame:
    big = F.array_max(F.transform("embedding", F.abs)) > 1
    return read(spark, d, "embeddings").agg(F.count_if(F.size("embedding") != 64).alias("shape"), F.count_if(big).alias("bound"), F.count_if(F.col("label").isNull()).alias("unlabelled"))


@register("q18_recompute_and_compare", "WITH t AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS s FROM lineitem GROUP BY 1) SELECT count(*) AS n, count(*) FILTER (abs(s - o_totalprice) <= 0.5 * o_totalprice) AS close FROM orders JOIN t ON l_orderkey = o_orderkey")
def q18(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.expr("l_extendedprice * (1 - l_discount)")).alias("s"))
    o = read(spark, d, "orders").join(t, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("abs(s - o_totalprice) <= 0.5 * o_totalprice")).alias("close"))


@register("q19_class_membership", "SELECT l_returnflag AS cls, count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 1")
def q19(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").filter(~F.col("l_returnflag").isin("A", "N")).groupBy(F.col("l_returnflag").alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@register("q20_reuse_if_equal", "WITH a AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_discount < 0.05), b AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_tax < 0.05) SELECT 'only_a' AS side, count(*) AS n FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'only_b', count(*) FROM (FROM b EXCEPT FROM a)")
def q20(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    a, b = (li.filter(f).select("l_orderkey", "l_partkey").distinct() for f in ("l_discount < 0.05", "l_tax < 0.05"))
    return G.difference(a, b)


@register("q21_span_gate", "WITH s AS (SELECT user_id, ts::DATE AS day, epoch_us(max(ts)) - epoch_us(min(ts)) AS span FROM events GROUP BY ALL) SELECT round(quantile_cont(span / 1e6, 0.5), 4) AS p50, round(quantile_cont(span / 1e6, 0.95), 4) AS p95, count(*) FILTER (span > 36000000000) AS over FROM s")
def q21(spark: SparkSession, d: str) -> DataFrame:
    from trackloom.sources.tables import micros

    e = read(spark, d, "events").select("user_id", F.col("ts").cast("date").alias("day"), micros(F.col("ts")).alias("t"))
    s = e.groupBy("user_id", "day").agg((F.max("t") - F.min("t")).alias("span"))
    q = quantiles(s.withColumn("sec", F.col("span") / 1e6), "sec", {"p50": 0.5, "p95": 0.95})
    return q.select(F.round("p50", 4).alias("p50"), F.round("p95", 4).alias("p95")).join(s.agg(F.count_if(F.col("span") > 36000000000).alias("over")))


@register("q22_self_holdout", f"WITH {POSE}, h AS (SELECT *, eid % 10 = 0 AS held FROM pose), m AS (SELECT scene, kind, quantile_cont(x, 0.5) FILTER (NOT held) AS med FROM h GROUP BY ALL) SELECT round(avg(abs(x - med)), 5) AS error, count(*) AS n FROM h JOIN m USING (scene, kind) WHERE held AND med IS NOT NULL")
def q22(spark: SparkSession, d: str) -> DataFrame:
    h = pose_track(spark, d).withColumn("held", F.col("eid") % 10 == 0)
    m = h.filter("not held").groupBy("scene", "kind").agg(F.percentile("x", F.lit(0.5)).alias("med"))
    return h.filter("held").join(m, ["scene", "kind"]).agg(F.round(F.avg(F.abs(F.expr("x - med"))), 5).alias("error"), F.count(F.lit(1)).alias("n"))


@register("q23_value_quantiles", "SELECT l_returnflag AS cls, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99, count(*) FILTER (l_extendedprice > 90000) AS high FROM lineitem GROUP BY 1")
def q23(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("cls"), "l_extendedprice")
    k = with_quantiles(rows, ["cls"], "l_extendedprice", {"p50": 0.5, "p99": 0.99}, F.count_if(F.col("l_extendedprice") > 90000).alias("high"))
    return k.withColumn("p50", F.round("p50", 4)).withColumn("p99", F.round("p99", 4))


#: The columns that a full read has to find, with how to weigh each: characters of texts, microseconds of times, sums of numbers.
SHAPES = {
    "documents": {"doc_id": "sum", "text": "chars", "lang": "chars", "source": "chars", "n_chars": "sum"},
    "events": {"event_id": "sum", "ts": "time", "user_id": "sum", "event_type": "chars", "value": "sum", "props": "chars"},
    "orders": {"o_orderkey": "sum", "o_custkey": "sum", "o_orderdate": "time", "o_totalprice": "sum"},
}
_DUCK_WEIGHT = {"sum": "sum({c})", "chars": "sum(length({c}))", "time": "max(epoch_us({c}))"}
FULL_READ = " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{c}' AS name, count(*) AS n, count({c}) AS filled, round(CAST({_DUCK_WEIGHT[how].format(c=c)} AS DOUBLE), 3) AS amount FROM {t}" for t, columns in SHAPES.items() for c, how in columns.items()
)


@register("q24_full_read", FULL_READ)
def q24(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the tables is read, in one pass a table; a column that a shape names and the table lacks raises."""
    from trackloom.sources.tables import micros

    weight = {"sum": F.sum, "chars": lambda c: F.sum(F.length(c)), "time": lambda c: F.max(micros(c))}
    out = None
    for t, columns in SHAPES.items():
        rows = read(spark, d, t)
        if missing := columns.keys() - set(rows.columns):
            raise ValueError(f"{t} lacks {sorted(missing)}")
        once = rows.agg(F.count(F.lit(1)).alias("n"), *[x for c, how in columns.items() for x in (F.count(c).alias(f"{c}_filled"), F.round(weight[how](F.col(c)).cast("double"), 3).alias(f"{c}_amount"))])
        said = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"{c}_filled").alias("filled"), F.col(f"{c}_amount").alias("amount")) for c in columns])
        one = once.select(F.lit(t).alias("t"), "n", F.inline(said))
        out = one if out is None else out.unionByName(one)
    return out


LINES = "lines AS (SELECT l_orderkey AS line, CASE l_linenumber WHEN 1 THEN 'car 1 2' WHEN 2 THEN 'car x 2 3' ELSE concat_ws(' ', l_returnflag, l_quantity - 10, l_partkey, l_discount * 0 + 1) END AS raw FROM lineitem)"


@register("s8_label_parser", f"WITH {LINES}, f AS (SELECT line, raw, string_split(raw, ' ') AS p FROM lines) SELECT CASE WHEN len(p) <> 4 THEN 'field_count' WHEN TRY_CAST(p[2] AS DOUBLE) IS NULL OR TRY_CAST(p[3] AS DOUBLE) IS NULL OR TRY_CAST(p[4] AS DOUBLE) IS NULL THEN 'parse' WHEN CAST(p[2] AS DOUBLE) <= 0 THEN 'size' WHEN p[1] NOT IN ('A', 'N', 'car') THEN 'class' END AS reason, count(*) AS n FROM f GROUP BY 1")
def s8(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    raw = F.when(F.col("l_linenumber") == 1, "car 1 2").when(F.col("l_linenumber") == 2, "car x 2 3").otherwise(F.concat_ws(" ", "l_returnflag", (F.col("l_quantity") - 10).cast("string"), F.col("l_partkey").cast("string"), F.lit("1.0")))
    parsed = label_lines(li.select(F.col("l_orderkey").alias("line"), raw.alias("raw")), 4, [1, 2, 3], [1], 0, ["A", "N", "car"])
    return parsed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("s7_dedup_time", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS rn FROM events) SELECT user_id, event_id FROM r WHERE rn = 1")
def s7(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id", F.date_trunc("hour", "ts")).orderBy("ts", "event_id")
    return read(spark, d, "events").withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("user_id", "event_id")


@register("s14_category_count", "SELECT l_orderkey % 100 AS scene, count(*) FILTER (l_returnflag = 'R') / count(*) < 0.32 AS indoor FROM lineitem GROUP BY 1")
def s14(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 100).alias("scene")).agg((F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1)) < 0.32).alias("indoor"))


@register("s16_last_match_per_file", r"SELECT conv_id, arg_max(regexp_extract(text, '(\w+)\.', 1), turn) AS last FROM conversations WHERE regexp_matches(text, '\w+\.') AND NOT regexp_matches(text, '[^\x00-\x7F]') GROUP BY conv_id")
def s16(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return read(spark, d, "conversations").filter(t.rlike(r"\w+\.") & ~t.rlike(r"[^\x00-\x7F]")).groupBy("conv_id").agg(F.max_by(F.regexp_extract(t, r"(\w+)\.", 1), "turn").alias("last"))


@register("k6_sample_export", "WITH s AS (SELECT source, min(doc_id) AS ord FROM documents GROUP BY source HAVING count(*) >= 20 ORDER BY ord LIMIT 1), r AS (SELECT d.*, row_number() OVER (ORDER BY doc_id) AS rn FROM documents d JOIN s USING (source) WHERE n_chars > 100) SELECT doc_id FROM r WHERE rn <= 10")
def k6(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    s = docs.groupBy("source").agg(F.min("doc_id").alias("ord"), F.count(F.lit(1)).alias("n")).filter("n >= 20").orderBy("ord").limit(1)
    return docs.filter("n_chars > 100").join(F.broadcast(s.select("source")), "source").orderBy("doc_id").limit(10).select("doc_id")


@register("k7_polyline_export", f"WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS seq FROM pose) SELECT 'node_' || scene || '_' || lpad(CAST(seq AS VARCHAR), 4, '0') AS token, x, y FROM n")
def k7(spark: SparkSession, d: str) -> DataFrame:
    lines = pose_track(spark, d).groupBy("scene").agg(F.sort_array(F.collect_list(F.struct("t", "eid", "x", "y"))).alias("p"))
    n = lines.select("scene", F.posexplode("p").alias("seq", "q"))
    return n.select(F.concat(F.lit("node_"), F.col("scene").cast("string"), F.lit("_"), F.lpad(F.col("seq").cast("string"), 4, "0")).alias("token"), "q.x", "q.y")


@register("m4_health_fallback", f"WITH {POSE}, w AS (SELECT *, stddev_pop(x) OVER r AS sd, max(x) OVER r - min(x) OVER r AS rng FROM pose WINDOW r AS (PARTITION BY scene ORDER BY t, eid ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) SELECT scene, eid, CASE WHEN sd >= 3 AND rng >= 10 THEN x ELSE y END AS v FROM w")
def m4(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("t", "eid").rowsBetween(-9, 0)
    ok = (F.stddev_pop("x").over(w) >= 3) & (F.max("x").over(w) - F.min("x").over(w) >= 10)
    return pose_track(spark, d).select("scene", "eid", F.when(ok, F.col("x")).otherwise(F.col("y")).alias("v"))


@register("q25_coverage_rollup", "SELECT coalesce(lang, 'all') AS lang, coalesce(source, 'all') AS source, count(*) AS n, round(avg(CASE WHEN n_chars > 1000 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share FROM documents GROUP BY ROLLUP (lang, source)")
def q25(spark: SparkSession, d: str) -> DataFrame:
    rolled = read(spark, d, "documents").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), r6(F.avg((F.col("n_chars") > 1000).cast("double"))).alias("share"))
    return rolled.select(F.coalesce("lang", F.lit("all")).alias("lang"), F.coalesce("source", F.lit("all")).alias("source"), "n", "share")

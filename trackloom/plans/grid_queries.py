"""Grid queries (A1-A13) and raster queries that stay relational (R rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import band, r6
from trackloom.operators import grids as G
from trackloom.plans.oracle import POINTS
from trackloom.plans.registry import register
from trackloom.sources.tables import points

RC = ["r", "c"]
CELLS = f"{POINTS}, cells AS (SELECT *, CAST(trunc((x + 20) / 4) AS INT) AS r, CAST(trunc((y + 40) / 4) AS INT) AS c FROM points WHERE trunc((x + 20) / 4) >= 0 AND trunc((y + 40) / 4) >= 0)"
ORDER = ["AF", "AO", "NF", "NO", "RF", "RO"]
RANK = "CASE cls " + " ".join(f"WHEN '{k}' THEN {-i}" for i, k in enumerate(ORDER)) + " END"
OCC = f"{CELLS}, occ AS (SELECT DISTINCT frame, r, c FROM cells)"


def cells(spark: SparkSession, d: str) -> DataFrame:
    return G.binned(points(spark, d), 4.0, x0=-20.0, y0=-40.0)


def occupied(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("frame", *RC).distinct()


@register("p12_cell_index", f"WITH {CELLS} SELECT r, c, count(*) AS n FROM cells GROUP BY r, c")
def p12(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy(*RC).agg(F.count(F.lit(1)).alias("n"))


@register("a1_class_histogram", f"WITH {CELLS} SELECT r, c, cls, count(*) AS n, round(min(sqrt(x * x + y * y)), 6) AS nearest FROM cells GROUP BY r, c, cls")
def a1(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy(*RC, "cls").agg(F.count(F.lit(1)).alias("n"), r6(F.min(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")))).alias("nearest"))


@register("a2_cell_resolve", f"""WITH {CELLS}, w AS (SELECT r, c, count(*) AS total, count(*) FILTER (cls = 'AF') AS a0, count(*) FILTER (cls = 'NO') AS a1, count(*) FILTER (cls = 'RF') AS a2, count(*) FILTER (cls = 'AO') AS t0, count(*) FILTER (cls = 'RO') AS t1 FROM cells GROUP BY r, c),
l AS (SELECT r, c, total, CASE WHEN t1 >= 3 AND 4 * t1 >= total THEN 'RO' WHEN t0 >= 3 AND 4 * t0 >= total THEN 'AO' WHEN greatest(a0, a1, a2) = 0 THEN NULL WHEN a0 = greatest(a0, a1, a2) THEN 'AF' WHEN a1 = greatest(a0, a1, a2) THEN 'NO' ELSE 'RF' END AS cls FROM w)
SELECT r, c, cls, total FROM l WHERE cls IS NOT NULL""")
def a2(spark: SparkSession, d: str) -> DataFrame:
    return G.thin_override(G.histogram(cells(spark, d), RC), RC, ["AF", "NO", "RF"], ["AO", "RO"])


@register("a3_confidence_mask", f"WITH {CELLS} SELECT r, c FROM cells GROUP BY r, c HAVING min(sqrt(x * x + y * y)) <= 20")
def a3(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy(*RC).agg(F.min(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))).alias("m")).filter("m <= 20").select(*RC)


@register("a4_merge_grids", f"WITH {CELLS}, s AS (SELECT frame % 3 AS scene, r, c, count(*) AS n, min(z) AS low FROM cells GROUP BY ALL) SELECT r + CAST(scene AS INT) AS r, c, CAST(least(sum(n), 65535) AS BIGINT) AS n, round(min(low), 6) AS low FROM s GROUP BY ALL")
def a4(spark: SparkSession, d: str) -> DataFrame:
    grids = cells(spark, d).groupBy((F.col("frame") % 3).alias("scene"), *RC).agg(F.count(F.lit(1)).alias("n"), F.min("z").alias("low"))
    return grids.groupBy((F.col("r") + F.col("scene").cast("int")).alias("r"), "c").agg(F.least(F.sum("n"), F.lit(65535).cast("long")).alias("n"), r6(F.min("low")).alias("low"))


@register("a5_pillar_raster", f"WITH {CELLS} SELECT frame, r, c, round(ln(1 + count(*)), 6) AS log_n, round(max(z), 6) AS top, round(avg(z), 6) AS mean FROM cells GROUP BY frame, r, c")
def a5(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy("frame", *RC).agg(r6(F.log1p(F.count(F.lit(1)))).alias("log_n"), r6(F.max("z")).alias("top"), r6(F.avg("z")).alias("mean"))


@register("a6_min_splat", f"WITH {CELLS} SELECT frame, c, round(min(x), 6) AS depth FROM cells WHERE x > -19.5 GROUP BY frame, c")
def a6(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).filter("x > -19.5").groupBy("frame", "c").agg(r6(F.min("x")).alias("depth"))


@register("a7_best_label", f"WITH {CELLS} SELECT frame, r, c, min_by(cls, (z, cls)) AS cls FROM cells GROUP BY frame, r, c")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy("frame", *RC).agg(F.min_by("cls", F.struct("z", "cls")).alias("cls"))


@register("a8_temporal_majority", f"""WITH {CELLS}, f AS (SELECT frame, r, c, cls, count(*) AS n FROM cells GROUP BY ALL), v AS (SELECT f.frame + k AS frame, r, c, cls, sum(n) AS n FROM f, range(-8, 9) t(k) WHERE (cls NOT LIKE 'R%' OR abs(k) <= 1) AND f.frame + k BETWEEN 0 AND 49 GROUP BY ALL)
SELECT frame, r, c, max_by(cls, (n, {RANK})) AS cls, CAST(sum(n) AS BIGINT) AS total FROM v GROUP BY frame, r, c""")
def a8(spark: SparkSession, d: str) -> DataFrame:
    """Static classes vote over 8 frames either side, moving ones (R) over one; partial sums per frame keep the spread small."""
    per = G.histogram(cells(spark, d), ["frame", *RC])
    reach = F.when(F.col("cls").startswith("R"), F.sequence(F.lit(-1), F.lit(1))).otherwise(F.sequence(F.lit(-8), F.lit(8)))
    spread = per.withColumn("k", F.explode(reach)).withColumn("frame", F.col("frame") + F.col("k")).filter("frame between 0 and 49")
    votes = spread.groupBy("frame", *RC, "cls").agg(F.sum("n").alias("n"))
    return G.majority(votes, ["frame", *RC], ORDER).drop("n")


@register("a9_free_space_carving", f"""WITH {OCC}, ray AS (SELECT frame, r, c, 3 AS r0, 4 AS c0 FROM occ), w AS (SELECT DISTINCT frame, CAST(trunc(r0 + k / 8.0::DOUBLE * (r - r0)) AS INT) AS r, CAST(trunc(c0 + k / 8.0::DOUBLE * (c - c0)) AS INT) AS c FROM ray, range(0, 8) t(k))
SELECT frame, r, c FROM w WHERE NOT EXISTS (SELECT 1 FROM occ o WHERE o.frame = w.frame AND o.r = w.r AND o.c = w.c)""")
def a9(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    return G.carve(occ.withColumn("r0", F.lit(3)).withColumn("c0", F.lit(4)), occ, ["frame"], 8)


@register("a10_hits_over_seen", f"""WITH {CELLS}, f AS (SELECT DISTINCT frame, r, c, cls LIKE 'N%' AS hit FROM cells), a AS (SELECT r, c, count(DISTINCT frame) AS seen, count(DISTINCT frame) FILTER (hit) AS hits FROM f GROUP BY r, c)
SELECT r, c, hits, seen FROM a WHERE hits >= 3 AND hits >= 0.6 * seen""")
def a10(spark: SparkSession, d: str) -> DataFrame:
    per = cells(spark, d).groupBy("frame", *RC).agg(F.bool_or(F.col("cls").startswith("N")).alias("hit"))
    return per.groupBy(*RC).agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("seen")).filter("hits >= 3 and hits >= 0.6 * seen")


@register("a11_consensus_votes", f"""WITH {CELLS}, v AS (SELECT r, c, count(*) FILTER (cls LIKE 'A%') AS a, count(*) FILTER (cls LIKE 'N%') AS n, count(*) FILTER (cls LIKE 'R%') AS m FROM cells GROUP BY r, c)
SELECT r, c, CASE WHEN m >= 5 AND m > a AND m > n THEN 'moving' WHEN n >= 2 AND n > a THEN 'road' WHEN a >= 2 THEN 'side' END AS label FROM v""")
def a11(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.expr("r_ >= 5 and r_ > a and r_ > n"), "moving").when(F.expr("n >= 2 and n > a"), "road").when(F.expr("a >= 2"), "side")
    v = cells(spark, d).groupBy(*RC).agg(F.count_if(F.col("cls").startswith("A")).alias("a"), F.count_if(F.col("cls").startswith("N")).alias("n"), F.count_if(F.col("cls").startswith("R")).alias("r_"))
    return v.select(*RC, label.alias("label"))


TWO = f"""{CELLS}, one AS (SELECT r, c, max_by(cls, (n, {RANK})) AS cls FROM (SELECT r, c, cls, count(*) AS n FROM cells WHERE frame < 25 GROUP BY ALL) GROUP BY r, c),
two AS (SELECT r, c, max_by(cls, (n, {RANK})) AS cls FROM (SELECT r, c, cls, count(*) AS n FROM cells WHERE frame >= 25 GROUP BY ALL) GROUP BY r, c)"""


def two(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    every = cells(spark, d)
    return tuple(G.majority(G.histogram(every.filter(f), RC), RC, ORDER).select(*RC, "cls") for f in ("frame < 25", "frame >= 25"))


@register("a12_two_generations", f"WITH {TWO} SELECT r, c, CASE WHEN one.cls = two.cls THEN one.cls WHEN one.cls LIKE 'R%' THEN one.cls END AS cls FROM one FULL JOIN two USING (r, c)")
def a12(spark: SparkSession, d: str) -> DataFrame:
    a, b = two(spark, d)
    both = a.join(b.withColumnRenamed("cls", "other"), RC, "full")
    return both.select(*RC, F.when(F.col("cls") == F.col("other"), F.col("cls")).when(F.col("cls").startswith("R"), F.col("cls")).alias("cls"))


@register("a13_coverage_by_band", f"""WITH {OCC} SELECT frame, CASE WHEN r < 3 THEN 0 WHEN r < 6 THEN 1 ELSE 2 END AS band, count(*) AS n, round(count(*) / (27 * CASE WHEN max(r) < 6 THEN 3 ELSE 6 END), 6) AS share FROM occ WHERE r < 12 GROUP BY ALL""")
def a13(spark: SparkSession, d: str) -> DataFrame:
    b = occupied(spark, d).filter("r < 12").withColumn("band", band(F.col("r"), [0, 3, 6, 12]))
    return b.groupBy("frame", "band").agg(F.count(F.lit(1)).alias("n"), r6(F.count(F.lit(1)) / (27 * F.when(F.max("r") < 6, 3).otherwise(6))).alias("share"))


@register("a21_confusion_iou", f"""WITH {TWO}, k AS (SELECT one.cls AS truth, two.cls AS said, count(*) AS n FROM one JOIN two USING (r, c) GROUP BY ALL), cs AS (SELECT truth AS cls FROM k UNION SELECT said FROM k)
SELECT cls, CAST(coalesce(sum(n) FILTER (truth = cls AND said = cls), 0) AS BIGINT) AS inter, round(coalesce(sum(n) FILTER (truth = cls AND said = cls), 0) / sum(n), 6) AS iou FROM cs, k WHERE truth = cls OR said = cls GROUP BY cls""")
def a21(spark: SparkSession, d: str) -> DataFrame:
    a, b = two(spark, d)
    k = G.confusion(a.join(b.withColumnRenamed("cls", "other"), RC), "cls", "other")
    return G.iou(k).select("cls", "inter", r6("iou").alias("iou"))


@register("a22_iou_with_ignore", f"""WITH {TWO}, k AS (SELECT CASE WHEN one.cls <> 'NO' THEN one.cls LIKE 'A%' END AS truth, coalesce(two.cls LIKE 'A%', false) AS said FROM one LEFT JOIN two USING (r, c))
SELECT round(count(*) FILTER (truth AND said) / nullif(count(*) FILTER (truth OR said), 0), 6) AS iou, count(*) AS cells FROM k WHERE truth IS NOT NULL""")
def a22(spark: SparkSession, d: str) -> DataFrame:
    a, b = two(spark, d)
    k = a.filter("cls <> 'NO'").join(b.withColumnRenamed("cls", "other"), RC, "left").select(F.col("cls").startswith("A").alias("truth"), F.coalesce(F.col("other").startswith("A"), F.lit(False)).alias("said"))
    return k.agg(r6(F.count_if(F.expr("truth and said")) / F.nullif(F.count_if(F.expr("truth or said")), F.lit(0))).alias("iou"), F.count(F.lit(1)).alias("cells"))


@register("r1_warp_nearest", f"""WITH {OCC}, t AS (SELECT frame, i AS r, j AS c, CAST(round_even(0.8 * i - 0.6 * j + 3, 0) AS INT) AS sr, CAST(round_even(0.6 * i + 0.8 * j + 1, 0) AS INT) AS sc FROM (SELECT DISTINCT frame FROM occ), range(0, 12) a(i), range(0, 20) b(j))
SELECT t.frame, t.r, t.c FROM t JOIN occ o ON o.frame = t.frame AND o.r = t.sr AND o.c = t.sc""")
def r1(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    window = occ.select("frame").distinct().withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long")))).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))))
    source = window.select("frame", "r", "c", F.rint(0.8 * F.col("r") - 0.6 * F.col("c") + 3).cast("int").alias("sr"), F.rint(0.6 * F.col("r") + 0.8 * F.col("c") + 1).cast("int").alias("sc"))
    return source.join(occ.select("frame", F.col("r").alias("sr"), F.col("c").alias("sc")), ["frame", "sr", "sc"]).select("frame", "r", "c")


@register("r2_close", f"""WITH {OCC}, o AS (SELECT frame, r, c FROM occ WHERE (r + c + frame) % 3 <> 0), dil AS (SELECT DISTINCT frame, r + CAST(a AS INT) AS r, c + CAST(b AS INT) AS c FROM o, range(-1, 2) s(a), range(-1, 2) t(b))
SELECT frame, r + CAST(a AS INT) AS r, c + CAST(b AS INT) AS c FROM dil, range(-1, 2) s(a), range(-1, 2) t(b) GROUP BY ALL HAVING count(*) = 9""")
def r2(spark: SparkSession, d: str) -> DataFrame:
    return G.close(occupied(spark, d).filter("(r + c + frame) % 3 <> 0"), ["frame"], 1)


@register("r3_disc_stamp", f"""WITH {OCC}, p AS (SELECT frame, r, c FROM occ WHERE c = 5) SELECT DISTINCT frame, r + CAST(a AS INT) AS r, c + CAST(b AS INT) AS c FROM p, range(-2, 3) s(a), range(-2, 3) t(b) WHERE a * a + b * b <= 4
  AND NOT EXISTS (SELECT 1 FROM occ o WHERE o.frame = p.frame AND o.r = p.r + a AND o.c = p.c + b)""")
def r3(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    return G.offsets(occ.filter("c = 5"), G.disc(2)).distinct().join(occ, ["frame", *RC], "left_anti")


@register("r9_later_overwrites", f"WITH {CELLS} SELECT r, c, max_by(cls, (frame, z, cls)) AS cls FROM cells GROUP BY r, c")
def r9(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy(*RC).agg(F.max_by("cls", F.struct("frame", "z", "cls")).alias("cls"))


@register("r10_line_of_sight", f"""WITH {OCC}, hit AS (SELECT f.frame, f.r, f.c, bool_or(b.frame IS NOT NULL) AS blocked FROM occ f CROSS JOIN range(1, 64) t(k) LEFT JOIN occ b ON b.frame = f.frame AND b.c > 8 AND b.r = CAST(trunc(k / 64.0::DOUBLE * f.r) AS INT) AND b.c = CAST(trunc(k / 64.0::DOUBLE * f.c) AS INT) AND NOT (b.r = f.r AND b.c = f.c) GROUP BY ALL)
SELECT frame, r, c FROM hit WHERE NOT blocked""")
def r10(spark: SparkSession, d: str) -> DataFrame:
    """Cells whose ray from (0, 0) meets no blocker: 63 samples of each ray, looked up by equality."""
    occ = occupied(spark, d)
    part = F.col("k") / 64
    rays = occ.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(63)))).select("frame", *RC, (part * F.col("r")).cast("int").alias("br"), (part * F.col("c")).cast("int").alias("bc")).filter("not (br = r and bc = c)").distinct()
    blockers = occ.filter("c > 8").select("frame", F.col("r").alias("br"), F.col("c").alias("bc"))
    return occ.join(rays.join(blockers, ["frame", "br", "bc"]).select("frame", *RC).distinct(), ["frame", *RC], "left_anti")


@register("r11_coverage_downsample", f"WITH {CELLS} SELECT r // 2 AS r, c // 2 AS c, avg(CASE WHEN cls = 'RO' THEN 1.0::DOUBLE ELSE 0 END) > 0.12 AS thin FROM cells GROUP BY r // 2, c // 2")
def r11(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy(F.expr("cast(r div 2 as int)").alias("r"), F.expr("cast(c div 2 as int)").alias("c")).agg((F.avg((F.col("cls") == "RO").cast("double")) > 0.12).alias("thin"))


@register("r12_pool_and_upsample", f"WITH {CELLS}, p AS (SELECT r // 2 AS r, c // 2 AS c, max(z) AS z FROM cells GROUP BY ALL) SELECT r * 2 + CAST(a AS INT) AS r, c * 2 + CAST(b AS INT) AS c, round(z, 6) AS z FROM p, range(0, 2) s(a), range(0, 2) t(b)")
def r12(spark: SparkSession, d: str) -> DataFrame:
    pooled = cells(spark, d).groupBy(F.expr("cast(r div 2 as int)").alias("r"), F.expr("cast(c div 2 as int)").alias("c")).agg(F.max("z").alias("z"))
    doubled = pooled.withColumn("r", F.col("r") * 2).withColumn("c", F.col("c") * 2)
    return G.offsets(doubled, [(0, 0), (0, 1), (1, 0), (1, 1)]).select(*RC, r6("z").alias("z"))


@register("r14_neighbour_fill", f"""WITH {CELLS}, m AS (SELECT frame, r, c, cls, min(z) AS z FROM cells GROUP BY ALL), s AS (SELECT frame, r + CAST(a AS INT) AS r, c + CAST(b AS INT) AS c, cls, z FROM m, range(-1, 2) x(a), range(-1, 2) y(b) WHERE NOT (a = 0 AND b = 0)),
f AS (SELECT frame, r, c, cls, quantile_cont(z, 0.5) AS z FROM s GROUP BY ALL HAVING count(*) >= 2 AND max(z) - min(z) <= greatest(0.6, 0.08 * quantile_cont(z, 0.5)))
SELECT frame, r, c, cls, round(z, 6) AS z FROM f WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.frame = f.frame AND m.r = f.r AND m.c = f.c AND m.cls = f.cls)""")
def r14(spark: SparkSession, d: str) -> DataFrame:
    """A cell without a class takes the median of its neighbours that have it, in each frame; a median is over eight values at most."""
    keys = ["frame", *RC, "cls"]
    m = cells(spark, d).groupBy(*keys).agg(F.min("z").alias("z"))
    mid = F.percentile("z", F.lit(0.5))
    near = G.offsets(m, [s for s in G.square(1) if s != (0, 0)]).groupBy(*keys).agg(mid.alias("mid"), F.count(F.lit(1)).alias("n"), (F.max("z") - F.min("z")).alias("spread"))
    return near.filter((F.col("n") >= 2) & (F.col("spread") <= F.greatest(F.lit(0.6), 0.08 * F.col("mid")))).join(m, keys, "left_anti").select(*keys, r6("mid").alias("z"))


@register("r24_known_subtraction", f"WITH {CELLS}, box AS (SELECT DISTINCT frame, r, c FROM cells WHERE cls = 'NF') SELECT cells.frame, cells.r, cells.c, cls, CASE WHEN box.frame IS NOT NULL THEN 'known' WHEN cls LIKE 'R%' AND cells.r < 3 THEN 'free' WHEN cls LIKE 'R%' THEN 'ignore' ELSE 'unknown' END AS label FROM cells LEFT JOIN box USING (frame, r, c)")
def r24(spark: SparkSession, d: str) -> DataFrame:
    every = cells(spark, d)
    box = every.filter("cls = 'NF'").select("frame", *RC).distinct().withColumn("known", F.lit(True))
    moving = F.col("cls").startswith("R")
    return every.join(box, ["frame", *RC], "left").select("frame", *RC, "cls", F.when(F.col("known"), "known").when(moving & (F.col("r") < 3), "free").when(moving, "ignore").otherwise("unknown").alias("label"))


@register("r25_protected_fill", f"""WITH {CELLS}, cur AS (SELECT r, c, min(cls) AS cls FROM cells WHERE frame = 1 GROUP BY ALL), prop AS (SELECT r, c, max_by(cls, (n, {RANK})) AS cls FROM (SELECT r, c, cls, count(*) AS n FROM cells GROUP BY ALL) GROUP BY ALL)
SELECT r, c, coalesce(cur.cls, prop.cls) AS cls, cur.cls IS NULL AS filled FROM cur FULL JOIN prop USING (r, c)""")
def r25(spark: SparkSession, d: str) -> DataFrame:
    every = cells(spark, d)
    now = every.filter("frame = 1").groupBy(*RC).agg(F.min("cls").alias("now"))
    proposed = G.majority(G.histogram(every, RC), RC, ORDER).select(*RC, "cls")
    return now.join(proposed, RC, "full").select(*RC, F.coalesce("now", "cls").alias("cls"), F.col("now").isNull().alias("filled"))


@register("r26_edge_thinning", f"WITH {OCC} SELECT o.frame, o.r, o.c FROM occ o WHERE NOT EXISTS (SELECT 1 FROM occ n WHERE n.frame = o.frame AND n.r = o.r AND n.c = o.c + 1)")
def r26(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    return occ.join(occ.select("frame", "r", (F.col("c") - 1).alias("c")), ["frame", *RC], "left_anti")


@register("r27_metric_crop", f"WITH {CELLS} SELECT frame, r, c, count(*) AS n FROM cells WHERE x BETWEEN -10 AND 15 AND abs(y) <= 20 GROUP BY ALL")
def r27(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).filter("x between -10 and 15 and abs(y) <= 20").groupBy("frame", *RC).agg(F.count(F.lit(1)).alias("n"))


@register("r29_instance_boxes", f"WITH {CELLS} SELECT frame, cls, min(r) AS r0, min(c) AS c0, max(r) AS r1, max(c) AS c1, count(*) AS n FROM cells GROUP BY frame, cls")
def r29(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).groupBy("frame", "cls").agg(F.min("r").alias("r0"), F.min("c").alias("c0"), F.max("r").alias("r1"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("n"))


@register("r31_evidence_fusion", f"""WITH {CELLS}, v AS (SELECT r, c, count(*) FILTER (z < 1) AS lidar, count(*) FILTER (z BETWEEN 1 AND 1.5) AS camera, count(*) FILTER (z > 1.5) AS map FROM cells GROUP BY r, c)
SELECT r, c, CASE WHEN map >= 5 AND camera >= 2 THEN 7 WHEN lidar >= 20 AND camera >= 5 THEN 5 WHEN lidar >= 20 THEN 3 WHEN camera >= 2 THEN 2 WHEN map > 0 THEN 1 ELSE 0 END AS code FROM v""")
def r31(spark: SparkSession, d: str) -> DataFrame:
    v = cells(spark, d).groupBy(*RC).agg(F.count_if(F.expr("z < 1")).alias("lidar"), F.count_if(F.expr("z between 1 and 1.5")).alias("camera"), F.count_if(F.expr("z > 1.5")).alias("map"))
    code = F.when(F.expr("map >= 5 and camera >= 2"), 7).when(F.expr("lidar >= 20 and camera >= 5"), 5).when(F.expr("lidar >= 20"), 3).when(F.expr("camera >= 2"), 2).when(F.expr("map > 0"), 1).otherwise(0)
    return v.select(*RC, code.alias("code"))


@register("r32_bright_tail", f"""WITH {CELLS}, q AS (SELECT r, greatest(quantile_cont(z, 0.985), 1.9) AS cut FROM cells GROUP BY r HAVING count(*) >= 50) SELECT frame, cells.r, c, round(z, 6) AS z FROM cells JOIN q ON q.r = cells.r WHERE z > cut""")
def r32(spark: SparkSession, d: str) -> DataFrame:
    every = cells(spark, d)
    cut = every.groupBy("r").agg(F.greatest(F.percentile("z", F.lit(0.985)), F.lit(1.9)).alias("cut"), F.count(F.lit(1)).alias("n")).filter("n >= 50")
    return every.join(cut.select("r", "cut"), "r").filter("z > cut").select("frame", *RC, r6("z").alias("z"))


@register("r33_tolerant_agreement", f"""WITH {OCC} SELECT a.frame, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM occ b WHERE b.frame = a.frame - 1 AND abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1)) AS agree FROM occ a WHERE a.frame > 0 GROUP BY a.frame""")
def r33(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    before = G.dilate(occ, ["frame"], 1).withColumn("frame", F.col("frame") + 1).withColumn("hit", F.lit(True))
    return occ.filter("frame > 0").join(before, ["frame", *RC], "left").groupBy("frame").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hit").isNotNull()).alias("agree"))


@register("x5_column_runs", f"""WITH {OCC}, g AS (SELECT frame, r, c, c - row_number() OVER (PARTITION BY frame, r ORDER BY c) AS g FROM occ) SELECT frame, r, min(c) AS first_c, count(*) AS n, round(avg(c), 6) AS centroid FROM g GROUP BY frame, r, g""")
def x5(spark: SparkSession, d: str) -> DataFrame:
    g = occupied(spark, d).withColumn("g", F.col("c") - F.row_number().over(Window.partitionBy("frame", "r").orderBy("c")))
    return g.groupBy("frame", "r", "g").agg(F.min("c").alias("first_c"), F.count(F.lit(1)).alias("n"), r6(F.avg("c")).alias("centroid")).drop("g")


@register("x6_edge_offsets", f"WITH {OCC}, e AS (SELECT frame, r, min(c) AS lo, max(c) AS hi, count(*) AS n FROM occ GROUP BY frame, r) SELECT a.frame, a.r, a.lo - b.lo AS left_off, a.hi - b.hi AS right_off, round(a.n / b.n, 6) AS width_ratio FROM e a JOIN e b ON a.r = b.r AND b.frame = a.frame + 1")
def x6(spark: SparkSession, d: str) -> DataFrame:
    e = occupied(spark, d).groupBy("frame", "r").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("n"))
    nxt = e.select((F.col("frame") - 1).alias("frame"), "r", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("n").alias("n2"))
    return e.join(nxt, ["frame", "r"]).select("frame", "r", (F.col("lo") - F.col("lo2")).alias("left_off"), (F.col("hi") - F.col("hi2")).alias("right_off"), r6(F.col("n") / F.col("n2")).alias("width_ratio"))


@register("x7_tolerant_precision_recall", f"""WITH {OCC}, a AS (SELECT * FROM occ WHERE (r + c) % 4 = 0), b AS (SELECT frame, r, c FROM occ WHERE (r + 2 * c) % 5 = 0), k AS (SELECT CAST(k AS INT) AS k FROM range(0, 3) t(k)),
m AS (SELECT k, round((SELECT avg(CASE WHEN EXISTS (SELECT 1 FROM b WHERE b.frame = a.frame AND abs(b.r - a.r) <= k AND abs(b.c - a.c) <= k) THEN 1.0::DOUBLE ELSE 0 END) FROM a), 6) AS precision, round((SELECT avg(CASE WHEN EXISTS (SELECT 1 FROM a WHERE b.frame = a.frame AND abs(b.r - a.r) <= k AND abs(b.c - a.c) <= k) THEN 1.0::DOUBLE ELSE 0 END) FROM b), 6) AS recall FROM k) SELECT *, round(2 * precision * recall / (precision + recall), 5) AS f1 FROM m""")
def x7(spark: SparkSession, d: str) -> DataFrame:
    occ = occupied(spark, d)
    a, b = occ.filter("(r + c) % 4 = 0"), occ.filter("(r + 2 * c) % 5 = 0")
    out = None
    for k in range(3):
        hit = lambda x, y, k=k: x.join(G.dilate(y, ["frame"], k).withColumn("hit", F.lit(1.0)), ["frame", *RC], "left").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("v"))
        one = hit(a, b).select(F.lit(k).alias("k"), r6("v").alias("precision")).join(hit(b, a).select(F.lit(k).alias("k"), r6("v").alias("recall")), "k")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("f1", F.round(F.expr("2 * precision * recall / (precision + recall)"), 5))


@register("x24_best_shift", f"""WITH {OCC}, s AS (SELECT CAST(a AS INT) AS dr, CAST(b AS INT) AS dc FROM range(-2, 3) x(a), range(-2, 3) y(b)), t AS (SELECT frame, count(*) AS total FROM occ GROUP BY frame),
i AS (SELECT a.frame, dr, dc, count(*) AS n FROM occ a, s, occ b WHERE b.frame = a.frame + 1 AND b.r = a.r + dr AND b.c = a.c + dc GROUP BY ALL),
u AS (SELECT i.*, round(n / (a.total + b.total - n), 9) AS iou FROM i JOIN t a ON a.frame = i.frame JOIN t b ON b.frame = i.frame + 1) SELECT frame, arg_max(dr, (iou, dr, dc)) AS dr, arg_max(dc, (iou, dr, dc)) AS dc, round(max(iou), 6) AS iou FROM u GROUP BY frame""")
def x24(spark: SparkSession, d: str) -> DataFrame:
    """Of each frame and the next one: the integer shift with the largest intersection over union."""
    occ = occupied(spark, d)
    moved = occ.select((F.col("frame") + 1).alias("frame"), "r", "c", F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in G.square(2)])).alias("s"))
    moved = moved.select("frame", (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"), "s.dr", "s.dc")
    hits = moved.join(occ, ["frame", *RC]).groupBy("frame", "dr", "dc").agg(F.count(F.lit(1)).alias("n"))
    total = occ.groupBy("frame").agg(F.count(F.lit(1)).alias("total"))
    hits = hits.join(total, "frame").join(total.select((F.col("frame") + 1).alias("frame"), F.col("total").alias("before")), "frame")
    hits = hits.withColumn("iou", F.round(F.expr("n / (total + before - n)"), 9))
    return hits.groupBy((F.col("frame") - 1).alias("frame")).agg(F.max(F.struct("iou", "dr", "dc")).alias("b")).select("frame", "b.dr", "b.dc", r6("b.iou").alias("iou"))

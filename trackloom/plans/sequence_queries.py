"""Window and sequence queries (W rows) and the statistics of whole tracks (A14-A19)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import first_reason, r6
from trackloom.operators import sequences as S
from trackloom.plans.oracle import POSE
from trackloom.plans.registry import register
from trackloom.sources.tables import pose_track

K, O = ["scene"], ["t", "eid"]
LAGS = "lag({0}) OVER w AS b, lead({0}) OVER w AS f"


@register("w1_gradient_speed", f"""WITH {POSE}, g AS (SELECT *, lag(x) OVER w AS bx, lead(x) OVER w AS fx, lag(y) OVER w AS by_, lead(y) OVER w AS fy, lag(t) OVER w AS bt, lead(t) OVER w AS ft
  FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)),
d AS (SELECT scene, eid, CASE WHEN bx IS NULL THEN fx - x WHEN fx IS NULL THEN x - bx ELSE (fx - bx) / 2 END AS gx,
  CASE WHEN by_ IS NULL THEN fy - y WHEN fy IS NULL THEN y - by_ ELSE (fy - by_) / 2 END AS gy,
  CASE WHEN bt IS NULL THEN ft - t WHEN ft IS NULL THEN t - bt ELSE (ft - bt) / 2.0::DOUBLE END AS gt FROM g)
SELECT scene, eid, round(sqrt(gx * gx + gy * gy) / nullif(gt / 1e6, 0), 6) AS speed FROM d""")
def w1(spark: SparkSession, d: str) -> DataFrame:
    return S.speed(pose_track(spark, d), K, O).select("scene", "eid", r6("speed").alias("speed"))


@register("w2_box_filter", f"WITH {POSE} SELECT scene, eid, round(sum(x) OVER (PARTITION BY scene ORDER BY t, eid ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS smooth FROM pose")
def w2(spark: SparkSession, d: str) -> DataFrame:
    return pose_track(spark, d).select("scene", "eid", r6(S.box5("x", S.along(K, O))).alias("smooth"))


YAW = f"{POSE}, yawed AS (SELECT *, (x * 0.37) - floor((x * 0.37 + pi()) / (2 * pi())) * 2 * pi() AS yaw FROM pose)"


def yawed(spark: SparkSession, d: str) -> DataFrame:
    """A heading in [-pi, pi) that jumps at the seam, from x."""
    a = F.col("x") * 0.37
    return pose_track(spark, d).withColumn("yaw", a - F.floor((a + math.pi) / (2 * math.pi)) * 2 * math.pi)


@register("w3_yaw_unwrap", f"""WITH {YAW}, s AS (SELECT *, yaw - lag(yaw) OVER (PARTITION BY scene ORDER BY t, eid) + pi() AS dd FROM yawed)
SELECT scene, eid, round(first_value(yaw) OVER w + sum(coalesce(dd - floor(dd / (2 * pi())) * 2 * pi() - pi(), 0)) OVER w, 4) AS unwrapped
FROM s WINDOW w AS (PARTITION BY scene ORDER BY t, eid ROWS UNBOUNDED PRECEDING)""")
def w3(spark: SparkSession, d: str) -> DataFrame:
    return S.unwrap(yawed(spark, d), "yaw", K, O).select("scene", "eid", F.round("unwrapped", 4).alias("unwrapped"))


STEP = f"{POSE}, stepped AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid))"


@register("w4_step_teleport", f"WITH {STEP} SELECT scene, eid, round(step, 6) AS step, coalesce(step > 60, false) AS teleport FROM stepped")
def w4(spark: SparkSession, d: str) -> DataFrame:
    return S.steps(pose_track(spark, d), K, O).select("scene", "eid", r6("step").alias("step"), F.coalesce(F.col("step") > 60, F.lit(False)).alias("teleport"))


ERROR = f"""{YAW}, c AS (SELECT *, yaw - atan2(lead(y) OVER w - lag(y) OVER w, lead(x) OVER w - lag(x) OVER w) + pi() AS dd FROM yawed WINDOW w AS (PARTITION BY scene ORDER BY t, eid)),
err AS (SELECT *, abs(dd - floor(dd / (2 * pi())) * 2 * pi() - pi()) AS error FROM c)"""


@register("w5_heading_vs_motion", f"WITH {ERROR} SELECT scene, eid, round(error, 6) AS error FROM err WHERE error IS NOT NULL")
def w5(spark: SparkSession, d: str) -> DataFrame:
    return S.heading_error(yawed(spark, d), "yaw", K, O).filter("error is not null").select("scene", "eid", r6("error").alias("error"))


@register("w6_until_jump", f"""WITH {STEP}, r AS (SELECT *, max(CASE WHEN step > 90 THEN 1 ELSE 0 END) OVER (PARTITION BY scene ORDER BY t, eid ROWS UNBOUNDED PRECEDING) AS j FROM stepped)
SELECT scene, eid, x, y FROM r WHERE j = 0""")
def w6(spark: SparkSession, d: str) -> DataFrame:
    return S.until_jump(pose_track(spark, d), 90.0, K, O).select("scene", "eid", "x", "y")


@register("w7_isolated_flip", f"""WITH {POSE}, n AS (SELECT *, {LAGS.format('kind')} FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid))
SELECT scene, eid, CASE WHEN b = f AND b <> kind THEN b ELSE kind END AS smoothed FROM n""")
def w7(spark: SparkSession, d: str) -> DataFrame:
    return S.without_flips(pose_track(spark, d), "kind", K, O).select("scene", "eid", "smoothed")


@register("w8_islands", """WITH i AS (SELECT DISTINCT user_id AS scene, event_id // 40 AS idx FROM events), g AS (SELECT *, idx - row_number() OVER (PARTITION BY scene ORDER BY idx) AS g FROM i)
SELECT scene, min(idx) AS "first", max(idx) AS "last", count(*) AS n FROM g GROUP BY scene, g HAVING count(*) >= 2""")
def w8(spark: SparkSession, d: str) -> DataFrame:
    return S.islands(pose_track(spark, d).select("scene", F.expr("eid div 40").alias("idx")), "idx", K, 2)


@register("w9_stride", f"WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n FROM pose) SELECT scene, eid FROM n WHERE (n - 1) % 5 = 0")
def w9(spark: SparkSession, d: str) -> DataFrame:
    return S.strided(pose_track(spark, d), 5, K, O).select("scene", "eid")


@register("w10_trim", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n, count(*) OVER (PARTITION BY scene) AS c FROM pose)
SELECT scene, eid FROM n WHERE c <= 25 OR (n > 10 AND n <= c - 15)""")
def w10(spark: SparkSession, d: str) -> DataFrame:
    return S.trimmed(pose_track(spark, d), 10, 15, K, O).select("scene", "eid")


HOUR = 3_600_000_000


@register("w11_resample", f"""WITH {POSE}, s AS (SELECT *, (t - min(t) OVER (PARTITION BY scene) + {HOUR} - 1) // {HOUR} AS slot FROM pose),
n AS (SELECT *, row_number() OVER (PARTITION BY scene, slot ORDER BY t) AS n FROM s) SELECT scene, eid FROM n WHERE n = 1""")
def w11(spark: SparkSession, d: str) -> DataFrame:
    return S.resampled(pose_track(spark, d), HOUR, K).select("scene", "eid")


@register("w12_neighbourhood", f"""WITH {POSE} SELECT scene, eid, count(*) OVER w AS n, round(max(x) OVER w, 6) AS top FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t RANGE BETWEEN {HOUR} PRECEDING AND {HOUR} FOLLOWING)""")
def w12(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("t").rangeBetween(-HOUR, HOUR)
    return pose_track(spark, d).select("scene", "eid", F.count(F.lit(1)).over(w).alias("n"), r6(F.max("x").over(w)).alias("top"))


@register("w13_gap_parts", f"""WITH {POSE}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY scene ORDER BY t) > 6 * {HOUR} THEN 1 ELSE 0 END AS gap FROM pose),
p AS (SELECT *, CAST(sum(gap) OVER (PARTITION BY scene ORDER BY t ROWS UNBOUNDED PRECEDING) AS BIGINT) AS part FROM g) SELECT scene, part, count(*) AS n FROM p GROUP BY scene, part""")
def w13(spark: SparkSession, d: str) -> DataFrame:
    return S.gap_groups(pose_track(spark, d), 6 * HOUR, K).groupBy("scene", "part").agg(F.count(F.lit(1)).alias("n"))


@register("w14_arc_length", f"WITH {STEP} SELECT scene, eid, round(sum(coalesce(step, 0)) OVER (PARTITION BY scene ORDER BY t, eid ROWS UNBOUNDED PRECEDING), 4) AS along FROM stepped")
def w14(spark: SparkSession, d: str) -> DataFrame:
    return S.arc_length(pose_track(spark, d), K, O).select("scene", "eid", F.round("along", 4).alias("along"))


@register("w15_roi_runs", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n FROM pose), i AS (SELECT scene, n, n - row_number() OVER (PARTITION BY scene ORDER BY n) AS g FROM n WHERE x < 20 AND y < 60)
SELECT scene, min(n) AS "first", max(n) AS "last", count(*) AS n FROM i GROUP BY scene, g HAVING count(*) >= 2""")
def w15(spark: SparkSession, d: str) -> DataFrame:
    placed = pose_track(spark, d).withColumn("n", F.row_number().over(S.along(K, O)).cast("long"))
    return S.islands(placed.filter((F.col("x") < 20) & (F.col("y") < 60)).withColumnRenamed("n", "place"), "place", K, 2)


@register("w16_comfort_curvature", f"""WITH {POSE}, l AS (SELECT scene, eid, x - 2 * lag(x, 1) OVER w + lag(x, 2) OVER w AS second, atan2(lead(y) OVER w - y, lead(x) OVER w - x) - atan2(y - lag(y) OVER w, x - lag(x) OVER w) + pi() AS dd
  FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)) SELECT scene, eid, round(second, 6) AS second, round(dd - floor(dd / (2 * pi())) * 2 * pi() - pi(), 6) AS turn FROM l WHERE dd IS NOT NULL AND second IS NOT NULL""")
def w16(spark: SparkSession, d: str) -> DataFrame:
    both = S.turning(S.second_difference(pose_track(spark, d), "x", K, O), K, O)
    return both.filter("turn is not null and second is not null").select("scene", "eid", r6("second").alias("second"), r6("turn").alias("turn"))


@register("w17_theil_sen", f"""WITH {POSE}, n AS (SELECT scene, row_number() OVER (PARTITION BY scene ORDER BY t, eid) AS n, x FROM pose)
SELECT a.scene, round(least(greatest(quantile_cont((b.x - a.x) / (b.n - a.n), 0.5), -1), 1), 6) AS slope FROM n a JOIN n b ON a.scene = b.scene AND b.n - a.n >= 8 GROUP BY a.scene""")
def w17(spark: SparkSession, d: str) -> DataFrame:
    placed = pose_track(spark, d).withColumn("n", F.row_number().over(S.along(K, O)).cast("long"))
    return S.theil_sen(placed, K, "n", "x", 8, 1.0).select("scene", r6("slope").alias("slope"))


@register("w18_group_advantage", f"""WITH {POSE} SELECT scene, eid, round((x - avg(x) OVER w) / greatest(coalesce(stddev_samp(x) OVER w, 0), 0.001), 5) AS advantage FROM pose WINDOW w AS (PARTITION BY scene, kind)""")
def w18(spark: SparkSession, d: str) -> DataFrame:
    return S.advantage(pose_track(spark, d), "x", ["scene", "kind"]).select("scene", "eid", F.round("advantage", 5).alias("advantage"))


def scene_statistics(track: DataFrame, longest: float, least_rows: int) -> DataFrame:
    """scene, n, distance, median_step, max_step, verdict: the first failing rule, or ok."""
    hourly = S.resampled(track, HOUR, K)
    stats = S.steps(hourly, K, O).groupBy("scene").agg(F.count(F.lit(1)).alias("n"), F.sum("step").alias("distance"), F.percentile("step", F.lit(0.5)).alias("median_step"), F.max("step").alias("max_step"))
    verdict = F.coalesce(first_reason(("too_short", F.col("n") < least_rows), ("teleport", F.col("max_step") > longest), ("still", F.col("median_step") < 15)), F.lit("ok"))
    return stats.select("scene", "n", F.round("distance", 4).alias("distance"), r6("median_step").alias("median_step"), r6("max_step").alias("max_step"), verdict.alias("verdict"))


@register("a14_scene_statistics", f"""WITH {POSE}, s AS (SELECT *, (t - min(t) OVER (PARTITION BY scene) + {HOUR} - 1) // {HOUR} AS slot FROM pose), r AS (SELECT *, row_number() OVER (PARTITION BY scene, slot ORDER BY t) AS rn FROM s),
q AS (SELECT scene, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM r WHERE rn = 1 WINDOW w AS (PARTITION BY scene ORDER BY t, eid)),
a AS (SELECT scene, count(*) AS n, sum(step) AS distance, quantile_cont(step, 0.5) AS med, max(step) AS top FROM q GROUP BY scene)
SELECT scene, n, round(distance, 4) AS distance, round(med, 6) AS median_step, round(top, 6) AS max_step, CASE WHEN n < 10 THEN 'too_short' WHEN top > 200 THEN 'teleport' WHEN med < 15 THEN 'still' ELSE 'ok' END AS verdict FROM a""")
def a14(spark: SparkSession, d: str) -> DataFrame:
    return scene_statistics(pose_track(spark, d), 200.0, 10)


@register("a15_pose_quality", f"""WITH {ERROR}, st AS (SELECT scene, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step, error FROM err WINDOW w AS (PARTITION BY scene ORDER BY t, eid))
SELECT scene, count(*) FILTER (step > 60) AS jumps, round(max(step), 6) AS max_step, round(CASE WHEN count(error) >= 20 THEN quantile_cont(error, 0.5) END, 6) AS median_error FROM st GROUP BY scene""")
def a15(spark: SparkSession, d: str) -> DataFrame:
    rows = S.steps(S.heading_error(yawed(spark, d), "yaw", K, O), K, O)
    return rows.groupBy("scene").agg(F.count_if(F.coalesce(F.col("step") > 60, F.lit(False))).alias("jumps"), r6(F.max("step")).alias("max_step"), r6(F.when(F.count("error") >= 20, F.percentile("error", F.lit(0.5)))).alias("median_error"))


@register("a16_bias_with_fallback", f"""WITH {POSE}, s AS (SELECT scene, kind, count(*) AS n, quantile_cont(x, 0.5) AS own FROM pose GROUP BY scene, kind), g AS (SELECT kind, quantile_cont(own, 0.5) AS grp FROM s WHERE n >= 12 GROUP BY kind)
SELECT scene, kind, round(CASE WHEN n >= 12 THEN own ELSE grp END, 6) AS bias FROM s LEFT JOIN g USING (kind)""")
def a16(spark: SparkSession, d: str) -> DataFrame:
    own = pose_track(spark, d).groupBy("scene", "kind").agg(F.count(F.lit(1)).alias("n"), F.percentile("x", F.lit(0.5)).alias("own"))
    group = own.filter("n >= 12").groupBy("kind").agg(F.percentile("own", F.lit(0.5)).alias("grp"))
    return own.join(group, "kind", "left").select("scene", "kind", r6(F.when(F.col("n") >= 12, F.col("own")).otherwise(F.col("grp"))).alias("bias"))


@register("a17_mean_of_means", f"""WITH {POSE}, f AS (SELECT scene, t // {24 * HOUR} AS day, avg(CASE WHEN kind = 'view' THEN 1.0::DOUBLE ELSE 0 END) AS share FROM pose GROUP BY ALL)
SELECT scene, round(avg(share), 6) AS share, avg(share) < 0.2 AS flagged FROM f GROUP BY scene""")
def a17(spark: SparkSession, d: str) -> DataFrame:
    daily = pose_track(spark, d).groupBy("scene", F.expr(f"t div {24 * HOUR}").alias("day")).agg(F.avg((F.col("kind") == "view").cast("double")).alias("share"))
    return daily.groupBy("scene").agg(r6(F.avg("share")).alias("share"), (F.round(F.avg("share"), 12) < 0.2).alias("flagged"))  # a mean of just 0.2 isn't below it, in whatever order it was summed


@register("a18_three_valued_probe", f"""WITH {POSE}, n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS n FROM pose), p AS (SELECT * FROM n WHERE n % 10 = 0 AND n < 50)
SELECT scene, count(*) AS probed, CASE WHEN count(*) FILTER (kind = 'error') > 0 THEN true WHEN count(*) >= 5 THEN false END AS found FROM p GROUP BY scene""")
def a18(spark: SparkSession, d: str) -> DataFrame:
    probed = pose_track(spark, d).withColumn("n", F.row_number().over(S.along(K, O)) - 1).filter("n % 10 = 0 and n < 50")
    hit = F.count_if(F.col("kind") == "error")
    return probed.groupBy("scene").agg(F.count(F.lit(1)).alias("probed"), F.when(hit > 0, F.lit(True)).when(F.count(F.lit(1)) >= 5, F.lit(False)).alias("found"))


@register("a19_rich_frames", f"""WITH {POSE}, f AS (SELECT scene, t // {24 * HOUR} AS day, count(*) AS n FROM pose GROUP BY ALL)
SELECT scene, round(avg(CASE WHEN n >= 3 THEN 1.0::DOUBLE ELSE 0 END), 6) AS rich, round(avg(n), 6) AS mean FROM f GROUP BY scene""")
def a19(spark: SparkSession, d: str) -> DataFrame:
    daily = pose_track(spark, d).groupBy("scene", F.expr(f"t div {24 * HOUR}").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.groupBy("scene").agg(r6(F.avg((F.col("n") >= 3).cast("double"))).alias("rich"), r6(F.avg("n")).alias("mean"))

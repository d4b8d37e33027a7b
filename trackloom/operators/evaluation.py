"""Reports over matched boxes, plans and labels: shape, yaw and corner errors by class and zone, plan errors taken apart, chains of own plans, lamp elements."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.metrics import guarded


def corners(x: Column, y: Column, length: Column, width: Column, yaw: Column) -> list[tuple[Column, Column]]:
    """The four corners of a rotated box, clockwise from the front left."""
    c, s = F.cos(yaw), F.sin(yaw)
    return [(x + a * length / 2 * c - b * width / 2 * s, y + a * length / 2 * s + b * width / 2 * c) for a, b in ((1, 1), (1, -1), (-1, -1), (-1, 1))]


def corner_error(a: list[tuple[Column, Column]], b: list[tuple[Column, Column]]) -> Column:
    """Mean distance of corners, for the turn of the second box's corners that makes it least: a box turned by half a turn is the same box."""
    turns = [reduce(lambda p, q: p + q, (F.hypot(a[i][0] - b[(i - k) % 4][0], a[i][1] - b[(i - k) % 4][1]) for i in range(4))) / 4 for k in range(4)]
    return F.least(*turns)


def yaw_difference(a: Column, b: Column) -> Column:
    """Between 0 and pi."""
    return F.abs(F.pmod(a - b + math.pi, F.lit(2 * math.pi)) - math.pi)


def zone(x: Column) -> Column:
    """Ahead near and far, behind near and far, at 40 and 80 metres; null beyond."""
    return F.when((x >= 0) & (x < 40), "ahead").when((x >= 40) & (x <= 80), "far ahead").when((x < 0) & (x > -40), "behind").when((x <= -40) & (x >= -80), "far behind")


def detection_report(matched: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    """cls, zone, tp, fp, fn, precision, recall, and of matched pairs the mean errors of centre, length, width, yaw (degrees, of the axis) and corners and the
    share of flipped yaws; recall_50 and recall_near within 50 m, and within 30 m and 12 m aside.

    matched(frame, pred, truth, distance) has every box of pred and truth(frame, id, cls, x, y, l, w, yaw) once. A box that is not matched counts in
    its own zone. Rows by class and zone, and by class alone with zone null; boxes beyond every zone count there alone.
    """
    side = lambda df, k: df.select("frame", F.col("id").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("cls", "x", "y", "l", "w", "yaw")])
    rows = matched.join(side(pred, "pred"), ["frame", "pred"], "left").join(side(truth, "truth"), ["frame", "truth"], "left")
    both = F.col("pred").isNotNull() & F.col("truth").isNotNull()
    p, t = ([F.col(f"{k}_{c}") for c in ("x", "y", "l", "w", "yaw")] for k in ("pred", "truth"))
    dy = yaw_difference(p[4], t[4])
    x, y = F.coalesce("truth_x", "pred_x"), F.coalesce("truth_y", "pred_y")
    rows = rows.select(
        F.coalesce("truth_cls", "pred_cls").alias("cls"),
        zone(x).alias("at"),
        both.alias("tp"),
        F.col("truth").isNull().alias("fp"),
        F.col("pred").isNull().alias("fn"),
        F.when(both, F.col("distance")).alias("centre"),
        F.when(both, F.abs(p[2] - t[2])).alias("length"),
        F.when(both, F.abs(p[3] - t[3])).alias("width"),
        F.when(both, F.degrees(F.least(dy, math.pi - dy))).alias("yaw"),
        F.when(both, (dy > math.pi / 2).cast("double")).alias("flipped"),
        F.when(both, corner_error(corners(*p), corners(*t))).alias("corner"),
        (x * x + y * y < 2500).alias("in_50"),
        ((x * x + y * y < 900) & (F.abs(y) < 12)).alias("near"),
    )
    spread = rows.withColumn("zone", F.explode(F.array(F.col("at"), F.lit("all")))).filter("zone is not null")
    tp, fp, fn = F.count_if("tp"), F.count_if("fp"), F.count_if("fn")
    within = lambda c: guarded(F.count_if(F.col(c) & F.col("tp")), F.count_if(F.col(c) & ~F.col("fp")))
    means = [F.avg(c).alias(c) for c in ("centre", "length", "width", "yaw", "flipped", "corner")]
    return spread.groupBy("cls", "zone").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), guarded(tp, tp + fp).alias("precision"), guarded(tp, tp + fn).alias("recall"), *means, within("in_50").alias("recall_50"), within("near").alias("recall_near"))


def plan_report(modes: DataFrame, truth: DataFrame, last: int, step: float) -> DataFrame:
    """One row: errors of plans modes(sample, mode, score, h, x, y) against truth(sample, h, x, y, v), h counting from 1 to `last` by `step` seconds.

    ade and fde are of the mode with the highest score (of equals the smaller mode), oracle of each sample's best mode, cv of going straight on at speed v;
    moving, stopped (v at most 2) and curve (over 2 m aside at the end) are ade on parts of the samples; bias is the mean of how far ahead the
    first point is for v from 8 to 15. Parts without a sample are null.
    """
    # One row a sample, and one shuffle by sample for all that follows. Sizes of exploded rows are guessed too low, so the join has to be named.
    t = truth.groupBy("sample").agg(F.collect_list(F.struct(F.col("h").alias("at"), F.col("x").alias("tx"), F.col("y").alias("ty"), "v")).alias("t"))
    e = modes.join(t.hint("merge"), "sample").withColumn("t", F.explode(F.filter("t", lambda p: p["at"] == F.col("h")))).select(*modes.columns, "t.tx", "t.ty", "t.v")
    e = e.withColumn("e", F.hypot(F.col("x") - F.col("tx"), F.col("y") - F.col("ty")))
    at = lambda c, h: F.max(F.when(F.col("h") == h, F.col(c)))
    cv = F.avg(F.hypot(F.col("v") * F.col("h") * step - F.col("tx"), F.col("ty")))
    per_mode = e.groupBy("sample", "mode").agg(F.max("score").alias("score"), F.avg("e").alias("ade"), at("e", last).alias("fde"), (at("x", 1) - at("tx", 1)).alias("ahead"), cv.alias("cv"), F.max("v").alias("v"), at("ty", last).alias("aside"))
    chosen = F.max(F.struct("score", (-F.col("mode")).alias("m"), "ade", "fde", "ahead", "cv", "v", "aside"))
    s = per_mode.groupBy("sample").agg(chosen.alias("c"), F.min("ade").alias("oracle")).select("oracle", "c.*")
    part = lambda c, where: F.avg(F.when(where, F.col(c)))
    return s.agg(
        F.avg("ade").alias("ade"),
        F.avg("fde").alias("fde"),
        F.avg("oracle").alias("oracle"),
        F.avg("cv").alias("cv"),
        part("ade", F.col("v") > 2).alias("moving"),
        part("ade", F.col("v") <= 2).alias("stopped"),
        part("ade", F.abs("aside") > 2).alias("curve"),
        part("ahead", (F.col("v") >= 8) & (F.col("v") < 15)).alias("bias"),
        F.count(F.lit(1)).alias("n"),
    )


def class_report(labels: DataFrame) -> DataFrame:
    """cls, tp, fp, fn, precision, recall, ratio, thickness of labels(truth, said), either null where a cell has none: what is said where nothing is
    known is false as well. ratio is the area said over the true one, at least a cell; thickness the same, and null for a class that isn't there."""
    rows = labels.select("truth", "said", F.explode(F.array_distinct(F.array("truth", "said"))).alias("cls")).filter("cls is not null")
    truth, said = F.col("truth").eqNullSafe(F.col("cls")), F.col("said").eqNullSafe(F.col("cls"))
    n = rows.groupBy("cls").agg(F.count_if(truth & said).alias("tp"), F.count_if(said & ~truth).alias("fp"), F.count_if(truth & ~said).alias("fn"))
    area, own = F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")
    return n.select("*", guarded(F.col("tp"), area).alias("precision"), guarded(F.col("tp"), own).alias("recall"), guarded(area, own).alias("ratio"), (area / F.nullif(own, F.lit(0))).alias("thickness"))


def chain_drift(steps: DataFrame, stride: int, chain: int) -> DataFrame:
    """place, drift, n: how far apart chained plans and truth are after each step, on average over chains.

    steps(scene, n, valid, px, py, gx, gy) has what the plan and the truth move by in each row, n counting a scene's rows from 0. Every stride-th row
    counts; chains of `chain` such rows follow one another as long as one more row follows. A chain ends at its first row that isn't valid.
    """
    rows = steps.filter(F.col("n") % stride == 0).withColumn("k", F.floor(F.col("n") / stride))
    size = F.max("k").over(Window.partitionBy("scene")) + 1
    rows = rows.withColumn("first", F.floor(F.col("k") / chain) * chain).withColumn("size", size).filter(F.col("first") < F.col("size") - chain)
    w = Window.partitionBy("scene", "first").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    total = rows.select((F.col("k") - F.col("first") + 1).alias("place"), F.min("valid").over(w).alias("whole"), F.sum(F.col("px") - F.col("gx")).over(w).alias("dx"), F.sum(F.col("py") - F.col("gy")).over(w).alias("dy"))
    return total.filter("whole").groupBy("place").agg(F.avg(F.hypot("dx", "dy")).alias("drift"), F.count(F.lit(1)).alias("n"))


def recovery(y: Column, offset: Column) -> Column:
    """The part of a lateral offset that a plan which is aside by y takes back: 1 for all of it, and -0.5 at worst."""
    return 1 - F.least(F.abs(y + offset) / offset, F.lit(1.5))


def boundary_kinds(lanes: DataFrame, boundaries: DataFrame) -> DataFrame:
    """boundary, n, kind of boundaries(boundary) that lanes(left, right) refer to: inner with two references or more, else outer."""
    refs = lanes.select(F.explode(F.array("left", "right")).alias("boundary")).filter("boundary is not null").groupBy("boundary").agg(F.count(F.lit(1)).alias("n"))
    return boundaries.select("boundary").distinct().join(refs, "boundary").withColumn("kind", F.when(F.col("n") >= 2, "inner").otherwise("outer"))


def lamp_elements(objects: DataFrame, categories: DataFrame, data: DataFrame, cameras: list[str]) -> DataFrame:
    """keyframe, camera, x1, y1, x2, y2, red, yellow, green, pedestrian, arrow, sin, cos of objects (sample_data, category, bbox, orientation).

    A category (token, name) is a colour, an underscore and a shape; other colours are no lamps. A picture (token, filename, width, height) tells its camera by the
    first of `cameras` that its file name holds, and its keyframe by its stem; others are left out. Boxes are shares of the picture, and an
    unknown orientation gives 0 for both sine and cosine.
    """
    name = F.split("name", "_", 2)
    named = categories.select(F.col("token").alias("category"), name[0].alias("colour"), F.coalesce(F.get(name, 1), F.lit("circle")).alias("shape")).filter(F.col("colour").isin("red", "yellow", "green"))
    camera = reduce(lambda c, k: c.when(F.contains(F.col("filename"), F.lit(k[1])), F.lit(k[0])), list(enumerate(cameras))[1:], F.when(F.contains(F.col("filename"), F.lit(cameras[0])), F.lit(0)))
    stem = F.regexp_extract("filename", r"(?:^|/)(\d+)(?:\.[^./]*)?$", 1)
    frames = data.select(F.col("token").alias("sample_data"), camera.alias("camera"), F.when(stem != "", stem.cast("long")).alias("keyframe"), "width", "height").filter("camera is not null and keyframe is not null")
    rows = objects.join(F.broadcast(named), "category").join(frames, "sample_data")
    box = [(F.col("bbox")[k] / F.col("height" if k % 2 else "width")).alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))]
    flags = [(F.col("colour") == c).cast("int").alias(c) for c in ("red", "yellow", "green")] + [F.contains(F.col("shape"), F.lit(s)).cast("int").alias(s) for s in ("pedestrian", "arrow")]
    turn = [F.coalesce(f("orientation"), F.lit(0.0)).alias(n) for f, n in ((F.sin, "sin"), (F.cos, "cos"))]
    return rows.select("keyframe", "camera", *box, *flags, *turn)

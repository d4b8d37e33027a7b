"""Painted lines in a mask by their votes: maxima over angle and distance, the runs that support them, and what they are: lanes, crossings, stop bars.

An angle is that of a line's normal, in steps of half a turn; a line at angle a and distance d is also the one at a + pi and -d.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.grids import square
from trackloom.operators.joins import neighbours

CELL = ["frame", "r", "c"]


def normals(n: int) -> list[tuple[int, float]]:
    """The angles, half a step off the axes, so that no distance is a tie of two roundings."""
    return [(k, math.pi * (k + 0.5) / n) for k in range(n)]


def ballots(mask: DataFrame, n: int) -> DataFrame:
    """frame, r, c, angle, a, rho: each cell's vote at each of n angles."""
    s = F.explode(F.array(*[F.struct(F.lit(k).alias("angle"), F.lit(a).alias("a")) for k, a in normals(n)]))
    voted = mask.select(*CELL).distinct().withColumn("s", s)
    return voted.select(*CELL, "s.angle", "s.a", F.rint(F.expr("r * cos(s.a) + c * sin(s.a)")).cast("int").alias("rho"))


def maxima(votes: DataFrame, n: int, least: int) -> DataFrame:
    """frame, angle, rho, votes: places of at least `least` votes that no neighbour in angle or distance has more than, the last angle's being the first
    one's at the opposite distance. Of equal neighbours the one of the smaller angle, then distance, stays."""
    total = votes.groupBy("frame", "angle", "rho").agg(F.count(F.lit(1)).alias("votes")).filter(F.col("votes") >= least)
    rank = F.struct("votes", (-F.col("angle")).alias("a"), (-F.col("rho")).alias("d"))
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in square(1)]))
    told = total.withColumn("rank", rank).withColumn("s", near).select("frame", F.col("angle").alias("of"), (F.col("angle") + F.col("s.a")).alias("k"), (F.col("rho") + F.col("s.b")).alias("d"), "rank", F.expr("s.a = 0 and s.b = 0").alias("own"))
    out = (F.col("k") < 0) | (F.col("k") >= n)
    told = told.select("frame", F.pmod("k", F.lit(n)).alias("angle"), F.when(out, -F.col("d")).otherwise(F.col("d")).alias("rho"), "rank", "own")
    best = told.groupBy("frame", "angle", "rho").agg(F.max("rank").alias("top"), F.max(F.when(F.col("own"), F.col("rank"))).alias("mine"))
    return best.filter("mine is not null and mine = top").select("frame", "angle", "rho", F.col("mine.votes").alias("votes"))


def supported(votes: DataFrame, peaks: DataFrame, gap: float, least: float) -> DataFrame:
    """frame, angle, rho, run, r0, c0, r1, c1, length, cells: the stretches of each line's cells without a gap over `gap`, at least `least` long."""
    on = votes.join(peaks.select("frame", "angle", "rho"), ["frame", "angle", "rho"]).withColumn("t", F.round(F.expr("c * cos(a) - r * sin(a)"), 9))
    w = Window.partitionBy("frame", "angle", "rho").orderBy("t", "r", "c")
    runs = on.withColumn("new", F.when(F.col("t") - F.lag("t").over(w) <= gap, 0).otherwise(1)).withColumn("run", (F.sum("new").over(w) - 1).cast("int"))
    end = F.struct("t", "r", "c")
    ends = runs.groupBy("frame", "angle", "rho", "run").agg(F.min(end).alias("a"), F.max(end).alias("b"), F.count(F.lit(1)).alias("cells"))
    found = ends.select("frame", "angle", "rho", "run", F.col("a.r").alias("r0"), F.col("a.c").alias("c0"), F.col("b.r").alias("r1"), F.col("b.c").alias("c1"), "cells")
    return found.withColumn("length", F.hypot(F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0"))).filter(F.col("length") >= least)


def half_turn_apart(a: Column, b: Column) -> Column:
    """The angle between two directions without a sense, at most a right angle."""
    return F.abs(F.pmod(a - b + math.pi / 2, F.lit(math.pi)) - math.pi / 2)


def stripes(lines: DataFrame, n: int, radius: float, apart_deg: float, spacing: float, least: int, spread: tuple[float, float]) -> DataFrame:
    """frame, angle, rho, run: lines of groups that look like a crossing.

    A group is a transverse line and all whose middles lie within radius of its own and whose directions differ by at most apart_deg. Its
    direction is the mean of doubled angles, so that opposite senses agree. It counts if its middles, across that direction, fall on at least `least`
    offsets by `spacing`, and spread over the given extent. Lines farther apart than two radii never meet.
    """
    key = ["frame", "angle", "rho", "run"]
    direction = F.pmod(-(F.col("angle") + 0.5) * (math.pi / n), F.lit(math.pi))
    own = lines.filter("abs(c1 - c0) >= 1.4 * abs(r1 - r0)").select(*key, ((F.col("r0") + F.col("r1")) / 2).alias("y"), ((F.col("c0") + F.col("c1")) / 2).alias("x"), direction.alias("h"))
    seeds = own.select("frame", F.struct("angle", "rho", "run").alias("seed"), "y", "x", "h")
    near = neighbours(seeds, own, ["frame"], "x", "y", radius).filter(half_turn_apart(F.col("h_b"), F.col("h")) <= math.radians(apart_deg) + 1e-9)
    member = F.struct(*[F.col(f"{k}_b").alias(k) for k in ("angle", "rho", "run", "y", "x")])
    groups = near.groupBy("frame", "seed").agg(F.collect_list(member).alias("m"), F.atan2(F.sum(F.sin(2 * F.col("h_b"))), F.sum(F.cos(2 * F.col("h_b")))).alias("h2"))
    # h is the direction from the column axis to the row axis; across it a middle's offset is y cos - x sin.
    offsets = F.transform("m", lambda p: F.round(p["y"] * F.cos(F.col("h2") / 2) - p["x"] * F.sin(F.col("h2") / 2), 6))
    groups = groups.withColumn("o", offsets).withColumn("width", F.round(F.array_max("o") - F.array_min("o"), 6))
    kinds = F.size(F.array_distinct(F.transform("o", lambda x: F.rint(F.round(x / spacing, 6)).cast("long"))))
    fine = groups.filter((kinds >= least) & F.col("width").between(*spread))
    return fine.select("frame", F.explode("m").alias("p")).select("frame", "p.angle", "p.rho", "p.run").distinct()


def named(lines: DataFrame, crossing: DataFrame, near: float, bar: tuple[float, float]) -> DataFrame:
    """lines with kind: stripe (of crossing), lane (along the rows), stop (across them, of a bar's length, its middle within `near` of a stripe's), or other."""
    key = ["frame", "angle", "rho", "run"]
    marked = lines.join(crossing.withColumn("striped", F.lit(True)), key, "left").withColumn("striped", F.coalesce("striped", F.lit(False)))
    middle = [((F.col("r0") + F.col("r1")) / 2).alias("y"), ((F.col("c0") + F.col("c1")) / 2).alias("x")]
    across = "not striped and abs(c1 - c0) >= 2 * greatest(abs(r1 - r0), 1)"
    bars = marked.filter(across).filter(F.col("length").between(*bar)).select(*key, *middle)
    zones = marked.filter("striped").select("frame", *middle)
    stops = neighbours(bars, zones, ["frame"], "x", "y", near).select(*key, F.lit(True).alias("stops")).distinct()
    kind = F.when(F.col("striped"), "stripe").when(F.expr("abs(r1 - r0) >= 2 * greatest(abs(c1 - c0), 1)"), "lane").when(F.col("stops"), "stop").otherwise("other")
    return marked.join(stops, key, "left").withColumn("kind", kind).drop("striped", "stops")

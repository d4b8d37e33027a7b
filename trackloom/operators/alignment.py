"""Where one mask lies best on another: a coarse-to-fine search over shifts and turns, with bounds that cut branches and never the best.

A mask's field gives every cell within `tolerance` of it a weight, the higher the nearer. A move's score is the sum of the field under the moved
cells. Over a block of 2^k x 2^k shifts no score can be more than the sum of the field's largest values in such blocks: that is a lookup in a field
pooled once. Blocks whose bound is under the best score found so far go; the others are split in four.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.grids import disc, offsets

KEYS = ["frame", "r", "c"]


def field(mask: DataFrame, tolerance: int) -> DataFrame:
    """frame, r, c, w: (tolerance + 1)^2 less the squared distance to the mask's nearest cell, for cells within tolerance."""
    shifts = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in disc(tolerance)]))
    near = mask.select(*KEYS, shifts.alias("s")).select("frame", (F.col("r") + F.col("s.a")).alias("r"), (F.col("c") + F.col("s.b")).alias("c"), (F.lit((tolerance + 1) ** 2) - F.expr("s.a * s.a + s.b * s.b")).alias("w"))
    return near.groupBy(*KEYS).agg(F.max("w").alias("w"))


def pooled(weights: DataFrame, size: int) -> DataFrame:
    """frame, r, c, w: the largest weight in the size x size block that begins at each cell."""
    return offsets(weights, [(-a, -b) for a in range(size) for b in range(size)]).groupBy(*KEYS).agg(F.max("w").alias("w"))


def turned(mask: DataFrame, turns: list[float]) -> DataFrame:
    """frame, turn, r, c: the distinct cells of the mask about the origin, for each turn."""
    t = F.explode(F.array(*map(F.lit, turns)))
    moved = mask.select(*KEYS, t.alias("turn"))
    r, c = F.rint(F.expr("cos(turn) * r - sin(turn) * c")).cast("int"), F.rint(F.expr("sin(turn) * r + cos(turn) * c")).cast("int")
    return moved.select("frame", "turn", r.alias("r"), c.alias("c")).distinct()


def scored(nodes: DataFrame, cells: DataFrame, fields: dict[str, DataFrame], keep: list[str]) -> DataFrame:
    """frame, turn, dr, dc and the columns `keep` of nodes, with the sum of each field's weights under their moved cells. nodes are read once."""
    moved = nodes.join(cells, ["frame", "turn"]).withColumn("r", F.col("r") + F.col("dr")).withColumn("c", F.col("c") + F.col("dc"))
    for name, weights in fields.items():
        moved = moved.join(weights.withColumnRenamed("w", name), KEYS, "left")
    return moved.groupBy("frame", "turn", "dr", "dc", *keep).agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in fields])


def aligned(mask: DataFrame, onto: DataFrame, levels: int, turns: list[float], tolerance: int = 1) -> tuple[DataFrame, list[DataFrame]]:
    """(best, tried): frame, dr, dc, turn, score of the best move of mask(frame, r, c) onto the other mask, over shifts from -2^levels to
    2^levels - 1 each way and the given turns about the origin; and the nodes whose bounds each level looked at, from coarse to fine.

    Of equal scores the smaller |dr| + |dc| wins, then the larger dr, dc and turn. Frames that lack either mask give no row.
    """
    both = mask.select("frame").distinct().join(onto.select("frame").distinct(), "frame")
    weights, cells = field(onto, tolerance), turned(mask, turns)
    half = 1 << levels
    start = F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc"), F.lit(t).alias("turn")) for a in (-half, 0) for b in (-half, 0) for t in turns]))
    nodes, tried = both.select("frame", start.alias("s")).select("frame", "s.*", F.lit(0).cast("long").alias("least")), []
    for level in range(levels, 0, -1):
        tried.append(nodes)
        bound = scored(nodes, cells, {"bound": pooled(weights, 1 << level), "sure": weights}, ["least"])
        bound = bound.withColumn("least", F.greatest(F.max("sure").over(Window.partitionBy("frame")), F.col("least"))).filter("bound >= least")
        step = 1 << (level - 1)
        parts = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, step) for b in (0, step)]))
        nodes = bound.select("frame", "turn", "dr", "dc", "least", parts.alias("s")).select("frame", "turn", (F.col("dr") + F.col("s.a")).alias("dr"), (F.col("dc") + F.col("s.b")).alias("dc"), "least")
    tried.append(nodes)
    found = scored(nodes, cells, {"score": weights}, [])
    best = F.max(F.struct("score", F.expr("-abs(dr) - abs(dc)").alias("near"), "dr", "dc", "turn"))
    return found.groupBy("frame").agg(best.alias("b")).select("frame", "b.dr", "b.dc", "b.turn", "b.score"), tried

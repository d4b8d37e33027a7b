"""Sparse grids: one row per occupied cell. Votes and resolutions are plain aggregates, so they combine map-side."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import cell
from trackloom.operators.matching import by_frame, whole_frames


def binned(df: DataFrame, size: float, x: str = "x", y: str = "y", x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """df with r, c: cells by truncation toward zero, those below the origin's cell left out."""
    out = df.withColumn("r", cell(F.col(x) - x0, size)).withColumn("c", cell(F.col(y) - y0, size))
    return out.filter("r >= 0 and c >= 0")


def histogram(cells: DataFrame, keys: list[str], cls: str = "cls") -> DataFrame:
    return cells.groupBy(*keys, cls).agg(F.count(F.lit(1)).alias("n"))


def majority(counts: DataFrame, keys: list[str], order: list[str], cls: str = "cls") -> DataFrame:
    """keys, cls, n, total: the class with most votes, of equals the first in order."""
    rank = reduce(lambda c, k: c.when(F.col(cls) == k[1], F.lit(-k[0])), list(enumerate(order))[1:], F.when(F.col(cls) == order[0], F.lit(0)))
    best = F.max(F.struct(F.col("n").alias("n"), rank.alias("rank"), F.col(cls).alias("cls")))
    return counts.groupBy(*keys).agg(best.alias("b"), F.sum("n").alias("total")).select(*keys, F.col("b.cls").alias(cls), F.col("b.n").alias("n"), "total")


def thin_override(counts: DataFrame, keys: list[str], area: list[str], thin: list[str], least: int = 3, share: int = 4, cls: str = "cls") -> DataFrame:
    """keys, cls: the area majority, unless a thin class has at least `least` votes and a 1/share part of all; the last such class wins."""
    wide = counts.groupBy(*keys).agg(F.sum("n").alias("total"), *[F.sum(F.when(F.col(cls) == k, F.col("n")).otherwise(0)).alias(f"n_{i}") for i, k in enumerate([*area, *thin])])
    votes = [F.col(f"n_{i}") for i in range(len(area))]
    top = F.greatest(*votes) if len(votes) > 1 else votes[0]
    label = F.when(top == 0, F.lit(None))
    for v, k in zip(votes, area, strict=True):
        label = label.when(v == top, F.lit(k))
    for i, k in enumerate(thin, len(area)):
        n = F.col(f"n_{i}")
        label = F.when((n >= least) & (n * share >= F.col("total")), F.lit(k)).otherwise(label)
    return wide.select(*keys, label.alias(cls), "total").filter(F.col(cls).isNotNull())


def offsets(cells: DataFrame, shifts: list[tuple[int, int]]) -> DataFrame:
    """Each cell at each shift; the base of dilation, erosion, stamping and neighbour lookups."""
    s = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in shifts]))
    return cells.withColumn("_s", s).withColumn("r", F.col("r") + F.col("_s.a")).withColumn("c", F.col("c") + F.col("_s.b")).drop("_s")


def square(k: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(-k, k + 1) for b in range(-k, k + 1)]


def disc(k: int) -> list[tuple[int, int]]:
    return [(a, b) for a, b in square(k) if a * a + b * b <= k * k]


def dilate(cells: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    return offsets(cells.select(*keys, "r", "c"), square(k)).distinct()


def erode(cells: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    """Cells all of whose square is occupied."""
    spread = offsets(cells.select(*keys, "r", "c").distinct(), square(k)).groupBy(*keys, "r", "c").agg(F.count(F.lit(1)).alias("n"))
    return spread.filter(F.col("n") == (2 * k + 1) ** 2).drop("n")


def close(cells: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    return erode(dilate(cells, keys, k), keys, k)


def carve(rays: DataFrame, occupied: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """Free cells along rays (r0, c0) -> (r, c), the end left out; an occupied cell is never freed."""
    s = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
    walked = rays.withColumn("_k", s)
    part = F.col("_k") / steps
    free = walked.select(*keys, (F.col("r0") + part * (F.col("r") - F.col("r0"))).cast("int").alias("r"), (F.col("c0") + part * (F.col("c") - F.col("c0"))).cast("int").alias("c")).distinct()
    return free.join(occupied.select(*keys, "r", "c"), [*keys, "r", "c"], "left_anti")


def confusion(df: DataFrame, truth: str, said: str, keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), F.col(truth).alias("truth"), F.col(said).alias("said")).agg(F.count(F.lit(1)).alias("n"))


def iou(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, cls, inter, truths, saids, iou of a confusion table; null truth is ignored, iou null where the class is absent."""
    keys, known = keys or [], counts.filter("truth is not null")
    rows = known.select(*keys, "n", F.explode(F.array(F.struct(F.col("truth").alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("s")), F.struct(F.col("said").alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("s")))).alias("e"), (F.col("truth") == F.col("said")).alias("hit"))
    per = rows.filter("e.cls is not null").groupBy(*keys, F.col("e.cls").alias("cls")).agg(F.sum(F.when(F.col("hit") & (F.col("e.t") == 1), F.col("n")).otherwise(0)).alias("inter"), F.sum(F.col("n") * F.col("e.t")).alias("truths"), F.sum(F.col("n") * F.col("e.s")).alias("saids"))
    return per.withColumn("iou", F.col("inter") / F.nullif(F.col("truths") + F.col("saids") - F.col("inter"), F.lit(0)))


def peaks(values: DataFrame, least: float, k: int) -> DataFrame:
    """frame, r, c, s: of values (frame, r int, c int, s double), the largest of a cell counting, the first k cells of each frame (by falling s, then r
    and c) that are above `least` and no smaller than the eight around them. One shuffle, by frame; a frame's cells stand in one task's batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, v, bounds in whole_frames(batches):
            frame = np.repeat(np.arange(len(bounds)), [b - a for a, b in bounds])
            order = np.lexsort((v["s"], v["c"], v["r"], frame))
            last = np.flatnonzero(np.concatenate([np.any([np.diff(x[order]) != 0 for x in (frame, v["r"], v["c"])], axis=0), [True]]))
            at = order[last]
            f, r, c, s = frame[at], v["r"][at].astype(np.int64), v["c"][at].astype(np.int64), v["s"][at]
            r0, c0 = r - r.min() + 1, c - c.min() + 1
            high, wide = int(r0.max()) + 2, int(c0.max()) + 2
            place = (f * high + r0) * wide + c0  # rises with frame, r, c
            top = s.copy()
            for a, b in square(1):
                near = np.searchsorted(place, place + a * wide + b)
                near = np.where(near < len(place), near, 0)
                top = np.where(place[near] == place + a * wide + b, np.maximum(top, s[near]), top)
            peak = np.flatnonzero((top <= s) & (s > least))
            peak = peak[np.lexsort((c[peak], r[peak], -s[peak], f[peak]))]
            first = np.searchsorted(f[peak], f[peak])
            peak = peak[np.arange(len(peak)) - first < k]
            yield from table.select(["frame", "r", "c", "s"]).take(pa.array(at[peak])).combine_chunks().to_batches()

    return by_frame(values.select("frame", "r", "c", "s").dropna(), [], run, "frame long, r int, c int, s double")


def share(*parts: Column) -> Column:
    """parts[0] over the sum of parts, with the sum at least 1."""
    return parts[0] / F.greatest(reduce(lambda a, b: a + b, parts), F.lit(1))


def rotated(cells: DataFrame, degrees: float, centre: tuple[float, float], extent: tuple[int, int], outside: int) -> DataFrame:
    """frame, r, c, label of every place of each frame's raster, turned about centre (r, c) by `degrees`, columns toward smaller rows; each place takes the label of
    the nearest source cell, 0 where that has none, and `outside` where it lies beyond the raster."""
    a, b = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    grid = cells.select("frame").distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(extent[0] - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(extent[1] - 1))))
    dr, dc = F.col("r") - centre[0], F.col("c") - centre[1]
    from_ = grid.withColumn("sr", F.rint(F.round(centre[0] + b * dc + a * dr, 9)).cast("int")).withColumn("sc", F.rint(F.round(centre[1] + a * dc - b * dr, 9)).cast("int"))
    found = from_.join(cells.select("frame", F.col("r").alias("sr"), F.col("c").alias("sc"), "label"), ["frame", "sr", "sc"], "left")
    beyond = (F.col("sr") < 0) | (F.col("sr") >= extent[0]) | (F.col("sc") < 0) | (F.col("sc") >= extent[1])
    return found.select("frame", "r", "c", F.when(beyond, F.lit(outside)).otherwise(F.coalesce("label", F.lit(0))).alias("label"))


def row_continuity(truth: DataFrame, said: DataFrame, reach: int = 1) -> DataFrame:
    """frame, r, hit of every row of a frame with a true cell: whether any lies within reach of a cell that is said."""
    keys = ["frame", "r", "c"]
    own = truth.select(*keys).distinct()
    near = dilate(said, ["frame"], reach).withColumn("near", F.lit(True))
    return own.join(near, keys, "left").groupBy("frame", "r").agg(F.coalesce(F.bool_or("near"), F.lit(False)).alias("hit"))


def missed_runs(rows: DataFrame) -> DataFrame:
    """frame, run, n: stretches of rows (frame, r, hit), one below the other, without a hit. A row that isn't there ends a run."""
    missed = rows.filter("not hit").withColumn("run", F.col("r") - F.row_number().over(Window.partitionBy("frame").orderBy("r")))
    return missed.groupBy("frame", "run").agg(F.count(F.lit(1)).alias("n"))

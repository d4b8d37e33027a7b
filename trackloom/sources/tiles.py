"""Ways cut to tiles: each segment becomes the pieces that lie in the tiles it crosses, by Liang and Barsky's clipping, and pieces become runs.

A segment is cut to rows of tiles first and to the columns of each row then, so it makes as many rows as it crosses tiles, and not as many as
its extent holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def segments(ways: DataFrame) -> DataFrame:
    """way, n, x0, y0, x1, y1 of ways(way, n, x, y): each node with the next one, n counting from 0. Ways of one node have none."""
    w = Window.partitionBy("way").orderBy("n")
    ahead = ways.select("way", (F.row_number().over(w) - 1).alias("n"), F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(w).alias("x1"), F.lead("y").over(w).alias("y1"))
    return ahead.filter("x1 is not null and y1 is not null")


def entering(at: Column, step: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """(first, last) share of the way along a coordinate that lies between lo and hi: from at to at + step. All of it where it doesn't move."""
    a, b = (lo - at) / F.nullif(step, F.lit(0.0)), (hi - at) / F.nullif(step, F.lit(0.0))
    return F.coalesce(F.least(a, b), F.lit(0.0)), F.coalesce(F.greatest(a, b), F.lit(1.0))


def clipped(parts: DataFrame, size: float) -> DataFrame:
    """tile_x, tile_y, way, n, t0, t1, ax, ay, bx, by, length: the piece of each segment in each tile that it crosses, t being the share along it.

    Tiles are half open: one that a segment only touches, in a corner or where it ends, gets nothing, and one that lies along a border belongs
    to the tile above or right of it. So the pieces of a segment are as long as it is.
    """
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    tile = lambda c: F.floor(c / size)
    rows = parts.withColumn("dx", dx).withColumn("dy", dy).withColumn("tile_y", F.explode(F.sequence(tile(F.least("y0", "y1")), tile(F.greatest("y0", "y1")))))
    first, last = entering(F.col("y0"), F.col("dy"), F.col("tile_y") * size, (F.col("tile_y") + 1) * size)
    rows = rows.withColumn("r0", F.greatest(first, F.lit(0.0))).withColumn("r1", F.least(last, F.lit(1.0))).filter("r0 < r1 or (dx = 0 and dy = 0)")
    left, right = F.col("x0") + F.col("r0") * F.col("dx"), F.col("x0") + F.col("r1") * F.col("dx")
    cells = rows.withColumn("tile_x", F.explode(F.sequence(tile(F.least(left, right)), tile(F.greatest(left, right)))))
    first, last = entering(F.col("x0"), F.col("dx"), F.col("tile_x") * size, (F.col("tile_x") + 1) * size)
    cut = cells.withColumn("t0", F.greatest(first, F.col("r0"))).withColumn("t1", F.least(last, F.col("r1"))).filter("t0 < t1")
    at = lambda o, d, t: F.col(o) + F.col(t) * F.col(d)
    ends = [at("x0", "dx", "t0").alias("ax"), at("y0", "dy", "t0").alias("ay"), at("x0", "dx", "t1").alias("bx"), at("y0", "dy", "t1").alias("by")]
    return cut.select("tile_x", "tile_y", "way", "n", "t0", "t1", *ends, (F.hypot("dx", "dy") * (F.col("t1") - F.col("t0"))).alias("length"))


def tile_runs(pieces: DataFrame) -> DataFrame:
    """tile_x, tile_y, way, run, points, length: what of each way lies in each tile, as polylines. A way that leaves a tile and comes back has several runs."""
    w = Window.partitionBy("tile_x", "tile_y", "way").orderBy("n")
    goes_on = (F.col("t0") == 0) & (F.lag("t1").over(w) == 1) & (F.lag("n").over(w) == F.col("n") - 1)
    numbered = pieces.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    ends = F.sort_array(F.collect_list(F.struct("n", "ax", "ay", "bx", "by")))
    runs = numbered.groupBy("tile_x", "tile_y", "way", "run").agg(ends.alias("e"), F.sum("length").alias("length"))
    first = F.array(F.struct(F.col("e")[0]["ax"].alias("x"), F.col("e")[0]["ay"].alias("y")))
    points = F.concat(first, F.transform("e", lambda s: F.struct(s["bx"].alias("x"), s["by"].alias("y"))))
    return runs.select("tile_x", "tile_y", "way", (F.col("run") - 1).cast("int").alias("run"), points.alias("points"), "length")


def write_tiles(runs: DataFrame, path: str) -> None:
    """A table by tile: reading one tile opens its folder alone. Rows meet in their tile's task first, so a tile is few files."""
    runs.repartition("tile_x", "tile_y").write.partitionBy("tile_x", "tile_y").parquet(path)

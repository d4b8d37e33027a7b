"""A frame's map drawn from parts: area classes, filled polygons, thick lines, the region about the ego vehicle, holes and road edge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators import grids as G
from trackloom.operators import rasters as R

CELL = ["frame", "r", "c"]


def thick_lines(lines: DataFrame, half: float) -> DataFrame:
    """frame, r, c, layer: cells whose centre (r + 0.5, c + 0.5) lies within `half` of a segment of lines (frame, layer, y0, x0, y1, x1).

    A row of cells meets the band about a segment in one span, since the band is convex; a segment costs a row for each raster row and its cells.
    Where layers overlap, the largest wins.
    """
    lo, hi = F.floor(F.least("y0", "y1") - half - 0.5).cast("int"), F.ceil(F.greatest("y0", "y1") + half).cast("int")
    rows = lines.withColumn("r", F.explode(F.sequence(lo, hi))).withColumn("y", F.col("r") + 0.5)
    # Where the row may meet the band at all: about the part of the segment that lies within `half` of the row.
    dy = F.nullif(F.col("y1") - F.col("y0"), F.lit(0.0))
    a, b = (F.col("y") - half - F.col("y0")) / dy, (F.col("y") + half - F.col("y0")) / dy
    first, last = F.greatest(F.coalesce(F.least(a, b), F.lit(0.0)), F.lit(0.0)), F.least(F.coalesce(F.greatest(a, b), F.lit(1.0)), F.lit(1.0))
    rows = rows.withColumn("t0", first).withColumn("t1", last).filter("t0 <= t1")
    x = lambda t: F.col("x0") + F.col(t) * (F.col("x1") - F.col("x0"))
    cells = rows.withColumn("c", F.explode(F.sequence(F.floor(F.least(x("t0"), x("t1")) - half - 0.5).cast("int"), F.ceil(F.greatest(x("t0"), x("t1")) + half).cast("int"))))
    return cells.filter(_squared_distance() <= half * half).groupBy(*CELL).agg(F.max("layer").alias("layer"))


def _squared_distance() -> Column:
    """From the cell's centre to the segment."""
    dx, dy, px, py = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.col("c") + 0.5 - F.col("x0"), F.col("r") + 0.5 - F.col("y0")
    t = F.coalesce(F.greatest(F.least((px * dx + py * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)), F.lit(0.0))
    ex, ey = px - t * dx, py - t * dy
    return ex * ex + ey * ey


def painted(base: DataFrame, *layers: DataFrame) -> DataFrame:
    """frame, r, c, label: base(frame, r, c, label) with each layer over what is below it."""
    stacked = base.select(*CELL, "label", F.lit(0).alias("k"))
    for k, layer in enumerate(layers, 1):
        stacked = stacked.unionByName(layer.select(*CELL, "label", F.lit(k).alias("k")))
    return stacked.groupBy(*CELL).agg(F.max_by("label", "k").alias("label"))


#: Ends a frame's lineage: writes what several later steps read, under a name, and reads it back.
Keep = Callable[..., DataFrame]


def ego_region(road: DataFrame, strip: tuple[int, int], erosion: int, dilation: int, least_share: float, keep: Keep) -> DataFrame:
    """frame, r, c: the road that hangs together with the strip of columns that the ego vehicle is in.

    Eroding first breaks narrow bridges to other roads; what is left and touches the strip is dilated back within the road. If that is less than
    least_share of the frame's road, erosion has broken up the road itself, and all of it stays; so it does where nothing touches the strip.
    """
    parts = keep(R.components(G.erode(road, ["frame"], erosion)), name="parts")
    own = parts.filter(F.col("c").between(*strip)).select("frame", "part").distinct()
    near = G.dilate(parts.join(own, ["frame", "part"], "left_semi"), ["frame"], dilation)
    kept = keep(road.join(near, CELL, "left_semi"), name="near")
    sizes = road.groupBy("frame").agg(F.count(F.lit(1)).alias("n")).join(kept.groupBy("frame").agg(F.count(F.lit(1)).alias("k")), "frame", "left")
    enough = sizes.filter(F.coalesce("k", F.lit(0)) >= least_share * F.col("n")).select("frame")
    return kept.join(enough, "frame", "left_semi").unionByName(road.join(enough, "frame", "left_anti"))


def road_edge(road: DataFrame, extent: tuple[int, int], beyond: int, keep: Keep) -> DataFrame:
    """frame, r, c: the road's outermost cells, its holes filled, beside which the land beyond goes on: it holds a square of reach `beyond`.

    Outside the frame's rows and columns (extent: how many) is neither road nor land, and the first and last row have no edge.
    """
    height, width = extent
    whole = keep(R.filled_holes(G.close(road, ["frame"]), height * width), name="whole")
    outer = whole.select(*CELL).join(G.erode(whole, ["frame"]), CELL, "left_anti")
    grid = road.select("frame").distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    land = grid.join(whole, CELL, "left_anti")
    open_land = G.dilate(G.erode(land, ["frame"], beyond), ["frame"], beyond + 1)
    return outer.filter((F.col("r") > 0) & (F.col("r") < height - 1)).join(open_land, CELL, "left_semi")


def composed(area: DataFrame, polygons: DataFrame, lines: DataFrame, road: list[str], extent: tuple[int, int], strip: tuple[int, int], most_hole: int, keep: Keep, share: float = 0.3) -> DataFrame:
    """frame, r, c, label: areas, polygons over them (both frame, r, c, label) and lines over both; of the drivable labels `road` only the ego
    vehicle's region; holes in it of at most most_hole cells become the first of them, where nothing else is; and its edge goes over all."""
    inside = (F.col("r").between(0, extent[0] - 1)) & (F.col("c").between(0, extent[1] - 1))
    drawn = keep(painted(area, polygons, lines).filter(inside), name="drawn")
    drivable = drawn.filter(F.col("label").isin(road)).select(*CELL)
    region = keep(ego_region(drivable, strip, 1, 2, share, keep), name="region")
    kept = drawn.filter(~F.col("label").isin(road)).unionByName(drawn.join(region, CELL, "left_semi").filter(F.col("label").isin(road)))
    holes = R.filled_holes(region, most_hole).join(kept, CELL, "left_anti").select(*CELL, F.lit(road[0]).alias("label"))
    filled = keep(kept.unionByName(holes), name="filled")
    edge = road_edge(filled.filter(F.col("label").isin(road)).select(*CELL), extent, 1, keep).withColumn("label", F.lit("edge"))
    return painted(filled, edge)

"""Depth of pixels by normalised cross-correlation of patches over hypotheses, from summed-area tables in columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import r6


def dense_image(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """frame, r, c, v of every place of each frame's image; places that pixels(frame, r, c, v) lacks are 0."""
    grid = pixels.select("frame").distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    return grid.join(pixels, ["frame", "r", "c"], "left").select("frame", "r", "c", F.coalesce("v", F.lit(0)).cast("long").alias("v"))


def box_sums(image: DataFrame, keys: list[str], values: list[str], reach: int) -> DataFrame:
    """keys, r, c and each value's sum over the square of `reach` about every place whose square lies in the image.

    image has all places of each image. Running sums along rows, then along columns, make the summed-area table; a square's sum is four of its
    entries, whatever its size. Integers stay exact.
    """
    row, column = Window.partitionBy(*keys, "r").orderBy("c"), Window.partitionBy(*keys, "c").orderBy("r")
    size = 2 * reach + 1
    so_far = image.select(*keys, "r", "c", *[F.sum(v).over(row.rowsBetween(Window.unboundedPreceding, 0)).alias(v) for v in values])
    # Along rows first: the table's entry at the square's right end less the one before its left end.
    spans = so_far.select(*keys, "r", "c", F.row_number().over(row).alias("_n"), *[(F.col(v) - F.coalesce(F.lag(v, size).over(row), F.lit(0))).alias(v) for v in values]).filter(F.col("_n") >= size)
    down = spans.select(*keys, "r", "c", F.row_number().over(column).alias("_n"), *[F.sum(v).over(column.rowsBetween(Window.unboundedPreceding, 0)).alias(v) for v in values])
    sums = down.select(*keys, "r", "c", "_n", *[(F.col(v) - F.coalesce(F.lag(v, size).over(column), F.lit(0))).alias(v) for v in values]).filter(F.col("_n") >= size)
    return sums.select(*keys, (F.col("r") - reach).alias("r"), (F.col("c") - reach).alias("c"), *values)


def correlation(n: int, a: Column, aa: Column, b: Column, bb: Column, ab: Column) -> Column:
    """Normalised cross-correlation from sums over n places; null where a side is flat."""
    va, vb = n * aa - a * a, n * bb - b * b
    return F.when((va > 0) & (vb > 0), (n * ab - a * b) / F.sqrt(va.cast("double") * vb.cast("double")))


def matched_depth(image: DataFrame, other: DataFrame, depths: list[float], focal_base: float, reach: int) -> DataFrame:
    """frame, r, c, depth, ncc: for each pixel the depth under which the patch about it agrees best with the other image's patch there.

    A depth z moves a pixel by round(focal_base / z) columns. A hypothesis counts where both patches lie in their images and neither is flat; of
    equal correlations (to nine places) the farthest depth wins. Both images have all their places.
    """
    shift = F.explode(F.array(*[F.struct(F.lit(z).alias("depth"), F.lit(round(focal_base / z)).alias("by")) for z in depths]))
    moved = image.withColumn("s", shift).select("frame", "r", "c", "v", "s.depth", (F.col("c") + F.col("s.by")).alias("oc"))
    there = other.select("frame", "r", F.col("c").alias("oc"), F.col("v").alias("w"))
    both = moved.join(there, ["frame", "r", "oc"]).select("frame", "depth", "r", "c", F.col("v").alias("a"), F.expr("v * v").alias("aa"), F.col("w").alias("b"), F.expr("w * w").alias("bb"), F.expr("v * w").alias("ab"))
    sums = box_sums(both, ["frame", "depth"], ["a", "aa", "b", "bb", "ab"], reach)
    ncc = F.round(correlation((2 * reach + 1) ** 2, *[F.col(k) for k in ("a", "aa", "b", "bb", "ab")]), 9)
    best = sums.select("frame", "r", "c", "depth", ncc.alias("ncc")).filter("ncc is not null").groupBy("frame", "r", "c").agg(F.max(F.struct("ncc", "depth")).alias("b"))
    return best.select("frame", "r", "c", "b.depth", r6("b.ncc").alias("ncc"))

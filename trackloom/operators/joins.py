"""Joins along time, validity and space. None is a nested loop: each gets an equality key before its residual predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _events(left: DataFrame, right: DataFrame, keys: list[str], t: str, columns: list[str]) -> DataFrame:
    """Both sides on one time line; the right side's row is a struct, so that a window can carry it."""
    row = F.struct(F.col(t).alias("t"), *columns)
    kind = right.select(row.alias("r")).schema["r"].dataType
    a = left.select(*keys, F.col(t).alias("_t"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(kind).alias("_r"))
    b = right.select(*keys, F.col(t).alias("_t"), F.lit(None).cast(a.schema["_l"].dataType).alias("_l"), row.alias("_r"))
    return a.unionByName(b)


def around(left: DataFrame, right: DataFrame, keys: list[str], t: str, columns: list[str]) -> DataFrame:
    """left with structs before (last right row at or before) and after (first at or after), each of t and columns.

    One shuffle on keys and a sort for each direction. Both directions look back along their own order, because Spark extends such a
    frame row by row, but computes one that reaches ahead to the end anew for every row. Right rows should have distinct (keys, t).
    """
    both = _events(left, right, keys, t, columns)
    past, future = (Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0) for order in (F.asc("_t"), F.desc("_t")))
    seen = both.select("*", F.last("_r", ignorenulls=True).over(past).alias("before"))
    seen = seen.select("*", F.last("_r", ignorenulls=True).over(future).alias("after"))
    return seen.filter("_l is not null").select("_l.*", "before", "after")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], t: str, columns: list[str], tolerance: int) -> DataFrame:
    """left with nearest (struct), gap and within; of two equally near rows the earlier one."""
    both = around(left, right, keys, t, columns)
    back, ahead = F.col(t) - F.col("before.t"), F.col("after.t") - F.col(t)
    pick = F.when(F.col("before").isNull() | (ahead < back), F.col("after")).otherwise(F.col("before"))
    chosen = both.withColumn("nearest", pick).drop("before", "after")
    gap = F.abs(F.col(t) - F.col("nearest.t"))
    return chosen.withColumn("gap", gap).withColumn("within", F.coalesce(gap <= tolerance, F.lit(False)))


def interpolated(left: DataFrame, right: DataFrame, keys: list[str], t: str, columns: list[str], widest: int | None = None) -> DataFrame:
    """left with each column interpolated between the rows around it; null outside, and where the rows are more than widest apart."""
    both = around(left, right, keys, t, columns)
    span = F.col("after.t") - F.col("before.t")
    share = F.when(span == 0, F.lit(0.0)).otherwise((F.col(t) - F.col("before.t")) / span)
    ok = F.lit(True) if widest is None else span <= widest
    out = [F.when(ok, F.col(f"before.{c}") + share * (F.col(f"after.{c}") - F.col(f"before.{c}"))).alias(c) for c in columns]
    return both.select(*[F.col(c) for c in left.columns], *out)


def horizons(left: DataFrame, t: str, offsets: list[int]) -> DataFrame:
    """Each row once per offset: h, and `at` = t + offset."""
    steps = F.array(*[F.struct(F.lit(k + 1).alias("h"), F.lit(o).cast("long").alias("o")) for k, o in enumerate(offsets)])
    return left.withColumn("_s", F.explode(steps)).withColumn("h", F.col("_s.h")).withColumn("at", F.col(t) + F.col("_s.o")).drop("_s")


def valid_interval(left: DataFrame, periods: DataFrame, at: str, start: str, end: str, width: int) -> DataFrame:
    """left with the periods that hold its instant: start <= at < end. Periods are cut into buckets of `width` for an equality key."""
    spread = periods.withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    return left.withColumn("_b", F.floor(F.col(at) / width)).join(spread.hint("merge"), "_b", "left").drop("_b").filter(F.col(start).isNull() | ((F.col(start) <= F.col(at)) & (F.col(at) < F.col(end))))


def exactly_one(matches: DataFrame, keys: list[str], found: Column) -> DataFrame:
    """keys, n, status: one, none or several."""
    n = F.count_if(found)
    return matches.groupBy(*keys).agg(n.alias("n")).withColumn("status", F.when(F.col("n") == 1, "one").when(F.col("n") == 0, "none").otherwise("several"))


def neighbours(a: DataFrame, b: DataFrame, keys: list[str], x: str, y: str, radius: float, suffix: str = "_b") -> DataFrame:
    """Pairs within radius: b is put into the 3 x 3 cells around its own, a looks in one.

    Spark guesses the size of exploded rows as if there were none, and would broadcast them; so the join is a merge of two sorted sides.
    """
    cx, cy = F.floor(F.col(x) / radius), F.floor(F.col(y) / radius)
    left = a.withColumn("_cx", cx).withColumn("_cy", cy)
    shift = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    right = b.withColumn("_s", shift).withColumn("_cx", cx + F.col("_s.i")).withColumn("_cy", cy + F.col("_s.j")).drop("_s")
    right = right.select(*keys, "_cx", "_cy", *[F.col(c).alias(c + suffix) for c in b.columns if c not in keys])
    distance = F.hypot(F.col(x) - F.col(x + suffix), F.col(y) - F.col(y + suffix))
    return left.join(right.hint("merge"), [*keys, "_cx", "_cy"]).drop("_cx", "_cy").withColumn("distance", distance).filter(F.col("distance") <= radius)

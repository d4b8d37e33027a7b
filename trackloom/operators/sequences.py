"""Operators along a time axis: each takes a partition key and an order, and adds columns by one window."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.angles import wrap


def along(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def gradient(value: str, w) -> Column:
    """Central difference inside, one-sided at the ends, per row; null for a single row."""
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    return F.when(before.isNull(), after - F.col(value)).when(after.isNull(), F.col(value) - before).otherwise((after - before) / 2)


def box5(value: Column | str, w) -> Column:
    """Five-tap box filter with zeros beyond the ends: a sum over five, not a mean."""
    return F.sum(value).over(w.rowsBetween(-2, 2)) / 5


def speed(df: DataFrame, keys: list[str], order: list[str], t: str = "t", x: str = "x", y: str = "y", per: float = 1e6) -> DataFrame:
    """speed from gradients of position over the gradient of time (t in units of 1/per seconds)."""
    w = along(keys, order)
    gx, gy, gt = gradient(x, w), gradient(y, w), gradient(t, w)
    return df.withColumn("speed", F.hypot(gx, gy) / F.nullif(gt / per, F.lit(0.0)))


def unwrap(df: DataFrame, angle: str, keys: list[str], order: list[str], out: str = "unwrapped") -> DataFrame:
    """An angle without jumps: the first value plus the running sum of wrapped differences."""
    w = along(keys, order)
    step = F.coalesce(wrap(F.col(angle) - F.lag(angle).over(w)), F.lit(0.0))
    first = F.first(angle).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_step", step).withColumn(out, first + F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def steps(df: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """step: distance to the row before; null at the start."""
    w = along(keys, order)
    return df.withColumn("step", F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)))


def until_jump(df: DataFrame, limit: float, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Rows before the first step longer than limit."""
    w = along(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    flagged = steps(df, keys, order, x, y).withColumn("_jump", F.max(F.coalesce((F.col("step") > limit).cast("int"), F.lit(0))).over(w))
    return flagged.filter("_jump = 0").drop("_jump", "step")


def without_flips(df: DataFrame, label: str, keys: list[str], order: list[str], out: str = "smoothed") -> DataFrame:
    """A label that differs from two agreeing neighbours takes theirs; neighbours are read unsmoothed."""
    w = along(keys, order)
    before, after = F.lag(label).over(w), F.lead(label).over(w)
    return df.withColumn(out, F.when((before == after) & (before != F.col(label)), before).otherwise(F.col(label)))


def islands(df: DataFrame, index: str, keys: list[str], least: int = 1) -> DataFrame:
    """keys, first, last, n of each run of consecutive distinct indices, runs of at least `least`."""
    distinct = df.select(*keys, index).distinct()
    grouped = distinct.withColumn("_g", F.col(index) - F.row_number().over(Window.partitionBy(*keys).orderBy(index)))
    out = grouped.groupBy(*keys, "_g").agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count(F.lit(1)).alias("n"))
    return out.filter(F.col("n") >= least).drop("_g")


def strided(df: DataFrame, k: int, keys: list[str], order: list[str]) -> DataFrame:
    """Every k-th row by its place, not by its id."""
    return df.withColumn("_n", F.row_number().over(along(keys, order))).filter(F.pmod(F.col("_n") - 1, F.lit(k)) == 0).drop("_n")


def trimmed(df: DataFrame, first: int, last: int, keys: list[str], order: list[str]) -> DataFrame:
    """Without the first and last rows of each key; keys with no more rows than both stay whole."""
    up, all_rows = along(keys, order), Window.partitionBy(*keys)
    counted = df.withColumn("_n", F.row_number().over(up)).withColumn("_of", F.count(F.lit(1)).over(all_rows))
    return counted.filter((F.col("_of") <= first + last) | ((F.col("_n") > first) & (F.col("_n") <= F.col("_of") - last))).drop("_n", "_of")


def resampled(df: DataFrame, every: int, keys: list[str], t: str = "t") -> DataFrame:
    """The first row at or after each multiple of `every` since a key's first row."""
    start = F.min(t).over(Window.partitionBy(*keys))
    slot = F.floor((F.col(t) - start + every - 1) / every)
    ranked = df.withColumn("_slot", slot.cast("long"))
    return ranked.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy(t))).filter("_n = 1").drop("_slot", "_n")


def gap_groups(df: DataFrame, limit: int, keys: list[str], t: str = "t", out: str = "part") -> DataFrame:
    """Number of the part a row is in; a gap longer than limit starts a new one."""
    w = along(keys, [t])
    gap = F.coalesce((F.col(t) - F.lag(t).over(w) > limit).cast("int"), F.lit(0))
    return df.withColumn("_gap", gap).withColumn(out, F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_gap")


def arc_length(df: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """along: path length from the first row."""
    stepped = steps(df, keys, order, x, y)
    return stepped.withColumn("along", F.sum(F.coalesce("step", F.lit(0.0))).over(along(keys, order).rowsBetween(Window.unboundedPreceding, 0))).drop("step")


def second_difference(df: DataFrame, value: str, keys: list[str], order: list[str], out: str = "second") -> DataFrame:
    w = along(keys, order)
    return df.withColumn(out, F.col(value) - 2 * F.lag(value, 1).over(w) + F.lag(value, 2).over(w))


def turning(df: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y", out: str = "turn") -> DataFrame:
    """Angle between the step before a row and the step after it."""
    w = along(keys, order)
    here = F.atan2(F.lead(y).over(w) - F.col(y), F.lead(x).over(w) - F.col(x))
    before = F.atan2(F.col(y) - F.lag(y).over(w), F.col(x) - F.lag(x).over(w))
    return df.withColumn(out, wrap(here - before))


def heading_error(df: DataFrame, yaw: str, keys: list[str], order: list[str], x: str = "x", y: str = "y", out: str = "error") -> DataFrame:
    """|yaw - direction of motion from the row before to the row after|; null at the ends."""
    w = along(keys, order)
    course = F.atan2(F.lead(y).over(w) - F.lag(y).over(w), F.lead(x).over(w) - F.lag(x).over(w))
    return df.withColumn(out, F.abs(wrap(F.col(yaw) - course)))


def pairs_at_most(at: np.ndarray, value: np.ndarray, before: np.ndarray, slope: float) -> int:
    """How many pairs (i, j), i among the first before[j] rows, have a slope of at most `slope`.

    That is so if value - slope * at is as large at i as at j, or larger. Ranks of these numbers are read bit by bit, from the highest: at
    each bit rows are parted by it, and each j follows its own rank's bits, counting the rows among its first ones that are above it.
    """
    level = value - slope * at
    ranks = np.unique(level, return_inverse=True)[1].astype(np.int32)
    lo, hi, now, own, found = np.zeros(len(at), np.int32), before.astype(np.int32), ranks, ranks, 0
    for bit in range(max(int(ranks.max()).bit_length(), 1) - 1, -1, -1):
        ones = (now >> bit & 1).astype(bool)
        up = np.concatenate([[0], np.cumsum(ones, dtype=np.int32)]).astype(np.int32)
        zeros, lo1, hi1 = len(now) - int(up[-1]), up[lo], up[hi]
        above = (own >> bit & 1).astype(bool)
        found += int((hi1 - lo1)[~above].sum(dtype=np.int64))
        lo, hi = np.where(above, zeros + lo1, lo - lo1), np.where(above, zeros + hi1, hi - hi1)
        now = np.concatenate([now[~ones], now[ones]])
    return found + int((hi - lo).sum(dtype=np.int64))


def median_slope(at: np.ndarray, value: np.ndarray, apart: float, direct: int = 1_000_000) -> float | None:
    """The median slope over pairs of rows at least `apart` (over 0) apart; None without a pair.

    Slopes are searched by halving, between two of a few thousand pairs' at first; counting those below takes n log n steps, so the pairs themselves
    are never made. What is found is the slope of a pair, unless several differ by less than 1e-12. Up to `direct` pairs are simply made: the
    result is the same, and searching has its price for each step.
    """
    order = np.argsort(at, kind="stable")
    at, value = at[order].astype(float), value[order].astype(float)
    before = np.searchsorted(at, at - apart, "right")
    total = int(before.sum())
    if not total:
        return None
    if total <= direct:
        b = np.repeat(np.arange(len(at)), before)
        a = np.arange(total) - np.repeat(np.cumsum(before) - before, before)
        return float(np.median((value[b] - value[a]) / (at[b] - at[a])))
    most = float(np.ptp(value)) / apart
    known = {most: total}
    rng = np.random.default_rng(1)
    j = rng.choice(np.flatnonzero(before), 4000)
    i = (rng.random(len(j)) * before[j]).astype(int)
    for guess in np.quantile((value[j] - value[i]) / (at[j] - at[i]), [0.46, 0.54]).tolist():
        known[guess] = pairs_at_most(at, value, before, guess)

    def of_a_pair(lo: float, hi: float) -> float:
        """The least slope over lo that a pair has up to hi: rows of one such slope lie side by side when sorted by what is left without it."""
        level = np.lexsort((at, value - hi * at))
        for step in range(1, len(at)):
            a, b = level[:-step], level[step:]
            wide = np.abs(at[b] - at[a]) >= apart
            slopes = (value[b[wide]] - value[a[wide]]) / (at[b[wide]] - at[a[wide]])
            slopes = slopes[(slopes > lo) & (slopes <= hi)]
            if len(slopes):
                return float(slopes.min())
            if step > 4 * apart:
                break
        return hi

    def smallest(rank: int) -> float:
        """The smallest slope that at least rank + 1 pairs have or are under."""
        hi = min(s for s, n in known.items() if n > rank)
        lo = max((s for s, n in known.items() if n <= rank), default=-most - 1.0)
        while hi - lo > 1e-12 * max(1.0, abs(hi), abs(lo)):
            middle = (lo + hi) / 2
            known[middle] = pairs_at_most(at, value, before, middle)
            lo, hi = (lo, middle) if known[middle] > rank else (middle, hi)
        return of_a_pair(lo - 1e-12, hi + 1e-12)

    return (smallest((total - 1) // 2) + smallest(total // 2)) / 2


def theil_sen(df: DataFrame, keys: list[str], at: str, value: str, apart: int = 8, clip_to: float | None = None) -> DataFrame:
    """keys, slope: the median slope over pairs of rows at least `apart` apart; keys without such a pair have no row. Nulls are left out."""
    rows = df.select(*keys, F.col(at).cast("double").alias("_at"), F.col(value).cast("double").alias("_value")).dropna(subset=["_at", "_value"])
    kinds = ", ".join(f"{n} {t}" for n, t in df.select(*keys).dtypes)

    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        slope = median_slope(part["_at"].to_numpy(), part["_value"].to_numpy(), apart)
        return pd.DataFrame([(*key, slope)] if slope is not None else [], columns=[*keys, "slope"])

    slope = F.col("slope") if clip_to is None else F.least(F.greatest(F.col("slope"), F.lit(-clip_to)), F.lit(clip_to))
    return rows.groupBy(*keys).applyInPandas(one, f"{kinds}, slope double").select(*keys, slope.alias("slope"))


def advantage(df: DataFrame, value: str, keys: list[str], floor: float = 1e-3, out: str = "advantage") -> DataFrame:
    """(value - group mean) / group sample deviation, the deviation not below floor."""
    w = Window.partitionBy(*keys)
    spread = F.greatest(F.coalesce(F.stddev_samp(value).over(w), F.lit(0.0)), F.lit(floor))
    return df.withColumn(out, (F.col(value) - F.avg(value).over(w)) / spread)


def parabola_weights(before: int, after: int) -> list[float]:
    """What each neighbour, from `before` places back to `after` ahead, adds to the value at 0 of the parabola that fits them best."""
    at = np.arange(-before, after + 1, dtype=float)
    return np.linalg.pinv(at[:, None] ** np.arange(min(2, len(at) - 1) + 1))[0].tolist()


def parabolas(points: DataFrame, keys: list[str], order: list[str], values: list[str], reach: int = 3) -> DataFrame:
    """points with s<value> columns: each point on the parabola that fits its neighbours within reach best, by their places.

    The weights of the neighbours depend on how many there are before and after alone, so they are fixed; ends have fewer neighbours.
    """
    weights = {(before, after): parabola_weights(before, after) for before in range(reach + 1) for after in range(reach + 1)}
    span = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-reach, reach)
    whole = Window.partitionBy(*keys).orderBy(*order)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    out = points.withColumn("_k", F.row_number().over(whole)).withColumn("_size", size)
    before, after = F.least(F.col("_k") - 1, F.lit(reach)), F.least(F.col("_size") - F.col("_k"), F.lit(reach))
    table = F.array(*[F.lit(weights[b, a]) for b in range(reach + 1) for a in range(reach + 1)])
    out = out.withColumn("_w", F.get(table, (before * (reach + 1) + after).cast("int")))
    for v in values:
        near = F.zip_with(F.collect_list(v).over(span), "_w", lambda x, w: x * w)
        out = out.withColumn(f"s{v}", near).withColumn(f"s{v}", F.aggregate(f"s{v}", F.lit(0.0), lambda a, b: a + b))
    return out.drop("_k", "_size", "_w")

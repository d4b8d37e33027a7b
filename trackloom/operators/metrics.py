"""Evaluation: counts to metrics, sweeps over thresholds, error statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def guarded(n: Column, of: Column) -> Column:
    """n / max(of, 1): rates of nothing are 0."""
    return n / F.greatest(of, F.lit(1))


def binary_counts(truth: Column, said: Column) -> list[Column]:
    return [F.count_if(truth & said).alias("tp"), F.count_if(~truth & said).alias("fp"), F.count_if(truth & ~said).alias("fn"), F.count_if(~truth & ~said).alias("tn")]


def derived(counts: DataFrame, keys: list[str]) -> DataFrame:
    """precision, recall, specificity, balanced and f1 of tp, fp, fn, tn; null where a rate has no base."""
    rate = lambda a, b: F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0))
    out = counts.select(*keys, "tp", "fp", "fn", "tn", rate("tp", "fp").alias("precision"), rate("tp", "fn").alias("recall"), rate("tn", "fp").alias("specificity"))
    return out.withColumn("balanced", (F.col("recall") + F.col("specificity")) / 2).withColumn("f1", 2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)))


def at_thresholds(df: DataFrame, score: str, truth: str, thresholds: list[float], keys: list[str] | None = None) -> DataFrame:
    """Counts for score > t, all thresholds in one pass: a row adds to the thresholds it passes."""
    keys = keys or []
    spread = df.withColumn("threshold", F.explode(F.lit(thresholds)))
    return spread.groupBy(*keys, "threshold").agg(*binary_counts(F.col(truth) == 1, F.col(score) > F.col("threshold")))


def cumulated(df: DataFrame, value: str, amounts: dict[str, str], parts: int = 64, keys: list[str] | None = None) -> DataFrame:
    """df with running sums {name: column} by rising value, equal values in one row each; of each group of `keys` for itself.

    Values are cut into about equal ranges; each range sums up by itself and starts from the total of the ranges before, so no
    task holds all rows, nor all rows of a group. Nulls come first. Keys are not null.
    """
    keys = keys or []
    cuts = sorted(set(df.approxQuantile(value, [k / parts for k in range(1, parts)], 0.01)))  # at most `parts` numbers
    ranged = df.withColumn("_part", F.coalesce(F.size(F.filter(F.lit(cuts), lambda c: c < F.col(value))), F.lit(0)) if cuts else F.lit(0))
    totals = ranged.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_all_{n}") for n, c in amounts.items()])
    earlier = (Window.partitionBy(*keys) if keys else Window).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    starts = totals.select(*keys, "_part", *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_from_{n}") for n in amounts])
    within = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(starts if keys else F.broadcast(starts), [*keys, "_part"])
    return summed.select(*df.columns, *[(F.sum(c).over(within) + F.col(f"_from_{n}")).alias(n) for n, c in amounts.items()])


def quantiles(df: DataFrame, value: str, shares: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """The exact quantiles {name: share} of a column, interpolated between neighbouring ranks; nulls are left out. One row, or one for each
    group of `keys` that has a value; groups with a null key are left out.

    Equal values are counted first, and ranks come from running sums, so no buffer holds all values.
    """
    keys = keys or []
    rows = df.dropna(subset=[value, *keys]).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = cumulated(rows, "_v", {"_upto": "_n"}, keys=keys)
    size = rows.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_size"))
    picked = []
    for name, q in shares.items():
        at = (F.col("_size") - 1) * F.lit(q)
        holds = lambda rank: F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank), F.col("_v")))
        low, high = holds(F.floor(at)), holds(F.ceil(at))
        picked.append((low + (high - low) * (F.first(at) - F.floor(F.first(at)))).alias(name))
    sized = placed.join(size, keys) if keys else placed.join(F.broadcast(size))
    return sized.groupBy(*keys).agg(*picked)


def with_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], *others: Column) -> DataFrame:
    """df by keys with the given aggregates, and quantiles of a column; groups without a value have null ones."""
    found = quantiles(df, value, shares, keys)
    return df.groupBy(*keys).agg(*others).join(found, keys, "left")


def sweep(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Counts for score >= t at every distinct score, from running sums over the distinct scores alone."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(F.sum(truth).alias("p"), F.sum(1 - F.col(truth)).alias("n")).withColumn("down", -F.col("threshold"))
    whole = per.agg(F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))
    run = cumulated(per, "down", {"tp": "p", "fp": "n"}).join(F.broadcast(whole))
    return run.select("threshold", "tp", "fp", (F.col("all_p") - F.col("tp")).alias("fn"), (F.col("all_n") - F.col("fp")).alias("tn"))

"""Ranks, gates and picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first k rows of each key, with slot from 0. Spark filters each task's rows before the shuffle (window group limit)."""
    return df.withColumn("slot", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).filter(F.col("slot") < k)


def best(df: DataFrame, keys: list[str], order: Column, columns: list[str]) -> DataFrame:
    """keys and columns of the row with the largest order (a struct); one aggregation, combined map-side."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_b")).select(*keys, "_b.*")


def worst_share(df: DataFrame, share: float, order: list[Column | str]) -> DataFrame:
    """The first max(1, floor(n * share)) rows of df in order. The count is taken first, so that the rest is a top-n without a global sort."""
    n = df.count()
    return df.orderBy(*order).limit(max(1, int(n * share))) if n else df


def gated(df: DataFrame, gate: Column, order: list[Column | str]) -> DataFrame:
    """The first row in order among those that pass the gate, or among all if none does."""
    ranked = df.withColumn("_pass", F.coalesce(gate, F.lit(False)))
    return ranked.orderBy(F.desc("_pass"), *order).limit(1).withColumn("gated", F.col("_pass")).drop("_pass")

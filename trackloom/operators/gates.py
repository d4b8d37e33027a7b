"""Validation as queries: every rule is a DataFrame of its violations, and promotion happens only when none is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def violations(rules: dict[str, DataFrame]) -> DataFrame:
    """(rule, n) of every rule, also those that hold."""
    out = None
    for name, bad in rules.items():
        one = bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("rule"), "n")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no rules")
    return out


def require_none(found: DataFrame) -> None:
    """Raise with the first rules that are violated."""
    bad = found.filter("n > 0").limit(20).collect()
    if bad:
        raise ValueError("violated: " + ", ".join(f"{r['rule']} ({r['n']})" for r in bad))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, n): distinct rows of one table that the other lacks; equal tables give two zeros."""
    count = lambda df, side: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
    return count(a.subtract(b), "only_a").unionByName(count(b.subtract(a), "only_b"))

"""Scalar expressions that plain SQL names differ on, or has no name for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Six decimals; negative zero becomes zero, so that equal results compare equal."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def clip(c: Column, lo: float, hi: float) -> Column:
    """Null stays null; NaN, larger than all numbers in Spark, becomes null."""
    return F.when(~F.isnan(c), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def finite(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def softmax(values: Column) -> Column:
    """Of an array, stable for large values."""
    top = F.array_max(values)
    grown = F.transform(values, lambda v: F.exp(v - top))
    total = F.aggregate(grown, F.lit(0.0), lambda a, v: a + v)
    return F.transform(grown, lambda v: v / total)


def entropy(probabilities: Column) -> Column:
    return -F.aggregate(probabilities, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log(p)).otherwise(0.0))


def argmax(values: Column) -> Column:
    """0-based place of the largest value, the first of equals; null for an empty array."""
    return F.when(F.size(values) > 0, F.array_position(values, F.array_max(values)) - 1)


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, or null; a null condition does not hold."""
    return reduce(lambda out, rule: out.when(rule[1], F.lit(rule[0])), rules[1:], F.when(rules[0][1], F.lit(rules[0][0])))


def bucket(key: Column, buckets: int) -> Column:
    """A bucket of a key by its SHA-1, the same on every engine."""
    return F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("long") % buckets


def cell(value: Column, size: float) -> Column:
    """Grid index by truncation toward zero: (-size, 0) falls into cell 0."""
    return (value / size).cast("int")


def band(value: Column, edges: list[float]) -> Column:
    """k for edges[k] <= value < edges[k + 1]; null outside."""
    return first_reason_value([(k, (value >= lo) & (value < hi)) for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True))])


def first_reason_value(rules: list[tuple[int, Column]]) -> Column:
    return reduce(lambda out, rule: out.when(rule[1], F.lit(rule[0])), rules[1:], F.when(rules[0][1], F.lit(rules[0][0])))


def safe_path(path: Column) -> Column:
    """Relative, and without a parent step."""
    return F.coalesce(~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|$)") & (path != ""), F.lit(False))


def gps_nanos(week: Column, seconds: Column) -> Column:
    """Nanoseconds since 1970 of a GPS week and seconds, less 18 leap seconds; seconds are split so that no LONG digit is lost."""
    whole = F.floor(seconds)
    return (F.lit(315964800).cast("long") + week.cast("long") * 604800 - 18 + whole) * 1_000_000_000 + F.rint((seconds - whole) * 1e9).cast("long")


def stem_nanos(stem: Column) -> Column:
    """Nanoseconds of a 'seconds-nanoseconds' file stem."""
    part = F.split(stem, "-")
    return part[0].cast("long") * 1_000_000_000 + part[1].cast("long")

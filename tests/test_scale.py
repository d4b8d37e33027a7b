"""Operators that have to end on large groups: the same results as plain versions on small ones, and large ones within a minute."""

from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import metrics, rasters, sequences


@pytest.mark.parametrize("seed", range(60))
def test_median_slope(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 45))
    at = rng.integers(0, 50, n).astype(float) if seed % 2 else np.arange(n).astype(float)
    value, apart = np.round(rng.normal(size=n), int(rng.integers(0, 4))), int(rng.integers(1, 9))
    slopes = [(value[j] - value[i]) / (at[j] - at[i]) for i in range(n) for j in range(n) if at[j] - at[i] >= apart]
    for direct in (0, 1_000_000):
        got = sequences.median_slope(at, value, apart, direct)
        assert got is None if not slopes else got == pytest.approx(np.median(slopes), abs=1e-14)


def test_theil_sen_of_a_long_scene(spark):
    n = 250_000
    rows = spark.range(n).select(F.lit(7).alias("scene"), F.col("id").alias("n"), (F.col("id") * 0.25 + F.xxhash64("id") % 1000 / 3).alias("x")).unionByName(spark.createDataFrame([(8, 0, 1.0), (9, 0, None), (9, 9, 4.0), (9, 20, 8.0)], "scene int, n long, x double"))
    began = time.time()
    got = {r["scene"]: r["slope"] for r in sequences.theil_sen(rows, ["scene"], "n", "x").collect()}
    assert got == {7: pytest.approx(0.25, abs=1e-4), 9: pytest.approx(4 / 11)} and time.time() - began < 60


def test_quantiles_by_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.choice([None, *(round(rng.random(), 2) for _ in range(9))])) for _ in range(900)] + [("d", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for r in metrics.with_quantiles(df, ["k"], "v", {"a": 0.5, "b": 0.93, "c": 0.0, "d": 1.0}, F.count(F.lit(1)).alias("n")).collect():
        own = [v for k, v in rows if k == r["k"] and v is not None]
        assert r["n"] == sum(k == r["k"] for k, _ in rows)
        want = [None] * 4 if not own or r["k"] is None else [pytest.approx(np.quantile(own, q)) for q in (0.5, 0.93, 0.0, 1.0)]
        assert [r[c] for c in "abcd"] == want


def test_linked_ends_of_a_large_scene(spark):
    n = 150_000
    s = spark.range(n).select(F.lit(1).cast("long").alias("scene"), F.col("id").alias("line"), F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    ends = s.select("*", (F.col("line") * 10 + F.col("side") * 8.0).alias("x"), F.lit(0.0).alias("y"), F.when(F.col("side") == 1, 0.0).otherwise(math.pi).alias("heading"))
    began = time.time()
    got = rasters.linked_lines(ends, 3.0, 20.0)
    assert got.count() == n - 1 and got.filter("line_b <> line_a + 1 or side_a <> 1 or side_b <> 0").isEmpty() and time.time() - began < 60


def test_linked_equals_the_matrix(spark):
    rng = random.Random(8)
    rows = [(1, line, side, rng.uniform(0, 12), rng.uniform(0, 12), rng.uniform(-3, 3)) for line in range(60) for side in (0, 1)]
    ends = spark.createDataFrame(rows, "scene long, line long, side int, x double, y double, heading double")
    pdf = ends.toPandas()
    want = {(pdf["line"][a], pdf["side"][a], pdf["line"][b], pdf["side"][b]) for a, b in rasters.linked(pdf, 4.0, 60.0)}
    assert {tuple(r)[1:] for r in rasters.linked_lines(ends, 4.0, 60.0).collect()} == want and len(want) > 15

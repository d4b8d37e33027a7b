"""Steps whose cost has to grow no faster than their tables: one shuffle where one is enough, bounded files, tasks and groups."""

from __future__ import annotations

from contextlib import contextmanager

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import trackloom.plans  # noqa: F401
from trackloom.operators import rasters
from trackloom.plans import file_queries, registry
from trackloom.sources import parsers, scenes

FOLDER = "/root/testdata/sf0.001"


def shuffles(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_polygons_are_filled_after_one_shuffle(spark):
    assert shuffles(spark, "r8_polygon_fill") == 1


def test_frames_of_polygons_go_on_in_the_next_batch(spark, monkeypatch):
    rng = np.random.default_rng(11)
    shapes = [(k % 4, int(rng.integers(0, 5)), rng.uniform(-9, 9, (int(rng.integers(1, 7)), 2)).round(1)) for k in range(300)]
    want: dict = {}
    for f, layer, v in shapes:
        for r, c in rasters.polygon_cells(v).tolist():
            want[f, r, c] = max(layer, want.get((f, r, c), layer))
    rows = [(f, layer, v[:, 0].tolist(), v[:, 1].tolist()) for f, layer, v in shapes] + [(1, 9, [], []), (2, 9, None, None), (7, 9, [], [])]
    df = spark.createDataFrame(rows, "frame long, layer int, ys array<double>, xs array<double>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = [tuple(r) for r in rasters.filled_shapes(df).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len(want) and {r[:3]: r[3] for r in got} == want


@contextmanager
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def by_sql(name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS FROM '{FOLDER}/lineitem.parquet'")
    return sorted(con.sql(registry.oracle_sql()[name]).fetchall())


@pytest.mark.parametrize(("name", "most"), [("x1_nearest_error_by_band", 2), ("x3_recall_by_side_and_band", 2), ("x4_recall_curve", 1)])
def test_pairs_are_made_after_one_shuffle(spark, name, most):
    """Boxes go by frame; what goes further are sums of a few groups. Batches that end within a frame change nothing."""
    assert shuffles(spark, name) <= most
    with small_batches(spark):
        assert sorted(map(tuple, registry.queries()[name](spark, FOLDER).collect())) == by_sql(name)


def test_peaks_after_one_shuffle(spark):
    assert shuffles(spark, "t6_peak_nms") == 1
    with small_batches(spark):
        assert sorted(map(tuple, registry.queries()["t6_peak_nms"](spark, FOLDER).collect())) == by_sql("t6_peak_nms")


def test_geopackages_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(file_queries, "work_folder", lambda spark: str(tmp_path / "maps"))
    monkeypatch.setattr(file_queries, "BLOCK", 50, raising=False)
    rows = registry.queries()["s12_geopackage"](spark, FOLDER).count()
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    assert rows == part.filter("p_size % 7 <> 0").count()
    assert len(list((tmp_path / "maps").glob("*.gpkg"))) == 5 * (part.agg({"p_partkey": "max"}).first()[0] // 50 + 1)


def test_runs_of_many_masks_are_those_of_each():
    rng = np.random.default_rng(5)
    runs = [rng.integers(0, 10 ** int(rng.integers(1, 6)), int(rng.integers(1, 9))).tolist() for _ in range(200)]
    texts = pa.array([None, "", *map(parsers.rle_text, runs), ""])
    for part, skipped in ((texts, 2), (texts.slice(7, 100), 0)):
        got, own = parsers.rle_arrays(part)
        assert [(k + skipped, n) for k, r in enumerate(runs if skipped else runs[5:105]) for n in r] == list(zip(own.tolist(), got.tolist(), strict=True))
    table = rng.integers(0, 5000, (50, 6))
    assert parsers.rle_texts(table).to_pylist() == [parsers.rle_text(r) for r in table.tolist()]
    with pytest.raises(ValueError, match="cut off"):
        parsers.rle_arrays(pa.array(["0", "0P"]))


def test_no_pixel_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(scenes, "PAINT", 50)
    df = registry.queries()["s13_painted_masks"](spark, FOLDER)
    assert "explode" not in df._jdf.queryExecution().executedPlan().toString()
    with small_batches(spark):
        assert sorted(map(tuple, df.collect())) == by_sql("s13_painted_masks")

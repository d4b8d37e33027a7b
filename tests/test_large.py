"""What has to hold when tables grow: plans without broadcasts of exploded rows, bounded rows and files, exact ties."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import trackloom.plans  # noqa: F401
from trackloom.plans import file_queries, registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["a25_plan_report", "r20_adjacency", "j16_geometry_in_window", "j17_radius_pairs"])
def test_exploded_rows_are_not_broadcast(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_arrays_of_annotations_are_bounded(spark, tmp_path, monkeypatch):
    """Of one scene's 150 samples no array has all, and none is lost."""
    monkeypatch.setattr(file_queries, "work_folder", lambda spark: str(tmp_path / "work"))
    monkeypatch.setattr(file_queries, "ARRAY", 50)
    made = file_queries._annotation_tables(spark, FOLDER, ["sample", "sample_data"])
    lines = [json.loads(x) for f in (tmp_path / "work" / "sample").rglob("*.txt") for x in f.read_text().splitlines()]
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    assert sum(map(len, lines)) == orders.count() and max(map(len, lines)) < 20
    assert made["sample"].select("token").distinct().count() == orders.count()
    assert made["sample_data"].agg(F.sum("width")).first()[0] == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()


def events(spark, tmp_path, rows):
    """A folder with an events table of rows (event_id, user_id, hours since 2024, type, value)."""
    df = spark.createDataFrame(rows, "event_id long, user_id long, h double, event_type string, value double")
    df.select("event_id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, h * 3600)").alias("ts"), "user_id", "event_type", "value", F.lit("{}").alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_flat_patches_have_no_correlation(spark, tmp_path):
    rows = [(k, 1, k / 10, "view", 5.0) for k in range(8)] + [(k, 1, k / 10, "view", float(k)) for k in range(8, 16)]
    got = {r["patch"]: (r["shift"], str(r["ncc"])) for r in registry.queries()["x16_depth_by_correlation"](spark, events(spark, tmp_path, rows)).collect()}
    assert got[0] == (0, "nan") and got[1][1] != "nan"


def test_a_mean_of_a_fifth_is_not_below_it(spark, tmp_path):
    """Eight days with 0.1 and eight with 0.3: however doubles are added, some sums fall short of 3.2."""
    shares, rows = [1, 3] * 8, []
    for day, share in enumerate(shares):
        rows += [(day * 10 + k, 1, day * 24.0 + k, "view" if k < share else "click", 1.0) for k in range(10)]
    (r,) = registry.queries()["a17_mean_of_means"](spark, events(spark, tmp_path, rows)).collect()
    assert r["share"] == 0.2 and r["flagged"] is False


def test_a_slope_close_to_halfway_is_rounded_once(spark, tmp_path):
    """Of 25 heights 19 are kept; their slope is -1.1864649998, which nine decimals would make -1.186465."""
    import duckdb

    bins = [0, 1, 2, 5, 6, 7, 10, 12, 13, 16, 20, 21, 22, 23, 24, 25, 28, 29, 30, 31, 32, 34, 35, 37, 39]
    tenths = [860, 834, 872, 748, 754, 710, 733, 337, 160, 470, 276, 764, 687, 938, 327, 202, 406, 456, 575, 22, 550, 199, 994, 510, 944]
    rows = [(y * pow(7919, -1, 1000) % 1000 + 1000 * k, 1, float(k), "view", 20.0 * b + 5) for k, (b, y) in enumerate(zip(bins, tenths, strict=True))]
    folder = events(spark, tmp_path, rows)
    (r,) = registry.queries()["x15_grade_line_fit"](spark, folder).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    assert (r["scene"], r["slope"], r["kept"]) == con.execute(registry.oracle_sql()["x15_grade_line_fit"]).fetchone() == (1, -1.18646, 19)


def test_lists_of_scenes_are_whole(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r["scene"]: r["listed"].split("\n") for r in registry.queries()["k1_scene_tables"](spark, FOLDER).collect()}
    assert sorted(int(i) for ids in got.values() for i in ids) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_frames_stay_whole_across_batches():
    """Frames of 1 to 9 rows in batches of any size: each comes out once, whole and in order."""
    import numpy as np
    import pyarrow as pa

    from trackloom.operators.matching import whole_frames

    frame = np.repeat(np.arange(40), np.arange(40) % 9 + 1)
    table = pa.table({"frame": frame, "cls": ["a"] * len(frame), "x": np.arange(len(frame))})
    for size in (1, 2, 7, 1000):
        got = [(int(b["frame"][lo]), b["x"][lo:hi].tolist()) for _, b, places in whole_frames(iter(table.to_batches(max_chunksize=size))) for lo, hi in places]
        assert got == [(k, np.flatnonzero(frame == k).tolist()) for k in range(40)]


def test_files_of_a_stream_grow_in_number(spark, tmp_path, monkeypatch):
    from trackloom.plans import stream_queries

    monkeypatch.setattr(stream_queries, "FILE", 100)
    stream_queries.arrived([spark.range(2000).selectExpr("id", "id % 500 as scene")], str(tmp_path), 2)
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "in").glob("*.parquet")]
    assert sum(sizes) == 2000 and len(sizes) > 12 and max(sizes) < 300


def test_lobes_are_spread_after_their_frames_have_met(spark, monkeypatch):
    from trackloom.plans import scalar_queries

    monkeypatch.setattr(scalar_queries, "LOBES", 1000)
    df = registry.queries()["r15_risk_lobes"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(frame") == 1


def test_long_walks_are_walked_to_their_end(spark, tmp_path):
    """Only event 9 can be read, a step of 1009 being one of 9 among ten: walks of one to nine steps; and no step makes rows for all."""
    rows = [(k, 1, float(k), "view" if k == 9 else "error", 1.0) for k in range(10)]
    df = registry.queries()["q15_retry_walk"](spark, events(spark, tmp_path, rows))
    assert {r["event_id"]: (r["tries"], r["taken"]) for r in df.collect()} == {k: (k + 1, 9) for k in range(9)}
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_scenes_accumulate_together():
    """Many scenes in two waves, the second with late frames: each as in a plain version that goes row by row, and the state is kept by dumps."""
    import numpy as np
    import pandas as pd

    from trackloom.streaming import accumulate

    rng = np.random.default_rng(5)
    rows = [(s, t, 2.0 * t + 30 * (t == 6), t // 4, None if (s + t) % 9 == 0 else 0.0, *rng.integers(-1, 17, 2).tolist(), float(rng.normal())) for s in range(-3, 61) for t in range(8 + s % 3) for _ in range(rng.integers(1, 6))]
    rows = pd.DataFrame(rows, columns=["scene", "t", "x", "y", "yaw", "r", "c", "v"]).sample(frac=1, random_state=1)
    waves = [rows[rows["t"] < 5], rows[(rows["t"] >= 5) | (rows["t"] == 2)]]
    held, got = accumulate.Accumulator(), []
    for wave in waves:
        got.append(accumulate.advance(wave, held))
        held = accumulate.Accumulator(state=held.dump())
    late = got[1][got[1]["t"] == 2]
    assert len(late) == 64 and (late["late"] > 0).all() and (late["cells"] == 0).all() and late["late"].sum() == (rows["t"] == 2).sum()
    got = pd.concat([got[0], got[1][got[1]["t"] >= 5]]).set_index(["scene", "t"])
    assert len(got) == rows.groupby(["scene", "t"]).ngroups and (got["late"] == 0).all()
    for _, own in rows.groupby("scene"):
        grid, before = {}, None
        for (s, t), frame in own.groupby(["scene", "t"]):
            x, y, yaw = frame[["x", "y", "yaw"]].iloc[0]
            reset = before is None or np.isnan(yaw) or np.hypot(x - before[0], y - before[1]) >= 10
            grid = {} if reset else {(r - x + before[0], c - y + before[1]): 0.7 * v for (r, c), v in grid.items()}
            for r, c, v in zip(frame["r"], frame["c"], frame["v"], strict=True):
                grid[r, c] = grid.get((r, c), 0.0) + v
            grid, before = {k: v for k, v in grid.items() if 0 <= min(k) and max(k) < 16}, None if np.isnan(yaw) else (x, y)
            assert (got.loc[(s, t), "cells"], got.loc[(s, t), "reset"]) == (len(grid), reset) and got.loc[(s, t), "total"] == pytest.approx(sum(grid.values()), abs=2e-9)


def test_states_of_many_scenes_are_written_together(spark, tmp_path, monkeypatch):
    """A wave's rows of a block lie in one file, and the stream keeps one record for each block and not for each scene."""
    from trackloom.plans import stream_queries

    monkeypatch.setattr(stream_queries, "FILE", 10_000)
    monkeypatch.setattr(stream_queries, "work_folder", lambda spark: str(tmp_path))
    folder = "/root/testdata/sf0.01"
    registry.queries()["m2_decayed_evidence"](spark, folder).collect()
    lies = spark.read.parquet(f"{tmp_path}/in").selectExpr("scene div 64 as block", "t div 16 as wave", "input_file_name() as file").distinct().collect()
    blocks = spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr("l_orderkey div 2048").distinct().count()
    assert len({r["file"] for r in lies}) > 4 and len(lies) == 2 * blocks
    assert spark.read.format("statestore").load(f"{tmp_path}/state").count() == blocks

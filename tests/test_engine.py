"""The engine's own operators: golden fixtures, brute force, ties and edges, and stream equal to batch."""

from __future__ import annotations

import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackloom.functions import angles, commands, geometry, scalars
from trackloom.operators import gates, grids, joins, matching, metrics, rasters
from trackloom.operators import sequences as S
from trackloom.sources import parsers, publish
from trackloom.streaming import accumulate

TRACK = "scene string, t long, x double, y double, yaw double"


def test_future_waypoints(spark):
    """Speed 2 along x: six waypoints 1..6 at half seconds, invalid where 3 s exceed the end."""
    rows = spark.createDataFrame([("a", i * 500_000, float(i), 0.0, 0.0) for i in range(8)], TRACK)
    ahead = joins.horizons(rows.filter("t <= 1000000"), "t", [k * 500_000 for k in range(1, 7)]).select("scene", F.col("t").alias("t0"), "h", F.col("x").alias("x0"), F.col("at").alias("t"))
    got = joins.interpolated(ahead, rows, ["scene"], "t", ["x"]).groupBy("t0").agg(F.sort_array(F.collect_list(F.struct("h", (F.col("x") - F.col("x0")).alias("dx")))).alias("w"), F.bool_and(F.col("x").isNotNull()).alias("valid"))
    found = {r["t0"]: ([w["dx"] for w in r["w"]], r["valid"]) for r in got.collect()}
    assert found[0] == ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0], True) and found[500_000][1] and not found[1_000_000][1]


def test_nearest_ties_go_to_the_earlier(spark):
    left = spark.createDataFrame([("a", 10), ("a", 25), ("b", 5)], "k string, t long")
    right = spark.createDataFrame([("a", 0, 1.0), ("a", 20, 2.0), ("a", 30, 3.0)], "k string, t long, v double")
    got = {(r["k"], r["t"]): (r["nearest"] and r["nearest"]["v"], r["within"]) for r in joins.nearest(left, right, ["k"], "t", ["v"], 5).collect()}
    assert got == {("a", 10): (1.0, False), ("a", 25): (2.0, True), ("b", 5): (None, False)}


def test_neighbours_equal_all_pairs(spark):
    rng = random.Random(1)
    p = [(i, rng.uniform(-20, 20), rng.uniform(-20, 20)) for i in range(150)]
    df = spark.createDataFrame(p, "id int, x double, y double")
    got = {(r["id"], r["id_b"]) for r in joins.neighbours(df, df, [], "x", "y", 3.0).collect()}
    assert got == {(a, b) for a, ax, ay in p for b, bx, by in p if math.hypot(ax - bx, ay - by) <= 3.0}


def test_validity_periods(spark):
    periods = spark.createDataFrame([(1, 0, 10), (2, 10, 20), (3, 15, 30)], "id int, a long, b long")
    at = spark.createDataFrame([(0,), (10,), (17,), (30,), (99,)], "t long")
    hits = joins.valid_interval(at, periods, "t", "a", "b", 4).select("t", "id")
    assert {r["t"]: r["status"] for r in joins.exactly_one(at.join(hits, "t", "left"), ["t"], F.col("id").isNotNull()).collect()} == {0: "one", 10: "one", 17: "several", 30: "none", 99: "none"}


@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_sequences_do_not_depend_on_partitions(spark, partitions):
    rows = spark.createDataFrame([("a", i, float(x), 0.0, 0.0) for i, x in enumerate([0, 1, 3, 3, 20, 21])], TRACK).repartition(partitions, "t")
    v = {r["t"]: r["b"] for r in rows.select("t", S.box5("x", S.along(["scene"], ["t"])).alias("b")).collect()}
    assert [v[i] for i in range(6)] == pytest.approx(np.convolve([0, 1, 3, 3, 20, 21], np.ones(5) / 5, "same").tolist())
    assert sorted(r["t"] for r in S.until_jump(rows, 8.0, ["scene"], ["t"]).collect()) == [0, 1, 2, 3]
    g = {r["t"]: r["g"] for r in rows.select("t", S.gradient("x", S.along(["scene"], ["t"])).alias("g")).collect()}
    assert [g[i] for i in range(6)] == np.gradient([0.0, 1, 3, 3, 20, 21]).tolist()


def test_chains_and_unwrap(spark):
    idx = spark.createDataFrame([("s", i) for i in (1, 2, 3, 7, 8)], "scene string, i int")
    assert [(r["first"], r["last"], r["n"]) for r in S.islands(idx, "i", ["scene"], 3).collect()] == [(1, 3, 3)]
    yaw = [3.0, -3.1, -2.9, 3.1, 2.0]
    rows = spark.createDataFrame([("a", i, 0.0, 0.0, v) for i, v in enumerate(yaw)], TRACK)
    got = [r["unwrapped"] for r in S.unwrap(rows, "yaw", ["scene"], ["t"]).orderBy("t").collect()]
    assert got == pytest.approx(np.unwrap(yaw).tolist())


def test_cells_and_scalars(spark):
    row = spark.range(1).select(scalars.cell(F.lit(-0.5), 1.0).alias("a"), scalars.cell(F.lit(-1.0), 1.0).alias("b"), scalars.argmax(F.array(F.lit(1), F.lit(3), F.lit(3))).alias("c"), scalars.finite(F.lit(float("nan"))).alias("d"), angles.quarter_turns(F.lit(45.0)).alias("e"), scalars.gps_nanos(F.lit(0), F.lit(18.5)).alias("f"), scalars.stem_nanos(F.lit("12-000000034")).alias("g"), scalars.safe_path(F.lit("a/../b")).alias("h")).first()
    assert tuple(row) == (0, -1, 1, False, 0.0, 315964800_500000000, 12_000000034, False)


def test_commands_and_plans(spark):
    rows = spark.createDataFrame([([1, 0, 0, 0],), ([0, 1, 0, 0],), ([0, 0, 1, 0],), ([0, 0, 0, 1],)], "v array<int>")
    assert [r[0] for r in rows.select(commands.reordered(F.col("v"))).collect()] == [[0, 1, 0], [1, 0, 0], [0, 0, 1], [0, 0, 0]]
    with pytest.raises(Exception, match="one of four"):
        spark.createDataFrame([([1, 1, 0, 0],)], "v array<int>").select(commands.reordered(F.col("v"))).collect()
    plan = F.array(*[F.struct(F.lit(float(i)).alias("x"), F.lit(0.0).alias("y")) for i in range(1, 7)])
    line, held, mode = spark.range(1).select(commands.extended(plan, 2), commands.extended(plan, 2, True), commands.best_mode(F.array(F.lit(0.0), F.lit(4.0), F.lit(1.0)), F.array(F.lit("a"), F.lit("b"), F.lit("c")))).first()
    assert [p["x"] for p in line][6:] == [7.0, 8.0] and [p["x"] for p in held][6:] == [6.0, 6.0] and mode == "b"


def test_world_and_back(spark):
    x, y = angles.to_world(*angles.to_local(F.lit(3.0), F.lit(-4.0), F.lit(0.7)), F.lit(0.7))
    a, b, e, n = spark.range(1).select(x, y, *geometry.enu(*map(F.lit, (35.0, 139.0, 10.0, 35.0, 139.0, 0.0)))[1:]).first()
    assert (a, b) == pytest.approx((3.0, -4.0)) and (e, n) == pytest.approx((0.0, 10.0), abs=1e-6)


def test_votes_and_thin_classes(spark):
    votes = spark.createDataFrame([("tie", "B", 2), ("tie", "A", 2), ("thin", "A", 9), ("thin", "L", 3), ("few", "A", 6), ("few", "L", 2), ("less", "A", 10), ("less", "L", 3)], "k string, cls string, n long")
    assert {r["k"]: r["cls"] for r in grids.majority(votes, ["k"], ["A", "B", "L"]).collect()}["tie"] == "A"
    assert {r["k"]: r["cls"] for r in grids.thin_override(votes, ["k"], ["A", "B"], ["L"]).collect()} == {"tie": "A", "thin": "L", "few": "A", "less": "A"}


def boxed(rows):
    return pd.DataFrame(rows, columns=["id", "cls", "score", "x", "y"]).assign(w=2.0, l=2.0)


def test_matching_rules_differ():
    p, t = boxed([(1, "c", 0.5, 0.0, 0.0), (2, "c", 0.9, 1.0, 0.0)]), boxed([(7, "c", 1, 0.4, 0.0), (8, "c", 1, 3.0, 0.0)])
    assert sorted(matching.score_first(p, t, 2.0)) == [(1, 0)]
    assert sorted(matching.truth_first(p, t, 2.0)) == [(0, 0)]
    assert sorted(matching.truth_first(p, t, 2.01)) == [(0, 0), (1, 1)]
    assert sorted(matching.run_pairs(p, t, 2.0)) == [(0, 0), (1, 1)]
    assert sorted(matching.listed_order(p, t, 2.0)) == [(0, 0)]
    assert matching.by_overlap(p, t, 0.3) == [(1, 0)]


def test_match_lists_everything(spark):
    schema = "frame long, id long, cls string, score double, x double, y double, w double, l double"
    p = spark.createDataFrame([(0, 1, "c", 0.5, 0.0, 0.0, 1.0, 1.0), (1, 2, "c", 0.5, 0.0, 0.0, 1.0, 1.0)], schema)
    t = spark.createDataFrame([(0, 7, "c", 1.0, 0.5, 0.0, 1.0, 1.0), (2, 8, "c", 1.0, 0.0, 0.0, 1.0, 1.0)], schema)
    assert {(r["frame"], r["pred"], r["truth"], r["distance"]) for r in matching.match(p, t, matching.score_first, 2.0).collect()} == {(0, 1, 7, 0.5), (1, 2, None, None), (2, None, 8, None)}


def test_rotated_overlap():
    assert matching.rotated_iou((0, 0, 4, 2, 0.3), (0, 0, 4, 2, 0.3)) == pytest.approx((1.0, 1.0))
    assert matching.rotated_iou((0, 0, 4, 2, 0.0), (0, 0, 2, 4, math.pi / 2)) == pytest.approx((1.0, 1.0))
    assert matching.rotated_iou((0, 0, 2, 2, 0.0), (1, 0, 2, 2, 0.0)) == pytest.approx((1 / 3, 1 / 2))
    assert matching.rotated_iou((0, 0, 1, 1, 0.0), (9, 9, 1, 1, 0.5)) == (0.0, 0.0)


def test_raster_kernels():
    rng = np.random.default_rng(2)
    mask = rng.random((15, 18)) < 0.3
    r, c = np.nonzero(mask)
    near = np.sqrt(((np.indices(mask.shape)[:, :, :, None] - np.stack([r, c])[:, None, None, :]) ** 2).sum(0).min(-1))
    assert rasters.distances(mask) == pytest.approx(near)
    parts = rasters.labelled(np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 0, 0], [1, 1, 0, 0]], bool))
    assert parts.tolist() == [[1, 0, 0, 2], [0, 1, 0, 2], [0, 0, 0, 0], [3, 3, 0, 0]]
    assert {tuple(p) for p in rasters.polygon_cells(np.array([[0, 0], [0, 3], [2, 3], [2, 0]], float)).tolist()} == {(a, b) for a in range(2) for b in range(3)}
    thin = rasters.thinned(np.ones((5, 20), bool))
    assert 0 < thin.sum() < 25 and rasters.labelled(thin).max() == 1
    line = np.array([[0, 0], [1, 0.05], [2, 0], [3, 2], [4, 0]], float)
    assert rasters.simplified(line, 0.1).tolist() == [0, 2, 3, 4]
    ends = pd.DataFrame({"line": [0, 1, 2], "x": [0.0, 1.0, 1.5], "y": [0.0, 0.0, 0.0], "heading": [0.0, math.pi, math.pi]})
    assert rasters.linked(ends, 2.0, 20.0) == [(0, 1)]


def test_filled_polygons_are_polygon_cells(spark):
    rng = np.random.default_rng(7)
    shapes = [(k % 3, k, int(rng.integers(0, 4)), np.round(rng.uniform(0, 9, (int(rng.integers(3, 8)), 2)) * 2) / 2) for k in range(60)]
    rows = [(f, k, layer, i, float(y), float(x)) for f, k, layer, v in shapes for i, (y, x) in enumerate(v)]
    want: dict = {}
    for f, _, layer, v in shapes:
        for r, c in rasters.polygon_cells(v).tolist():
            want[f, r, c] = max(layer, want.get((f, r, c), 0))
    df = spark.createDataFrame(rows, "frame long, poly long, layer int, seq int, y double, x double")
    assert {(r["frame"], r["r"], r["c"]): r["layer"] for r in rasters.filled_polygons(df).collect()} == want


def test_plan_headings(spark):
    """A left curve, longer by two in a line or held: headings rise, and a held end keeps the last one."""
    points = F.array(*[F.struct(F.lit(float(i)).alias("x"), F.lit(0.1 * i * i).alias("y")) for i in range(1, 7)])
    rows = spark.range(1).select(commands.poses(points).alias("curve"), commands.poses(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (-1.0, 0.1), (-2.0, 0.0), (-2.0, 0.0))])).alias("turned")).first()
    xy = np.array([[0, 0], *[[i, 0.1 * i * i] for i in range(1, 7)]])
    step = np.diff(xy, axis=0)
    assert [p["heading"] for p in rows["curve"]] == pytest.approx(np.arctan2(step[:, 1], step[:, 0]).tolist())
    raw = [0.0, math.atan2(0.1, -1), math.atan2(-0.1, -1), math.atan2(-0.1, -1)]
    assert [p["heading"] for p in rows["turned"]] == pytest.approx(np.unwrap(raw).tolist())


def test_simplified_and_smoothed_lines(spark):
    rng = np.random.default_rng(5)
    xy = np.cumsum(rng.normal(0, 1, (40, 2)), axis=0)
    df = spark.createDataFrame([(1, n, float(x), float(y)) for n, (x, y) in enumerate(xy)], "scene long, n long, x double, y double")
    rows = rasters.simplified_lines(df, 1.5).orderBy("n").collect()
    kept = [r["n"] for r in rows if r["kept"]]
    for a, b in zip(kept, kept[1:], strict=False):
        d = xy[b] - xy[a]
        off = [abs(d[0] * (p[1] - xy[a][1]) - d[1] * (p[0] - xy[a][0])) / np.hypot(*d) for p in xy[a + 1 : b]]
        assert max(off, default=0) <= 1.5
    line = np.stack([np.arange(12.0), 2 + 0.5 * np.arange(12.0) ** 2], 1)
    assert rasters.smoothed(line) == pytest.approx(line)


def test_around_is_linear(spark):
    """A quarter of a million rows of one scene: with a frame that reaches ahead this took hours."""
    n = 250_000
    rows = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("t"), F.col("id").alias("v"))
    got = joins.nearest(rows.select("k", (F.col("t") + 3).alias("t")), rows, ["k"], "t", ["v"], 5)
    assert got.agg(F.count_if("within"), F.sum("gap")).first() == (n, 3 * n)


def test_running_sums_and_quantiles(spark):
    rng = random.Random(4)
    for values in ([], [3.0], [1.0, 2.0], [float(rng.randint(0, 50)) for _ in range(501)], [rng.gauss(0, 1) for _ in range(1000)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        got = metrics.quantiles(df, "v", {"a": 0.5, "b": 0.93, "c": 1.0, "d": 0.0}).first()
        want = [float(np.quantile(values, q)) for q in (0.5, 0.93, 1.0, 0.0)] if values else [None] * 4
        assert list(got) == (want if not values else pytest.approx(want))
    df = spark.createDataFrame([(float(k), k) for k in range(300)], "v double, n long")
    up = {r["v"]: r["upto"] for r in metrics.cumulated(df, "v", {"upto": "n"}, 7).collect()}
    assert up == {float(k): k * (k + 1) // 2 for k in range(300)}


def test_holes_and_regions(spark):
    ring = [(0, a, b) for a in range(5) for b in range(5) if a in (0, 4) or b in (0, 4)]
    cells = spark.createDataFrame(ring, "frame long, r int, c int")
    assert rasters.filled_holes(cells, 9).count() == 25 and rasters.filled_holes(cells, 8).count() == 16
    two = spark.createDataFrame([*ring, (0, 9, 9)], "frame long, r int, c int")
    assert rasters.connected_to(two, (0, 0)).count() == 16 and rasters.connected_to(two, (9, 9)).count() == 17


def test_parsers(spark, tmp_path):
    lines = spark.createDataFrame([(0, "car 1 2 3"), (1, "car 1 2"), (2, "car x 2 3"), (3, "car 1 NaN 3"), (4, "car -1 2 3"), (5, "cow 1 2 3")], "line int, raw string")
    got = {r["line"]: r["reason"] for r in parsers.label_lines(lines, 4, [1, 2, 3], [1], 0, ["car"]).collect()}
    assert got == {0: None, 1: "field_count", 2: "parse", 3: "non_finite", 4: "size", 5: "class"}
    head = b"# .PCD\nVERSION 0.7\nFIELDS x y z rgb\nSIZE 4 4 4 1\nTYPE F F F U\nCOUNT 1 1 1 3\nWIDTH 2\nHEIGHT 1\nPOINTS 2\nDATA binary\n"
    body = struct.pack("<fffBBBfffBBB", 1, 3, 5, 0, 0, 0, -2, 4, 6, 0, 0, 0)
    assert parsers.pcd_points(head + body).tolist() == [[1, 3, 5], [-2, 4, 6]]
    with pytest.raises(ValueError, match="cut off"):
        parsers.pcd_points(head + body[:-1])
    ring = struct.pack("<BIII6d", 1, 3, 1, 3, 0, 0, 1, 0, 0, 1)
    assert parsers.wkb_polygon(ring) == [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]
    (tmp_path / "cam").mkdir()
    (tmp_path / "cam" / "12-000000005.bin").write_bytes(np.arange(10, dtype="<f4").tobytes())
    files = parsers.stamped_files(spark, str(tmp_path))
    assert [(r["stream"], r["t"]) for r in files.collect()] == [("cam", 12_000000005)]
    points = parsers.float_points(spark.read.format("binaryFile").load(f"{tmp_path}/cam"))
    assert [(r["pt"], r["x"], r["z"]) for r in points.orderBy("pt").collect()] == [(0, 0.0, 2.0), (1, 5.0, 7.0)]


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    good, bad = spark.range(3), spark.range(4)
    rule = lambda df: gates.violations({"few": df.filter("id > 2")})
    assert publish.current_version(spark, root) is None
    publish.publish(good, root, 1, rule)
    with pytest.raises(ValueError, match="few"):
        publish.publish(bad, root, 2, rule)
    assert publish.current_version(spark, root) == 1 and publish.current(spark, root).count() == 3
    with pytest.raises(FileExistsError):
        publish.publish(bad, root, 1)
    assert publish.current(spark, root).count() == 3
    assert publish.stages_to_run(["a", "b", "c"], [("a", "k")], "k", lambda s: True) == ["b", "c"]
    for done, exists in (([("b", "k")], True), ([("a", "old")], True), ([("a", "k")], False)):
        with pytest.raises(ValueError):
            publish.stages_to_run(["a", "b", "c"], done, "k", lambda s, e=exists: e)


def test_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(3)
    schema = "scene long, t long, x double, y double, yaw double, r int, c int, v double"
    rows = [(s, t, 0.8 * t + (30.0 if t == 6 else 0), 0.1 * t, None if (s, t) == (1, 4) else 0.05 * t, int(rng.integers(0, 16)), int(rng.integers(0, 16)), float(rng.normal())) for s in (1, 2) for t in range(9) for _ in range(5)]
    for k in range(3):
        spark.createDataFrame([r for r in rows if r[1] // 3 == k], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = accumulate.accumulate_stream(accumulate.frame_stream(spark, f"{tmp_path}/in", schema))
    query = stream.writeStream.format("memory").queryName("acc").option("checkpointLocation", f"{tmp_path}/ck").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = sorted(map(tuple, spark.sql("select * from acc").collect()))
    want = sorted(map(tuple, accumulate.accumulate_batch(spark.createDataFrame(rows, schema)).collect()))
    assert got == want and len(got) == 18
    assert {(r[0], r[1]) for r in got if r[4]} == {(1, 0), (2, 0), (1, 4), (1, 5), (1, 6), (2, 6), (1, 7), (2, 7)}

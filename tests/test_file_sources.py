"""Tiles, GeoPackages, projection, byte ranges, numbered lines and resumed stages."""

from __future__ import annotations

import math
import os
import random
import struct
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.functions import projection
from trackloom.sources import byte_ranges, geopackage, publish, tiles


def test_pieces_are_as_long_as_their_way(spark):
    rng = random.Random(2)
    rows = [(w, n, rng.uniform(-50, 50), rng.uniform(-50, 50)) for w in range(30) for n in range(rng.randint(1, 9))]
    rows += [(90, n, x, y) for n, (x, y) in enumerate([(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (20.0, 20.0), (-20.0, -20.0), (0.0, 0.0), (10.0, 0.0), (30.0, 0.0), (15.0, 0.0)])]  # along borders and through corners
    ways = spark.createDataFrame(rows, "way long, n int, x double, y double")
    pieces = tiles.clipped(tiles.segments(ways), 10.0).collect()
    length, want = defaultdict(float), defaultdict(float)
    for p in pieces:
        length[p["way"]] += p["length"]
        middle = ((p["ax"] + p["bx"]) / 2, (p["ay"] + p["by"]) / 2)
        assert all(10 * t - 1e-9 <= c <= 10 * t + 10 + 1e-9 for t, c in zip((p["tile_x"], p["tile_y"]), middle, strict=True))
        assert p["length"] == pytest.approx(math.hypot(p["bx"] - p["ax"], p["by"] - p["ay"]), abs=1e-9)
    by = defaultdict(list)
    for r in sorted(rows):
        by[r[0]].append(r[2:])
    for w, points in by.items():
        want[w] = sum(math.dist(a, b) for a, b in zip(points, points[1:], strict=False))
    assert set(length) == {w for w in want if len(by[w]) > 1} and all(length[w] == pytest.approx(want[w]) for w in length)
    long = spark.createDataFrame([(1, 0, 0.5, 0.5), (1, 1, 4000.5, 4000.5)], "way long, n int, x double, y double")
    assert tiles.clipped(tiles.segments(long), 1.0).count() < 3 * 4001  # the tiles it crosses, and not its extent's 16 million


def test_runs_join_what_a_tile_holds(spark, tmp_path):
    ways = spark.createDataFrame([(1, 0, 1.0, 1.0), (1, 5, 5.0, 1.0), (1, 7, 15.0, 1.0), (1, 8, 15.0, 5.0), (1, 9, 5.0, 5.0), (1, 10, 5.0, 8.0)], "way long, n int, x double, y double")
    runs = tiles.tile_runs(tiles.clipped(tiles.segments(ways), 10.0))
    got = {(r["tile_x"], r["run"]): [(p["x"], p["y"]) for p in r["points"]] for r in runs.collect()}
    assert got == {(0, 0): [(1, 1), (5, 1), (10, 1)], (1, 0): [(10, 1), (15, 1), (15, 5), (10, 5)], (0, 1): [(10, 5), (5, 5), (5, 8)]}
    tiles.write_tiles(runs, f"file://{tmp_path}/t")
    one = spark.read.parquet(f"file://{tmp_path}/t").filter("tile_x = 1")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(tile_x" in one._jdf.queryExecution().executedPlan().toString()


def test_utm(spark):
    """On the central meridian northings are the meridian's length; the map is conformal; and both together leave no other one."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    h = 1e-4
    places = [(lat, lon) for lat in (-60.0, -1.0, 0.5, 35.0, 52.3, 83.0) for lon in (12.1, 15.0, 17.4)]
    rows = [(lat + dy, lon + dx) for lat, lon in places for dy, dx in ((0, 0), (h, 0), (-h, 0), (0, h), (0, -h))]
    x, y = projection.utm(F.col("lat"), F.col("lon"), 33)
    at = [(r["x"], r["y"]) for r in spark.createDataFrame(rows, "lat double, lon double").select(x.alias("x"), y.alias("y")).collect()]
    for k, (lat, lon) in enumerate(places):
        (ex, ny), (x1, y1), (x2, y2), (x3, y3), (x4, y4) = at[5 * k : 5 * k + 5]
        phi = math.radians(lat)
        w = math.sqrt(1 - e2 * math.sin(phi) ** 2)
        meridian, parallel = a * (1 - e2) / w**3, a * math.cos(phi) / w
        step = math.radians(2 * h)
        up, right = ((x1 - x2) / step / meridian, (y1 - y2) / step / meridian), ((x3 - x4) / step / parallel, (y3 - y4) / step / parallel)
        assert up[0] == pytest.approx(-right[1], abs=2e-6) and up[1] == pytest.approx(right[0], abs=2e-6)
        if lon == 15.0:
            p = np.linspace(0, phi, 200_001)
            g = a * (1 - e2) / (1 - e2 * np.sin(p) ** 2) ** 1.5
            assert ex == pytest.approx(500000, abs=1e-6) and up[1] == pytest.approx(0.9996, abs=1e-6)
            assert ny == pytest.approx(0.9996 * float(((g[1:] + g[:-1]) / 2 * np.diff(p)).sum()) + (1e7 if lat < 0 else 0), abs=2e-4)
    zone = spark.range(1).select(projection.utm_zone(F.lit(13.4)).alias("a"), projection.utm_zone(F.lit(-180.0)).alias("b"), projection.utm(F.lit(85.0), F.lit(0.0), 31)[0].alias("c")).first()
    assert (zone["a"], zone["b"], zone["c"]) == (33, 1, None)


def blob(body, flags=1):
    return b"GP\x00" + bytes([flags]) + b"\x00\x00\x00\x00" + b"\x00" * geopackage.ENVELOPES.get(flags >> 1 & 7, 0) + body


def test_geometries():
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    raw = geopackage.polygon_blob([square, square[:3]])
    kind, points = geopackage.geometry(geopackage.wkb_of(raw))
    assert kind == "polygon" and points == [(0, r, k, *p) for r, ring in enumerate((square, square[:3])) for k, p in enumerate(ring)]
    line = struct.pack(">BII6d", 0, 1002, 2, 1, 2, 9, 3, 4, 9)  # big endian, with heights
    assert geopackage.geometry(line) == ("line", [(0, 0, 0, 1.0, 2.0), (0, 0, 1, 3.0, 4.0)])
    many = struct.pack("<BII", 1, 4, 2) + struct.pack("<BIdd", 1, 1, 5, 6) + struct.pack("<BIdd", 1, 1, 7, 8)
    for flags in (1, 3, 5, 7, 9):
        assert geopackage.geometry(geopackage.wkb_of(blob(many, flags))) == ("points", [(0, 0, 0, 5.0, 6.0), (1, 0, 0, 7.0, 8.0)])
    for cut in range(9, len(raw)):
        with pytest.raises(ValueError):
            geopackage.geometry(geopackage.wkb_of(raw[:cut]))
    for bad in (b"", b"GP", b"XX\x00\x01" + b"\x00" * 40, blob(many, 11), blob(struct.pack("<BII", 1, 17, 0))):
        with pytest.raises(ValueError):
            geopackage.geometry(geopackage.wkb_of(bad))


def test_layers_are_read_by_ranges(spark, tmp_path):
    geopackage.register(spark)
    rows = [(f"c{i % 3}", "lanes" if i % 2 else "walks", i, None if i % 5 == 0 else bytearray(geopackage.polygon_blob([[(float(i), 0.0), (i + 1.0, 0.0), (float(i), 1.0)]]))) for i in range(1, 200)]
    assert geopackage.write_layers(spark.createDataFrame(rows, "file string, layer string, fid long, geom binary"), f"file://{tmp_path}/maps", "EPSG:32633") == 3
    read = lambda **o: spark.read.format("geopackage").options(path=f"file://{tmp_path}/maps", **o).load()
    got = read(layer="lanes", rowsPerTask="7")
    assert got.rdd.getNumPartitions() > 60
    assert sorted((r["fid"], r["n"], r["x"], r["y"]) for r in got.collect()) == sorted((i, n, i + (n == 1), float(n == 2)) for _, layer, i, g in rows if layer == "lanes" and g for n in range(3))
    broken = spark.createDataFrame([("x", "lanes", 1, bytearray(geopackage.polygon_blob([[(0.0, 0.0)] * 4])[:-3]))], "file string, layer string, fid long, geom binary")
    geopackage.write_layers(broken, f"file://{tmp_path}/broken", "EPSG:32633")
    with pytest.raises(Exception, match="cut off"):
        spark.read.format("geopackage").options(path=f"{tmp_path}/broken", layer="lanes").load().collect()
    with pytest.raises(Exception, match="name"):
        read(layer='a"; DROP').collect()


def test_ends_of_files_alone_are_read(spark, tmp_path):
    byte_ranges.register(spark)
    with open(tmp_path / "huge.json", "wb") as file:  # 60 GB, of which the disk has 8 KB
        file.write(b"sky" * 1000)
        file.truncate(60 << 30)
        file.seek(-9, os.SEEK_END)
        file.write(b"skyskyend")
    (tmp_path / "small.json").write_bytes(b"0123456789")
    (tmp_path / "two.json").write_bytes(b"x" * 8192)
    (tmp_path / "over.json").write_bytes(b"x" * 8192 + b"y")
    (tmp_path / ".hidden").write_bytes(b"")
    got = {os.path.basename(r["path"]): r for r in spark.read.format("file_ends").options(path=str(tmp_path), chunk="4096", filesPerTask="1").load().collect()}
    assert set(got) == {"huge.json", "small.json", "two.json", "over.json"}
    assert got["huge.json"]["bytes_read"] == 8192 and got["huge.json"]["size"] == 60 << 30 and bytes(got["huge.json"]["tail"]).count(b"sky") == 2
    assert (bytes(got["small.json"]["head"]), bytes(got["small.json"]["tail"])) == (b"0123456789", b"")
    assert len(got["two.json"]["tail"]) == 0 and bytes(got["over.json"]["tail"]) == b"x" * 4095 + b"y"
    with pytest.raises(Exception, match="mounted"):
        spark.read.format("file_ends").options(path="s3://bucket/x").load().collect()


def test_numbered_lines(spark, tmp_path):
    byte_ranges.register(spark)
    texts = {"a.log": b"one\r\ntwo\n\nfour", "b.log": b"", "c.log": b"\xff bad\n" + b"n\n" * 10_000, "d.txt": b"no"}
    n = byte_ranges.write_files(spark.createDataFrame([(k, bytearray(v)) for k, v in texts.items()], "name string, content binary"), f"file://{tmp_path}/logs")
    assert n == 4 and sorted(os.listdir(tmp_path / "logs")) == sorted(texts)
    got = defaultdict(list)
    for r in spark.read.format("numbered_lines").options(path=f"{tmp_path}/logs", suffix=".log").load().orderBy("path", "line").collect():
        got[os.path.basename(r["path"])].append((r["line"], r["text"]))
    assert got["a.log"] == [(1, "one"), (2, "two"), (3, ""), (4, "four")] and set(got) == {"a.log", "c.log"}
    assert got["c.log"][0] == (1, "� bad") and got["c.log"][-1] == (10_001, "n") and len(got["c.log"]) == 10_001


def test_stages_resume(spark, tmp_path):
    ran = []

    def stage(name):
        def run(before):
            ran.append(name)
            return spark.range(3) if before is None else before.withColumn("id", F.col("id") + 1)

        return name, run

    root, stages = f"file://{tmp_path}/s", [stage(n) for n in "abc"]
    with pytest.raises(InterruptedError):
        publish.run_stages(spark, root, stages, "x", crash_before_entry="b")
    out = publish.run_stages(spark, root, stages, "x")
    assert ran == ["a", "b", "b", "c"] and sorted(r["id"] for r in out["c"].collect()) == [2, 3, 4]
    assert publish.run_stages(spark, root, stages, "x")["c"].count() == 3 and ran == ["a", "b", "b", "c"]
    with pytest.raises(ValueError, match="configuration"):
        publish.run_stages(spark, root, stages, "y")
    with pytest.raises(ValueError, match="prefix"):
        publish.run_stages(spark, root, [stage("b"), stage("a")], "x")

"""Source queries (S rows): rows of the tables are written in a format's bytes or text, and read back by the format's reader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.scalars import r6
from trackloom.plans.oracle import POSE
from trackloom.plans.registry import register
from trackloom.sources import parsers, scenes
from trackloom.sources.tables import pose_track, read

_FLOATS = "p AS (SELECT l_orderkey // 64 AS sweep, l_quantity::FLOAT AS x, (l_extendedprice / 1000)::FLOAT AS y, l_discount::FLOAT AS z FROM lineitem)"


def _sweeps(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    return li.select(F.expr("l_orderkey div 64").alias("sweep"), F.col("l_quantity").cast("float").alias("x"), (F.col("l_extendedprice") / 1000).cast("float").alias("y"), F.col("l_discount").cast("float").alias("z"))


def _as_files(points: DataFrame, encode) -> DataFrame:
    """(path, content): one file per sweep."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"path": [f"sweep/{rows['sweep'].iloc[0]}"], "content": [encode(rows[["x", "y", "z"]].to_numpy(np.float32))]})

    return points.groupBy("sweep").applyInPandas(one, "path string, content binary")


def _five(xyz: np.ndarray) -> bytes:
    return np.hstack([xyz, np.zeros((len(xyz), 2), np.float32)]).astype("<f4").tobytes()


def _pcd(xyz: np.ndarray) -> bytes:
    n = len(xyz)
    head = f"# .PCD v0.7\nVERSION 0.7\nFIELDS x y z intensity\nSIZE 4 4 4 1\nTYPE F F F U\nCOUNT 1 1 1 1\nWIDTH {n}\nHEIGHT 1\nPOINTS {n}\nDATA binary\n"
    rows = np.zeros(n, np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("intensity", "u1")]))
    rows["x"], rows["y"], rows["z"] = xyz.T
    return head.encode() + rows.tobytes()


_BY_SWEEP = f"WITH {_FLOATS} SELECT CAST(sweep AS VARCHAR) AS sweep, count(*) AS n, round(sum(x::DOUBLE), 3) AS x, round(sum(y::DOUBLE), 3) AS y, round(max(z::DOUBLE), 6) AS z FROM p GROUP BY sweep"


def _by_sweep(points: DataFrame) -> DataFrame:
    total = lambda c: F.round(F.sum(F.col(c).cast("double")), 3).alias(c)
    return points.groupBy(F.substring_index("path", "/", -1).alias("sweep")).agg(F.count(F.lit(1)).alias("n"), total("x"), total("y"), r6(F.max(F.col("z").cast("double"))).alias("z"))


@register("s4_float_points", _BY_SWEEP)
def s4(spark: SparkSession, d: str) -> DataFrame:
    return _by_sweep(parsers.float_points(_as_files(_sweeps(spark, d), _five)))


@register("s5_pcd_points", _BY_SWEEP)
def s5(spark: SparkSession, d: str) -> DataFrame:
    return _by_sweep(parsers.pcd_files(_as_files(_sweeps(spark, d), _pcd)))


@register("s6_exported_logs", f"WITH {POSE} SELECT scene, row_number() OVER (PARTITION BY scene ORDER BY t, eid) - 1 AS place, eid, round(x, 6) AS x FROM pose")
def s6(spark: SparkSession, d: str) -> DataFrame:
    """Logs exported as one JSON array per recording, in any order, read back and sorted by time."""
    texts = pose_track(spark, d).groupBy("scene").agg(F.to_json(F.collect_list(F.struct("eid", "t", "x"))).alias("raw"))
    rows = parsers.log_rows(texts, "raw", "eid long, t long, x double")
    place = F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid")) - 1
    return rows.select("scene", place.cast("long").alias("place"), "eid", r6("x").alias("x"))


@register("s9_stream_files", f"WITH {POSE} SELECT kind AS stream, count(*) AS files, min(t * 1000) AS first_ns, max(t * 1000) AS last_ns FROM pose WHERE kind <> 'error' GROUP BY kind")
def s9(spark: SparkSession, d: str) -> DataFrame:
    """Files by sensor and the nanoseconds of their stems; files with another name don't count."""
    p = pose_track(spark, d)
    stem = F.format_string("%d-%09d", F.expr("t div 1000000"), F.expr("(t % 1000000) * 1000"))
    paths = p.select(F.when(F.col("kind") == "error", F.concat(F.lit("/rec/"), "kind", F.lit("/readme"))).otherwise(F.concat(F.lit("/rec/"), "kind", F.lit("/"), stem, F.lit(".jpg"))).alias("path"))
    return parsers.stamped(paths).groupBy("stream").agg(F.count(F.lit(1)).alias("files"), F.min("t").alias("first_ns"), F.max("t").alias("last_ns"))


@register("s10_scenes_by_depth", "SELECT '/root/data' || repeat('/d' || (p_partkey % 7), CAST(p_size % 5 AS INT)) || '/s' || p_partkey AS scene FROM part WHERE p_size % 5 + 1 <= 3 AND p_type <> 'SMALL'")
def s10(spark: SparkSession, d: str) -> DataFrame:
    """Folders at most three levels down that hold the marker file."""
    p = read(spark, d, "part")
    folder = F.concat(F.lit("/root/data"), F.expr("repeat(concat('/d', p_partkey % 7), p_size % 5)"), F.lit("/s"), F.col("p_partkey").cast("string"))
    paths = p.select(F.concat(folder, F.when(F.col("p_type") == "SMALL", "/other.json").otherwise("/scene.json")).alias("path"))
    return parsers.scene_folders(paths, "/root/data", "scene.json", 3)


_CSV = "r AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type <> 'error'), n AS (SELECT *, row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 3600000000 ORDER BY ts, event_id) AS rn FROM r)"


@register("s7_telemetry_csv", f"WITH {_CSV} SELECT user_id AS recording, epoch_us(ts) * 1000 - epoch_us(ts) * 1000 % 3600000000000 AS t, event_id AS row, round(value, 6) AS value FROM n WHERE rn = 1")
def s7(spark: SparkSession, d: str) -> DataFrame:
    """CSV lines of several files of a recording: clock from seconds and nanoseconds, sorted, and of rows of one time the first."""
    e = read(spark, d, "events").filter("event_type <> 'error'")
    from trackloom.sources.tables import micros

    line = F.format_string("%d,%d,%d,%s", F.expr("us div 1000000"), F.expr("(us % 1000000) * 1000"), "event_id", F.col("value").cast("string"))
    lines = e.withColumn("us", micros(F.col("ts"))).select(F.col("user_id").alias("recording"), line.alias("line"))
    rows = parsers.telemetry(lines, "sec long, nsec long, row long, value double")
    hour = rows.withColumn("slot", F.col("t") - F.col("t") % 3_600_000_000_000)
    first = hour.withColumn("rn", F.row_number().over(Window.partitionBy("recording", "slot").orderBy("t", "row"))).filter("rn = 1")
    return first.select("recording", F.col("slot").alias("t"), "row", r6("value").alias("value"))


@register("s13_painted_masks", """WITH m AS (SELECT l_orderkey // 8 AS img, CAST(l_linenumber AS INT) AS ord, l_orderkey * 10 + l_linenumber AS id, l_partkey * 7 % 900 AS lo, 1 + l_suppkey % 40 AS n FROM lineitem),
k AS (SELECT img, ord, lo, n, row_number() OVER (PARTITION BY img ORDER BY ord, lo, n) AS place FROM m), px AS (SELECT img, lo + i AS p, max(place) AS top FROM k, range(0, 41) t(i) WHERE i < n GROUP BY ALL) SELECT img, top AS cls, count(*) AS pixels, min(p) AS first_pixel FROM px GROUP BY img, top""")
def s13(spark: SparkSession, d: str) -> DataFrame:
    """Masks as compressed run lengths, decoded and painted over one another in order: what is left to see of each."""
    li = read(spark, d, "lineitem").select(F.expr("l_orderkey div 8").alias("img"), F.col("l_linenumber").alias("ord"), F.expr("l_partkey * 7 % 900").alias("lo"), F.expr("1 + l_suppkey % 40").alias("n"))
    place = F.row_number().over(Window.partitionBy("img").orderBy("ord", "lo", "n"))
    placed = li.select("img", place.alias("place"), "lo", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, n = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            counts = parsers.rle_texts(np.stack([lo, n, 1000 - lo - n], 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), counts], names=["img", "place", "counts"])

    coded = placed.mapInArrow(run, "img long, place int, counts string")
    mask = F.struct(F.array(F.lit(50), F.lit(20)).alias("size"), F.base64(F.col("counts").cast("binary")).alias("counts"))
    seen = scenes.painted(coded.select(F.col("img").cast("string").alias("sample_data"), F.col("place").alias("order"), F.col("place").alias("cls"), mask.alias("mask")))
    pixel = F.col("col").cast("long") * 20 + F.col("row")
    return seen.groupBy(F.col("sample_data").cast("long").alias("img"), F.col("cls").cast("long").alias("cls")).agg(F.count(F.lit(1)).alias("pixels"), F.min(pixel).alias("first_pixel"))


@register("m3_temporal_slots", f"WITH {POSE} SELECT scene, eid, round(lag(x, 1) OVER w, 6) AS slot1, round(lag(x, 2) OVER w, 6) AS slot2, round(lag(x, 3) OVER w, 6) AS slot3 FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)")
def m3(spark: SparkSession, d: str) -> DataFrame:
    """The last three values beside each; a scene starts with empty slots."""
    w = Window.partitionBy("scene").orderBy("t", "eid")
    return pose_track(spark, d).select("scene", "eid", *[r6(F.lag("x", k).over(w)).alias(f"slot{k}") for k in (1, 2, 3)])

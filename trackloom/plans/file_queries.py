"""Queries over files of other formats (S rows): the tables' rows are written as such files in a work folder, and read back by a source.

Also a whole dataset built aside (K3), and a plan of stages whose log survives a crash (Q12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import projection
from trackloom.functions.scalars import r6
from trackloom.operators import metrics
from trackloom.operators.gates import violations
from trackloom.plans.oracle import POSE
from trackloom.plans.registry import register
from trackloom.plans.stream_queries import work_folder
from trackloom.sources import byte_ranges, geopackage, publish, scenes, tiles
from trackloom.sources.tables import pose_track, read

TILE = 20.0


def _track_ways(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("scene").orderBy("t", "eid"))
    return pose_track(spark, d).select(F.col("scene").alias("way"), n.alias("n"), "x", "y")


@register("s11_way_tiles", f"""WITH {POSE}, s AS (SELECT scene AS way, eid, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM pose WINDOW w AS (PARTITION BY scene ORDER BY t, eid)),
g AS (SELECT *, row_number() OVER () AS g FROM s WHERE x1 IS NOT NULL),
cut AS (SELECT g, 0.0::DOUBLE AS t FROM g UNION SELECT g, 1.0::DOUBLE FROM g
 UNION SELECT g, (k * {TILE}::DOUBLE - x0) / (x1 - x0) FROM g, range(-50, 200) r(k) WHERE x0 <> x1 AND k * {TILE}::DOUBLE > least(x0, x1) AND k * {TILE}::DOUBLE < greatest(x0, x1)
 UNION SELECT g, (k * {TILE}::DOUBLE - y0) / (y1 - y0) FROM g, range(-50, 200) r(k) WHERE y0 <> y1 AND k * {TILE}::DOUBLE > least(y0, y1) AND k * {TILE}::DOUBLE < greatest(y0, y1)),
p AS (SELECT g, t, lead(t) OVER (PARTITION BY g ORDER BY t) AS u FROM cut),
m AS (SELECT way, CAST(floor((x0 + (t + u) / 2 * (x1 - x0)) / {TILE}) AS BIGINT) AS tile_x, CAST(floor((y0 + (t + u) / 2 * (y1 - y0)) / {TILE}) AS BIGINT) AS tile_y, (u - t) * sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS length FROM p JOIN g USING (g) WHERE u IS NOT NULL)
SELECT tile_x, tile_y, way, round(sum(length), 5) AS length FROM m GROUP BY ALL HAVING round(sum(length), 5) > 0""")
def s11(spark: SparkSession, d: str) -> DataFrame:
    """How much of each track lies in each tile, from a table of its runs by tile."""
    folder = work_folder(spark)
    tiles.write_tiles(tiles.tile_runs(tiles.clipped(tiles.segments(_track_ways(spark, d)), TILE)), folder)
    runs = spark.read.schema("way long, run int, points array<struct<x: double, y: double>>, length double, tile_x long, tile_y long").parquet(folder)
    return runs.groupBy("tile_x", "tile_y", "way").agg(F.round(F.sum("length"), 5).alias("length")).filter("length > 0")


#: Row numbers of a GeoPackage, which has a fifth of them: files and tasks grow in number with the table and not in size.
BLOCK = 250_000

_LON, _LAT = "(13 + p_partkey % 97 * 0.001 + p_size * 0.00001)", "(52 + p_partkey % 89 * 0.001)"
_UTM_CONSTANTS = f"SELECT {2 * projection._N**0.5 / (1 + projection._N)!r}::DOUBLE AS e, {projection.SCALE * projection.RADIUS!r}::DOUBLE AS k, " + ", ".join(f"{a!r}::DOUBLE AS a{i}" for i, a in enumerate(projection.ALPHA, 1))
_SERIES = {f: " + ".join(["{0}"] + [f"a{i} * " + ("cos" if f == "e" else "sin") + f"({2 * i} * xi) * " + ("sinh" if f == "e" else "cosh") + f"({2 * i} * eta)" for i in range(1, 5)]) for f in "en"}


@register("s12_geopackage", f"""WITH c AS ({_UTM_CONSTANTS}), q AS (SELECT p_partkey AS fid, CASE WHEN p_size % 2 = 0 THEN 'lanes' ELSE 'crosswalks' END AS layer, unnest(range(0, 5)) AS n, {_LON}::DOUBLE AS lon, {_LAT}::DOUBLE AS lat, p_size FROM part WHERE p_size % 7 <> 0),
v AS (SELECT fid, layer, n, radians(lon + CASE WHEN n % 4 IN (1, 2) THEN p_size * 0.00002::DOUBLE ELSE 0 END - 15) AS away, radians(lat + CASE WHEN n % 4 IN (2, 3) THEN p_size * 0.00001::DOUBLE ELSE 0 END) AS phi FROM q),
t AS (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM v, c), x AS (SELECT *, atan2(t, cos(away)) AS xi, atanh(sin(away) / sqrt(1 + t * t)) AS eta FROM t),
m AS (SELECT fid, layer, n, 500000 + k * ({_SERIES["e"].format("eta")}) AS x, k * ({_SERIES["n"].format("xi")}) AS y FROM x),
o AS (SELECT *, min(x) OVER (PARTITION BY fid) AS x0, min(y) OVER (PARTITION BY fid) AS y0 FROM m), s AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM o WINDOW w AS (PARTITION BY fid ORDER BY n))
SELECT layer, fid, count(*) AS points, round(min(x), 3) AS x, round(min(y), 3) AS y, round(sum((x - x0) * (y1 - y0) - (x1 - x0) * (y - y0)) / 2, 2) AS area FROM s GROUP BY layer, fid""")
def s12(spark: SparkSession, d: str) -> DataFrame:
    """Quadrilaterals in two layers of several GeoPackages, read back and laid out in UTM metres: their place and area. Rows without a geometry drop out."""
    folder = work_folder(spark)
    geopackage.register(spark)
    p = read(spark, d, "part").selectExpr("p_partkey as fid", "if(p_size % 2 = 0, 'lanes', 'crosswalks') as layer", f"cast({_LON} as double) as lon", f"cast({_LAT} as double) as lat", "p_size", f"concat('city', p_partkey % 5, '-', p_partkey div {BLOCK}) as file")

    def encode(batches):
        import pyarrow as pa

        for b in batches:
            rows = b.to_pylist()
            ring = lambda r: [(r["lon"] + dx * r["p_size"] * 0.00002, r["lat"] + dy * r["p_size"] * 0.00001) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]
            blobs = [None if r["p_size"] % 7 == 0 else geopackage.polygon_blob([ring(r)]) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("layer"), b.column("fid"), pa.array(blobs, pa.binary())], names=["file", "layer", "fid", "geom"])

    geopackage.write_layers(p.mapInArrow(encode, "file string, layer string, fid long, geom binary"), folder, "EPSG:32633")
    layer = lambda name: spark.read.format("geopackage").options(path=folder, layer=name, rowsPerTask=str(BLOCK)).load().withColumn("layer", F.lit(name))
    points = layer("lanes").unionByName(layer("crosswalks"))
    x, y = projection.utm(F.col("y"), F.col("x"), 33)
    m = points.select("layer", "fid", "n", x.alias("x"), y.alias("y"))
    whole = Window.partitionBy("layer", "fid")
    s = m.withColumn("x0", F.min("x").over(whole)).withColumn("y0", F.min("y").over(whole)).withColumn("x1", F.lead("x").over(whole.orderBy("n"))).withColumn("y1", F.lead("y").over(whole.orderBy("n")))
    return s.groupBy("layer", "fid").agg(F.count(F.lit(1)).alias("points"), F.round(F.min("x"), 3).alias("x"), F.round(F.min("y"), 3).alias("y"), F.round(F.sum(F.expr("(x - x0) * (y1 - y0) - (x1 - x0) * (y - y0)")) / 2, 2).alias("area"))


CHUNK, TOKEN = 400, "click"


def _user_files(spark: SparkSession, d: str, line: str, folder: str) -> None:
    """A text file for each user of the events, a line an event."""
    e = read(spark, d, "events").select("user_id", "event_id", F.expr(line).alias("line"))
    texts = e.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "line"))), lambda s: s["line"]), "\n").alias("text"))
    byte_ranges.write_files(texts.select(F.concat(F.lit("user-"), "user_id", F.lit(".log")).alias("name"), F.concat("text", F.lit("\n")).cast("binary").alias("content")), folder)
    byte_ranges.register(spark)


def _user(path: str = "path"):
    return F.regexp_extract(path, r"user-(\d+)\.log$", 1).cast("long").alias("user_id")


def _count_sql(part: str) -> str:
    return f"(length({part}) - length(replace({part}, '{TOKEN}', ''))) // {len(TOKEN)}"


@register("s14_file_ends", f"""WITH f AS (SELECT user_id, string_agg(event_id || ' ' || event_type, chr(10) ORDER BY event_id) || chr(10) AS body FROM events GROUP BY user_id),
h AS (SELECT user_id, length(body) AS size, substr(body, 1, {CHUNK}) AS head, CASE WHEN length(body) > {2 * CHUNK} THEN substr(body, length(body) - {CHUNK - 1}, {CHUNK}) ELSE '' END AS tail FROM f)
SELECT user_id, size, length(head) + length(tail) AS bytes_read, CAST({_count_sql("head")} + {_count_sql("tail")} AS BIGINT) AS found FROM h""")
def s14_ends(spark: SparkSession, d: str) -> DataFrame:
    """How often a word stands in the first and last bytes of each file; what lies between is not read."""
    folder = work_folder(spark)
    _user_files(spark, d, "concat(event_id, ' ', event_type)", folder)
    ends = spark.read.format("file_ends").options(path=folder, chunk=str(CHUNK), suffix=".log").load()
    found = lambda c: F.regexp_count(F.decode(c, "UTF-8"), F.lit(TOKEN))
    return ends.select(_user(), "size", "bytes_read", (found("head") + found("tail")).cast("long").alias("found"))


@register("s16_last_metric_per_file", """SELECT user_id, arg_max(round(value, 4), event_id) AS last, CAST(max(place) AS BIGINT) AS line FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events) WHERE event_type = 'purchase' GROUP BY user_id""")
def s16_metric(spark: SparkSession, d: str) -> DataFrame:
    """The last metric that each log file tells, and in which line."""
    folder = work_folder(spark)
    _user_files(spark, d, "case when event_type = 'purchase' then concat('step ', event_id, ' miou=', cast(round(value, 4) as string)) else concat('step ', event_id, ' ', event_type) end", folder)
    lines = spark.read.format("numbered_lines").options(path=folder, suffix=".log").load()
    value = F.regexp_extract("text", r"miou=(-?[0-9.]+)", 1)
    return lines.filter(F.col("text").contains("miou=")).groupBy(_user()).agg(F.max_by(value.cast("double"), "line").alias("last"), F.max("line").alias("line"))


#: Rows of all scenes' arrays of JSON that go by one hash, about: a scene has as many arrays as it needs, so none grows with the table.
ARRAY = 20_000


def _annotation_tables(spark: SparkSession, d: str, names: list[str]) -> dict[str, DataFrame]:
    """Customers are scenes, their orders samples in a chain, and line items their sensors' data: written as lines of arrays of JSON, one folder a scene."""
    folder = work_folder(spark)
    orders, items = read(spark, d, "orders"), read(spark, d, "lineitem")
    scene = F.concat(F.lit("s"), (F.col("o_custkey") % 16).cast("string"))
    w = Window.partitionBy("scene").orderBy("o_orderdate", "o_orderkey")
    key = lambda c: F.when(c.isNull(), "").otherwise(c.cast("string"))
    o = orders.select(scene.alias("scene"), "o_orderkey", "o_orderdate", "o_totalprice")
    samples = o.select("scene", F.struct(F.col("o_orderkey").cast("string").alias("token"), key(F.lag("o_orderkey").over(w)).alias("prev"), key(F.lead("o_orderkey").over(w)).alias("next"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("timestamp")).alias("row"))
    poses = o.filter("o_orderkey % 11 <> 0").select("scene", F.expr("struct(cast(o_orderkey as string) as token, 0L as timestamp, array(o_totalprice, 0D, 0D) as translation, array(1D, 0D, 0D, 0D) as rotation)").alias("row"))
    data = items.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("scene", F.expr("struct(concat(l_orderkey, '-', l_linenumber) as token, cast(l_orderkey as string) as sample_token, concat('f', l_linenumber) as filename, true as is_key_frame, concat('c', l_linenumber % 4) as calibrated_sensor_token, cast(l_orderkey as string) as ego_pose_token, 0L as timestamp, 1 as width, 1 as height)").alias("row"))
    each = o.select("scene").distinct()
    sensors = each.select("scene", F.explode(F.expr("transform(sequence(0, 2), k -> struct(concat('k', k) as token, concat('CAM_', k) as channel, 'camera' as modality))")).alias("row"))
    calibrated = each.select("scene", F.explode(F.expr("transform(sequence(0, 3), k -> struct(concat('c', k) as token, concat('k', k) as sensor_token, array(cast(k as double)) as translation, array(1D) as rotation, array(array(1D)) as camera_intrinsic))")).alias("row"))
    made = {"sample": samples, "ego_pose": poses, "sample_data": data, "sensor": sensors, "calibrated_sensor": calibrated}
    part = F.pmod(F.xxhash64("row.token"), F.lit(1 + items.count() // ARRAY))
    for name in names:
        texts = made[name].groupBy("scene", part).agg(F.to_json(F.collect_list("row")).alias("text"))
        texts.select("text", "scene").write.partitionBy("scene").text(f"{folder}/{name}")
    return {name: scenes.json_folders(spark, f"{folder}/{name}", name) for name in names}


LINKED = ["sample_data", "calibrated_sensor", "sensor", "ego_pose"]
_SCENES = """o AS (SELECT 's' || (o_custkey % 16) AS scene, o_orderkey, o_orderdate, o_totalprice FROM orders)"""


@register("s1_scene_frames", f"""WITH {_SCENES} SELECT scene, CASE WHEN l_linenumber % 4 < 3 THEN 'CAM_' || (l_linenumber % 4) END AS channel, count(*) AS frames, count(*) FILTER (o_orderkey % 11 <> 0) AS posed, round(sum(CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END), 2) AS x FROM o JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def s1(spark: SparkSession, d: str) -> DataFrame:
    """Frames of every scene with their sensor's channel and the vehicle's pose, by their tokens; broken links leave nulls."""
    f = scenes.frames(_annotation_tables(spark, d, LINKED))
    return f.groupBy("scene", "channel").agg(F.count(F.lit(1)).alias("frames"), F.count("ego_at").alias("posed"), F.round(F.sum(F.col("ego_at")[0]), 2).alias("x"))


@register("s2_ordered_samples", f"""WITH {_SCENES} SELECT scene, o_orderkey::VARCHAR AS token, row_number() OVER (PARTITION BY scene ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM o""")
def s2(spark: SparkSession, d: str) -> DataFrame:
    """The samples of every scene in order, where the chain of their tokens agrees with the clock."""
    samples = scenes.ordered_samples(_annotation_tables(spark, d, ["sample"])["sample"].withColumn("token", F.lpad("token", 20, "0")).withColumn("prev", F.when(F.col("prev") == "", "").otherwise(F.lpad("prev", 20, "0"))))
    return samples.filter("linked").select("scene", F.col("token").cast("long").cast("string").alias("token"), F.col("place").cast("long").alias("place"))


@register("s3_runtime_frames", f"""WITH {_SCENES}, p AS (SELECT scene, o_orderkey, row_number() OVER (PARTITION BY scene ORDER BY o_orderdate, o_orderkey) - 1 AS place, o_totalprice FROM o)
SELECT scene, place, l_linenumber % 4 AS camera, count(*) AS files, round(CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END, 2) AS x FROM p JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber % 4 < 3 GROUP BY ALL""")
def s3(spark: SparkSession, d: str) -> DataFrame:
    """What a running vehicle would be given, sample by sample: each camera's files with its mounting, and the pose where it is known."""
    made = _annotation_tables(spark, d, ["sample", *LINKED])
    order = Window.partitionBy("scene").orderBy("timestamp", F.col("token").cast("long"))
    samples = made["sample"].select("scene", F.col("token").alias("sample"), (F.row_number().over(order) - 1).cast("long").alias("place"))
    given = scenes.frames(made).filter("channel is not null").join(samples, ["scene", "sample"])
    return given.groupBy("scene", "place", F.col("sensor_at")[0].cast("int").alias("camera"), F.round(F.col("ego_at")[0], 2).alias("x")).agg(F.count(F.lit(1)).alias("files"))


@register("k3_whole_dataset", "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def k3(spark: SparkSession, d: str) -> DataFrame:
    """A whole dataset by partitions, built aside over one that is in force, checked against its source, and put in its place at once."""
    root, orders = work_folder(spark), read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")

    def whole(written: DataFrame) -> DataFrame:
        both = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).join(written.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("m")), "o_orderpriority", "full")
        return violations({"rows": both.filter("not n <=> m")})

    publish.publish(orders.limit(0), root, 1)
    try:
        publish.publish(orders.filter("o_orderkey % 2 = 0"), root, 2, whole, ["o_orderpriority"])
    except ValueError:
        assert publish.current(spark, root).isEmpty()  # half a dataset doesn't come into force
    publish.publish(orders, root, 3, whole, ["o_orderpriority"])
    return publish.current(spark, root).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("q12_resumed_stages", "SELECT 'read' AS stage, 1 AS runs, count(*) AS rows FROM orders UNION ALL SELECT 'keep', 1, count(*) FROM orders WHERE o_totalprice > 1000 UNION ALL SELECT 'total', 2, count(DISTINCT o_custkey) FROM orders WHERE o_totalprice > 1000")
def q12(spark: SparkSession, d: str) -> DataFrame:
    """Three stages of which the last crashes between its output and its entry in the log. The second run does only that one again."""
    root, runs = work_folder(spark), {"read": 0, "keep": 0, "total": 0}
    plan = {
        "read": lambda _: read(spark, d, "orders"),
        "keep": lambda before: before.filter("o_totalprice > 1000"),
        "total": lambda before: before.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")),
    }

    def counted(name):
        def run(before):
            runs[name] += 1
            return plan[name](before)

        return run

    stages = [(name, counted(name)) for name in plan]
    try:
        publish.run_stages(spark, root, stages, "config 1", crash_before_entry="total")
    except InterruptedError:
        pass
    done = publish.run_stages(spark, root, stages, "config 1")
    rows = [(name, runs[name]) for name in plan]
    counts = [done[name].agg(F.lit(name).alias("stage"), F.lit(n).alias("runs"), F.count(F.lit(1)).alias("rows")) for name, n in rows]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


EVERY, BATCH = 3, 40


@register("m5_ingest_cadence", f"""WITH done AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id), w AS (SELECT d.doc_id, CASE WHEN done.doc_id IS NULL THEN 'new' ELSE 'repair' END AS work FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN done USING (doc_id) WHERE done.doc_id IS NULL OR coalesce(q, 0) = 0)
SELECT doc_id, work, CAST({EVERY} * (1 + (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH}) AS BIGINT) AS epoch FROM w""")
def m5_cadence(spark: SparkSession, d: str) -> DataFrame:
    """What is new, and what was taken in but has to be done again, in order, a batch in every third epoch."""
    done = read(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.lit(True).alias("done"))
    work = read(spark, d, "documents").select("doc_id").distinct().join(done, "doc_id", "left").filter("done is null or coalesce(q, 0) = 0")
    work = work.select("doc_id", F.when(F.col("done").isNull(), "new").otherwise("repair").alias("work"), F.lit(1).alias("one"))
    placed = metrics.cumulated(work, "doc_id", {"place": "one"})  # by ranges: no task holds all work
    return placed.select("doc_id", "work", (EVERY * (1 + F.floor((F.col("place") - 1) / BATCH))).cast("long").alias("epoch"))


@register("q25_installed_results", "WITH n AS (SELECT o_custkey % 40 AS scene, o_orderpriority AS cls, count(*) AS n FROM orders GROUP BY ALL), c AS (SELECT o_custkey % 40 AS scene, count(*) FILTER (o_orderstatus <> 'P') / count(*) AS covered FROM orders GROUP BY 1) SELECT scene, count(DISTINCT cls) AS classes, CAST(sum(n) AS BIGINT) AS rows, round(any_value(covered), 6) AS coverage, true AS unchanged FROM n JOIN c USING (scene) GROUP BY scene")
def q25_installed(spark: SparkSession, d: str) -> DataFrame:
    """Results of every scene installed as a version of their own beside the originals: of known classes alone, one for each original row, with
    their coverage, and whether the originals are what they were. A version with an unknown class does not come into force."""
    folder = work_folder(spark)
    orders = read(spark, d, "orders").select((F.col("o_custkey") % 40).alias("scene"), "o_orderkey", "o_orderpriority", "o_orderstatus")
    print_ = lambda df, name: df.groupBy("scene").agg(F.sum(F.xxhash64("o_orderkey", "o_orderpriority", "o_orderstatus").cast("decimal(38,0)")).alias(name), F.count(F.lit(1)).alias(f"{name}_n"))
    publish.publish(orders, f"{folder}/originals", 1, partition=["scene"])
    before = publish.written(print_(publish.current(spark, f"{folder}/originals"), "before"), folder, "before")
    known = orders.select("o_orderpriority").distinct()  # a handful
    results = orders.select("scene", "o_orderkey", F.col("o_orderpriority").alias("cls"), (F.col("o_orderstatus") != "P").alias("seen"))

    def faults(written: DataFrame) -> DataFrame:
        strange = written.join(F.broadcast(known), F.col("cls") == F.col("o_orderpriority"), "left_anti")
        rows = written.groupBy("scene").agg(F.count(F.lit(1)).alias("n")).join(before, "scene", "full")
        return violations({"class": strange, "rows": rows.filter("not n <=> before_n")})

    publish.publish(results, f"{folder}/results", 1, faults, ["scene"])
    try:
        publish.publish(results.withColumn("cls", F.lit("unknown")), f"{folder}/results", 2, faults, ["scene"])
    except ValueError:
        assert publish.current_version(spark, f"{folder}/results") == 1
    told = publish.current(spark, f"{folder}/results").groupBy("scene").agg(F.count_distinct("cls").alias("classes"), F.count(F.lit(1)).alias("rows"), r6(F.avg(F.col("seen").cast("double"))).alias("coverage"))
    after = print_(publish.current(spark, f"{folder}/originals"), "after")
    same = before.join(after, "scene", "full").select("scene", F.expr("before <=> after and before_n <=> after_n").alias("unchanged"))
    return told.join(same, "scene").select(F.col("scene").cast("long").alias("scene"), "classes", "rows", "coverage", "unchanged")

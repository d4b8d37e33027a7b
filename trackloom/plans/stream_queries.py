"""Streaming queries (M rows): whole tables arrive as files, a bounded number per micro-batch, and the sink's rows are read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.scalars import r6
from trackloom.plans.registry import register
from trackloom.sources.tables import read
from trackloom.streaming import accumulate


def work_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; under a temp folder only where none is set and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="trackloom-")
    return f"{base.rstrip('/')}/trackloom-stream-{uuid.uuid4().hex}"


#: Rows of a file, about: files grow in number with the table and not in size.
FILE = 500_000


def arrived(waves: list[DataFrame], folder: str, files: int, by: Column | str = "scene") -> str:
    """Write the rows wave by wave, each scene's in one file of its wave; at least so many files, and as many as the rows need."""
    for wave in waves:
        wave.repartition(max(files, 1 + wave.count() // FILE), by).write.mode("append").parquet(f"{folder}/in")
    return f"{folder}/in"


def at_once(spark: SparkSession) -> int:
    """Files per trigger: two for each core, and no more than that ahead of the work."""
    return 2 * spark.sparkContext.defaultParallelism


def drained(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all files that are there, and read what it wrote."""
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


@register("m1_frame_pipeline", "SELECT l_orderkey // 64 AS scene, l_orderkey AS frame, l_linenumber AS channel, round(sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice / 1e6), 6) AS reach FROM lineitem WHERE l_quantity > 2")
def m1(spark: SparkSession, d: str) -> DataFrame:
    """Frames read ahead of the work on them: files per trigger are the bound, and the end of the files is the end of the run."""
    rows = read(spark, d, "lineitem").select(F.expr("l_orderkey div 64").alias("scene"), F.col("l_orderkey").alias("frame"), F.col("l_linenumber").alias("channel"), "l_quantity", "l_extendedprice")
    folder = work_folder(spark)
    frames = accumulate.frame_stream(spark, arrived([rows], folder, 4), rows.schema, at_once(spark))
    reach = F.sqrt(F.expr("l_quantity * l_quantity + l_extendedprice * l_extendedprice / 1e6"))
    return drained(frames.filter("l_quantity > 2").select("scene", "frame", "channel", r6(reach).alias("reach")), folder)


_STEPS = """li AS (SELECT l_orderkey // 32 AS scene, l_orderkey % 32 AS t, l_partkey % 16 AS r, l_suppkey % 16 AS c, (l_discount - 0.03::DOUBLE) * pi() AS v FROM lineitem),
f AS (SELECT DISTINCT scene, t, CASE WHEN t <> 7 THEN 2 * t + CASE WHEN t >= 20 THEN 30 ELSE 0 END END AS x, CASE WHEN t <> 7 THEN t // 4 END AS y FROM li),
g AS (SELECT *, row_number() OVER w AS k, lag(x) OVER w AS px, lag(y) OVER w AS py FROM f WINDOW w AS (PARTITION BY scene ORDER BY t)),
s AS (SELECT *, px IS NULL OR x IS NULL OR sqrt((x - px) ** 2 + (y - py) ** 2) >= 10 AS reset FROM g),
q AS (SELECT *, sum(CASE WHEN reset THEN 1 ELSE 0 END) OVER (PARTITION BY scene ORDER BY t) AS seg FROM s),
m AS (SELECT n.scene, n.t, n.reset, li.r - coalesce(n.x - p.x, 0) AS r, li.c - coalesce(n.y - p.y, 0) AS c, li.v * power(0.7::DOUBLE, n.k - p.k) AS v FROM q n JOIN q p ON p.scene = n.scene AND p.seg = n.seg AND p.k <= n.k JOIN li ON li.scene = p.scene AND li.t = p.t),
e AS (SELECT scene, t, reset, r, c, sum(v) AS v FROM m WHERE r >= 0 AND c >= 0 GROUP BY ALL)"""


@register("m2_decayed_evidence", f"WITH {_STEPS} SELECT scene, t, reset, count(*) FILTER (abs(v) > 1e-9) AS cells, round(sum(v), 9) + 0.0::DOUBLE AS total FROM e GROUP BY ALL")
def m2(spark: SparkSession, d: str) -> DataFrame:
    """Evidence decays by 0.7 a frame and moves with the ego; a missing pose or a far step starts anew. Frames come in two waves, so the
    state lives on between micro-batches."""
    li = read(spark, d, "lineitem").withColumn("t", F.col("l_orderkey") % 32)
    pose = lambda e: F.when(F.col("t") != 7, F.expr(e).cast("double"))
    rows = li.select(
        F.expr("l_orderkey div 32").alias("scene"), "t", pose("2 * t + if(t >= 20, 30, 0)").alias("x"), pose("t div 4").alias("y"), pose("0").alias("yaw"),
        (F.col("l_partkey") % 16).cast("int").alias("r"), (F.col("l_suppkey") % 16).cast("int").alias("c"), ((F.col("l_discount") - 0.03) * F.pi()).alias("v"),
    )
    folder = work_folder(spark)
    source = arrived([rows.filter("t < 16"), rows.filter("t >= 16")], folder, 2, accumulate.block())
    out = drained(accumulate.accumulate_stream(accumulate.frame_stream(spark, source, rows.schema, at_once(spark))), folder)
    return out.select("scene", "t", "reset", F.col("cells").cast("long").alias("cells"), (F.col("total") + 0.0).alias("total"))

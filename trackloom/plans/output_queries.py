"""Output queries (K rows): what is written in a work folder is read back from there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.scalars import first_reason
from trackloom.operators import gates as G
from trackloom.plans.registry import register
from trackloom.plans.stream_queries import work_folder
from trackloom.sources import publish
from trackloom.sources.tables import read

_TOTALS = "SELECT o_custkey AS scene, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders"


def _totals(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").groupBy(F.col("o_custkey").alias("scene")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("k1_scene_tables", "SELECT source AS scene, count(*) AS rows, string_agg(doc_id::VARCHAR, chr(10) ORDER BY doc_id) AS listed FROM documents GROUP BY source")
def k1(spark: SparkSession, d: str) -> DataFrame:
    """A table by scene and text lists of each scene's rows, one line a row, read back together: a scene's whole list is one text of the result."""
    folder = work_folder(spark)
    read(spark, d, "documents").select("doc_id", F.col("source").alias("scene")).write.partitionBy("scene").parquet(f"{folder}/rows")
    rows = spark.read.schema("doc_id long, scene string").parquet(f"{folder}/rows")
    rows.select(F.col("doc_id").cast("string").alias("value"), "scene").write.partitionBy("scene").text(f"{folder}/lists")
    lines = spark.read.schema("value string, scene string").text(f"{folder}/lists").select("scene", F.col("value").cast("long").alias("i"))
    listed = lines.groupBy("scene").agg(F.array_join(F.sort_array(F.collect_list("i")).cast("array<string>"), "\n").alias("listed"))
    return rows.groupBy("scene").agg(F.count(F.lit(1)).alias("rows")).join(listed, "scene")


@register("k2_published_version", f"SELECT * FROM ({_TOTALS} GROUP BY o_custkey) WHERE n >= 5")
def k2(spark: SparkSession, d: str) -> DataFrame:
    """Three versions, of which the last fails its check and the second stays in force."""
    root, totals = work_folder(spark), _totals(spark, d)
    few = lambda df: G.violations({"few": df.filter("n < 5")})
    publish.publish(totals, root, 1)
    publish.publish(totals.filter("n >= 5"), root, 2, few)
    try:
        publish.publish(totals.withColumn("n", F.lit(0).cast("long")), root, 3, few)
    except ValueError:
        return publish.current(spark, root)
    raise AssertionError("a version that fails its check was published")


@register("k4_reused_rows", "SELECT coalesce(a.half, 'new') AS source, count(*) AS n FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || '!' ELSE text END AS text FROM documents) d LEFT JOIN (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS half FROM documents WHERE n_chars > 200) a ON a.doc_id = d.doc_id AND a.text = d.text GROUP BY 1")
def k4(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a new version that an old one has unchanged are named by where they lie; contents are compared by hash."""
    docs = read(spark, d, "documents").select("doc_id", "text", "n_chars")
    old = docs.filter("n_chars > 200").select("doc_id", F.sha2("text", 256).alias("hash"), F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("half"))
    new = docs.select("doc_id", F.sha2(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("hash"))
    return publish.reused(old, new, "doc_id", "hash", "half").groupBy(F.coalesce("from", F.lit("new")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


@register("k5_catalog_and_quarantine", "SELECT CASE WHEN n_chars < 100 THEN 'short' WHEN lang NOT IN ('en', 'de') THEN 'language' ELSE 'accepted' END AS part, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY 1")
def k5(spark: SparkSession, d: str) -> DataFrame:
    """Accepted rows to one table, all others to another by reason; both read back."""
    folder = work_folder(spark)
    reason = first_reason(("short", F.col("n_chars") < 100), ("language", ~F.col("lang").isin("en", "de")))
    publish.split_write(read(spark, d, "documents").select("doc_id", "n_chars", reason.alias("reason")), "reason", f"{folder}/accepted", f"{folder}/quarantine")
    accepted = spark.read.schema("doc_id long, n_chars long").parquet(f"{folder}/accepted").withColumn("reason", F.lit("accepted"))
    both = accepted.unionByName(spark.read.schema("doc_id long, n_chars long, reason string").parquet(f"{folder}/quarantine"))
    return both.groupBy(F.col("reason").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))

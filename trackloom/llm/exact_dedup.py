"""Exact dedup by skew-safe combining, in DataFrame operations alone.

1. Each task merges its own equal texts (map-side half of the first aggregation).
2. Salted groups (digest, salt, whole text) merge what the tasks kept, so that no task gets a hot text from everywhere.
3. The salts' winners, at most `salts` rows of a text, merge per (digest, whole text).
Every stage groups by the whole text beside the digest, so texts that share a digest stay apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import docs_column, materialize, text_of, unused, without

#: A group is hot if it holds this share of all rows or more; there are at most 1 / HOT_SHARE such groups, which bounds their broadcast.
HOT_SHARE = 1 / 1000


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(docs: DataFrame, salts: int = 16, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per digest: digest, keep_id, group_size, n_texts (over 1 only where different texts share the digest)."""
    rows = docs.select(F.col("doc_id").alias("i"), text_of().alias("t")).select("i", "t", digest(F.col("t")).alias("digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "salt", "t").agg(F.max("i").alias("i"), F.count(F.lit(1)).alias("n"))
    whole = salted.repartition(F.col("digest")).groupBy("digest", "t").agg(F.max("i").alias("i"), F.sum("n").alias("n"))
    return whole.groupBy("digest").agg(F.max("i").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("n_texts"))


def exact_dedup(docs: DataFrame, salts: int = 16, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs(doc_id, text, ...).

    Null texts equal empty ones. The largest doc_id of equal texts stays; null ids lose to all others, and a group of
    null ids alone has a null keep_id and keeps none. Rows that repeat a doc_id and text share their decision. Other
    columns of docs are not read. An empty table gives an empty result.
    """
    won = materialize(winners(docs, salts, digest), "exact-winners")
    total, shared = won.agg(F.sum("group_size"), F.max("n_texts")).first()
    rows = docs.select("doc_id", text_of().alias("t")).select("doc_id", digest(F.col("t")).alias("digest"), sha256_hex(F.col("t")).alias("text_sha256"))
    single = won.filter("n_texts = 1").select("digest", "keep_id", "group_size")
    limit = max(64, int((total or 0) * HOT_SHARE))
    hot = single.filter(F.col("group_size") >= limit).select(F.col("digest").alias("hot_digest"), F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    cold = single.filter(F.col("group_size") < limit).select(F.col("digest").alias("cold_digest"), "keep_id", "group_size")
    seen = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
    #: Rows of hot groups are done; a key of their own spreads them over the tasks of the second join.
    seen = seen.withColumn("key", F.when(F.col("hot_size").isNull(), F.col("digest")).otherwise(F.concat(F.lit("~"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    seen = seen.join(cold, F.col("key") == F.col("cold_digest"), "left")
    out = seen.select("doc_id", F.coalesce("hot_id", "keep_id").alias("keep_id"), F.coalesce("hot_size", "group_size").alias("group_size"), "text_sha256")
    if (shared or 0) > 1:
        out = out.filter("group_size is not null").unionByName(_collided(docs, won.filter("n_texts > 1").select("digest"), digest))
    return out.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256")


def _collided(docs: DataFrame, shared: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The rows whose digest several texts share: these few are settled by their whole texts."""
    rows = docs.select("doc_id", text_of().alias("t")).withColumn("digest", digest(F.col("t"))).join(shared, "digest", "left_semi")
    groups = rows.groupBy("t").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, "t").select("doc_id", "keep_id", "group_size", sha256_hex(F.col("t")).alias("text_sha256"))


def keep_largest(docs: DataFrame, salts: int = 16) -> DataFrame:
    """docs without the rows that a row of equal text and larger doc_id replaces, and without those that have no doc_id; same columns.

    A doc_id whose rows differ in text stays if any of its rows does; rows that repeat one stay or go together. Null texts equal empty ones; long
    texts are compared whole; other columns, whatever they are called, come along. An empty table gives an empty result.
    """
    lost = exact_dedup(docs, salts).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept")
    return without(docs.filter("doc_id is not null"), lost)


def keep_each_text(docs: DataFrame, salts: int = 16) -> DataFrame:
    """keep_largest, and of the texts that only rows without a doc_id have, one row per equal text; same columns, whatever they are called.

    Such rows of equal text may differ in other columns: any one of them stays. Null texts equal empty ones; long texts are compared whole. An
    empty table gives an empty result.
    """
    kept, nameless = keep_largest(docs, salts), docs.filter("doc_id is null")
    if nameless.isEmpty():
        return kept
    text, key = unused("__text", docs), unused("__alone", docs)
    alone = exact_dedup(docs, salts).filter("doc_id is null and keep_id is null").select(F.col("text_sha256").alias(key)).distinct()
    one = nameless.withColumn(text, text_of()).dropDuplicates([text])
    return kept.unionByName(one.join(alone, sha256_hex(F.col(text)) == F.col(key), "left_semi").select(*[docs_column(c) for c in docs.columns]))

"""Readers for the tables that queries run on, in the roles that the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(ts: Column) -> Column:
    """Microseconds since 1970, as LONG, whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def pose_track(spark: SparkSession, folder: str) -> DataFrame:
    """scene, eid, t (µs), x, y, kind: one pose per event; a user is a scene."""
    e = read(spark, folder, "events")
    return e.select(F.col("user_id").alias("scene"), F.col("event_id").alias("eid"), micros(F.col("ts")).alias("t"), F.col("value").alias("x"), ((F.col("event_id") * 7919 % 1000).cast("double") / 10).alias("y"), F.col("event_type").alias("kind"))


def points(spark: SparkSession, folder: str) -> DataFrame:
    """frame, x, y, z, cls: one labelled point per line item."""
    li = read(spark, folder, "lineitem")
    return li.select(F.pmod("l_orderkey", F.lit(50)).alias("frame"), (F.col("l_quantity") - 25).alias("x"), (F.col("l_extendedprice") / 1000 - 50).alias("y"), (F.col("l_discount") * 20 + F.col("l_tax")).alias("z"), F.concat("l_returnflag", "l_linestatus").alias("cls"))


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    """frame, box, x, y, w, l, score, cls: one box per line item, an order being a frame."""
    li = read(spark, folder, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("frame"),
        (F.col("l_partkey") * 100 + F.col("l_linenumber") * 10 + F.pmod("l_suppkey", F.lit(10))).alias("box"),
        (F.pmod("l_partkey", F.lit(80)) - 40).cast("double").alias("x"),
        (F.pmod("l_suppkey", F.lit(50)) - 25).cast("double").alias("y"),
        (F.col("l_quantity") / 10).alias("w"),
        (F.col("l_extendedprice") / 10000).alias("l"),
        (F.col("l_discount") * 10).alias("score"),
        F.col("l_returnflag").alias("cls"),
    )

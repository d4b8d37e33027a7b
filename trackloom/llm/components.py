"""Connected components of an edge table, by alternating large-star and small-star steps; all state stays distributed.

Every step joins edges with the smallest neighbour of an end; those of an end with very many are dealt to several tasks (join_skewed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import Tables, drop_table, join_skewed, materialize

def components(edges: DataFrame, tables: Tables | None = None, most_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of edges(a, b); the component is its smallest node.

    A large step hangs each node's larger neighbours on its smallest one, a small step its smaller ones; the number of
    steps grows with the logarithm of the longest chain. Self-loops and nulls are left out. The table that the result reads
    goes with `tables`, or stays in the shared folder.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before, n = None, now.count()
    for _ in range(most_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_skewed(both.filter("v > u"), least, ["u"], n).select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_skewed(large, down, ["a"], n).select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        after = materialize(small, "edges")
        drop_table(now)
        now, state = after, after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, n = state, state[0]
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    if tables is not None:
        tables.made.append(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

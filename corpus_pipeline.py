"""The corpus pipeline: toxicity, exact dedup, near-dedup, benchmark decontamination, packing.

Each stage takes docs(doc_id, text, ...) with any further columns, and all but the last return the same columns. Null texts count as empty
ones; very long texts are read whole; an empty table passes through every stage. What a stage does with rows that lack a doc_id, and
with ties and repeats, stands with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm.common import drop_table, materialize, table
from trackloom.llm.decontamination import drop_leaking
from trackloom.llm.exact_dedup import keep_each_text
from trackloom.llm.near_dedup import keep_one
from trackloom.llm.packing import pack_documents
from trackloom.llm.queries import tokenizer_path
from trackloom.llm.toxicity import fit, reject_toxic

#: Words whose ids a worker keeps; less than op5 alone has, as other stages' memory is not all given back before packing begins.
TOKEN_CACHE = 150_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model calls toxic go, with or without an id; repeats go or stay together. Without both labels none goes."""
    return reject_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest doc_id stays. Rows without an id stay once per text that no row with an id has."""
    return keep_each_text(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the rows of the smallest doc_id stay; rows without an id, and texts without words, stay."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, with or without an id; repeats go or stay together."""
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's pieces, repeats and rows without an id included; of equally long pieces the smaller doc_id goes first."""
    return pack_documents(docs, tokenizer_path(), cache=TOKEN_CACHE)


STAGES: list[tuple[str, Stage]] = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: A trained model and packing are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's result is a table that the next one reads, and that goes when it has been read."""
    docs, made = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, before = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}"), made
        if before is not None:
            drop_table(before)
        made = docs
    return STAGES[-1][1](spark, docs, sf_dir)

r"""License scans: fixed phrases, and an exact set-similarity join of text blocks with licence notices, in DataFrame operations alone.

A text is cut into overlapping blocks of BLOCK words, STRIDE apart, so every run of BLOCK - STRIDE + 1 words lies whole in a block, and
every notice is shorter. A block meets a notice if it holds at least PERCENT of the notice's distinct words. The join finds every such pair:

1. Words of notices are ordered by how many documents hold them, the rarest first.
2. Prefix filter: a pair of overlap a shares one of the notice's first n - a + 1 words and one of the block's first m - a + 1.
3. Length filter: a block of fewer than a of these words can't meet the notice.
4. Positional filter: a first common word at places i and j leaves an overlap of at most 1 + min(n - i - 1, m - j - 1).
5. What is left is verified on the whole sets.

Only the notices and their words are broadcast; they are fixed, and do not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import text_of

# What lies between words, and the base phrases with their labels.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Sentences of well-known licence notices, as words, with their labels.
NOTICES = [
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
]

BLOCK, STRIDE, PERCENT = 64, 32, 80


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; other letters stay as they are."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "")


def phrase_places(words: str, hits: str, phrase: str) -> Column:
    """Where a phrase's words stand consecutively; hits are the places of all phrases' first words."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return same

    return F.filter(hits, here)


def base_places(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, n_words, and for each phrase the places of its first word, of every row."""
    firsts = sorted({p.split()[0] for p, _ in PHRASES})
    rows = docs.select("doc_id", text_of().alias("t")).select("doc_id", F.sha2("t", 256).alias("digest"), words_of(F.col("t")).alias("words"))
    some = F.arrays_overlap("words", F.lit(firsts))
    at = F.when(some, F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(firsts)))
    rows = rows.select("doc_id", "digest", "words", F.coalesce(at, F.array().cast("array<int>")).alias("hits"))
    return rows.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), *[phrase_places("words", "hits", p).alias(f"p{k}") for k, (p, _) in enumerate(PHRASES)])


def token_order(docs: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary by the number of documents that hold each word, the rarest first; of equals the smaller word. One row a word at most."""
    held = docs.select(F.explode(F.array_intersect(words_of(text_of()), F.lit(list(vocabulary)))).alias("token"))
    n = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def notice_matches(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, percent: int = PERCENT, block: int = BLOCK, stride: int = STRIDE) -> DataFrame:
    """doc_id, digest, block, notice, label, shared, size: every pair of a text block and a notice that meets the threshold, once.

    Rows that repeat a doc_id and text share their pairs. block counts from 0; notice is its place in the list. Blocks may lie half
    a block over a text's end, but every word lies in one. A notice without words meets nothing.
    """
    spark = docs.sparkSession
    sets = [sorted(set(text.split())) for _, text in notices]
    least = {t: max(1, -(-len(words) * percent // 100)) for t, words in enumerate(sets) if words}
    if not least:
        return spark.createDataFrame([], "doc_id long, digest string, block long, notice int, label string, shared int, size int")
    order = token_order(docs, sorted(set().union(*sets)))
    rank = {w: k for k, w in enumerate(order)}
    ranked = {t: sorted(rank[w] for w in sets[t]) for t in least}
    prefix = sorted({r for t in least for r in ranked[t][: len(ranked[t]) - least[t] + 1]})
    index = spark.createDataFrame(
        [(r, t, i, len(ranked[t]), least[t]) for t in least for i, r in enumerate(ranked[t][: len(ranked[t]) - least[t] + 1])],
        "rank int, notice int, i int, n int, least int",
    )
    templates = spark.createDataFrame([(t, notices[t][0], ranked[t]) for t in least], "notice int, label string, held array<int>")
    vocabulary = spark.createDataFrame([(w, k) for w, k in rank.items()], "token string, rank int")

    rows = docs.select("doc_id", text_of().alias("t")).select("doc_id", F.sha2("t", 256).alias("digest"), words_of(F.col("t")).alias("words"))
    rows = rows.filter(F.arrays_overlap("words", F.lit([order[r] for r in prefix])))  # the prefix filter, over whole texts first
    found = rows.select("doc_id", "digest", F.posexplode("words").alias("at", "token")).join(F.broadcast(vocabulary), "token")
    last = F.floor(F.col("at") / stride)
    covering = F.sequence(F.greatest(last - (block // stride - 1), F.lit(0)), last)
    placed = found.select("doc_id", "digest", "rank", F.explode(covering).alias("block"))
    blocks = placed.groupBy("doc_id", "digest", "block").agg(F.array_sort(F.collect_set("rank")).alias("own"))
    blocks = blocks.withColumn("m", F.size("own")).filter(F.col("m") >= min(least.values()))

    probes = blocks.select("*", F.posexplode("own").alias("j", "rank")).join(F.broadcast(index), "rank")
    length = F.col("m") >= F.col("least")
    block_prefix = F.col("j") <= F.col("m") - F.col("least")
    positional = 1 + F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1) >= F.col("least")
    pairs = probes.filter(length & block_prefix & positional).select("doc_id", "digest", "block", "notice", "own", "least", "n", "i").join(F.broadcast(templates), "notice")
    common = F.array_intersect("own", "held")
    met = pairs.withColumn("shared", F.size(common)).filter((F.col("shared") >= F.col("least")) & (F.array_min(common) == F.element_at("held", F.col("i") + 1)))
    return met.select("doc_id", "digest", "block", "notice", "label", "shared", F.col("n").alias("size"))


def scan_licenses(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs(doc_id, text, ...).

    score is 1 where a base phrase stands, else the largest share of a notice's words that one block holds, if it meets the threshold, else
    0. Null texts are empty: no words, no labels, score 0. Very long texts are scanned whole. Rows that repeat come as often; rows
    without a doc_id come too. Labels are distinct and sorted, so ties cannot arise. Other columns are not read; an empty table gives
    an empty result.
    """
    met = notice_matches(docs, notices, percent).groupBy("doc_id", "digest").agg(F.collect_set("label").alias("own_labels"), F.max(F.col("shared") / F.col("size")).alias("share"))
    met = met.select(F.col("doc_id").alias("met_id"), F.col("digest").alias("met_digest"), "own_labels", "share")
    base = base_places(docs)
    places = F.flatten(F.array(*[f"p{k}" for k in range(len(PHRASES))]))
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)]))
    base = base.select("doc_id", "digest", "n_words", places.alias("places"), labels.alias("base"))
    #: One row of met for each doc_id and text, so the join makes no more rows than there are documents.
    both = base.join(met, F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("digest") == F.col("met_digest")), "left")
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return both.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("own_labels", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

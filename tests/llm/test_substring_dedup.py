"""Substring dedup against a plain version that looks at every window."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from trackloom.llm import substring_dedup as S


def brute(texts: dict[int, str | None], window: int) -> dict[int, tuple[int, int, str]]:
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def got(spark, texts, window, batches):
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, lo int")
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in S.digests(S.substring_dedup(df, window, batches)).collect()}


@pytest.mark.parametrize(("window", "batches"), [(12, 1), (12, 4)])
def test_against_every_window(spark, window, batches):
    rng = random.Random(window + batches)
    pool = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    texts: dict[int, str | None] = {0: None, 1: "", 2: "  \n", 3: "a b"}
    for i in range(4, 60):
        parts = [rng.choice(pool) if rng.random() < 0.5 else [str(rng.randint(0, 30)) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 5))]
        words = [w for p in parts for w in p]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "edit"
        texts[i] = " ".join(words)
    texts[60], texts[61] = texts[10], "x " * 3000
    texts[62] = "x " * 500
    want = brute(texts, window)
    assert sum(v[1] for v in want.values()) > 500
    assert got(spark, texts, window, batches) == want


def test_segments(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 37)
    rng = random.Random(5)
    words = S.np.array([rng.getrandbits(64) for _ in range(300)], S.np.uint64)
    starts = [at + s for at, w in S.segments(words, 12) for a, z in zip(*S.anchors(w, 12)[2:], strict=True) for s in range(a, z + 1)]
    assert starts == list(range(289))


def test_nulls_repeats_and_empty(spark):
    text = " ".join(map(str, range(60)))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    rows = sorted((str(r["doc_id"]), r["n_removed"]) for r in S.substring_dedup(df).collect())
    assert rows == [("1", 0), ("1", 0), ("2", 60), ("None", 0)]
    assert S.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_batches_have_to_rise(spark):
    index = S.FingerprintIndex(12)
    docs = spark.createDataFrame([(i, "a b c") for i in (5, 6)], "doc_id long, text string")
    index.append(docs)
    with pytest.raises(ValueError, match="rising"):
        index.append(docs.filter("doc_id = 6"))
    index.append(docs.limit(0))
    index.close()


def test_runs_are_not_shuffled(spark):
    """Merging the bucketed runs with a batch reads them where they are."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    index = S.FingerprintIndex(12, most_runs=9)
    for k in range(3):
        index.append(spark.createDataFrame([(10 * k + i, text(i + k)) for i in range(4)], "doc_id long, text string"))
    mine = index.runs[2][1].select("g").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.runs[0][1].join(mine, "g", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    index.close()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()}
    assert got(spark, texts, 50, 3) == brute(texts, 50)

"""Toxicity on texts that training did not see, misspelt ones among them."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from trackloom.llm import toxicity as T

BAD = ["stupid", "horrible", "worthless", "disgusting"]


def made(n, seed, misspelt=False):
    rng = random.Random(seed)
    syllables = ["ra", "ten", "mo", "li", "ver", "sa", "ko", "ne", "du", "pi"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 200))]
        toxic = i % 3 == 0
        for _ in range(2 * toxic):
            bad = rng.choice(BAD)
            if misspelt:
                k = rng.randrange(1, len(bad) - 1)
                bad = bad[:k] + bad[k] * 2 + bad[k + 1 :]
            words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_and_misspelt():
    rows = made(300, 1)
    model = T.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    for new in (made(300, 2), made(300, 3, misspelt=True)):
        said = model.score(pa.array([r[1] for r in new])) >= 0.5
        assert np.mean(said == np.array([r[2] for r in new], bool)) > 0.97


def test_edges(spark):
    rows = made(300, 1)
    model = T.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    texts = [None, "", "  ", "123 ...", "mo " * 30000, "mo " * 30000 + "stupid"]
    docs = spark.createDataFrame([*enumerate(texts), (5, texts[5]), (None, "mo")], "doc_id long, text string").selectExpr("text as score", "doc_id", "text")
    got = T.score_documents(docs, model).collect()
    assert [r["predicted"] for r in sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"]))] == [0, 0, 0, 0, 0, 1, 1, 0]
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    left = T.reject_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == 6
    assert T.score_documents(docs.limit(0), model).count() == 0


def test_long_runs():
    rows = made(300, 1)
    model = T.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    for between in ("\u00a0", "\u3000", "-", "/", "_"):
        clean = between.join(["mo", "raten", "liver"] * 200)
        assert (model.score(pa.array([clean, between.join([clean, "stupid", clean])])) >= 0.5).tolist() == [False, True]
    for n in (1, 40, 41, 59, 60, 61, 2000):
        run = "".join(chr(0x4E00 + k) for k in range(n))
        parts = list(T.bags_of(run))
        assert set("".join(parts)) == set(run) and max(map(len, parts)) <= T.WORD_CHARS


def plainly(model, text):
    """A text's score by loops over its words and their n-grams."""
    best = -np.inf
    for run in (text or "").lower().split():
        for bag in T.bags_of(run):
            marked = f"<{bag}>"
            stretches = [(0, marked)] + [(n, marked[i : i + n]) for n in range(T.SHORTEST, T.LONGEST + 1) for i in range(len(marked) - n + 1)]
            buckets = []
            for n, part in stretches:
                total = sum(ord(c) * int(T._ODD[k + (n > 0)]) for k, c in enumerate(part)) + n
                buckets.append(int(T.mix(np.array([total % 2**64], np.uint64))[0]) % T.BUCKETS)
            best = max(best, float(np.mean(model.weights[buckets].astype(float))))
    logit = model.bias if np.isinf(best) else best * model.scale + model.bias
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def test_scores_are_those_of_loops():
    rows = made(300, 1)
    model = T.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    texts = [r[1] for r in made(9, 7)] + [None, "", "Ünïcode \u00a0STUPID's", "x" * 100 + "-" + "stupid" * 9, "... 12 ?!", "\u4e00\u4e01 mo", "a"]
    assert model.score(pa.array(texts)).tolist() == pytest.approx([plainly(model, t) for t in texts], abs=1e-5)


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables")
def test_held_out_labels(spark):
    """On the large table: the small ones' fold has six toxic texts, too few to say anything."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score_documents(docs, T.fit(docs, labels)).join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(toxic) > 50 and sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "stupid")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in T.score_documents(docs, T.fit(docs, labels)).collect()] == [0]


def test_labels_choose_only_rows_outside_the_fold(spark):
    rows = made(60, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts, labels = T.labelled_sample(docs, docs.select("doc_id", "toxic"), {1: 10, 0: 15})
    inside = {t: y for i, t, y in rows if zlib.crc32(str(i).encode()) % 5}
    assert len(texts) == 25 and labels.sum() == 10 and all(inside[t] == y for t, y in zip(texts, labels, strict=True))


def test_neighbours_do_not_change_a_bag():
    rows = made(300, 1)
    model = T.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    for n in (0, 1, 5, 30, 34, 35, 36, 400):
        beside = "mo," * (n // 3) + "raten"[: n % 3]
        assert list(T.bags_of(f"{beside},stupid,x"))[-2:] == ["stupid", "x"]
        assert model.score(pa.array([f"{beside},stupid,x", "stupid"])).tolist() == pytest.approx([model.score(pa.array(["stupid"]))[0].item()] * 2, abs=1e-6)

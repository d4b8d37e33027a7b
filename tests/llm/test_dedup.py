"""Exact and near dedup and components against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import near_dedup as N
from trackloom.llm.components import components
from trackloom.llm.exact_dedup import exact_dedup, keep_each_text, keep_largest

SCHEMA = "doc_id long, text string, keep_id int, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("digest", [None, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact(spark, digest):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "", "a", "A", "a ", "b" * 3000, str(rng.randint(0, 40))])) for i in range(300)]
    rows += [(7, rows[7][1]), (None, "a"), (None, "only null ids"), (900, "x"), (901, "x")]
    kw = {} if digest is None else {"digest": digest}
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup(frame(spark, rows), 3, **kw).collect())
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(str(i), str(keep), len(ids), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert got == sorted(want)
    kept = {r["doc_id"] for r in keep_largest(frame(spark, rows)).collect()}
    assert {str(k) for k in kept} == {w[1] for w in want} - {"None"}


def test_exact_keeps_one_row_without_an_id(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = frame(spark, [(None, "alone"), (None, "twice"), (None, "twice"), (None, "named"), (3, "named"), (5, "own"), (None, ""), (None, None)])
    left = corpus_pipeline.exact_dedup(spark, rows, "")
    assert left.columns == rows.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in left.collect()) == [("3", "named"), ("5", "own"), ("None", ""), ("None", "alone"), ("None", "twice")]


def test_each_text_keeps_columns_of_any_name(spark):
    rows = [(1, "a", "t1", "u1", "v1", 1), (2, "a", "t2", "u2", "v2", 2), (None, "b", "t3", "u3", "v3", 3), (None, "b", "t3", "u3", "v3", 3), (None, "a", "t4", "u4", "v4", 4), (None, None, "t5", "u5", "v5", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__t` string, `__alone` string, `a.b` string, `__text` int")
    kept = keep_each_text(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[2], rows[5]], key=str)


def test_exact_hot_group_and_empty(spark):
    rows = frame(spark, [(i, "same" if i % 2 else f"own {i}") for i in range(400)])
    assert {(r["keep_id"], r["group_size"]) for r in exact_dedup(rows).filter("group_size > 1").collect()} == {(399, 200)}
    assert exact_dedup(frame(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5), (None, 3)]
    up = {n: n for e in edges for n in e if n is not None}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        if a is not None and root(a) != root(b):
            up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in got} and set(range(41)) <= set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and root(a) != root(b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in ids}


def families(seed, groups, copies, words=120):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
                own[rng.randrange(words)] = f"e{rng.randint(0, 99)}"
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows))


def got(spark, rows, n):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(frame(spark, rows), n).collect()}


def test_near(spark):
    rows = families(3, 12, 8)
    k = len(rows)
    rows += [(k, None), (k + 1, ""), (k + 2, " \n"), (k + 3, "a b"), (k + 4, "A  B"), (k + 5, "a b c"), (k + 6, "same " * 4000), (k + 7, "same " * 9)]
    assert got(spark, rows, 4) == brute(rows, 4)


def test_near_hot_group_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 12)
    monkeypatch.setattr(N, "BLOCK", 5)
    monkeypatch.setattr(N, "PIVOTS", 2)
    rows = families(4, 2, 90, 100)
    want = brute(rows, 4)
    assert len({r for _, r in want.values()}) > 2
    assert got(spark, rows, 4) == want


def test_near_repeats_nulls_and_empty(spark):
    text = " ".join(map(str, range(30)))
    rows = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in N.near_duplicates(frame(spark, [(4, text), (4, text), (None, text), (9, text + " end")])).collect())
    assert rows == [("4", 4, True), ("4", 4, True), ("9", 4, False), ("None", None, False)]
    assert N.near_duplicates(frame(spark, [])).count() == 0
    kept = sorted(str(r["doc_id"]) for r in N.keep_one(frame(spark, [(4, text), (None, text), (9, text + " end"), (11, None)])).collect())
    assert kept == ["11", "4", "None"]


CLASHES = ["gone", "__gone", "__hit", "__s", "__slot", "__bits", "__place", "slot", "hit", "n", "g", "node", "a b", "x.y", "kept"]


def test_clashing_names(spark):
    text = " ".join(map(str, range(30)))
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame([(i, t, *[f"{i}{c}" for c in CLASHES]) for i, t in ((4, text), (9, text + " end"), (11, None), (12, text))], schema)
    for keep, ids in ((N.keep_one, [4, 11]), (keep_largest, [9, 11, 12])):
        left = keep(docs)
        assert left.columns == docs.columns
        assert sorted(map(tuple, left.collect())) == [r for r in sorted(map(tuple, docs.collect())) if r[0] in ids]


def test_size_bands(spark):
    """Any two sizes that can reach the threshold share a band or have neighbouring ones."""
    sizes = spark.range(1, 400).select(F.col("id").alias("n"), N.size_band(F.col("id"), 80).alias("b")).collect()
    for x in sizes:
        for y in sizes:
            if x["n"] < y["n"] and 100 * x["n"] >= 80 * y["n"]:
                assert y["b"] - x["b"] in (0, 1)


def test_hot_nodes_of_components(spark, monkeypatch):
    from trackloom.llm import common

    monkeypatch.setattr(common, "HOT_SHARE", 0.02)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    edges = [(0, k) for k in range(1, 400)] + [(1000 + k, 399) for k in range(300)] + [(5000 + k, 5001 + k) for k in range(20)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {v for k, v in got.items() if k < 5000} == {0} and {v for k, v in got.items() if k >= 5000} == {5000}


def test_no_tables_left(spark, tmp_path, monkeypatch):
    """One call leaves its result alone behind."""
    from trackloom.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    assert N.near_duplicates(frame(spark, families(3, 3, 4))).count() == 12
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["trackloom-near-duplicates"]


def test_odd_sketch_estimates():
    rng = np.random.default_rng(6)
    for true in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(30):
            both = rng.integers(0, 1 << 63, int(600 * true), dtype=np.uint64)
            rest = rng.integers(0, 1 << 63, 600 - len(both), dtype=np.uint64)
            a, b = np.concatenate([both, rest[: len(rest) // 2]]), np.concatenate([both, rest[len(rest) // 2 :]])
            odd = N.odd_sketch(N.minhash([a, b]))
            errors.append(N.odd_similarity(np.bitwise_count(odd[0] ^ odd[1]).sum()) - len(both) / 600)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < N.SLACK

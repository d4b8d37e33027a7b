"""Hard negatives against plain loops over all rows; intervals that hold, and windows that need no rerank of everything."""

from __future__ import annotations

import math

import numpy as np
import pytest

from trackloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


def plain(rows, every=50):
    kept = {}
    lengths = [len(v) for _, v, label in rows if ok(v, label)]
    most = max(set(lengths), key=lambda d: (lengths.count(d), d)) if lengths else 0
    for i, v, label in rows:
        if i is None or not ok(v, label) or len(v) != most:
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        new = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, new), new)
    out = []
    for a in (i for i in kept if i % every == 0):
        scored = sorted(((sum(x * y for x, y in zip(kept[a][1], v, strict=True)), i, label) for i, (label, v) in kept.items() if i != a), key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == kept[a][0]][:5]:
            fits = [(s, i) for s, i, label in scored if label != kept[a][0] and 50 * ps <= 100 * s <= 95 * ps][:3]
            out += [(a, p, k, i, ps, s) for k, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def ok(v, label):
    return label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) and abs(256 * x) < hn.LARGEST for x in v)


def got(df, **params):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in columns) for r in hn.hard_negatives(df, **params).collect())


def unit(rng, n, d):
    x = rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


@pytest.mark.parametrize("dims", [1, 7, 64])
def test_against_loops(spark, dims):
    rng = np.random.default_rng(dims)
    x = unit(rng, 700, dims)
    x[100:340] = x[100]  # a third are copies, and another sixth nearly so
    x[350:460] = x[350] + rng.normal(scale=0.02, size=(110, dims))
    rows = [(i, x[i].tolist(), int(rng.integers(0, 4))) for i in range(700)]
    rows += [(5, x[5].tolist(), rows[5][2]), (50, x[9].tolist(), 0), (None, x[3].tolist(), 1), (900, None, 1), (901, x[3].tolist(), None), (902, [None] * dims, 1), (903, [float("nan")] * dims, 1)]
    rows += [(904, [float("inf")] * dims, 1), (905, [], 1), (906, x[3].tolist() + [1.0], 1), (950, [1e30] * dims, 2), (1000, x[2].tolist(), -3), (1001, x[2].tolist(), 77), (-50, x[7].tolist(), 1), (-7, x[8].tolist(), -10), (1050, [0.0] * dims, 3)]
    df = spark.createDataFrame([(*r, 4) for r in rows], SCHEMA)
    want = plain(rows)
    assert len(want) > 20 or dims == 1
    assert got(df) == want
    assert got(df.repartition(7), group_rows=60, group_anchors=4, sample=50) == want


def test_intervals_hold_and_sieve(spark):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    x = np.floor(256 * unit(rng, 3000, 64).astype(np.float64)).astype(np.int64)
    book = hn.learnt_codebook(x[:1000])
    codes, rest = hn.encode(x, book)
    table = pa.table({"vec_id": np.arange(3000), "label": rng.integers(0, 5, 3000), "vector": [r.astype("<i4").tobytes() for r in x], "codes": [r.tobytes() for r in codes], "rest": rest})
    block = hn.Block(table, book)
    looked = block.looked_up(block.tables(x[:20]), slice(0, 3000))
    for k in range(20):
        exact, reach = block.exact(x[k], np.arange(3000)), block.bounds(x[k], slice(0, 3000))
        assert (np.abs(exact - looked[k]) <= reach).all() and np.median(reach) < 0.15 * (256 * 256)
        least = np.partition(looked[k] - reach, 2994)[2994]
        assert (looked[k] + reach >= least).sum() < 600  # a fifth at most is scored exactly for six of 3000


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(none) == [] and got(spark.createDataFrame([(50, None, 1, 1)], SCHEMA)) == []
    assert got(spark.createDataFrame([(51, [1.0], 1, 1)], SCHEMA)) == [] and got(spark.createDataFrame([(50, [1.0], 1, 1), (51, [1.0], 2, 1)], SCHEMA)) == []


def test_windows_of_scores():
    for p in range(-30, 400):
        lo, hi = hn.window_of(p)
        assert [s for s in range(-50, 500) if 50 * p <= 100 * s <= 95 * p] == list(range(lo, hi + 1))

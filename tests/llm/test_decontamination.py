"""Edit matching against a plain dynamic program."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from trackloom.llm import decontamination as D

SF = "/root/testdata/sf0.001"


def plain(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 90)))
        d = plain(p, t)
        assert D.myers(p, t, 100) == d and (D.myers(p, t, d - 1) is None)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        rng.choice([lambda k=k: text.pop(k), lambda k=k: text.insert(k, "q"), lambda k=k: text.__setitem__(k, "z")])()
    return "".join(text)


def test_find_leaks(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(30)) for i in range(8)] + [(8, None), (9, ""), (10, "tiny Item"), (None, prose(30)), (11, "x" * 40)]
    docs = [(0, None), (1, ""), (2, "TINY   item"), (3, "a tiny item within"), (4, prose(30000))]
    for i in range(40):
        text = D.normalized(items[i % 8][1])
        docs.append((10 + i, prose(rng.randint(0, 60)) + " " + edited(rng, text, i // 3).upper() + "\n" + prose(rng.randint(0, 60))))
    docs.append((10, docs[5][1]))
    want = []
    for i, t in docs:
        text = D.normalized(t)
        for k, item in items:
            p = D.normalized(item)
            if k is None or not p:
                continue
            if len(p) < 20:
                want += [(i, k, 0)] if p in text else []
            elif len(text) < 3000 and (d := plain(p, text)) <= int(D.RATE * len(p)):
                want.append((i, k, d))
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    assert sorted(tuple(r) for r in D.find_leaks(df, bench).collect()) == sorted(want)
    assert 10 < len(want) < 45
    left = D.drop_leaking(df, bench)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, _ in docs if i not in {w[0] for w in want})


def test_short_items():
    item = "the quick brown foxes ru"
    assert len(item) == 24
    matcher = D.Matcher([(1, item), (2, item + "n"), (3, "ab"), (4, "what is it")], whole_words=True)
    find = lambda t: dict(matcher.find(t))
    assert find(f"so {item.upper()} away") == {1: 0, 2: 1}
    assert find("so the quikc brown foxes ru") == {} and find("the quick brwn foxes ru!") == {1: 1}
    assert find("crab abs") == {} and find("crab ab.") == {3: 0} and find("(ab)") == {3: 0}
    assert find("so what is it?") == {4: 0} and find("somewhat is it") == {} and find("what is its") == {}


@pytest.mark.parametrize("n", [2, 19, 20, 24, 25, 26, 60])
def test_items_of_all_lengths_alike(n):
    item = "abcdefghij klmnopqrst uvwxyz 123456 7890 qwertz uiop asdfghjkl"[:n].strip()
    anywhere, words = D.Matcher([(1, item)]), D.Matcher([(1, item)], whole_words=True)
    assert anywhere.find(f"so zz{item}zz on") == [(1, 0)] and anywhere.find(f"({item})") == [(1, 0)]
    assert words.find(f"so zzzz{item}zzzz on") == [] and words.find(f"({item})") == [(1, 0)] and words.find(f"so {item} on") == [(1, 0)]


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_whole_table(spark):
    """The planted benchmark against the dynamic program, over every document that shares a piece, and a sample of the others."""
    docs = {r["doc_id"]: D.normalized(r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    items = {r["item_id"]: D.normalized(r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    got = {(r[0], r[1]): r[2] for r in D.find_leaks(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    small = sorted(docs, key=lambda i: len(docs[i]))[:40]
    for i in {d for d, _ in got} | set(small):
        for k, item in items.items():
            if (i, k) in got or (i in small and len(docs[i]) < 1500):
                d = plain(item, docs[i])
                assert got.get((i, k)) == (d if d <= int(D.RATE * len(item)) else None), (i, k)
    assert got


def test_blocks_and_empty(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_CHARS", 100)
    items = [(i, f"item number {i} " * 4) for i in range(12)]
    df = spark.createDataFrame([(i, f"before {t} after") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.find_leaks(df, bench).filter("distance = 0").collect()} >= {(i, i) for i in range(12)}
    keeps = spark.createDataFrame([(99, "nothing of the kind"), (None, None)], "doc_id long, text string")
    left = D.drop_leaking(df.unionByName(keeps), bench)  # a pass for each block: no stage holds two automata
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == [99, None] and left._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert D.find_leaks(df.limit(0), bench).count() == 0 and D.find_leaks(df, bench.limit(0)).count() == 0
    assert D.drop_leaking(df, bench.limit(0)).count() == 12

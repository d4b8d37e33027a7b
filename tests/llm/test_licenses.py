"""License scans against plain loops: every phrase at every word, every notice against every block."""

from __future__ import annotations

import random
import re

from trackloom.llm import licenses
from trackloom.llm.licenses import NOTICES, PHRASES, notice_matches, scan_licenses

GPL = dict(NOTICES)["gpl"]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]


def plain_pairs(text, notices=NOTICES, percent=80, block=64, stride=32):
    own = words(text)
    for b in range(0, len(own), stride):
        held = set(own[b : b + block])
        for t, (label, notice) in enumerate(notices):
            need = set(notice.split())
            if need and 100 * len(need & held) >= percent * len(need):
                yield b // stride, t, label, len(need & held), len(need)


def plain(text):
    own = words(text)
    places = [(i, label) for phrase, label in PHRASES for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
    met = list(plain_pairs(text))
    base, labels = sorted({label for _, label in places}), sorted({label for _, label in places} | {m[2] for m in met})
    score = 1.0 if places else max((m[3] / m[4] for m in met), default=0.0)
    return len(own), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(base), ",".join(labels), score


def texts():
    rng = random.Random(3)
    vocabulary = sorted({w for _, n in NOTICES for w in n.split()})
    out = [None, "", " \n", "GNU General Public License", "gnu general public\nLICENSE. Apache-License; mit license mit license cc by cc by-nc", "Cc", "mit", "ſ K license Mıt License", "x" * 5000]
    for _, notice in NOTICES:
        some = notice.split()
        for drop in (0, 2, 4, 6):
            kept = [w for i, w in enumerate(some) if i % 7 >= drop - 1 or drop == 0]
            rng.shuffle(kept) if drop == 4 else None
            filler = [rng.choice(["lorem", "ipsum", "the", "Été", "dolor9"]) for _ in range(rng.randint(0, 70))]
            out.append(" ".join(filler + kept + filler[:9]))
    out += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 400))) for _ in range(40)]
    return [*out, " ".join(rng.choice(["a", "of", "this"]) for _ in range(60_000)) + " " + GPL.upper() + " tail " * 5000]


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_scan_against_loops(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())]
    rows += [(None, texts()[4], "y", 2), (3, GPL, "z", 3), (3, GPL, "z", 3), (None, None, "z", 3), (None, GPL, "q", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, block int").repartition(5)
    got = sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in scan_licenses(docs).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t, _, _ in rows), key=str)
    assert sum(1 for g in got if g[6] != g[5]) > 10 and all(len(n.split()) <= licenses.BLOCK - licenses.STRIDE + 1 for _, n in NOTICES)


def test_every_pair_once(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    for percent, notices in ((80, NOTICES), (50, NOTICES), (100, [("a", "one two two"), ("b", ""), ("c", "the of a this")])):
        got = sorted((r["doc_id"], r["block"], r["notice"], r["label"], r["shared"], r["size"]) for r in notice_matches(docs, notices, percent).collect())
        want = sorted((i, *p) for i, t in enumerate(texts()) for p in plain_pairs(t, notices, percent))
        assert got == want


def test_filters_find_the_rarest_first(spark):
    docs = spark.createDataFrame([(1, "the the of"), (2, "the a"), (3, "THE")], "doc_id long, text string")
    assert licenses.token_order(docs, ["the", "of", "a", "zebra"]) == ["zebra", "a", "of", "the"]


def test_empty_table_and_no_notices(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert scan_licenses(none).collect() == [] and notice_matches(none).collect() == []
    one = spark.createDataFrame([(1, GPL)], "doc_id long, text string")
    assert notice_matches(one, []).collect() == [] and scan_licenses(one, []).first()["labels"] == "gpl"


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, GPL)], "doc_id long, text string")
    plan = scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

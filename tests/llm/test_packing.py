"""Packing and token output: every id in exactly one place, ids as the tokenizer gives them, little padding."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from trackloom.llm import packing, token_output  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001/documents.parquet"
TEXTS = ["", None, "a <|endoftext|> b", "Á était 'S don't Σας İx <|endoftext|> 12ab ***'s ﬁ ½ á ...'re\x85z q\x1c", "The end. " * 900, "word " * 37, *[f"Number {i}, " * (i % 90) for i in range(150)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (3, TEXTS[3], "y"), (None, "no id", "z")], "doc_id long, text string, start string")


def expected(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], np.uint32)


def test_packing(docs):
    rows = packing.pack_documents(docs, PATH, limit=256, group_chars=4000).toPandas()
    assert rows["sequence_id"].floordiv(1 << 32).nunique() > 1
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]] and own["length"].sum() <= 256
    for i, text in enumerate(TEXTS):
        want, own = expected(text), rows[rows["doc_id"] == i].sort_values("start", kind="stable")
        own = own.drop_duplicates("start") if i == 3 else own
        assert own["start"].tolist() == [0, *np.cumsum(own["length"])[:-1]] and own["length"].sum() == len(want) and (own["doc_tokens"] == len(want)).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(want[r.start : r.start + r.length].tobytes())
    assert (rows["doc_id"] == 3).sum() == 2 * (len(expected(TEXTS[3])) // 256 + 1) and rows["doc_id"].isna().sum() == 1
    used = rows["length"].sum()
    assert rows["sequence_id"].nunique() <= used / 256 * 1.1 + rows["sequence_id"].floordiv(1 << 32).nunique()


def test_special_tokens_and_sliced_batches():
    import pyarrow as pa

    from trackloom.llm.common import cut
    from trackloom.llm.tokens import WordTokens

    texts = ["a <|endoftext|> b", "x<|startoftext|>y <|ENDOFTEXT|> Σας<|endoftext|><|endoftext|>", "  <|endoftext|>", "<|endoftext", "plain", "é ü <|endoftext|>. 'S", None] * 9
    table = WordTokens(PATH)
    table.LIMIT = 3  # nothing is lost when the cache is full
    for part in cut(pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]).slice(1), 4):
        for text, ids in zip(part.column(0).to_pylist(), table.texts(part.column(0)), strict=True):
            assert ids.tolist() == expected(text).tolist(), text
    assert expected(texts[0]).tolist() == [320, 49407, 321, 2]
    parts = list(cut(pa.RecordBatch.from_arrays([pa.array(["x" * 50] * 7 + [None, "y" * 500, "z"])], names=["t"]), 4, 120))
    assert [p.num_rows for p in parts] == [2, 2, 2, 2, 1, 1] and sum((p.column(0).to_pylist() for p in parts), []) == ["x" * 50] * 7 + [None, "y" * 500, "z"]


def test_one_id_fills_no_group(spark):
    rows = spark.createDataFrame([(None, "same text here")] * 300 + [(5, "word " * 9000)], "doc_id long, text string")
    packed = packing.pack_documents(rows, PATH, limit=64, group_chars=6000).toPandas()
    group = packed["sequence_id"].floordiv(1 << 32)
    for own in (group[packed["doc_id"].isna()], group[packed["doc_id"] == 5]):
        assert len(own) > 100 and own.value_counts().max() < 0.5 * len(own) and own.nunique() > 4


def test_large_ids_beside_nulls_in_a_shuffled_table(spark):
    rows = [(2**60 + k, f"a b {k % 7}") for k in range(60)] + [(None, "c d")] * 20 + [(-(2**59) - 1, "e " * 700)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ids = sorted((r[0] for r in rows), key=str)
    pieces = packing.pack_documents(docs, PATH, limit=128, group_chars=300).collect()
    assert sorted((r["doc_id"] for r in pieces if r["start"] == 0), key=str) == ids and len({r["sequence_id"] >> 32 for r in pieces}) > 3
    packed = token_output.pack_matrices(docs, PATH, limit=128, group_chars=300).collect()
    assert sorted((i for r in packed for i, s in zip(r["doc_ids"], r["doc_starts"], strict=True) if s == 0), key=str) == ids


def test_places_do_not_depend_on_the_order():
    from collections import Counter

    from trackloom.llm.tokens import places

    pieces = [(k % 3 or None, 0, k % 2) for k in range(40)]

    def dealt(rows):
        return sorted(zip(rows, places(Counter(), *map(list, zip(*rows, strict=True))), strict=True), key=str)

    assert dealt(pieces) == dealt(pieces[::-1]) and len({p for _, p in dealt(pieces)}) == 40


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_whole_table(spark):
    docs = spark.read.parquet(SF)
    want = {r["doc_id"]: expected(r["text"]) for r in docs.collect()}
    pieces: dict = {}
    for r in packing.pack_documents(docs, PATH).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == want.keys()
    for doc_id, own in pieces.items():
        ids, at = want[doc_id], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes()) and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    found: dict = {}
    for r in token_output.pack_matrices(docs, PATH).collect():
        ids = np.frombuffer(r["ids"], "<u2")
        for d, start, lo, hi in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            found.setdefault(d, {})[start] = ids[lo:hi]
    assert {d: np.concatenate([p for _, p in sorted(parts.items())]).tolist() for d, parts in found.items()} == {d: ids.tolist() for d, ids in want.items()}


def test_first_fit_is_first_fit():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 200):
        lengths = rng.integers(1, 65, n)
        bins, offsets = packing.first_fit_decreasing(lengths, 64)
        room: list[int] = []
        for k in np.argsort(-lengths, kind="stable"):
            b = next((i for i, r in enumerate(room) if r >= lengths[k]), len(room))
            room += [64] if b == len(room) else []
            assert (bins[k], offsets[k]) == (b, 64 - room[b])
            room[b] -= lengths[k]


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 200):
        lengths = rng.integers(1, 65, n)
        bins, offsets = token_output.best_fit_decreasing(lengths, 64)
        room: list[int] = []
        for k in np.argsort(-lengths, kind="stable"):
            b = min((r, i) for i, r in enumerate([*room, 10**9]) if r >= lengths[k])[1]
            room += [64] if b == len(room) else []
            assert (bins[k], offsets[k]) == (b, 64 - room[b])
            room[b] -= lengths[k]


def test_matrices_round_trip(docs, spark, tmp_path):
    path = f"file://{tmp_path}/packed"
    token_output.write_matrices(token_output.pack_matrices(docs, PATH, limit=256, group_chars=4000), path)
    rows = spark.read.parquet(path).collect()
    found: dict = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] and (ids[r["n_tokens"] :] == 0).all()
        where = token_output.positions(r["position_resets"], 256)
        for d, start, lo, hi in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            assert where[lo:hi].tolist() == list(range(hi - lo))
            found.setdefault(d, []).append((start, ids[lo:hi]))
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in enumerate(TEXTS):
        parts = [p for _, p in sorted(found[i], key=lambda x: x[0])]
        want = expected(text)
        assert np.concatenate(parts).tolist() == (np.repeat(want, 1).tolist() if i != 3 else [*want, *want])


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(none, PATH).count() == 0 and token_output.pack_matrices(none, PATH).count() == 0

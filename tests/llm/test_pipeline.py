"""The pipeline on the smallest table, each stage against a plain version on its own input; and the registered names."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_dedup import brute  # noqa: E402
from trackloom.llm import decontamination as D  # noqa: E402
from trackloom.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_names():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, toxic = docs.columns, {r["doc_id"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r["toxic"] == 1}
    items = [r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(path := f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(path)
        after = {r["doc_id"] for r in docs.collect()}
        if name == "packing":
            assert after == set(before)
            continue
        assert docs.columns == columns and docs.count() == len(after)
        gone = set(before) - after
        if name == "toxicity":
            assert len(gone) < 0.3 * len(before) and len(gone & toxic) >= len(gone - toxic) / 9
        elif name == "exact_dedup":
            last = {t: i for i, t in sorted(before.items())}
            assert after == set(last.values())
        elif name == "near_dedup":
            assert after == {i for i, (_, root) in brute(list(before.items()), 5).items() if i == root}
        else:
            assert gone == {i for i, t in before.items() if D.Matcher(list(enumerate(items))).find(t)}


def awkward(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text), (1, text), (2, text + " end"), (3, None), (4, ""), (5, None), (None, "no id " * 9), (None, "no id " * 9), (None, None), (6, "x" * 300000), (7, "tie"), (8, "tie")]
    return spark.createDataFrame([(i, t, "l", "s", 1, i, "g", True) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, node long, `__gone` string, hit boolean")


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize(("name", "ids"), [("toxicity", [None] * 3 + [1, 1, 2, 3, 4, 5, 6, 7, 8]), ("exact_dedup", [None, 1, 1, 2, 5, 6, 8]), ("near_dedup", [None] * 3 + [1, 1, 3, 4, 5, 6, 7]), ("decontamination", [None] * 3 + [1, 1, 2, 3, 4, 5, 6, 7, 8])])
def test_awkward_rows(spark, name, ids):
    stage, docs = dict(corpus_pipeline.STAGES)[name], awkward(spark)
    left = stage(spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=lambda i: (i is not None, i or 0)) == ids
    assert stage(spark, docs.limit(0), SF).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df, want = queries.queries()[name](spark, SF), con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want.fetchall()))

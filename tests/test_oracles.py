"""Every registered query of the engine against its DuckDB oracle, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import trackloom.plans  # noqa: F401
from trackloom.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_oracle(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    want = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

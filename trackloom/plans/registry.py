"""Query registry: name -> (Spark query, DuckDB oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name that no other has."""

    def add(query: Query) -> Query:
        if name in _FOUND:
            raise ValueError(f"{name} is registered already")
        _FOUND[name] = (query, oracle)
        return query

    return add


def queries() -> dict[str, Query]:
    return {k: q for k, (q, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {k: o for k, (_, o) in _FOUND.items() if o}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return queries()["a14_scene_statistics"](spark, folder)

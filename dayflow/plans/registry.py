"""Query registry: name -> (spark callable, optional oracle SQL).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  The oracle is an independent ANSI-SQL formulation that DuckDB
runs over the same Parquet tables; queries whose semantics have no SQL form
(iterative fits, per-series Python state, file round trips of ML models)
register none and are checked by tests against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco

"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given test tables.
``sql`` is an equivalent DuckDB statement over the same tables (registered as
views by the checker); ``None`` marks an operator with no SQL equivalent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, ops: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, ops)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # import for side effects: each module registers its queries
    from . import scoring, text_queries, papers_queries, notes_queries, pages_queries, encode_queries, io_queries, stream_queries  # noqa: F401

    return dict(_REGISTRY)

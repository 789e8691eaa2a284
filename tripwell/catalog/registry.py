"""Name -> query, and name -> independent SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name!r} is registered twice")
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)

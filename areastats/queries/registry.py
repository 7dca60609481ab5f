"""Register of queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own or the given name, with the SQL it must agree with."""

    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            SQL[name or f.__name__] = sql
        return f

    return register

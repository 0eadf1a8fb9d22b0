"""Tiny registry: query name -> Spark callable and, where SQL can say it, the same query as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, **types: str):
    """Register a query; ``types`` casts columns of the SQL twin whose type differs by engine."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in types.items())
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({sql}) typed" if types else sql
        return fn

    return add

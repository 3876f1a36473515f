"""Registered queries: name -> (Spark callable, oracle SQL or None).

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame built
from the driver's tables (through the shared ``Ledger`` layers). Each SQL
twin derives the same result from the same raw tables in DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from txwatch.plans import (
        queries_contract, queries_core, queries_more, queries_reports, queries_splits, queries_streams)  # noqa: F401

"""Query registry: every registered query is ``fn(spark, sf_dir) -> DataFrame``
and, where SQL can express it, carries an equivalent DuckDB SQL text over the
same parquet tables (used as the correctness oracle)."""

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
    """Import every plan module so its queries register."""
    from . import cohort, retrieval, evaluation, tickets, power, htmlrecords, messages, files  # noqa: F401

"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its counterpart where SQL can express it."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from chatweave.catalog import (  # noqa: F401
        artifacts,
        batches,
        formats,
        generation,
        preparation,
        sampling,
        sessions,
        streams,
        tokens,
    )

    return QUERIES, ORACLE

"""Register of the queries that are compared with plain SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curveloom.checks.sample import Sample

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Callable[[Sample], DataFrame]], Callable[[Sample], DataFrame]]:
    """Register ``fn(sample)`` under ``name``; ``sql`` is the same result in plain SQL."""

    def add(fn: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Sample(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add

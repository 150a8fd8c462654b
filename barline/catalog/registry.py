"""Named queries, each with the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barline.functions.rounding import round_half_up

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is its DuckDB equivalent."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round result columns so that engines agree despite different summation orders."""
    return df.withColumns({c: round_half_up(F.col(c), n) for c, n in digits.items()})


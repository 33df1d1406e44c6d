"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Without ``sql`` it has no SQL counterpart and is covered by tests instead."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# Means of values with two decimals often lie exactly between two rounded values, where the last bit of a sum would
# decide. This offset moves them off the boundary, the same way on both sides; it also turns -0.0 into 0.0.
# Large sums, rounded to few digits, carry more noise and need a larger offset.
def off_tie(digits: int) -> float:
    return 1e-8 if digits > 2 else 3.7e-5


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round for comparison, because sums of doubles depend on their order in the last digits."""
    return df.withColumns({c: F.round(F.col(c) + F.lit(off_tie(d)), d) + F.lit(0.0) for c, d in digits.items()})


def sql_round(expr: str, digits: int) -> str:
    return f"round(({expr}) + {off_tie(digits)!r}, {digits}) + 0.0"

"""Names, queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


def six(column: str | Column) -> Column:
    """Six decimals, so that the order of floating sums does not show."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def six_all(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: six(c) for c in columns})


def ids_text(column: str) -> Column:
    """A list of ids as text."""
    return F.array_join(F.col(column).cast("array<string>"), ",")

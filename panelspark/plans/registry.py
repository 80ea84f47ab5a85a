"""Queries by name, each with its DuckDB form where SQL can tell it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def secs(column: str, name: str | None = None) -> Column:
    """A timestamp as seconds, which both engines print alike."""
    return F.unix_seconds(F.col(column)).alias(name or column.split(".")[-1])


def text(column: str, name: str | None = None) -> Column:
    """A date as text."""
    return F.col(column).cast("string").alias(name or column.split(".")[-1])

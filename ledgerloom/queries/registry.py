"""Where the query modules register what they define."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say it, the same result as DuckDB SQL."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column: str | Column) -> Column:
    """Dates and keys as text: the same value on every engine."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def day(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("date").cast("string")

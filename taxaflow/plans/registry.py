"""Queries over the driver's tables, each with its DuckDB equivalent where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[["Tables"], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """Attribute access to the tables of a directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def registered(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, path: f(Tables(spark, path))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return registered

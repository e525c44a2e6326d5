"""Registration of queries with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def keep(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return f

    return keep

"""Registration of a query next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder, by name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, path: build(Tables(spark, path))
        if sql:
            ORACLE_SQL[build.__name__] = sql
        return build

    return register

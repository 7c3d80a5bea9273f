"""Query registry: a name, the Spark query and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy readers of the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register ``fn(Tables) -> DataFrame`` under ``name``."""

    def add(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add

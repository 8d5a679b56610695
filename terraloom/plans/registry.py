"""Registry of query plans and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy readers of the tables in a folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Registers ``f(tables) -> DataFrame`` under ``name``."""
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add

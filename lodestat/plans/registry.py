"""Catalogue of queries over the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestat.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a function of (tables) under ``key``; ``sql`` is the DuckDB twin."""

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


class Tables:
    """Attribute access to the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship(spark)
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

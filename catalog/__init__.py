"""Queries on the generated tables, each with the SQL that has to give the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchlake.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, read on access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a function of ``Tables`` under a name."""
    def register(build: Callable[[Tables], DataFrame]):
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(prepare(spark), folder))

        QUERIES[name] = call
        if oracle is not None:
            ORACLES[name] = oracle
        return build
    return register


from catalog import (  # noqa: E402,F401
    picks, texts, joins, aggregates, maintenance, checks, files, league, builds, reports)

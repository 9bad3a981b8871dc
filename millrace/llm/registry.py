"""Registered queries of this subpackage and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a builder ``(spark, folder) -> DataFrame`` under ``name``."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

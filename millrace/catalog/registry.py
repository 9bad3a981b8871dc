"""Registered queries: a Spark builder next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure


class Tables:
    """The given Parquet tables, each read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    key: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(configure(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register the decorated builder under its own name.

    ``covers`` lists the operator ids of the survey's inventory.
    """

    def register(build: Callable[[Tables], DataFrame]):
        key = build.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} registered twice")
        REGISTRY[key] = Query(key, tuple(covers.split()), build, sql)
        return build

    return register

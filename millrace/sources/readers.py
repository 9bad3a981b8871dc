"""Scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files as one table; a path listed twice counts twice.

    Columns are matched by name; one that a file lacks is null there.
    """
    parts = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    header: bool = True,
) -> DataFrame:
    """CSV files, a folder or a pattern; names and types come from ``schema``."""
    return spark.read.schema(schema).option("header", header).csv(path)


def all_text(columns: Sequence[str]) -> T.StructType:
    """Schema that reads every column as text, for files with dirty numbers."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON files that hold one array of records each.

    Such a file cannot be split, so one task reads it; JSON lines are the form
    to store large data in.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def fields(
    lines: DataFrame,
    positions: dict[str, int],
    sep: str = ",",
    skip_prefix: str | None = None,
) -> DataFrame:
    """Text lines to trimmed columns by position, without quote handling.

    Lines that start with ``skip_prefix`` are headers; a missing field is null.
    """
    if skip_prefix is not None:
        lines = lines.filter(~F.col("value").startswith(skip_prefix))
    parts = F.split("value", f"\\Q{sep}\\E")
    return lines.select(
        *[F.trim(F.get(parts, F.lit(i))).alias(name) for name, i in positions.items()]
    )

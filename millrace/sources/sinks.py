"""Writers.  Paths must lie on storage all executors share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, small: bool = False) -> None:
    """Replace a Parquet table; ``small`` results go into a single file."""
    (df.coalesce(1) if small else df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """One formatted text line per row."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, name: str, path: str) -> None:
    """Replace a catalog table that keeps its files at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def archive_snapshot(df: DataFrame, path: str, taken: date) -> None:
    """Add today's state to the archive, one folder per day.

    Writing the same day again replaces that day only.
    """
    (
        df.withColumn("snapshot_date", F.lit(taken))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )

"""Country figures from a stored page: extract, transform, load, report."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import parse_thousands
from millrace.operators.aggregates import top_n_mean
from millrace.operators.joins import membership_flags
from millrace.sources.html import first_cells
from millrace.sources.sinks import archive_snapshot, write_json_lines, write_table

# Region names and their flag columns.
REGIONS = {
    "African": "african", "Arab": "arab", "Asia Pacific": "ap", "Latin": "latin",
    "North America": "na", "Oceanian": "oceanian", "Europe": "europe",
}


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Country and figure text of each table row below the three header rows."""
    return first_cells(pages, key, html, ["Country", "gdp_text"], skip_rows=3)


def transform(
    rows: DataFrame, membership: DataFrame, regions: Mapping[str, str] = REGIONS
) -> DataFrame:
    """Figures in billions with one flag per region.

    ``membership`` has one row per (Country, region); a country may be in
    several regions or in none.
    """
    figures = rows.select("Country", parse_thousands("gdp_text").alias("GDP_USD_billion"))
    return membership_flags(figures, membership, "Country", "Country", "region", regions)


def largest_first(df: DataFrame) -> DataFrame:
    """Sorted for the report; countries without a figure come last."""
    return df.orderBy(F.desc_nulls_last("GDP_USD_billion"), "Country")


def load(df: DataFrame, folder: str, table: str, taken: date) -> None:
    """Archive the day's state, then replace the JSON copy and the table."""
    archive_snapshot(df, f"{folder}/archive", taken)
    write_json_lines(df, f"{folder}/json")
    write_table(df, table, f"{folder}/table")


def over(df: DataFrame, billions: float = 100) -> DataFrame:
    return df.filter(F.col("GDP_USD_billion") >= billions).select("Country", "GDP_USD_billion")


def region_means(df: DataFrame, regions: Mapping[str, str] = REGIONS, n: int = 5) -> DataFrame:
    """Mean of the ``n`` largest figures per region.

    The flag columns become rows once, instead of one scan per region.
    """
    member = F.array(
        *[F.when(F.col(flag) == 1, F.lit(name)) for name, flag in regions.items()]
    )
    rows = df.select("Country", "GDP_USD_billion", F.explode(F.array_compact(member)).alias("region"))
    return top_n_mean(rows, ["region"], "GDP_USD_billion", "Country", n, "avg_gdp")

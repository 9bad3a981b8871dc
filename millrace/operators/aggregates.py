"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import (
    exact_sum,
    mean_round,
    ratio_or_zero,
    round_half_up,
    split_total,
    whole_total,
)
from millrace.operators.windows import top_n


def top_n_mean(
    df: DataFrame, keys: Sequence[str], value: str, tiebreak: str, n: int, name: str
) -> DataFrame:
    """Mean of the ``n`` largest values per group, null values last."""
    order = [F.col(value).desc_nulls_last(), F.col(tiebreak)]
    return top_n(df, keys, order, n).groupBy(*keys).agg(mean_round(value, 2).alias(name))


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence[str], other: str = "other"
) -> DataFrame:
    """Counts of row by column with one output column per listed value.

    Rows with any other value, or none, count in the column ``other``.
    """
    listed = [F.count_if(F.col(column) == v).alias(str(v)) for v in values]
    rest = F.count_if(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))
    return df.groupBy(row).agg(*listed, rest.alias(other))


def with_total_row(
    df: DataFrame, key: str, count_name: str, sums: dict[str, str], label: str = "TOTAL"
) -> DataFrame:
    """One row per key and a total row.

    The total is rolled up from the grouped rows, so the detail is read and
    aggregated once.
    """
    parts = {new: split_total(c) for c, new in sums.items()}
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_name),
        *[total.alias(new) for new, (total, _) in parts.items()],
        *[other.alias(f"_{new}") for new, (_, other) in parts.items()],
    )
    rolled = grouped.rollup(key).agg(
        F.grouping(key).alias("_total"),
        F.sum(count_name).alias(count_name),
        *[whole_total(F.sum(c), F.sum(f"_{c}")).alias(c) for c in sums.values()],
    )
    name = F.when(F.col("_total") == 1, label).otherwise(F.col(key).cast("string"))
    return rolled.select(name.alias(key), count_name, *sums.values())


def spend_summary(
    df: DataFrame, units: str, price: str, unit_profit: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Units, spend, mean price, profit, mean profit and return on spend.

    Rates are 0 where nothing was bought.
    """
    sums = df.groupBy(*keys).agg(
        F.sum(F.col(units)).cast("double").alias("_units"),
        exact_sum(F.col(units) * F.col(price)).alias("_spend"),
        exact_sum(F.col(units) * F.col(unit_profit)).alias("_profit"),
    )
    u, s, p = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("_units", "_spend", "_profit"))
    return sums.select(
        *keys,
        u.alias("units"),
        round_half_up(s, 1).alias("spend"),
        round_half_up(ratio_or_zero(s, u), 1).alias("avg_price"),
        round_half_up(p, 1).alias("total_profit"),
        round_half_up(ratio_or_zero(p, u), 1).alias("avg_profit_per_unit"),
        round_half_up(ratio_or_zero(p, s) * 100, 1).alias("avg_roi"),
    )

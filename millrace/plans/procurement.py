"""Plan, actual purchases and their comparison for many scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import spend_summary
from millrace.operators.planning import (
    DEFAULT_TERMS,
    Terms,
    cost_columns,
    greedy_plan,
    plan_vs_actual,
    rolling_replan,
    with_actuals,
    with_bids,
)


def schedule_from(
    days: DataFrame, target: int, base_price: float, noise: str | None = None
) -> DataFrame:
    """Schedule from rows (scenario, date, supply) with one target for all.

    Supplies of the same day are added up, so a scenario has at most one row
    per calendar day however many rows come in.
    """
    deviation = F.max(noise) if noise else F.lit(0.0)
    daily = days.groupBy("scenario", F.col("date").cast("date").alias("date")).agg(
        F.sum("supply").cast("bigint").alias("supply"), deviation.cast("double").alias("noise")
    )
    order = Window.partitionBy("scenario").orderBy("date")
    return daily.select(
        "scenario",
        "date",
        (F.row_number().over(order) - 1).alias("idx"),
        "supply",
        F.lit(float(base_price)).alias("base_price"),
        F.lit(target).cast("bigint").alias("target"),
        "noise",
    )


def baseline(schedule: DataFrame, terms: Terms = DEFAULT_TERMS) -> DataFrame:
    """Cheapest-first plan over the whole schedule."""
    return greedy_plan(with_bids(schedule, terms))


def plan_summary(plan: DataFrame) -> DataFrame:
    return spend_summary(plan, "buy", "exp_price", "unit_profit", ["scenario"])


def actual_history(
    schedule: DataFrame, actuals: DataFrame, terms: Terms = DEFAULT_TERMS
) -> DataFrame:
    """Purchases at the prices that were expected on their day."""
    day = rolling_replan(with_actuals(schedule, actuals), terms)
    return day.withColumns(cost_columns(terms))


def compare(schedule: DataFrame, actuals: DataFrame, terms: Terms = DEFAULT_TERMS) -> DataFrame:
    """Plan against actual per scenario."""
    planned = plan_summary(baseline(schedule, terms))
    history = actual_history(schedule, actuals, terms)
    actual = spend_summary(history, "bought", "exp_price", "unit_profit", ["scenario"])
    targets = schedule.groupBy("scenario").agg(F.max("target").alias("_target"))
    joined = actual.join(targets, "scenario")
    return plan_vs_actual(planned, joined, F.col("_target"))

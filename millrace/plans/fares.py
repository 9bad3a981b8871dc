"""Fares by kind of day, by temperature and by date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import (
    exact_mean,
    exact_sum,
    floor_bin,
    mean_round,
    round_half_up,
    split_total,
    whole_total,
)
from millrace.functions.times import day_type, month_range, year_range


def month_fares(trips: DataFrame, year: int, month: int) -> DataFrame:
    """Paid trips of one month; the range on the raw time prunes the scan."""
    kept = trips.filter(
        month_range("request_datetime", year, month) & (F.col("base_passenger_fare") > 0)
    )
    return kept.select(
        F.to_date("request_datetime").alias("date"),
        "trip_miles",
        "trip_time",
        "base_passenger_fare",
    )


def by_day_type(fares: DataFrame) -> DataFrame:
    return (
        fares.groupBy(day_type("date").alias("day_type"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            exact_mean("trip_miles").alias("avg_trip_miles"),
            exact_mean("base_passenger_fare").alias("avg_base_passenger_fare"),
        )
    )


def by_temperature(fares: DataFrame, weather: DataFrame, width: int = 5) -> DataFrame:
    """Means per temperature band of the day.

    Fares are summed per day first, so the weather is joined to one row a day.
    """
    miles, fare = split_total("trip_miles"), split_total("base_passenger_fare")
    daily = fares.groupBy("date").agg(
        F.count(F.lit(1)).alias("_n"),
        miles[0].alias("_miles"),
        miles[1].alias("_miles_other"),
        F.count("trip_miles").alias("_miles_n"),
        fare[0].alias("_fare"),
        fare[1].alias("_fare_other"),
        F.count("base_passenger_fare").alias("_fare_n"),
    )

    def mean(name: str) -> Column:
        total = whole_total(F.sum(name), F.sum(f"{name}_other"))
        return round_half_up(F.try_divide(total, F.sum(f"{name}_n")), 2)

    band = floor_bin("max", width).cast("double").alias("temp_group")
    joined = daily.join(weather.select("date", "max"), "date", "left")
    return (
        joined.groupBy(band)
        .agg(
            F.sum("_n").alias("count"),
            mean("_miles").alias("avg_trip_miles"),
            mean("_fare").alias("avg_base_passenger_fare"),
        )
        .orderBy(F.asc_nulls_first("temp_group"))
    )


def revenue_summary(trips: DataFrame, year: int) -> DataFrame:
    """Revenue, trips and mean distance of one year in one aggregate."""
    kept = _paid(trips, year)
    return kept.agg(
        exact_sum("base_passenger_fare").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_count"),
        mean_round("base_passenger_fare", 2).alias("average_revenue"),
        mean_round("trip_miles", 2).alias("average_distance"),
    )


def daily_metrics(trips: DataFrame, year: int) -> DataFrame:
    """Trips and revenue per day in date order."""
    return (
        _paid(trips, year)
        .groupBy(F.to_date("request_datetime").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            exact_sum("base_passenger_fare").alias("revenue"),
        )
        .orderBy("date")
    )


def _paid(trips: DataFrame, year: int) -> DataFrame:
    return trips.filter(year_range("request_datetime", year) & (F.col("base_passenger_fare") > 0))

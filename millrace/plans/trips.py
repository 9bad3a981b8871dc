"""Ride-hail trips by hour, weather, distance and route.

The grouped result tables come from one pass over the trips: one aggregate with
a grouping set per result.  A task sends at most one row per hour, weather band,
distance band and route, so the large input is joined once and hardly shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import (
    bucket_rank,
    bucketize,
    exact_mean,
    fahrenheit_to_celsius,
    map_codes,
    round_half_up,
    row_sum,
    split_total,
    to_number,
    whole_total,
)
from millrace.functions.times import date_from_parts, minutes, seconds_between
from millrace.operators.joins import lookup
from millrace.storage import materialize

# Category names, their boundaries and the code tables.
UNUSED = [
    "dispatching_base_num", "originating_base_num", "shared_request_flag",
    "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag",
]
SERVICES = {"HV0003": "Uber", "HV0005": "Lyft"}
SEASONS = {1: "Winter", 2: "Winter", 7: "Summer", 8: "Summer"}
TEMPERATURE_EDGES = [0, 10, 20, 30]
TEMPERATURE_LABELS = ["Below Freezing", "0-10°C", "10-20°C", "20-30°C", "Above 30°C"]
RAIN_EDGES = [0.1, 0.5, 1.0]
RAIN_LABELS = [
    "No Precipitation", "Light Precipitation", "Moderate Precipitation", "Heavy Precipitation",
]
DISTANCE_EDGES = [1, 2, 3, 4, 5, 10, 15, 20, 25, 30]
DISTANCE_LABELS = [
    "0-1 miles", "1-2 miles", "2-3 miles", "3-4 miles", "4-5 miles", "5-10 miles",
    "10-15 miles", "15-20 miles", "20-25 miles", "25-30 miles", "30+ miles",
]

# Result name and its keys.
GROUPINGS = {
    "peak_hours": ["hour"],
    "weather_analysis": ["temp_category", "weather_category"],
    "distance_analysis": ["distance_category"],
    "location_analysis": ["PULocation", "DOLocation"],
}
MEASURES = ["base_passenger_fare", "trip_time", "scene_time", "tips"]


def plausible(trips: DataFrame) -> DataFrame:
    """Trips whose times are in order and whose amounts are possible."""
    return trips.filter(
        (F.col("dropoff_datetime") > F.col("pickup_datetime"))
        & (F.col("on_scene_datetime") > F.col("request_datetime"))
        & (F.col("base_passenger_fare") > 0)
        & (F.col("driver_pay") >= 0)
    )


def clean(
    trips: DataFrame,
    services: Mapping[str, str] = SERVICES,
    seasons: Mapping[int, str] = SEASONS,
) -> DataFrame:
    """Plausible trips of the seasons with minutes, calendar fields and service."""
    waited = seconds_between("request_datetime", "on_scene_datetime")
    in_season = F.month("request_datetime").isin(sorted(seasons))
    return (
        plausible(trips.drop(*UNUSED))
        .filter(in_season)
        .withColumns(
            {
                "scene_time": minutes(waited),
                "trip_time": minutes("trip_time"),
                "date": F.to_date("request_datetime"),
                "year": F.year("request_datetime"),
                "month": F.month("request_datetime"),
                "day": F.dayofmonth("request_datetime"),
                "hour": F.hour("request_datetime"),
                "season": map_codes(F.month("request_datetime"), seasons),
                "service_type": map_codes("hvfhs_license_num", services),
            }
        )
    )


def with_boroughs(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough of both ends; trips with an unknown or 'N/A' end are dropped."""
    # The zone file is text; an id that is no number matches nothing.
    zones = zones.withColumn("LocationID", F.col("LocationID").try_cast("bigint"))
    out = lookup(trips, zones, "PULocationID", "LocationID", {"Borough": "PULocation"})
    out = lookup(out, zones, "DOLocationID", "LocationID", {"Borough": "DOLocation"})
    return out.filter((F.col("PULocation") != "N/A") & (F.col("DOLocation") != "N/A")).drop(
        "PULocationID", "DOLocationID"
    )


def daily_weather(raw: DataFrame) -> DataFrame:
    """Typed weather per day from a file in which every column is text.

    Fahrenheit becomes Celsius and the three rain readings are summed; T (a
    trace) counts as 0, other unreadable text as null.
    """
    rain = [to_number(f"precipitation{i}", marker="T") for i in (1, 2, 3)]
    return raw.select(
        date_from_parts("year", "month", "day").alias("date"),
        fahrenheit_to_celsius(to_number("max")).alias("max"),
        fahrenheit_to_celsius(to_number("min")).alias("min"),
        round_half_up(row_sum(rain), 2).alias("precipitation"),
    )


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on the day; ``weather`` comes from :func:`daily_weather`."""
    return trips.join(weather, "date", "left")


def categories() -> dict[str, Column]:
    return {
        "temp_category": bucketize("max", TEMPERATURE_EDGES, TEMPERATURE_LABELS, right_closed=True),
        "weather_category": bucketize("precipitation", RAIN_EDGES, RAIN_LABELS, right_closed=True),
        "distance_category": bucketize("trip_miles", DISTANCE_EDGES, DISTANCE_LABELS),
    }


def detail(trips: DataFrame, zones: DataFrame, weather: DataFrame, **options) -> DataFrame:
    """Cleaned trips with boroughs, weather and categories."""
    joined = with_weather(with_boroughs(clean(trips, **options), zones), weather)
    return joined.withColumns(categories())


def known_weather(rows: DataFrame) -> DataFrame:
    """:func:`detail` rows of days whose weather is known."""
    return rows.filter(F.col("weather_category") != "Unknown")


def global_means(trips: DataFrame) -> DataFrame:
    """Mean duration (seconds), distance and fare before any cleaning."""
    return trips.agg(
        exact_mean("trip_time").alias("avg_trip_duration"),
        exact_mean("trip_miles").alias("avg_trip_distance"),
        exact_mean("base_passenger_fare").alias("avg_fare"),
    )


def cells(rows: DataFrame, names: Sequence[str] = tuple(GROUPINGS)) -> DataFrame:
    """Counts and means of the named results, stacked, from one aggregate.

    ``report`` names the result a row belongs to.  ``trips`` counts all rows;
    the other figures leave out days without known weather, and groups that
    consist of such days only have ``known`` = 0.
    """
    known = F.col("weather_category") != "Unknown"
    keys = [k for name in names for k in GROUPINGS[name]]
    figures = [
        F.count(F.lit(1)).alias("trips"),
        F.count_if(known).alias("known"),
        F.count(F.when(known, F.col("service_type"))).alias("users"),
    ]
    for m in MEASURES:
        value = F.when(known, F.col(m))
        total, other = split_total(value)
        figures += [
            total.alias(f"{m}_sum"),
            other.alias(f"{m}_other"),
            F.count(value).alias(f"{m}_n"),
        ]
    owner = _owner(names)
    grouped = rows.groupingSets([[F.col(k) for k in GROUPINGS[n]] for n in names], *keys)
    return grouped.agg(owner.alias("report"), *figures)


def _owner(names: Sequence[str]) -> Column:
    """Name of the grouping set a row of the aggregate belongs to."""
    out = F.lit(None).cast("string")
    for name in names:
        out = F.when(F.grouping(GROUPINGS[name][0]) == 0, F.lit(name)).otherwise(out)
    return out


def _mean(measure: str, digits: int) -> Column:
    total = whole_total(F.col(f"{measure}_sum"), F.col(f"{measure}_other"))
    return round_half_up(F.try_divide(total, F.col(f"{measure}_n")), digits)


def _known(table: DataFrame, name: str) -> DataFrame:
    """Rows of one result, without groups and days of unknown weather."""
    return table.filter((F.col("report") == name) & (F.col("known") > 0))


def peak_hours(table: DataFrame) -> DataFrame:
    """Trips per hour of the request, days without weather included."""
    hours = table.filter(F.col("report") == "peak_hours")
    return hours.select("hour", F.col("trips").alias("count")).orderBy(F.desc("count"), "hour")


def weather_analysis(table: DataFrame) -> DataFrame:
    return (
        _known(table, "weather_analysis")
        .select(
            "temp_category",
            "weather_category",
            F.col("users").alias("num_users"),
            _mean("base_passenger_fare", 2).alias("avg_fare"),
            _mean("trip_time", 2).alias("avg_trip_time"),
        )
        .orderBy(F.desc("num_users"), "temp_category", "weather_category")
    )


def distance_analysis(table: DataFrame) -> DataFrame:
    """Means in whole units per distance band, shortest first, Unknown last."""
    return (
        _known(table, "distance_analysis")
        .select(
            "distance_category",
            F.col("users").alias("num_users"),
            _mean("trip_time", 0).alias("avg_trip_time_minutes"),
            _mean("scene_time", 0).alias("avg_scene_time_minutes"),
            _mean("base_passenger_fare", 0).alias("avg_base_passenger_fare"),
            _mean("tips", 0).alias("avg_tips"),
        )
        .orderBy(bucket_rank("distance_category", DISTANCE_LABELS))
    )


def location_analysis(table: DataFrame) -> DataFrame:
    return (
        _known(table, "location_analysis")
        .select(
            "PULocation",
            "DOLocation",
            F.col("users").alias("num_users"),
            _mean("base_passenger_fare", 2).alias("avg_fare"),
            _mean("trip_time", 2).alias("avg_trip_time"),
            _mean("scene_time", 2).alias("avg_scene_time"),
        )
        .orderBy(F.desc("num_users"), "PULocation", "DOLocation")
    )


def reports_from(rows: DataFrame) -> dict[str, DataFrame]:
    """The grouped results of :func:`detail` rows.

    The aggregate is written once, a few hundred rows, and read by all four.
    """
    table = materialize(cells(rows), "trip-cells")
    return {
        "peak_hours": peak_hours(table),
        "weather_analysis": weather_analysis(table),
        "distance_analysis": distance_analysis(table),
        "location_analysis": location_analysis(table),
    }


def reports(
    trips: DataFrame, zones: DataFrame, weather: DataFrame, **options
) -> dict[str, DataFrame]:
    """All result tables without keeping the detail."""
    rows = detail(trips, zones, weather, **options)
    return {"metrics": global_means(trips), **reports_from(rows)}

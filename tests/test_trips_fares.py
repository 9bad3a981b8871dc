"""Trip plans on a small fixture with every quirk of the raw files."""

from datetime import datetime as T

import pytest
from conftest import final_plan, values
from pyspark.sql import functions as F

from millrace.plans import fares, trips
from millrace.sources import readers, sinks
from millrace.storage import fresh_path

SCHEMA = (
    "hvfhs_license_num string, request_datetime timestamp, on_scene_datetime timestamp,"
    " pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int,"
    " trip_miles double, trip_time bigint, base_passenger_fare double, driver_pay double,"
    " tips double, wav_match_flag string"
)


def trip(**changes):
    base = dict(
        hvfhs_license_num="HV0003", request_datetime=T(2024, 1, 31, 8, 0),
        on_scene_datetime=T(2024, 1, 31, 8, 4, 30), pickup_datetime=T(2024, 1, 31, 8, 5),
        dropoff_datetime=T(2024, 1, 31, 8, 25), PULocationID=1, DOLocationID=2, trip_miles=1.0,
        trip_time=1170, base_passenger_fare=20.0, driver_pay=15.0, tips=1.0, wav_match_flag="N",
    )
    assert not set(changes) - set(base)
    return tuple({**base, **changes}.values())


BAD = [
    dict(on_scene_datetime=None),
    dict(on_scene_datetime=T(2024, 1, 31, 8, 0)),
    dict(dropoff_datetime=T(2024, 1, 31, 8, 5)),
    dict(base_passenger_fare=0.0),
    dict(driver_pay=-0.01),
]
FEBRUARY = dict(
    request_datetime=T(2024, 2, 1, 0, 10), on_scene_datetime=T(2024, 2, 1, 0, 11),
    pickup_datetime=T(2024, 2, 1, 0, 12), dropoff_datetime=T(2024, 2, 1, 0, 30),
)
APRIL = {k: v.replace(month=4) for k, v in FEBRUARY.items()}
GOOD = [
    {},
    dict(hvfhs_license_num="HV0005", trip_miles=0.99, base_passenger_fare=10.0, driver_pay=0.0),
    dict(hvfhs_license_num="HV0004", trip_miles=30.0, tips=None),
    dict(trip_miles=None, **FEBRUARY),
    dict(DOLocationID=4, **FEBRUARY),
    dict(PULocationID=3),
    dict(DOLocationID=99),
    APRIL,
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([trip(**c) for c in [*BAD, *GOOD]], SCHEMA)


@pytest.fixture(scope="module")
def zones(spark):
    rows = [("1", "Queens"), ("2", "Bronx"), ("3", "N/A"), ("4", "Queens"), ("x", "Nowhere")]
    return spark.createDataFrame(rows, "LocationID string, Borough string")


@pytest.fixture(scope="module")
def weather_text(spark):
    """January 31 is known, February 1 has an unreadable reading."""
    rows = [
        ("2024", "01", "31", "50", "32", "T", "0.05", "0.06"),
        ("2024", "02", "01", "86", "", "M", "0.05", "T"),
        ("2024", "02", "30", "86", "1", "0", "0", "0"),
    ]
    names = ["year", "month", "day", "max", "min", *[f"precipitation{i}" for i in (1, 2, 3)]]
    path = fresh_path(spark, "weather")
    sinks.write_csv(spark.createDataFrame(rows, readers.all_text(names)), path)
    return readers.read_csv(spark, path, readers.all_text(names))


def test_sanity_filter_drops_nulls_too(raw):
    assert trips.plausible(raw).count() == len(GOOD)


def test_clean(raw):
    out = trips.clean(raw)
    assert "wav_match_flag" not in out.columns
    assert out.filter("season = 'Winter'").count() == out.count() == len(GOOD) - 1
    first = out.filter("tips IS NULL").first()
    assert (first["scene_time"], first["trip_time"], first["hour"]) == (5.0, 20.0, 8)
    assert first["service_type"] is None
    with_code = trips.clean(raw, services={**trips.SERVICES, "HV0004": "Lyft"})
    assert with_code.filter("tips IS NULL").first()["service_type"] == "Lyft"


def test_daily_weather(weather_text):
    assert values(
        trips.daily_weather(weather_text).withColumn("date", F.col("date").cast("string"))
    ) == [
        (None, 30.0, -17.2, 0.0),
        ("2024-01-31", 10.0, 0.0, 0.11),
        ("2024-02-01", 30.0, None, None),
    ]


def test_reports(raw, zones, weather_text):
    out = trips.reports(raw, zones, trips.daily_weather(weather_text))
    assert values(out["metrics"])[0] == (1170.0, pytest.approx(40.99 / 12), pytest.approx(230 / 13))
    # Two trips of February 1 have no usable weather, but they do have an hour.
    assert values(out["peak_hours"]) == [(0, 2), (8, 3)]
    assert values(out["weather_analysis"]) == [
        ("0-10°C", "Light Precipitation", 2, 16.67, 20.0)
    ]
    assert [tuple(r) for r in out["distance_analysis"].collect()] == [
        ("0-1 miles", 1, 20.0, 5.0, 10.0, 1.0),
        ("1-2 miles", 1, 20.0, 5.0, 20.0, 1.0),
        ("30+ miles", 0, 20.0, 5.0, 20.0, None),
    ]
    assert values(out["location_analysis"]) == [("Queens", "Bronx", 2, 16.67, 20.0, 5.0)]


def test_cells_give_what_the_detail_gives(raw, zones, weather_text):
    detail = trips.detail(raw, zones, trips.daily_weather(weather_text))
    direct = (
        detail.filter("weather_category <> 'Unknown'")
        .groupBy("PULocation", "DOLocation")
        .agg(F.count("service_type"), F.round(F.avg("base_passenger_fare"), 2))
    )
    for cells in (trips.cells(detail), trips.cells(detail, ["location_analysis"])):
        routes = trips.location_analysis(cells)
        assert values(direct) == values(
            routes, "PULocation", "DOLocation", "num_users", "avg_fare"
        )


def test_fares_by_day_and_temperature(raw, weather_text):
    month = fares.month_fares(raw, 2024, 1)
    assert month.count() == 9  # January only; the trip without fare is out
    by_type = values(fares.by_day_type(month))
    assert by_type[0][:2] == ("weekday", 9)
    bands = fares.by_temperature(month, trips.daily_weather(weather_text))
    assert values(bands, "temp_group", "count") == [(10.0, 9)]
    without = fares.by_temperature(month, trips.daily_weather(weather_text).filter("false"))
    assert values(without, "temp_group", "count") == [(None, 9)]


def test_daily_figures_equal_the_pairwise_reduction(tables):
    """The DataFrame form against map, reduce and reduceByKey over rows."""
    orders = tables.orders.select(
        F.col("o_orderdate").alias("request_datetime"),
        F.col("o_totalprice").alias("base_passenger_fare"),
        F.lit(1.5).alias("trip_miles"),
    )
    rows = orders.rdd.filter(
        lambda r: r.request_datetime.year == 1997 and r.base_passenger_fare > 0
    )
    total, count = rows.map(lambda r: (round(r.base_passenger_fare * 100), 1)).reduce(
        lambda a, b: (a[0] + b[0], a[1] + b[1])
    )
    summary = fares.revenue_summary(orders, 1997).first()
    assert (summary["total_revenue"], summary["total_count"]) == (total / 100, count)
    daily = (
        rows.map(lambda r: (r.request_datetime.date(), (1, round(r.base_passenger_fare * 100))))
        .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]))
        .sortByKey()
        .collect()
    )
    mine = [tuple(r) for r in fares.daily_metrics(orders, 1997).collect()]
    assert mine == [(d, n, cents / 100) for d, (n, cents) in daily]


def test_day_conditions_stay_off_the_order_lines(tables):
    """The weather's day parts are made once a day, not for each line."""
    from millrace.catalog import workloads

    plan = final_plan(workloads.trip_detail(tables))
    assert "lineitem" in plan and "weather-days" in plan
    made = [line for line in plan.splitlines() if "format_string" in line]
    assert "date_format" not in plan and made and not any("l_" in line for line in made)

"""The end-to-end plans on the given tables.

Order lines play the trips (supplier nation to customer nation), nations the
zones, and shipping statistics per day the weather file, written as text the
way such files are.
"""

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import half_up, mean, mean_round, total
from millrace.functions.numbers import map_codes, round_half_up
from millrace.operators.joins import lookup
from millrace.plans import economies, fares, trips
from millrace.sources.readers import all_text, read_csv
from millrace.sources.sinks import write_csv
from millrace.storage import fresh_path, materialize


def ride_rows(t: Tables, since: str | None = None, until: str | None = None) -> DataFrame:
    """Trips without their ends: order lines with the times of their orders.

    A request is at most a day after its order, so requests from ``since`` on
    and before ``until`` need orders of a range that is a day wider; the scan
    of the orders is pruned by it.
    """
    orders = t.orders
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.to_timestamp(F.lit(since)) - timedelta(days=1))
    if until:
        orders = orders.filter(F.col("o_orderdate") < F.to_timestamp(F.lit(until)))
    # The time is added up once per order.
    asked = F.col("o_orderdate") + F.lit(timedelta(hours=1)) * (F.col("o_orderkey") % 24)
    orders = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", asked.alias("request_datetime")
    )
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    license = {"F": "HV0003", "O": "HV0005", "P": "HV0004"}
    waited = F.lit(timedelta(seconds=100)) * (F.col("l_linenumber") - 1)
    return lines.select(
        "l_suppkey",
        "o_custkey",
        "request_datetime",
        (F.col("request_datetime") + waited).alias("on_scene_datetime"),
        F.col("request_datetime").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        map_codes("o_orderstatus", license).alias("hvfhs_license_num"),
        (F.col("l_quantity") * 60 + F.col("l_linenumber") * 7).alias("trip_time"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("trip_miles"),
        F.col("l_extendedprice").alias("base_passenger_fare"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("driver_pay"),
        round_half_up(F.col("l_tax") * 100).alias("tips"),
        F.lit("N").alias("shared_request_flag"),
    )


def trip_rows(t: Tables) -> DataFrame:
    """Trips with the zones of both ends."""
    rides = lookup(ride_rows(t), t.customer, "o_custkey", "c_custkey", {"c_nationkey": "DOLocationID"})
    rides = lookup(rides, t.supplier, "l_suppkey", "s_suppkey", {"s_nationkey": "PULocationID"})
    return rides.drop("o_custkey", "l_suppkey")


def zone_rows(t: Tables) -> DataFrame:
    named = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    borough = F.when(F.col("r_name") == "MIDDLE EAST", "N/A").otherwise(F.col("r_name"))
    return named.select(
        F.col("n_nationkey").cast("string").alias("LocationID"), borough.alias("Borough")
    )


def weather_rows(t: Tables, file: bool = False) -> DataFrame:
    """The weather as a text table with one row per day.

    Columns year, month, day, max, min, precipitation1..3; T is a trace, M is
    missing.  With ``file`` it is written as CSV and read back as such files are.
    """
    daily = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    )
    rain = (F.col("q") % 8 / 10).cast("string")
    text = daily.select(
        F.year("d").cast("string").alias("year"),
        F.date_format("d", "MM").alias("month"),
        F.date_format("d", "dd").alias("day"),
        (F.col("q") % 90 + 15).cast("string").alias("max"),
        (F.col("q") % 70).cast("string").alias("min"),
        F.when(F.col("n") % 5 == 0, "T").otherwise(rain).alias("precipitation1"),
        F.when(F.col("n") % 11 == 0, "M").otherwise("0.1").alias("precipitation2"),
        F.when(F.col("n") % 3 == 0, "T").otherwise("0.05").alias("precipitation3"),
    )
    if not file:
        # Written, so that conditions on the days do not reach the order lines.
        return materialize(text, "weather-days")
    path = fresh_path(t.spark, "weather")
    write_csv(text, path)
    return read_csv(t.spark, path, all_text(text.columns))


def trip_detail(t: Tables, file: bool = False) -> DataFrame:
    return trips.detail(trip_rows(t), zone_rows(t), trips.daily_weather(weather_rows(t, file)))


_RAIN = "(TRY_CAST(CASE WHEN p1 = 'T' THEN '0' ELSE p1 END AS DOUBLE) + TRY_CAST(p2 AS DOUBLE) + TRY_CAST(CASE WHEN p3 = 'T' THEN '0' ELSE p3 END AS DOUBLE))"

TRIPS = f"""
    WITH raw AS (
      SELECT s_nationkey AS pu, c_nationkey AS dn, o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS request,
             (l_linenumber - 1) * 100 AS wait, l_shipdate AS dropoff, o_orderstatus AS code,
             l_quantity * 60 + l_linenumber * 7 AS seconds,
             CASE WHEN l_linenumber <> 3 THEN l_quantity END AS trip_miles, l_extendedprice AS fare,
             l_extendedprice * (1 - l_discount) AS pay, round(l_tax * 100) AS tips
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN customer ON o_custkey = c_custkey),
    zones AS (SELECT n_nationkey AS id, CASE WHEN r_name = 'MIDDLE EAST' THEN 'N/A' ELSE r_name END AS borough
              FROM nation JOIN region ON n_regionkey = r_regionkey),
    clean AS (
      SELECT pu, dn, CAST(request AS DATE) AS date, CAST(hour(request) AS INTEGER) AS hour,
             {half_up('(wait / 60)')} AS scene_time, {half_up('(seconds / 60)')} AS trip_time,
             CASE code WHEN 'F' THEN 'Uber' WHEN 'O' THEN 'Lyft' END AS service, trip_miles, fare, tips
      FROM raw WHERE dropoff > request AND wait > 0 AND fare > 0 AND pay >= 0 AND month(request) IN (1, 2, 7, 8)),
    daily AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q
              FROM lineitem GROUP BY 1),
    codes AS (SELECT d, (q % 90) + 15 AS mx, CASE WHEN n % 5 = 0 THEN 'T' ELSE CAST((q % 8) / 10 AS VARCHAR) END AS p1,
                     CASE WHEN n % 11 = 0 THEN 'M' ELSE '0.1' END AS p2, CASE WHEN n % 3 = 0 THEN 'T' ELSE '0.05' END AS p3
              FROM daily),
    weather AS (SELECT d, {half_up('(CAST(mx - 32 AS DOUBLE) * 5 / 9)', 1)} AS mx, {half_up(_RAIN, 2)} AS rain FROM codes),
    detail AS (
      SELECT c.*, a.borough AS pul, b.borough AS dol,
             CASE WHEN mx IS NULL THEN 'Unknown' WHEN mx <= 0 THEN 'Below Freezing' WHEN mx <= 10 THEN '0-10°C'
                  WHEN mx <= 20 THEN '10-20°C' WHEN mx <= 30 THEN '20-30°C' ELSE 'Above 30°C' END AS temp_category,
             CASE WHEN rain IS NULL THEN 'Unknown' WHEN rain <= 0.1::DOUBLE THEN 'No Precipitation'
                  WHEN rain <= 0.5::DOUBLE THEN 'Light Precipitation' WHEN rain <= 1.0 THEN 'Moderate Precipitation'
                  ELSE 'Heavy Precipitation' END AS weather_category,
             CASE WHEN trip_miles IS NULL THEN 'Unknown' WHEN trip_miles < 1 THEN '0-1 miles'
                  WHEN trip_miles < 2 THEN '1-2 miles' WHEN trip_miles < 3 THEN '2-3 miles' WHEN trip_miles < 4 THEN '3-4 miles'
                  WHEN trip_miles < 5 THEN '4-5 miles' WHEN trip_miles < 10 THEN '5-10 miles' WHEN trip_miles < 15 THEN '10-15 miles'
                  WHEN trip_miles < 20 THEN '15-20 miles' WHEN trip_miles < 25 THEN '20-25 miles'
                  WHEN trip_miles < 30 THEN '25-30 miles' ELSE '30+ miles' END AS distance_category
      FROM clean c JOIN zones a ON pu = a.id JOIN zones b ON dn = b.id LEFT JOIN weather ON date = d
      WHERE a.borough <> 'N/A' AND b.borough <> 'N/A'),
    known AS (SELECT * FROM detail WHERE weather_category <> 'Unknown')
"""


@query(
    "A05",
    f"{TRIPS} SELECT {mean('seconds')} AS avg_trip_duration, {mean('trip_miles')} AS avg_trip_distance, {mean('fare')} AS avg_fare FROM raw",
)
def trip_metrics(t: Tables):
    """Means over all trips, before any cleaning."""
    return trips.global_means(ride_rows(t))


@query(
    "A09 F10",
    f"{TRIPS} SELECT hour, count(*) AS count FROM detail GROUP BY 1 ORDER BY count DESC, hour",
)
def trip_peak_hours(t: Tables):
    return trips.peak_hours(trips.cells(trip_detail(t), ["peak_hours"]))


@query(
    "A10 J03 E18",
    f"""{TRIPS} SELECT temp_category, weather_category, count(service) AS num_users,
        {mean_round('fare')} AS avg_fare, {mean_round('trip_time')} AS avg_trip_time
        FROM known GROUP BY 1, 2""",
)
def weather_analysis(t: Tables):
    """The weather comes from a text file here."""
    return trips.weather_analysis(trips.cells(trip_detail(t, file=True), ["weather_analysis"]))


@query(
    "A11 O07 E18",
    f"""{TRIPS} SELECT distance_category, count(service) AS num_users,
        {mean_round('trip_time', 0)} AS avg_trip_time_minutes, {mean_round('scene_time', 0)} AS avg_scene_time_minutes,
        {mean_round('fare', 0)} AS avg_base_passenger_fare, {mean_round('tips', 0)} AS avg_tips
        FROM known GROUP BY 1""",
)
def distance_analysis(t: Tables):
    return trips.distance_analysis(trips.cells(trip_detail(t), ["distance_analysis"]))


@query(
    "A12 J01 F14",
    f"""{TRIPS} SELECT pul AS "PULocation", dol AS "DOLocation", count(service) AS num_users,
        {mean_round('fare')} AS avg_fare, {mean_round('trip_time')} AS avg_trip_time,
        {mean_round('scene_time')} AS avg_scene_time
        FROM known GROUP BY 1, 2""",
)
def location_analysis(t: Tables):
    return trips.location_analysis(trips.cells(trip_detail(t), ["location_analysis"]))


@query(
    "A09 A10 A11 A12",
    f"""{TRIPS}
        SELECT 'peak_hours' AS report, CAST(hour AS VARCHAR) AS first_key, NULL AS second_key, count(*) AS trips,
               count(CASE WHEN weather_category <> 'Unknown' THEN service END) AS users FROM detail GROUP BY hour
        UNION ALL
        SELECT 'weather_analysis', temp_category, weather_category, count(*), count(service) FROM known GROUP BY ALL
        UNION ALL
        SELECT 'distance_analysis', distance_category, NULL, trips, users FROM (
          SELECT distance_category, count(*) AS trips, count(CASE WHEN weather_category <> 'Unknown' THEN service END) AS users
          FROM detail GROUP BY 1)
        UNION ALL
        SELECT 'location_analysis', pul, dol, trips, users FROM (
          SELECT pul, dol, count(*) AS trips, count(CASE WHEN weather_category <> 'Unknown' THEN service END) AS users
          FROM detail GROUP BY 1, 2)""",
)
def trip_reports(t: Tables):
    """All grouped results from one aggregate, stacked."""
    table = trips.cells(trip_detail(t))
    bands = (F.col("report") != "weather_analysis") | (F.col("known") > 0)
    first = F.coalesce(
        F.col("hour").cast("string"), "temp_category", "distance_category", "PULocation"
    )
    return table.filter(bands).select(
        "report",
        first.alias("first_key"),
        F.coalesce("weather_category", "DOLocation").alias("second_key"),
        "trips",
        "users",
    )


@query(
    "X03",
    f"""{TRIPS}
        SELECT 'hours' AS result, count(*) AS rows, CAST(sum(n) AS BIGINT) AS trips
        FROM (SELECT hour, count(*) AS n FROM detail GROUP BY 1)
        UNION ALL
        SELECT 'bands', count(*), CAST(sum(n) AS BIGINT)
        FROM (SELECT distance_category, count(service) AS n FROM known GROUP BY 1)
        UNION ALL
        SELECT 'routes', count(*), CAST(sum(n) AS BIGINT)
        FROM (SELECT pul, dol, count(service) AS n FROM known GROUP BY 1, 2)""",
)
def trip_results_reused(t: Tables):
    """Several results of one written intermediate, which is computed once."""
    found = trips.reports_from(trip_detail(t))
    parts = [
        found[name].agg(F.count(F.lit(1)).alias("rows"), F.sum(measure).alias("trips")).select(
            F.lit(shown).alias("result"), "rows", "trips"
        )
        for shown, name, measure in (
            ("hours", "peak_hours", "count"),
            ("bands", "distance_analysis", "num_users"),
            ("routes", "location_analysis", "num_users"),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


_MONTH, _YEAR = ("1997-01-01", "1997-02-01"), ("1997-01-01", "1998-01-01")
_JANUARY = """month_fares AS (SELECT CAST(request AS DATE) AS date, trip_miles, fare FROM raw
                              WHERE request >= TIMESTAMP '1997-01-01' AND request < TIMESTAMP '1997-02-01' AND fare > 0)"""


@query(
    "A13 F11 E09",
    f"""{TRIPS}, {_JANUARY}
        SELECT CASE WHEN dayofweek(date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type, count(*) AS count,
               {mean('trip_miles')} AS avg_trip_miles, {mean('fare')} AS avg_base_passenger_fare
        FROM month_fares GROUP BY 1""",
)
def fare_day_types(t: Tables):
    return fares.by_day_type(fares.month_fares(ride_rows(t, *_MONTH), 1997, 1))


@query(
    "A14 J04 E08",
    f"""{TRIPS}, {_JANUARY}
        SELECT floor(mx / 5) * 5 AS temp_group, count(*) AS count, {mean_round('trip_miles')} AS avg_trip_miles,
               {mean_round('fare')} AS avg_base_passenger_fare
        FROM month_fares LEFT JOIN weather ON date = d GROUP BY 1""",
)
def fare_temperatures(t: Tables):
    weather = trips.daily_weather(weather_rows(t))
    return fares.by_temperature(fares.month_fares(ride_rows(t, *_MONTH), 1997, 1), weather)


@query(
    "A15 Y04",
    f"""{TRIPS} SELECT {total('fare')} AS total_revenue, count(*) AS total_count,
        {mean_round('fare')} AS average_revenue, {mean_round('trip_miles')} AS average_distance
        FROM raw WHERE year(request) = 1997 AND fare > 0""",
)
def fare_revenue(t: Tables):
    return fares.revenue_summary(ride_rows(t, *_YEAR), 1997)


@query(
    "A16 O06",
    f"""{TRIPS} SELECT CAST(CAST(request AS DATE) AS VARCHAR) AS date, count(*) AS trips, {total('fare')} AS revenue
        FROM raw WHERE year(request) = 1997 AND fare > 0 GROUP BY 1""",
)
def fare_daily(t: Tables):
    daily = fares.daily_metrics(ride_rows(t, *_YEAR), 1997)
    return daily.withColumn("date", F.col("date").cast("string"))


def economy_rows(t: Tables) -> DataFrame:
    """Customers as countries: a page per customer with three header rows."""
    shown = F.when(
        F.col("c_acctbal") < 0, "—"
    ).otherwise(F.format_number(F.floor(F.col("c_acctbal") * 1000), 0))
    head = "<table class='wikitable'><tr><th>a</th></tr><tr><th>b</th></tr><tr><td>World</td><td>1</td></tr>"
    page = F.concat(
        F.lit(head + "<tr><td><a href='/x'>"), F.col("c_name"), F.lit("</a></td><td> "), shown,
        F.lit("</td></tr></table>"),
    )
    pages = t.customer.select(F.col("c_custkey").alias("page_id"), page.alias("html"))
    return economies.extract(pages)


def economy_membership(t: Tables) -> DataFrame:
    """Nation and region of a customer as overlapping groups."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    groups = F.array(F.col("r_name"), F.when(F.col("r_name") != "AMERICA", F.lit("OLD WORLD")))
    return named.select(
        F.col("c_name").alias("Country"), F.explode(F.array_compact(groups)).alias("region")
    )


_GROUPS = {"ASIA": "asia", "EUROPE": "europe", "OLD WORLD": "old_world"}

_ECONOMIES = f"""
    WITH g AS (
      SELECT c_name AS "Country", CASE WHEN c_acctbal >= 0 THEN {half_up('(floor(c_acctbal * 1000) / 1000)', 2)} END AS gdp,
             CASE WHEN r_name = 'ASIA' THEN 1 ELSE 0 END AS asia, CASE WHEN r_name = 'EUROPE' THEN 1 ELSE 0 END AS europe,
             CASE WHEN r_name <> 'AMERICA' THEN 1 ELSE 0 END AS old_world
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@query(
    "S09 E02 P09 O02",
    f'{_ECONOMIES} SELECT "Country", gdp AS "GDP_USD_billion", asia, europe, old_world FROM g',
)
def economy_table(t: Tables):
    """Stored pages to figures with region flags, largest first."""
    return economies.largest_first(
        economies.transform(economy_rows(t), economy_membership(t), _GROUPS)
    )


@query(
    "F01",
    f'{_ECONOMIES} SELECT "Country", gdp AS "GDP_USD_billion" FROM g WHERE gdp >= 9000',
)
def economy_over(t: Tables):
    table = economies.transform(economy_rows(t), economy_membership(t), _GROUPS)
    return economies.over(table, 9000)


@query(
    "A31 N01 U03",
    " UNION ALL ".join(
        f"""(SELECT '{name}' AS region, {mean_round('gdp')} AS avg_gdp
             FROM ({_ECONOMIES} SELECT gdp FROM g WHERE {flag} = 1 ORDER BY gdp DESC NULLS LAST, "Country" LIMIT 5))"""
        for name, flag in _GROUPS.items()
    ),
)
def economy_region_means(t: Tables):
    """Mean of the five largest figures per region."""
    table = economies.transform(economy_rows(t), economy_membership(t), _GROUPS)
    return economies.region_means(table, _GROUPS)

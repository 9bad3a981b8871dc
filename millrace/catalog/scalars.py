"""Scalar functions."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import half_up
from millrace.functions import numbers, times


@query(
    "E02",
    f"""
    WITH f AS (
      SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN '—'
                  ELSE format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) END AS cell
      FROM orders)
    SELECT o_orderkey, cell, {half_up("(TRY_CAST(replace(cell, ',', '') AS DOUBLE) / 1000)", 2)} AS thousands
    FROM f
    """,
)
def parse_money(t: Tables):
    """'123,456' to thousands; the dash means missing."""
    shown = F.format_number(F.floor("o_totalprice"), 0)
    cell = F.when(F.col("o_orderstatus") == "P", "—").otherwise(shown)
    rows = t.orders.select("o_orderkey", cell.alias("cell"))
    return rows.withColumn("thousands", numbers.parse_thousands("cell"))


@query(
    "E03",
    """
    SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
           split_part(p_name, ' ', 1) AS first_word, lpad(CAST(p_size AS VARCHAR), 6, '0') AS padded,
           CAST(p_size AS VARCHAR) AS unpadded, trim('  ' || p_name || ' ') AS trimmed
    FROM part
    """,
)
def string_funcs(t: Tables):
    padded = F.lpad(F.col("p_size").cast("string"), 6, "0")
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.split("p_name", " ")[0].alias("first_word"),
        padded.alias("padded"),
        F.ltrim(padded, F.lit("0")).alias("unpadded"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
    )


@query(
    "E06",
    r"SELECT event_id, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events",
)
def regex_extract(t: Tables):
    from millrace.functions.text import first_number

    return t.events.select("event_id", first_number("props").alias("k"))


@query(
    "E07 E08",
    """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
           CAST(make_date(year(ts), month(ts), 1) AS VARCHAR) AS first_of_month,
           CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday
    FROM events
    """,
)
def date_parts(t: Tables):
    parts = t.events.select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.to_date("ts").cast("string").alias("date"),
        F.dayofweek("ts").alias("weekday"),
    )
    first = times.date_from_parts(F.col("year").cast("string"), "month", F.lit("01"))
    return parts.withColumn("first_of_month", first.cast("string"))


@query(
    "E10 E11",
    f"""
    WITH s AS (
      SELECT event_id, CAST(date_diff('second', date_trunc('hour', ts), date_trunc('second', ts)) AS BIGINT) AS seconds
      FROM events)
    SELECT event_id, seconds, {half_up('(seconds / 60)')} AS minutes_rounded,
           CAST(floor(seconds / 60) AS DOUBLE) AS minutes_cut
    FROM s
    """,
)
def duration_minutes(t: Tables):
    """Seconds since the full hour, and as rounded and truncated minutes."""
    rows = t.events.select(
        "event_id", times.seconds_between(F.date_trunc("hour", "ts"), F.col("ts")).alias("seconds")
    )
    return rows.withColumns(
        {
            "minutes_rounded": times.minutes("seconds"),
            "minutes_cut": times.minutes("seconds", truncate=True),
        }
    )


@query(
    "E12",
    f"""
    SELECT p_partkey, {half_up('((p_size - 32) * 5 / 9)', 1)} AS celsius,
           {half_up('(p_size * 1.60934::DOUBLE)', 2)} AS km
    FROM part
    """,
)
def unit_convert(t: Tables):
    return t.part.select(
        "p_partkey",
        numbers.fahrenheit_to_celsius("p_size").alias("celsius"),
        numbers.miles_to_km("p_size").alias("km"),
    )


@query(
    "E14",
    f"""
    WITH r AS (
      SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_tax > 0 THEN l_tax END AS a,
             CASE WHEN l_discount > 0 THEN l_discount END AS b, l_quantity AS c
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey, {half_up('(a + b + c)', 2)} AS strict_sum,
           {half_up('(coalesce(a, 0) + coalesce(b, 0) + c)', 2)} AS lenient_sum
    FROM r
    """,
)
def row_sum(t: Tables):
    """Across columns, with nulls propagated and with nulls skipped."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("a"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("b"),
        F.col("l_quantity").alias("c"),
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        numbers.round_half_up(numbers.row_sum(["a", "b", "c"]), 2).alias("strict_sum"),
        numbers.round_half_up(numbers.row_sum(["a", "b", "c"], skip_null=True), 2).alias(
            "lenient_sum"
        ),
    )


@query(
    "E15",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_orderkey + l_partkey AS plus,
           l_orderkey - l_partkey AS minus, l_partkey * 2 AS times,
           l_orderkey // (l_linenumber + 2) AS whole, l_orderkey % (l_linenumber + 2) AS rest,
           l_orderkey / (l_linenumber + 2) AS ratio
    FROM lineitem
    """,
)
def arith_ops(t: Tables):
    """Integer division truncates; ``/`` keeps the fraction."""
    return t.spark.sql(
        "SELECT l_orderkey, l_linenumber, l_suppkey, l_orderkey + l_partkey AS plus,"
        " l_orderkey - l_partkey AS minus, l_partkey * 2 AS times,"
        " l_orderkey div (l_linenumber + 2) AS whole, l_orderkey % (l_linenumber + 2) AS rest,"
        " l_orderkey / (l_linenumber + 2) AS ratio FROM {lineitem}",
        lineitem=t.lineitem,
    )


@query(
    "E16",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_orderkey & l_partkey AS both_bits,
           l_orderkey | l_partkey AS any_bits
    FROM lineitem
    """,
)
def bit_ops(t: Tables):
    a, b = F.col("l_orderkey"), F.col("l_partkey")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        a.bitwiseAND(b).alias("both_bits"), a.bitwiseOR(b).alias("any_bits"),
    )


@query(
    "E17 E20",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey,
           CASE WHEN l_quantity > 30 THEN 'over 30' WHEN l_quantity = 30 THEN 'is 30' ELSE 'under 30' END AS band,
           CASE WHEN month(l_shipdate) IN (1, 2) THEN 'Winter' WHEN month(l_shipdate) IN (7, 8) THEN 'Summer' END AS season,
           CASE WHEN l_quantity >= 3 THEN 'Positive' ELSE 'Negative' END AS sign
    FROM lineitem
    """,
)
def case_label(t: Tables):
    q = F.col("l_quantity")
    seasons = {1: "Winter", 2: "Winter", 7: "Summer", 8: "Summer"}
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(q > 30, "over 30").when(q == 30, "is 30").otherwise("under 30").alias("band"),
        numbers.map_codes(F.month("l_shipdate"), seasons).alias("season"),
        F.when(q >= 3, "Positive").otherwise("Negative").alias("sign"),
    )


@query(
    "E18",
    """
    WITH r AS (
      SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber <> 4 THEN l_quantity END AS q
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey,
           CASE WHEN q IS NULL THEN 'Unknown' WHEN q < 10 THEN 'a' WHEN q < 20 THEN 'b' ELSE 'c' END AS left_closed,
           CASE WHEN q IS NULL THEN 'Unknown' WHEN q <= 10 THEN 'a' WHEN q <= 20 THEN 'b' ELSE 'c' END AS right_closed
    FROM r
    """,
)
def bucketize(t: Tables):
    """Edges fall into the upper or into the lower band."""
    q = F.when(F.col("l_linenumber") != 4, F.col("l_quantity"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        numbers.bucketize(q, [10, 20], ["a", "b", "c"]).alias("left_closed"),
        numbers.bucketize(q, [10, 20], ["a", "b", "c"], right_closed=True).alias("right_closed"),
    )

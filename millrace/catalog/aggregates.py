"""Grouped and global aggregates, sorting and limits."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import half_up, mean, mean_round, total
from millrace.functions.numbers import exact_mean, exact_sum, exact_total, floor_bin
from millrace.functions.numbers import mean_round as rounded_mean
from millrace.operators.sums import exact_sums
from millrace.functions.times import day_type
from millrace.operators import aggregates as agg
from millrace.operators.joins import count_by_dimension
from millrace.operators.tables import latest_snapshot
from millrace.operators.windows import running_by_period


@query(
    "A01",
    """
    SELECT count(*) AS parts, count(*) FILTER (p_retailprice > 950) AS dear,
           count(DISTINCT p_retailprice) AS prices
    FROM part
    """,
)
def agg_count(t: Tables):
    return t.part.agg(
        F.count(F.lit(1)).alias("parts"),
        F.count_if(F.col("p_retailprice") > 950).alias("dear"),
        F.count_distinct("p_retailprice").alias("prices"),
    )


@query("A02", "SELECT min(p_retailprice) AS lowest, max(p_retailprice) AS highest FROM part")
def agg_minmax(t: Tables):
    return t.part.agg(F.min("p_retailprice").alias("lowest"), F.max("p_retailprice").alias("highest"))


@query(
    "A03",
    f"""
    SELECT {total('l_quantity')} AS quantity,
           {total("CASE WHEN l_returnflag = 'R' THEN l_quantity END")} AS returned
    FROM lineitem
    """,
)
def agg_sum(t: Tables):
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    return t.lineitem.agg(
        exact_sum("l_quantity").alias("quantity"), exact_sum(returned).alias("returned")
    )


@query(
    "A03 A04",
    """
    SELECT l_returnflag, CAST(sum(CAST(round(l_extendedprice * 100) AS HUGEINT)
        * (CAST(1 AS HUGEINT) << ((l_linenumber - 1) * 10))) AS DOUBLE) / 1099511627776.0 AS total,
      count(*) AS n
    FROM lineitem WHERE l_linenumber < 4 GROUP BY l_returnflag
    """,
)
def sums_of_any_size(t: Tables):
    """Exact sums of values from 1e-9 to 1e13, of which the large ones cancel out."""
    size = F.pow(F.lit(2.0), ((F.col("l_linenumber") - 1) * 10 - 40).cast("double"))
    value = F.round(F.col("l_extendedprice") * 100) * size
    lines = t.lineitem.select("l_returnflag", "l_linenumber", value.alias("value"))
    both = F.when(F.col("l_linenumber") < 4, F.array("value")).otherwise(
        F.array(F.col("value"), -F.col("value"))
    )
    rows = lines.select("l_returnflag", "l_linenumber", F.explode(both).alias("value"))
    kept = F.when(F.col("l_linenumber") < 4, F.lit(1.0))
    sums = exact_sums(rows, ["l_returnflag"], {"total": "value", "n": kept})
    return sums.withColumn("n", F.col("n").cast("bigint"))


@query(
    "A04",
    f"""
    SELECT {mean('p_retailprice')} AS price,
           {mean("CASE WHEN p_type = 'PROMO' THEN p_retailprice END")} AS promo_price
    FROM part
    """,
)
def agg_avg(t: Tables):
    promo = F.when(F.col("p_type") == "PROMO", F.col("p_retailprice"))
    return t.part.agg(
        exact_mean("p_retailprice").alias("price"), exact_mean(promo).alias("promo_price")
    )


@query(
    "A05",
    f"""
    SELECT {mean('l_quantity')} AS avg_quantity, {mean('l_extendedprice')} AS avg_price,
           {mean('l_discount')} AS avg_discount
    FROM lineitem
    """,
)
def global_metrics(t: Tables):
    """Three means from one scan."""
    return t.lineitem.agg(
        exact_mean("l_quantity").alias("avg_quantity"),
        exact_mean("l_extendedprice").alias("avg_price"),
        exact_mean("l_discount").alias("avg_discount"),
    )


@query(
    "A06 O02",
    """
    SELECT c_nationkey, count(c_custkey) AS customers FROM customer
    GROUP BY c_nationkey ORDER BY customers DESC, c_nationkey
    """,
)
def group_count(t: Tables):
    counted = t.customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"))
    return counted.orderBy(F.desc("customers"), "c_nationkey")


@query(
    "A07",
    """
    SELECT c_mktsegment, count(o_orderkey) AS orders
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """,
)
def group_after_join(t: Tables):
    """Orders are counted per customer before the join."""
    counted = count_by_dimension(
        t.orders, t.customer, "o_custkey", "c_custkey", "c_mktsegment", "o_orderkey", "orders"
    )
    return counted


@query(
    "A08",
    """
    SELECT c_mktsegment, count(o_orderkey) AS orders
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY'
    GROUP BY c_mktsegment HAVING count(o_orderkey) > 25
    """,
)
def group_having(t: Tables):
    some = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    counted = count_by_dimension(
        t.orders, some, "o_custkey", "c_custkey", "c_mktsegment", "o_orderkey", "orders", "inner"
    )
    return counted.filter("orders > 25")


@query(
    "A08",
    """
    SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey
    HAVING count(*) > 12 ORDER BY orders DESC, o_custkey
    """,
)
def group_having_sorted(t: Tables):
    counted = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return counted.filter("orders > 12").orderBy(F.desc("orders"), "o_custkey")


@query(
    "A09",
    """
    SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS count FROM events
    GROUP BY 1 ORDER BY count DESC, hour
    """,
)
def peak_hours(t: Tables):
    counted = t.events.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), "hour")


@query(
    "A13 E09",
    f"""
    SELECT CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
           count(*) AS count, {mean('value')} AS avg_value
    FROM events GROUP BY 1
    """,
)
def day_type_analysis(t: Tables):
    return t.events.groupBy(day_type("ts").alias("day_type")).agg(
        F.count(F.lit(1)).alias("count"), exact_mean("value").alias("avg_value")
    )


@query(
    "A14 E13",
    f"""
    SELECT floor(value / 5) * 5 AS band, count(*) AS count, {mean_round('value')} AS avg_value
    FROM events GROUP BY 1 ORDER BY 1
    """,
)
def binned_analysis(t: Tables):
    band = floor_bin("value", 5).cast("double").alias("band")
    return (
        t.events.groupBy(band)
        .agg(F.count(F.lit(1)).alias("count"), rounded_mean("value").alias("avg_value"))
        .orderBy("band")
    )


@query(
    "A15 Y04",
    f"""
    SELECT {total('o_totalprice')} AS total_revenue, count(*) AS total_count,
           {mean_round('o_totalprice')} AS average_revenue
    FROM orders WHERE o_totalprice > 0
    """,
)
def revenue_summary(t: Tables):
    """Sum, count and mean in one pass, combined per task."""
    return t.orders.filter("o_totalprice > 0").agg(
        exact_sum("o_totalprice").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_count"),
        rounded_mean("o_totalprice").alias("average_revenue"),
    )


@query(
    "A16 O06 Y03 Y04",
    f"""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, count(*) AS orders,
           {total('o_totalprice')} AS revenue
    FROM orders GROUP BY 1 ORDER BY 1
    """,
)
def daily_metrics(t: Tables):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("revenue")
    )
    return daily.orderBy("d").select(F.col("d").cast("string").alias("date"), "orders", "revenue")


@query(
    "A20 O08",
    f"""
    SELECT l_partkey AS item, {mean_round('l_quantity', 1)} AS avg_rating
    FROM lineitem GROUP BY 1 ORDER BY 1
    """,
)
def rating_avg(t: Tables):
    """Mean per item; numeric order needs no zero padding."""
    rated = t.lineitem.groupBy(F.col("l_partkey").alias("item"))
    return rated.agg(rounded_mean("l_quantity", 1).alias("avg_rating")).orderBy("item")


@query(
    "A21",
    f"""
    SELECT l_suppkey AS item, count(*) AS n, {mean_round('l_quantity', 1)} AS avg_rating
    FROM lineitem GROUP BY 1
    """,
)
def rating_count_avg(t: Tables):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("item")).agg(
        F.count(F.lit(1)).alias("n"), rounded_mean("l_quantity", 1).alias("avg_rating")
    )


@query("A22 T08", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def value_counts(t: Tables):
    counted = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "event_type")


@query("A23", "SELECT p_type, p_brand, count(p_partkey) AS n FROM part GROUP BY 1, 2")
def group_two_keys(t: Tables):
    return t.part.groupBy("p_type", "p_brand").agg(F.count("p_partkey").alias("n"))


@query(
    "A24",
    """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F",
           count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P", 0 AS other
    FROM orders GROUP BY 1
    """,
)
def crosstab(t: Tables):
    return agg.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "A25",
    f"""
    SELECT p_type, p_size, {mean_round('p_retailprice')} AS mean_price FROM part GROUP BY 1, 2
    """,
)
def group_mean(t: Tables):
    return t.part.groupBy("p_type", "p_size").agg(rounded_mean("p_retailprice").alias("mean_price"))


@query(
    "A31 N01",
    f"""
    SELECT c_nationkey, {mean_round('c_acctbal')} AS top_mean
    FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r
          FROM customer)
    WHERE r <= 5 GROUP BY 1
    """,
)
def topn_group_mean(t: Tables):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return agg.top_n_mean(rows, ["c_nationkey"], "c_acctbal", "c_custkey", 5, "top_mean")


@query(
    "A32",
    f"""
    SELECT coalesce(o_orderstatus, 'TOTAL') AS o_orderstatus, count(*) AS orders,
           {total('o_totalprice')} AS revenue
    FROM orders GROUP BY ROLLUP (o_orderstatus)
    """,
)
def rollup_total(t: Tables):
    return agg.with_total_row(t.orders, "o_orderstatus", "orders", {"o_totalprice": "revenue"})


@query(
    "A33",
    f"""
    WITH s AS (
      SELECT l_returnflag, sum(l_quantity) AS u,
             CAST(sum(CAST(l_quantity * 12.5 AS DECIMAL(18,4))) AS DOUBLE) AS sp,
             CAST(sum(CAST(l_quantity * (l_discount * 100) AS DECIMAL(18,4))) AS DOUBLE) AS pr
      FROM lineitem GROUP BY 1)
    SELECT l_returnflag, u AS units, {half_up('sp', 1)} AS spend, {half_up('(sp / u)', 1)} AS avg_price,
           {half_up('pr', 1)} AS total_profit, {half_up('(pr / u)', 1)} AS avg_profit_per_unit,
           {half_up('(pr / sp * 100)', 1)} AS avg_roi
    FROM s
    """,
)
def roi_summary(t: Tables):
    rows = t.lineitem.select(
        "l_returnflag", "l_quantity", F.lit(12.5).alias("price"),
        (F.col("l_discount") * 100).alias("profit"),
    )
    return agg.spend_summary(rows, "l_quantity", "price", "profit", ["l_returnflag"])


@query(
    "N03 E22",
    f"""
    WITH d AS (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS bought
      FROM orders GROUP BY 1, 2),
    r AS (
      SELECT *, sum(bought) OVER (PARTITION BY o_custkey ORDER BY day ROWS UNBOUNDED PRECEDING) AS upto FROM d)
    SELECT o_custkey, CAST(day AS VARCHAR) AS day, CAST(bought AS DOUBLE) AS bought,
           CAST(upto AS DOUBLE) AS cumulative, greatest(0, 1000000 - CAST(upto AS DOUBLE)) AS remaining
    FROM r
    """,
)
def remaining_target(t: Tables):
    """Bought so far and still open after each day.

    Orders are first summed per customer and day, so a customer's group is
    bounded by the calendar.
    """
    daily = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(
        exact_total("o_totalprice").alias("bought")
    )
    upto = running_by_period(daily, ["o_custkey"], "day", "bought", "upto")
    done = F.col("upto").cast("double")
    return upto.select(
        "o_custkey",
        F.col("day").cast("string").alias("day"),
        F.col("bought").cast("double").alias("bought"),
        done.alias("cumulative"),
        F.greatest(F.lit(0.0), 1000000 - done).alias("remaining"),
    )


@query("O01", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey")
def sort_asc(t: Tables):
    return t.part.select("p_partkey", "p_retailprice").orderBy("p_retailprice", "p_partkey")


@query(
    "O02",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey",
)
def sort_desc(t: Tables):
    rows = t.customer.select("c_custkey", "c_acctbal")
    return rows.orderBy(F.desc_nulls_last("c_acctbal"), "c_custkey")


@query(
    "O03",
    """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS city, n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    ORDER BY CASE WHEN city IS NULL THEN n_name ELSE city END, c_custkey
    """,
)
def sort_case(t: Tables):
    """Sorted by city, or by country where the city is unknown."""
    city = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = joined.select("c_custkey", city.alias("city"), "n_name")
    return rows.orderBy(F.coalesce("city", "n_name"), "c_custkey")


@query(
    "O04 X04",
    """
    (SELECT 'first' AS side, p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 5)
    UNION ALL
    (SELECT 'last', p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey DESC LIMIT 5)
    """,
)
def limit_n(t: Tables):
    """First and last rows of an order, each without a full sort."""
    rows = t.part.select("p_partkey", "p_retailprice")
    first = rows.orderBy("p_retailprice", "p_partkey").limit(5)
    last = rows.orderBy(F.desc("p_retailprice"), F.desc("p_partkey")).limit(5)
    return first.select(F.lit("first").alias("side"), "*").union(
        last.select(F.lit("last").alias("side"), "*")
    )


@query(
    "S18",
    """
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS snapshot_date
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS r FROM orders)
    WHERE r = 1
    """,
)
def snapshot_latest(t: Tables):
    """Newest archived row per key; the later order wins within a day."""
    rows = t.orders.select(
        "o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("snapshot_date")
    )
    newest = latest_snapshot(rows, "o_custkey", "snapshot_date")
    return newest.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))

"""Predicates; all of them reach the scan unless they need a join or a cast."""

from datetime import date

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.functions.times import month_range, seconds_between, within
from millrace.operators.joins import lookup


@query(
    "F01",
    """
    SELECT p_partkey, p_retailprice, p_retailprice = 950 AS eq, p_retailprice <> 950 AS ne,
           p_retailprice < 950 AS lt, p_retailprice >= 950 AS ge
    FROM part WHERE p_retailprice > 905 AND p_retailprice <= 990
    """,
)
def filter_compare(t: Tables):
    p = F.col("p_retailprice")
    return t.part.filter((p > 905) & (p <= 990)).select(
        "p_partkey", p, (p == 950).alias("eq"), (p != 950).alias("ne"),
        (p < 950).alias("lt"), (p >= 950).alias("ge"),
    )


@query(
    "F02",
    """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    WHERE (c_mktsegment = 'BUILDING' AND c_acctbal > 0)
       OR (c_mktsegment = 'MACHINERY' AND NOT c_nationkey = 3)
    """,
)
def filter_bool(t: Tables):
    building = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0)
    machinery = (F.col("c_mktsegment") == "MACHINERY") & ~(F.col("c_nationkey") == 3)
    return t.customer.filter(building | machinery).select(
        "c_custkey", "c_mktsegment", "c_acctbal"
    )


@query(
    "F03",
    """
    SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') AND c_nationkey NOT IN (1, 2, 3)
    """,
)
def filter_in(t: Tables):
    return t.customer.filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE")
        & ~F.col("c_nationkey").isin(1, 2, 3)
    ).select("c_custkey", "c_mktsegment", "c_nationkey")


@query(
    "F04",
    """
    SELECT p_partkey, p_retailprice, p_size FROM part
    WHERE p_retailprice BETWEEN 910 AND 980 AND p_size NOT BETWEEN 10 AND 20
      AND p_type IN ('SMALL', 'LARGE', 'PROMO')
    """,
)
def filter_between(t: Tables):
    return t.part.filter(
        F.col("p_retailprice").between(910, 980)
        & ~F.col("p_size").between(10, 20)
        & F.col("p_type").isin("SMALL", "LARGE", "PROMO")
    ).select("p_partkey", "p_retailprice", "p_size")


@query(
    "F05",
    """
    SELECT p_partkey, p_name FROM part
    WHERE p_name BETWEEN 'green' AND 'red ring' AND p_name NOT BETWEEN 'large bolt' AND 'large nut'
    ORDER BY p_name, p_partkey
    """,
)
def filter_between_text(t: Tables):
    return (
        t.part.filter(
            F.col("p_name").between("green", "red ring")
            & ~F.col("p_name").between("large bolt", "large nut")
        )
        .select("p_partkey", "p_name")
        .orderBy("p_name", "p_partkey")
    )


@query(
    "F06",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-07-01' AND DATE '1996-07-31'
    """,
)
def filter_date_range(t: Tables):
    """Written on the raw time, so that it prunes row groups."""
    july = within("o_orderdate", date(1996, 7, 1), date(1996, 8, 1))
    return t.orders.filter(july).select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day")
    )


@query(
    "F07",
    """
    SELECT p_partkey, p_name, p_name ILIKE 'S%' AS starts, p_name ILIKE '%BOLT' AS ends,
           p_name ILIKE '%or%' AS holds, p_name ILIKE '_e%' AS second, p_name ILIKE 'b%g' AS both_ends,
           p_name ILIKE 'r__%' AS three_or_more, p_name ILIKE 'Red Ring' AS whole
    FROM part WHERE p_name ILIKE '%R%' OR p_name NOT ILIKE 's%'
    """,
)
def filter_like(t: Tables):
    """Case-insensitive patterns."""
    name = F.col("p_name")
    patterns = {
        "starts": "S%", "ends": "%BOLT", "holds": "%or%", "second": "_e%", "both_ends": "b%g",
        "three_or_more": "r__%", "whole": "Red Ring",
    }
    return t.part.filter(name.ilike("%R%") | ~name.ilike("s%")).select(
        "p_partkey", "p_name", *[name.ilike(p).alias(k) for k, p in patterns.items()]
    )


@query(
    "F08",
    """
    SELECT p_partkey, p_name FROM part WHERE p_name GLOB '[bspBSP]*' OR p_name GLOB '[a-fA-F]*'
    """,
)
def filter_glob(t: Tables):
    """Character classes, case-sensitive."""
    return t.part.filter(F.col("p_name").rlike("^[bspBSP]") | F.col("p_name").rlike("^[a-fA-F]")).select(
        "p_partkey", "p_name"
    )


@query(
    "F09",
    """
    SELECT documents.doc_id, quality IS NOT NULL AS labelled
    FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id
    WHERE quality IS NULL OR lang = 'de'
    """,
)
def filter_null(t: Tables):
    joined = lookup(t.documents, t.labels, "doc_id", "doc_id", {"quality": "quality"})
    return joined.filter(F.col("quality").isNull() | (F.col("lang") == "de")).select(
        "doc_id", F.col("quality").isNotNull().alias("labelled")
    )


@query(
    "F10",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey,
           CAST(date_diff('second', o_orderdate, l_shipdate) AS BIGINT) AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate > o_orderdate AND l_extendedprice > 0
      AND l_extendedprice * (1 - l_discount) >= 0
    """,
)
def sanity_filter(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.filter(
        (F.col("l_shipdate") > F.col("o_orderdate"))
        & (F.col("l_extendedprice") > 0)
        & (F.col("l_extendedprice") * (1 - F.col("l_discount")) >= 0)
    ).select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        seconds_between("o_orderdate", "l_shipdate").alias("seconds"),
    )


@query(
    "F11",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 1
    """,
)
def filter_calendar(t: Tables):
    """One month as a range on the raw column."""
    return t.orders.filter(month_range("o_orderdate", 1997, 1)).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "F12 E06",
    r"""
    WITH coded AS (
      SELECT event_id, event_type,
             CASE WHEN event_type = 'error' THEN 'n/a' ELSE regexp_extract(props, '[0-9]+', 0) END AS v
      FROM events)
    SELECT event_id, event_type, TRY_CAST(v AS DOUBLE) AS v FROM coded
    WHERE TRY_CAST(v AS DOUBLE) IS NOT NULL
    """,
)
def skip_bad_rows(t: Tables):
    """Rows whose value is no number are left out."""
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.get_json_object("props", "$.k")
    )
    parsed = t.events.select("event_id", "event_type", text.try_cast("double").alias("v"))
    return parsed.filter(F.col("v").isNotNull())


@query(
    "F14",
    """
    SELECT c_custkey, r_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'ASIA'
    """,
)
def exclude_sentinel(t: Tables):
    """A null label fails the comparison too, so the outer joins become inner."""
    joined = t.customer.join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.filter(F.col("r_name") != "ASIA").select("c_custkey", "r_name")


@query(
    "F16",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000",
)
def filter_param(t: Tables):
    """Values are bound, never formatted into the text."""
    return t.spark.sql(
        "SELECT c_custkey, c_name FROM {customer}"
        " WHERE c_mktsegment = :segment AND c_acctbal > :balance",
        args={"segment": "BUILDING", "balance": 1000},
        customer=t.customer,
    )

"""Row changes as snapshots, copies and upserts."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.operators import tables
from millrace.operators.joins import outer_to_many
from millrace.sources.sinks import write_table
from millrace.storage import fresh_path


@query(
    "D01",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL VALUES (-1, 'Cardinal', 7, NULL, NULL), (-2, 'Skagen', NULL, 12.5, NULL)
    """,
)
def insert_rows(t: Tables):
    """Two new rows; columns that are not given become null."""
    new = t.spark.createDataFrame(
        [(-1, "Cardinal", 7, None), (-2, "Skagen", None, 12.5)],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    )
    return tables.insert_rows(t.customer, new)


@query(
    "D02",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE c_name END AS c_name,
           CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal
    FROM customer
    """,
)
def update_rows(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    changes = {"c_name": F.lit("overdrawn"), "c_acctbal": F.lit(0.0)}
    return tables.update_rows(rows, F.col("c_acctbal") < 0, changes)


@query("D03", "SELECT c_custkey, c_name FROM customer WHERE NOT c_mktsegment = 'BUILDING'")
def delete_rows(t: Tables):
    rows = tables.delete_rows(t.customer, F.col("c_mktsegment") == "BUILDING")
    return rows.select("c_custkey", "c_name")


@query(
    "D04 D06",
    "SELECT c_name, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey",
)
def ctas_copy(t: Tables):
    """A join stored as a table, replacing an older copy."""
    t.spark.sql("DROP TABLE IF EXISTS millrace_customer_orders")
    joined = outer_to_many(t.customer, t.orders, "c_custkey", "o_custkey")
    write_table(
        joined.select("c_name", "o_orderkey"),
        "millrace_customer_orders",
        fresh_path(t.spark, "table"),
    )
    return t.spark.table("millrace_customer_orders")


@query(
    "D05",
    """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
    UNION ALL
    SELECT NULL, s_name, s_nationkey, NULL FROM supplier WHERE s_acctbal > 0
    """,
)
def insert_select(t: Tables):
    """Some columns of another table appended."""
    base = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    new = t.supplier.filter("s_acctbal > 0").select(
        F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey")
    )
    return tables.insert_rows(base, new)


@query(
    "D07",
    """
    WITH ch AS (SELECT s_suppkey * 3 AS k, s_name, s_acctbal FROM supplier)
    SELECT coalesce(k, c_custkey) AS c_custkey, CASE WHEN k IS NOT NULL THEN s_name ELSE c_name END AS c_name,
           CASE WHEN k IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer FULL JOIN ch ON c_custkey = k
    """,
)
def upsert_rows(t: Tables):
    """Changed where the key exists, appended where it does not."""
    base = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    changes = t.supplier.select(
        (F.col("s_suppkey") * 3).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return tables.upsert_rows(base, changes, "c_custkey")

"""Set operations and samples."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.operators.sampling import bernoulli_sample, sample_per_class


@query("U01", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(t: Tables):
    return t.customer.select("c_mktsegment").distinct()


@query(
    "U02",
    """
    SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000
    UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000 ORDER BY 1
    """,
)
def union_distinct(t: Tables):
    a = t.customer.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nationkey"))
    b = t.supplier.filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("nationkey"))
    return a.union(b).distinct().orderBy("nationkey")


@query(
    "U03",
    """
    SELECT c_nationkey AS nationkey FROM customer
    UNION ALL SELECT s_nationkey FROM supplier ORDER BY 1
    """,
)
def union_all(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("nationkey"))
    b = t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    return a.union(b).orderBy("nationkey")


@query(
    "U04 P07",
    """
    SELECT 'Customer' AS type, c_nationkey AS nationkey FROM customer
    UNION SELECT 'Supplier', s_nationkey FROM supplier
    """,
)
def union_tagged(t: Tables):
    a = t.customer.select(F.lit("Customer").alias("type"), F.col("c_nationkey").alias("nationkey"))
    b = t.supplier.select(F.lit("Supplier").alias("type"), F.col("s_nationkey").alias("nationkey"))
    return a.unionByName(b).distinct()


@query(
    "X01",
    """
    SELECT event_id, event_type FROM events
    WHERE ('0x' || substr(md5('42:' || event_id), 1, 7))::BIGINT < CAST(floor(0.1 * 268435456) AS BIGINT)
    """,
)
def hash_sample(t: Tables):
    """About 10 % of the events, the same ones on every run."""
    rows = t.events.select("event_id", "event_type")
    return bernoulli_sample(rows, "event_id", 0.1, seed=42)


@query(
    "N04 X02",
    """
    SELECT event_id, event_type
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('7:' || event_id), event_id) AS r
          FROM events)
    WHERE r <= 500
    """,
)
def stratified_sample(t: Tables):
    """500 events of every type."""
    rows = t.events.select("event_id", "event_type")
    return sample_per_class(rows, ["event_type"], "event_id", 500, seed=7)

"""Column selection, naming and derivation."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.functions import numbers
from millrace.functions.numbers import to_number
from millrace.operators.joins import membership_flags


@query("P01 F17", "SELECT c_name, c_mktsegment FROM customer WHERE TRUE")
def project_cols(t: Tables):
    return t.customer.filter(F.lit(True)).select("c_name", "c_mktsegment")


@query(
    "P02",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice
    FROM lineitem
    """,
)
def drop_cols(t: Tables):
    return t.lineitem.drop(
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "not_there"
    )


@query("P03", "SELECT p_partkey AS id, p_name AS product, p_brand, p_size FROM part")
def rename_cols(t: Tables):
    kept = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    return kept.withColumnsRenamed({"p_partkey": "id", "p_name": "product"})


@query("P04", 'SELECT p_partkey AS id, p_name AS "My Great Product" FROM part')
def alias_cols(t: Tables):
    text = "SELECT p_partkey id, p_name AS `My Great Product` FROM {part}"
    return t.spark.sql(text, part=t.part)


@query(
    "P05",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
    FROM lineitem
    """,
)
def derive_cols(t: Tables):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        revenue.alias("revenue"),
        (revenue * (1 + F.col("l_tax"))).alias("charge"),
    )


@query(
    "P06 E01",
    r"""
    WITH raw AS (
      SELECT event_id, regexp_extract(props, '[0-9]+', 0) AS k FROM events),
    coded AS (
      SELECT event_id, CASE WHEN k LIKE '%5' THEN 'T' WHEN k LIKE '%7' THEN 'M' ELSE k END AS reading
      FROM raw)
    SELECT event_id, reading,
           TRY_CAST(CASE WHEN reading = 'T' THEN '0' ELSE reading END AS DOUBLE) AS amount,
           CAST(floor(TRY_CAST(reading AS DOUBLE) / 10) AS INTEGER) AS tens
    FROM coded
    """,
)
def clean_numeric(t: Tables):
    """Readings in which T stands for 0 and M for missing."""
    k = F.get_json_object("props", "$.k")
    reading = F.when(k.endswith("5"), "T").when(k.endswith("7"), "M").otherwise(k)
    coded = t.events.select("event_id", reading.alias("reading"))
    return coded.select(
        "event_id",
        "reading",
        to_number("reading", marker="T").alias("amount"),
        (to_number("reading") / 10).cast("int").alias("tens"),
    )


@query(
    "P08",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status
    FROM orders
    """,
)
def map_codes(t: Tables):
    """Code to label; an unmapped code is null."""
    labels = {"F": "finished", "O": "open"}
    return t.orders.select("o_orderkey", numbers.map_codes("o_orderstatus", labels).alias("status"))


@query(
    "P09 J16",
    """
    WITH bridge AS (
      SELECT n_nationkey, r_name AS grp FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL
      SELECT n_nationkey, 'OLD WORLD' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AMERICA'),
    flags AS (
      SELECT n_nationkey,
             max(CASE WHEN grp = 'ASIA' THEN 1 ELSE 0 END) AS asia,
             max(CASE WHEN grp = 'EUROPE' THEN 1 ELSE 0 END) AS europe,
             max(CASE WHEN grp = 'OLD WORLD' THEN 1 ELSE 0 END) AS old_world
      FROM bridge GROUP BY n_nationkey)
    SELECT c_custkey, c_nationkey, coalesce(asia, 0) AS asia, coalesce(europe, 0) AS europe,
           coalesce(old_world, 0) AS old_world
    FROM customer LEFT JOIN flags ON c_nationkey = n_nationkey
    """,
)
def membership_onehot(t: Tables):
    """Flags from overlapping groups; the bridge is pivoted before it is joined."""
    by_region = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    old = by_region.filter("r_name <> 'AMERICA'")
    bridge = by_region.select("n_nationkey", F.col("r_name").alias("grp")).unionByName(
        old.select("n_nationkey", F.lit("OLD WORLD").alias("grp"))
    )
    groups = {"ASIA": "asia", "EUROPE": "europe", "OLD WORLD": "old_world"}
    customers = t.customer.select("c_custkey", "c_nationkey")
    return membership_flags(customers, bridge, "c_nationkey", "n_nationkey", "grp", groups)


@query(
    "P11 Y01",
    """
    SELECT p_partkey,
           CASE WHEN p_type = 'PROMO' THEN 'promo ' ELSE '' END || CAST(p_size AS VARCHAR) AS tag
    FROM part
    """,
)
def concat_label(t: Tables):
    flag = F.when(F.col("p_type") == "PROMO", "promo ").otherwise("")
    return t.part.select("p_partkey", F.concat(flag, F.col("p_size").cast("string")).alias("tag"))

"""Joins and subqueries."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.functions.numbers import exact_sum
from millrace.operators.reconcile import differences
from millrace.operators import joins


@query(
    "J01 J02 P10",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, sn.n_name AS pu_nation, cn.n_name AS do_nation
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    """,
)
def join_role_playing(t: Tables):
    """The nation table once as origin and once as destination."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    orders = joins.lookup(orders, t.customer, "o_custkey", "c_custkey", {"c_nationkey": "_do"})
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    rows = joins.lookup(rows, t.supplier, "l_suppkey", "s_suppkey", {"s_nationkey": "_pu"})
    rows = joins.lookup(rows, t.nation, "_pu", "n_nationkey", {"n_name": "pu_nation"})
    rows = joins.lookup(rows, t.nation, "_do", "n_nationkey", {"n_name": "do_nation"})
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", "pu_nation", "do_nation")


@query(
    "J03 J04",
    """
    WITH ship AS (
      SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipped FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CAST(day AS VARCHAR) AS day, shipped
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) LEFT JOIN ship ON d = day
    """,
)
def join_day_dim(t: Tables):
    """Facts with a day table; year, month and day are one date key."""
    ship = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("shipped")
    )
    facts = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    joined = facts.join(ship, F.col("d") == F.col("day"), "left")
    return joined.select("o_orderkey", F.col("day").cast("string").alias("day"), "shipped")


@query(
    "J05",
    """
    SELECT o_orderkey, c_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders INNER JOIN customer ON o_custkey = c_custkey
    """,
)
def join_inner(t: Tables):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", F.to_date("o_orderdate").cast("string").alias("day")
    )


@query(
    "J06",
    """
    SELECT o_orderkey, c_name, n_name FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """,
)
def join_three(t: Tables):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_name", "n_name")
    )


@query(
    "J07",
    """
    SELECT c_name, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    ORDER BY c_name, o_orderkey
    """,
)
def join_left(t: Tables):
    joined = joins.outer_to_many(t.customer, t.orders, "c_custkey", "o_custkey")
    return joined.select("c_name", "o_orderkey").orderBy("c_name", "o_orderkey")


@query(
    "J08",
    """
    SELECT o_orderkey, c_name, c_mktsegment
    FROM orders RIGHT JOIN customer ON o_custkey = c_custkey ORDER BY o_orderkey
    """,
)
def join_right(t: Tables):
    """All customers, with their orders: the left join seen from orders."""
    joined = joins.outer_to_many(t.customer, t.orders, "c_custkey", "o_custkey")
    return joined.select("o_orderkey", "c_name", "c_mktsegment").orderBy("o_orderkey", "c_name")


@query(
    "J09",
    """
    SELECT c_name, o_orderkey FROM (SELECT * FROM customer WHERE c_acctbal > 0)
    FULL OUTER JOIN (SELECT * FROM orders WHERE o_totalprice > 100000) ON c_custkey = o_custkey
    ORDER BY c_name
    """,
)
def join_full(t: Tables):
    """Either side may stay without a partner."""
    customers = t.customer.filter("c_acctbal > 0")
    orders = t.orders.filter("o_totalprice > 100000")
    joined = joins.outer_to_many(customers, orders, "c_custkey", "o_custkey", keep_many=True)
    return joined.select("c_name", "o_orderkey").orderBy("c_name", "o_orderkey")


@query(
    "J10",
    """
    SELECT a.c_custkey, a.c_nationkey, count(*) AS partners
    FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_custkey <> b.c_custkey
    GROUP BY a.c_custkey, a.c_nationkey
    """,
)
def join_self_neq(t: Tables):
    """How many other customers share a customer's nation.

    The self join itself lists every ordered pair, which grows with the square
    of the largest nation; counting needs group sizes only.
    """
    rows = t.customer.select("c_custkey", "c_nationkey")
    return joins.partner_counts(rows, "c_nationkey", "c_custkey")


@query(
    "J10",
    """
    WITH first AS (SELECT s_nationkey AS nk, min(s_suppkey) AS sk FROM supplier GROUP BY 1)
    SELECT a.s_nationkey, a.s_suppkey AS a_s_suppkey, a.s_name AS a_s_name,
           b.s_suppkey AS b_s_suppkey, b.s_name AS b_s_name
    FROM supplier a JOIN first ON a.s_suppkey = sk
    JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey
    """,
)
def join_self_pairs(t: Tables):
    """Pairs of each nation's first supplier with all others of the nation."""
    first = t.supplier.groupBy("s_nationkey").agg(
        F.min(F.struct("s_suppkey", "s_name")).alias("_first")
    )
    probe = first.select("s_nationkey", "_first.*")
    return joins.pairs_with(probe, t.supplier, "s_nationkey", "s_suppkey", ["s_name"])


@query(
    "J11",
    """
    SELECT s_name FROM supplier
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity = 50
                  AND l_discount > 0.09)
    """,
)
def semi_exists(t: Tables):
    """Distinct keys first, so that a hot supplier is one row in the join."""
    large = t.lineitem.filter("l_quantity = 50 AND l_discount > 0.09")
    large = large.select("l_suppkey").distinct()
    return t.supplier.join(large, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select(
        "s_name"
    )


@query(
    "J12",
    """
    SELECT p_partkey, p_name FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)
    """,
)
def semi_in(t: Tables):
    return t.spark.sql(
        "SELECT p_partkey, p_name FROM {part}"
        " WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM {lineitem} WHERE l_quantity > 49)",
        part=t.part,
        lineitem=t.lineitem,
    )


@query(
    "J13",
    """
    SELECT p_partkey, p_retailprice FROM part
    WHERE p_retailprice > (SELECT CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM part)
    """,
)
def scalar_subquery(t: Tables):
    mean = t.part.agg((exact_sum("p_retailprice") / F.count(F.lit(1))).alias("m")).scalar()
    return t.part.filter(F.col("p_retailprice") > mean).select("p_partkey", "p_retailprice")


@query(
    "J14",
    """
    SELECT doc_id, source FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """,
)
def anti_join(t: Tables):
    labelled = t.labels.select("doc_id").distinct()
    return t.documents.select("doc_id", "source").join(labelled, "doc_id", "left_anti")


@query(
    "J15",
    """
    WITH e AS (SELECT o_orderkey, CAST(floor(o_totalprice / 100000) AS BIGINT) AS expected FROM orders),
    a AS (SELECT l_orderkey,
                 CAST(floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 100000) AS BIGINT) AS actual
          FROM lineitem GROUP BY 1)
    SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, expected, actual,
           CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status,
           CASE WHEN o_orderkey IS NULL OR l_orderkey IS NULL THEN 'missing'
                WHEN expected <> actual THEN 'differs' END AS reason
    FROM e FULL JOIN a ON o_orderkey = l_orderkey
    """,
)
def reconcile(t: Tables):
    """Order totals against the sum of their lines, in steps of 100,000."""
    expected = t.orders.select("o_orderkey", F.floor(F.col("o_totalprice") / 100000).alias("e"))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.floor(exact_sum("l_extendedprice") / 100000).alias("a")
    )
    return joins.reconcile(expected, lines, "o_orderkey", "e", "a")


@query(
    "J15",
    """
    SELECT o_orderkey, o_totalprice AS expected, NULL::DOUBLE AS actual, 'missing' AS reason
    FROM orders WHERE o_orderkey % 100 = 7
    UNION ALL SELECT o_orderkey, o_totalprice, o_totalprice + 1, 'differs'
    FROM orders WHERE o_orderkey % 100 = 33
    UNION ALL SELECT o_orderkey, o_totalprice, NULL, 'differs' FROM orders WHERE o_orderkey % 100 = 66
    UNION ALL SELECT -o_orderkey, NULL, o_totalprice, 'missing' FROM orders WHERE o_orderkey % 100 = 2
    """,
)
def reconcile_tree(t: Tables):
    """Orders against a copy with changed, lost and added rows; the rest is not moved."""
    rest = F.col("o_orderkey") % 100
    price = F.when(rest == 33, F.col("o_totalprice") + 1).when(rest != 66, F.col("o_totalprice"))
    copy = t.orders.filter(rest != 7).select("o_orderkey", price.alias("o_totalprice"))
    added = t.orders.filter(rest == 2).select((-F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice")
    found = differences(t.orders, copy.unionByName(added), ["o_orderkey"], ["o_totalprice"])
    return found.select(
        "o_orderkey",
        F.col("expected.o_totalprice").alias("expected"),
        F.col("actual.o_totalprice").alias("actual"),
        "reason",
    )


@query(
    "J05 E19",
    """
    SELECT d.doc_id, n_chars + coalesce(quality, 0) * 10 AS points, coalesce(toxic, -1) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def null_default(t: Tables):
    """A document without a label counts as 0."""
    taken = {"quality": "quality", "toxic": "toxic"}
    joined = joins.lookup(t.documents, t.labels, "doc_id", "doc_id", taken)
    return joined.select(
        "doc_id",
        (F.col("n_chars") + F.coalesce("quality", F.lit(0)) * 10).alias("points"),
        F.coalesce("toxic", F.lit(-1)).alias("toxic"),
    )

"""Descriptive statistics."""

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import half_up
from millrace.functions.numbers import exact_sum, mean_round, round_half_up
from millrace.operators import stats
from millrace.operators.joins import lookup

_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PROFILED = ["l_quantity", "l_extendedprice", "l_discount"]


def _corr_sql() -> str:
    rows = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in _CORR
        for b in _CORR
    ]
    return " UNION ALL ".join(rows)


@query("A26", _corr_sql())
def corr_matrix(t: Tables):
    """All pairs from one scan."""
    return stats.correlation_matrix(t.lineitem, _CORR)


def _describe_sql() -> str:
    rows = []
    for c in _PROFILED:
        fields = {
            "mean": f"avg({c})",
            "std": f"stddev_samp({c})",
            "min": f"min({c})",
            "p25": f"quantile_cont({c}, 0.25)",
            "p50": f"quantile_cont({c}, 0.5)",
            "p75": f"quantile_cont({c}, 0.75)",
            "max": f"max({c})",
        }
        picked = ", ".join(f"{half_up(x, 4)} AS {k}" for k, x in fields.items())
        rows.append(f"SELECT '{c}' AS column_name, count({c}) AS count, {picked} FROM lineitem")
    return " UNION ALL ".join(rows)


@query("A27", _describe_sql())
def describe_numeric(t: Tables):
    """Exact quartiles without holding a column in one place."""
    out = stats.describe_numeric(t.lineitem, _PROFILED)
    rounded = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select(
        "column_name", "count", *[round_half_up(c, 4).alias(c) for c in rounded]
    )


def _categorical_sql() -> str:
    rows = []
    for c in ("o_orderstatus", "o_orderpriority", "o_clerk"):
        x = "CAST(o_custkey AS VARCHAR)" if c == "o_clerk" else c
        rows.append(
            f"(SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique_values,"
            f" arg_min(v, (-n, v)) AS top, max(n) AS freq"
            f" FROM (SELECT {x} AS v, count(*) AS n FROM orders GROUP BY 1))"
        )
    return " UNION ALL ".join(rows)


@query("A27", _categorical_sql())
def describe_categorical(t: Tables):
    rows = t.orders.withColumn("o_clerk", F.col("o_custkey").cast("string"))
    out = stats.describe_categorical(rows, ["o_orderstatus", "o_orderpriority", "o_clerk"])
    return out.withColumnRenamed("unique", "unique_values")


_NULLS = ["doc_id", "source", "quality", "toxic"]


@query(
    "A28",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS row_count
        FROM (SELECT d.doc_id, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
        """
        for c in _NULLS
    ),
)
def null_counts(t: Tables):
    taken = {"quality": "quality", "toxic": "toxic"}
    joined = lookup(t.documents, t.labels, "doc_id", "doc_id", taken)
    return stats.null_counts(joined.select(*_NULLS))


@query(
    "A29",
    f"""
    WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w, count(value) AS n FROM events),
    c AS (SELECT CAST(least(29, floor((value - lo) / w)) AS INTEGER) AS bin, count(*) AS n
          FROM events, e WHERE value IS NOT NULL GROUP BY 1),
    g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
    SELECT g.bin, {half_up('(lo + g.bin * w)', 6)} AS bin_start, coalesce(c.n, 0) AS n,
           {half_up('(coalesce(c.n, 0) / (e.n * w))', 9)} AS density
    FROM g LEFT JOIN c ON g.bin = c.bin, e
    """,
)
def histogram_density(t: Tables):
    out = stats.histogram(t.events, "value", 30)
    return out.select(
        "bin",
        round_half_up("bin_start", 6).alias("bin_start"),
        "n",
        round_half_up("density", 9).alias("density"),
    )


@query(
    "A29",
    f"""
    WITH v AS (SELECT p_size, count(*) AS k FROM part GROUP BY 1),
    e AS (SELECT min(k) AS lo, CAST(max(k) - min(k) AS DOUBLE) / 10 AS w FROM v),
    c AS (SELECT CAST(least(9, floor((k - lo) / w)) AS INTEGER) AS bin, count(*) AS n FROM v, e GROUP BY 1),
    g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10))
    SELECT g.bin, {half_up('(lo + g.bin * w)', 6)} AS bin_start, coalesce(c.n, 0) AS n
    FROM g LEFT JOIN c ON g.bin = c.bin, e
    """,
)
def histogram_of_counts(t: Tables):
    """Ten bins over how often each value occurs."""
    counts = t.part.groupBy("p_size").agg(F.count(F.lit(1)).alias("k"))
    out = stats.histogram(counts, "k", 10)
    return out.select("bin", round_half_up("bin_start", 6).alias("bin_start"), "n")


@query(
    "A30",
    f"""
    WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                      stddev_samp(value) * pow(count(value), -0.2) AS h FROM events),
    v AS (SELECT value AS x, count(*) AS k FROM events WHERE value IS NOT NULL GROUP BY 1),
    g AS (SELECT CAST(range AS INTEGER) AS point FROM range(21))
    SELECT point, {half_up('(lo + (hi - lo) * point / 20)', 6)} AS x,
           {half_up('(sum(k * exp(-pow((v.x - (lo + (hi - lo) * point / 20)) / h, 2) / 2)) / (n * h * sqrt(2 * pi())))', 9)} AS density
    FROM g, v, s GROUP BY point, lo, hi, n, h
    """,
)
def kde_grid(t: Tables):
    out = stats.density_curve(t.events, "value", 21)
    return out.select(
        "point", round_half_up("x", 6).alias("x"), round_half_up("density", 9).alias("density")
    )


@query(
    "A04",
    f"""
    SELECT p_size, {half_up('avg(p_retailprice / 7)', 4)} AS mean_share,
           {half_up('sum(p_retailprice / 7)', 3)} AS share
    FROM part GROUP BY 1
    """,
)
def mean_of_fractions(t: Tables):
    """Means and sums of values with many decimals."""
    share = F.col("p_retailprice") / 7
    return t.part.groupBy("p_size").agg(
        mean_round(share, 4).alias("mean_share"),
        round_half_up(exact_sum(share), 3).alias("share"),
    )

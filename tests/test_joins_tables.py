import pytest
from conftest import final_plan, values
from pyspark.sql import functions as F

from millrace.operators.reconcile import differences, differing_leaves
from millrace.operators import aggregates, joins, tables
from millrace.plans import economies


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, "Ana", "Berlin"), (2, "Bo", "Berlin"), (3, "Cy", "London"), (4, "Di", None)],
        "id int, name string, city string",
    )


def test_lookup_in_two_roles(spark):
    trips = spark.createDataFrame([(1, 2), (2, 9), (None, 1)], "pu int, do int")
    zones = spark.createDataFrame([(1, "Bronx"), (2, "Queens")], "id int, borough string")
    out = joins.lookup(trips, zones, "pu", "id", {"borough": "from"})
    out = joins.lookup(out, zones, "do", "id", {"borough": "to"})
    assert values(out, "from", "to") == [(None, "Bronx"), ("Bronx", "Queens"), ("Queens", None)]


def test_partner_counts_equal_the_self_join(customers):
    got = values(joins.partner_counts(customers, "city", "id"), "id", "partners")
    assert got == [(1, 1), (2, 1)]


def test_pairs_in_both_directions(customers):
    out = joins.pairs_with(customers, customers, "city", "id", ["name"])
    assert values(out, "a_name", "b_name", "city") == [
        ("Ana", "Bo", "Berlin"),
        ("Bo", "Ana", "Berlin"),
    ]


def test_reconcile_has_three_outcomes(spark):
    expected = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    actual = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 4)], "k string, v int")
    out = joins.reconcile(expected, actual, "k", "v", "v")
    assert values(out, "k", "status", "reason") == [
        ("a", "PASS", None),
        ("b", "FAIL", "differs"),
        ("c", "PASS", None),
        ("d", "FAIL", "missing"),
    ]


def test_differences_of_two_tables(spark):
    """Changed, lost and added rows, nulls and repeated keys; order does not matter."""
    base = [(f"k{i}", i % 7, None if i % 5 == 0 else i / 3) for i in range(2000)]
    base += [(None, 1, 1.0), ("rep", 1, 1.0), ("rep", 1, 1.0), ("rep", 2, None), ("even", 3, 3.0)]
    other = [(k, a, b) for k, a, b in base if k not in ("k17", "k400")]
    other = [(k, a, 9.5) if k in ("k30", "k31") else (k, a, b) for k, a, b in other]
    other += [("new", None, None), ("even", 3, 3.0)]
    other.remove(("rep", 1, 1.0))
    schema = "k string, a int, b double"
    left, right = (spark.createDataFrame(rows, schema) for rows in (base, other))
    found = differences(left, right.repartition(3), ["k"], ["a", "b"]).collect()
    shown = {
        r["k"]: (r["expected"] and tuple(r["expected"]), r["actual"] and tuple(r["actual"]), r["reason"])
        for r in found
    }
    assert len(found) == len(shown) and shown == {
        "k17": ((3, 17 / 3), None, "missing"), "k400": ((1, None), None, "missing"),
        "k30": ((2, None), (2, 9.5), "differs"), "k31": ((3, 31 / 3), (3, 9.5), "differs"),
        "new": (None, (None, None), "missing"), "rep": ((1, 1.0), None, "missing"),
        "even": (None, (3, 3.0), "missing"),
    }
    assert differences(left, left.repartition(5), ["k"], ["a", "b"]).collect() == []
    assert differences(left.limit(0), left.limit(0), ["k"], ["a", "b"]).collect() == []


def test_only_differing_leaves_are_compared(spark):
    rows = spark.range(20_000).select("id", (F.col("id") * 2).alias("v"))
    signed = rows.withColumn("sign", F.lit(1).cast("bigint")).union(
        rows.select("id", F.when(F.col("id") == 5, 0).otherwise(F.col("v")), F.lit(-1).cast("bigint"))
    )
    assert differing_leaves(signed, ["id"], ["v"]).count() == 1
    assert differing_leaves(signed.filter("id <> 5"), ["id"], ["v"]).count() == 0


def test_membership_in_several_groups(spark):
    entities = spark.createDataFrame([("Egypt",), ("Chad",), ("Fiji",)], "c string")
    bridge = spark.createDataFrame(
        [("Egypt", "African"), ("Egypt", "Arab"), ("Chad", "African")], "c string, g string"
    )
    flags = {"African": "african", "Arab": "arab"}
    out = joins.membership_flags(entities, bridge, "c", "c", "g", flags)
    assert values(out) == [("Chad", 1, 0), ("Egypt", 1, 1), ("Fiji", 0, 0)]


def test_count_by_dimension_counts_unmatched_under_null(spark):
    orders = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None)], "o int, s int")
    shippers = spark.createDataFrame([(7, "Speedy"), (9, "Idle")], "s int, name string")
    out = joins.count_by_dimension(orders, shippers, "s", "s", "name", "o", "orders")
    assert values(out) == [(None, 2), ("Speedy", 2)]


@pytest.mark.parametrize("keep_many, how", [(False, "left"), (True, "full")])
def test_outer_to_many_equals_the_outer_join(spark, keep_many, how):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, name string")
    many = spark.createDataFrame(
        [(10, 1), (11, 1), (12, 1), (13, 2), (14, 9), (15, None)], "id int, ref int"
    )
    plain = one.join(many, one["k"] == many["ref"], how)
    mine = joins.outer_to_many(one, many, "k", "ref", keep_many)
    assert mine.columns == plain.columns
    assert values(mine) == values(plain)


def test_hot_key_of_an_outer_join_is_split(spark):
    """With sort-merge joins and small thresholds AQE splits the hot partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        one = spark.range(1000).selectExpr("id AS k", "uuid() AS name")
        many = spark.range(0, 200000, 1, 16).selectExpr(
            "id", "if(id % 3 = 0, 7, hash(id) % 1000) AS ref", "md5(string(id)) AS x"
        )
        joined = joins.outer_to_many(one, many, "k", "ref")
        assert "isSkew=true" in final_plan(joined) or "skewed" in final_plan(joined)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_insert_update_delete(customers):
    new = customers.sparkSession.createDataFrame([("Ed", 9)], "name string, id bigint")
    more = tables.insert_rows(customers, new)
    assert more.schema == customers.schema
    assert (9, "Ed", None) in values(more)
    with pytest.raises(ValueError):
        tables.insert_rows(customers, customers.withColumnRenamed("city", "town"))
    moved = tables.update_rows(more, F.col("city") == "Berlin", {"city": F.lit("Bonn")})
    assert values(moved, "city") == [(None,), (None,), ("Bonn",), ("Bonn",), ("London",)]
    # An unknown city is neither equal nor unequal, so the row stays.
    assert tables.delete_rows(more, F.col("city") != "London").count() == 3


def test_upsert_is_idempotent(customers):
    changes = customers.sparkSession.createDataFrame(
        [(2, None), (7, "Rome")], "id int, city string"
    )
    once = tables.upsert_rows(customers, changes, "id")
    assert (2, "Bo", None) in values(once) and (7, None, "Rome") in values(once)
    assert values(tables.upsert_rows(once, changes, "id")) == values(once)
    assert tables.duplicate_keys(once, ["id"]).count() == 0


def test_latest_snapshot(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-03-01", 2), ("b", "2024-02-01", 3)]
    df = spark.createDataFrame(rows, "k string, day string, v int")
    out = tables.latest_snapshot(df, "k", "day")
    assert values(out, "k", "day", "v") == [("a", "2024-03-01", 2), ("b", "2024-02-01", 3)]


def test_top_n_mean_equals_the_union_of_branches(spark):
    rng = [("x", i, float(i * 7 % 13)) for i in range(20)] + [("y", 1, 4.0), ("y", 2, None)]
    df = spark.createDataFrame(rng, "g string, id int, v double")
    branches = None
    for g in ("x", "y"):
        top = df.filter(F.col("g") == g).orderBy(F.desc_nulls_last("v"), "id").limit(5)
        one = top.agg(F.round(F.avg("v"), 2).alias("m")).select(F.lit(g).alias("g"), "m")
        branches = one if branches is None else branches.union(one)
    assert values(aggregates.top_n_mean(df, ["g"], "v", "id", 5, "m")) == values(branches)


def test_total_row(spark):
    df = spark.createDataFrame([("a", 1.1), ("a", 2.2), (None, 3.3)], "k string, v double")
    out = aggregates.with_total_row(df, "k", "n", {"v": "sum"})
    assert values(out) == [(None, 1, 3.3), ("TOTAL", 3, 6.6), ("a", 2, 3.3)]


def test_spend_summary_without_purchases_is_zero(spark):
    df = spark.createDataFrame([(0, 10.0, 1.0)], "buy int, price double, profit double")
    out = aggregates.spend_summary(df, "buy", "price", "profit").first()
    assert tuple(out) == (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_economies(spark):
    head = "<tr><th>h1</th></tr><tr><th>h2</th></tr><tr><td>World</td><td>1</td></tr>"
    body = (
        "<tr><td><a>Egypt</a></td><td>395,926</td><td>x</td></tr>"
        "<tr><td>Chad</td><td>18,700</td></tr><tr><td>Cuba</td><td>—</td></tr>"
    )
    pages = spark.createDataFrame([(1, f"<table>{head}{body}</table>")], "page_id int, html string")
    member = spark.createDataFrame(
        [("Egypt", "African"), ("Egypt", "Arab"), ("Chad", "African"), ("Cuba", "Latin")],
        "Country string, region string",
    )
    table = economies.transform(economies.extract(pages), member)
    ordered = [tuple(r)[:4] for r in economies.largest_first(table).collect()]
    assert ordered == [
        ("Egypt", 395.93, 1, 1), ("Chad", 18.7, 1, 0), ("Cuba", None, 0, 0),
    ]
    assert values(economies.over(table, 100)) == [("Egypt", 395.93)]
    assert values(economies.region_means(table)) == [
        ("African", 207.32), ("Arab", 395.93), ("Latin", None),
    ]


def test_plans_of_subqueries_and_filters(spark, folder):
    from millrace.catalog import REGISTRY

    assert "LeftSemi" in final_plan(REGISTRY["semi_exists"].run(spark, folder))
    assert "LeftSemi" in final_plan(REGISTRY["semi_in"].run(spark, folder))
    assert "LeftAnti" in final_plan(REGISTRY["anti_join"].run(spark, folder))
    inner = final_plan(REGISTRY["exclude_sentinel"].run(spark, folder))
    assert "LeftOuter" not in inner and "Inner" in inner
    pruned = final_plan(REGISTRY["filter_calendar"].run(spark, folder))
    assert "GreaterThanOrEqual(o_orderdate" in pruned and "LessThan(o_orderdate" in pruned


def test_upsert_with_repeated_changes(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(1, "x"), (1, "y"), (3, None), (3, "z")], "k int, v string")
    assert values(tables.upsert_rows(table, changes, "k")) == [(1, "y"), (2, "b"), (3, "z")]

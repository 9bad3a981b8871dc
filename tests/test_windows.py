"""Ranked, running and sampled groups, with a hot group."""

import random
from collections import Counter, defaultdict

import pytest
from conftest import final_plan, values
from pyspark.sql import functions as F

from millrace.operators import sampling, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one key; some keys are null."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((i, key, float(rng.randint(0, 40)), rng.randint(0, 5)))
    return spark.createDataFrame(rows, "id bigint, k string, price double, n bigint").repartition(5)


def brute_running(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["k"]].append(r)
    out = {}
    for members in groups.values():
        total = 0
        for r in sorted(members, key=lambda r: (r["price"], r["id"])):
            total += r["n"]
            out[r["id"]] = total
    return out


@pytest.mark.parametrize("partitions", [None, 1, 23])
def test_running_total(skewed, partitions):
    out = windows.running_total(skewed, ["k"], ["price", "id"], "n", "upto", partitions)
    assert out.columns == [*skewed.columns, "upto"]
    got = {r["id"]: r["upto"] for r in out.collect()}
    assert got == brute_running(skewed.collect())


def test_running_total_over_the_whole_table(skewed):
    out = windows.running_total(skewed, [], ["id"], "n", "upto", 11)
    total = 0
    for r in sorted(out.collect(), key=lambda r: r["id"]):
        total += r["n"]
        assert r["upto"] == total


def test_running_total_keeps_rows_without_value(spark):
    df = spark.createDataFrame(
        [("x", 1, None), ("x", 2, 5), ("x", 3, None), ("y", 1, None)], "k string, i int, n int"
    )
    out = windows.running_total(df, ["k"], ["i"], "n", "upto", 3)
    assert values(out, "k", "i", "upto") == [("x", 1, 0), ("x", 2, 5), ("x", 3, 5), ("y", 1, 0)]


def test_hot_group_is_summed_by_many_tasks(spark):
    hot = spark.range(100000).select(F.lit("hot").alias("k"), "id", F.lit(1).alias("n"))
    out = windows.running_total(hot, ["k"], ["id"], "n", "upto", 16)
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 4
    assert out.agg(F.max("upto"), F.sum("upto")).first() == (100000, 100000 * 100001 // 2)


def test_top_n_is_limited_before_the_shuffle(skewed):
    out = windows.top_n(skewed, ["k"], [F.col("price").desc(), F.col("id")], 3)
    assert "WindowGroupLimit" in final_plan(out)
    rows = skewed.collect()
    for key in {r["k"] for r in rows}:
        best = sorted((r for r in rows if r["k"] == key), key=lambda r: (-r["price"], r["id"]))[:3]
        mine = [r["id"] for r in out.collect() if r["k"] == key]
        assert sorted(mine) == sorted(r["id"] for r in best)


@pytest.mark.parametrize("n", [1, 100, 600, 5000])
def test_sample_per_class_is_exact_and_repeatable(skewed, n):
    sizes = Counter(r["k"] for r in skewed.collect())
    first = sampling.sample_per_class(skewed, ["k"], "id", n, seed=1)
    again = sampling.sample_per_class(skewed.repartition(3), ["k"], "id", n, seed=1)
    assert Counter(r["k"] for r in first.collect()) == {k: min(n, v) for k, v in sizes.items()}
    assert values(first) == values(again)


def test_bernoulli_sample(spark):
    df = spark.range(20000)
    some = sampling.bernoulli_sample(df, "id", 0.1, seed=42)
    assert 1800 < some.count() < 2200
    assert values(some) == values(sampling.bernoulli_sample(df.repartition(9), "id", 0.1, 42))
    assert values(some) != values(sampling.bernoulli_sample(df, "id", 0.1, seed=43))

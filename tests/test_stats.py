import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import stats


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(5)
    return [float(rng.choice([rng.gauss(0, 9), 4.0, 4.0])) for _ in range(997)]


@pytest.fixture(scope="module")
def frame(spark, numbers):
    rows = [(x, float(i % 7) if i % 5 else None) for i, x in enumerate(numbers)]
    return spark.createDataFrame(rows, "a double, b double").repartition(6)


def test_describe_numeric(frame, numbers):
    out = stats.describe_numeric(frame, ["a", "b"])
    got = {r["column_name"]: r for r in out.collect()}
    b = [float(i % 7) for i in range(997) if i % 5]
    for name, data in (("a", numbers), ("b", b)):
        r = got[name]
        assert r["count"] == len(data)
        assert math.isclose(r["mean"], statistics.fmean(data), rel_tol=1e-12)
        assert math.isclose(r["std"], statistics.stdev(data), rel_tol=1e-12)
        quartiles = np.quantile(data, [0.25, 0.5, 0.75])
        assert np.allclose([r["p25"], r["p50"], r["p75"]], quartiles, rtol=1e-12)
        assert (r["min"], r["max"]) == (min(data), max(data))


def test_describe_numeric_of_one_value(spark):
    one = stats.describe_numeric(spark.createDataFrame([(2.5,)], "x double"), ["x"]).first()
    assert (one["count"], one["p25"], one["p75"], one["std"]) == (1, 2.5, 2.5, None)


@pytest.mark.parametrize("most, accuracy", [(100_000, 10_000), (50, 10_000), (50, 100)])
def test_ranges_are_narrowed_again(spark, monkeypatch, most, accuracy):
    """The same quartiles however coarse the sketch and however small a range must be."""
    monkeypatch.setattr(stats, "_MOST_VALUES", most)
    monkeypatch.setattr(stats, "_ACCURACY", accuracy)
    df = spark.range(300_000).selectExpr("cast(pmod(hash(id), 1000003) as double) AS x")
    got = stats.describe_numeric(df, ["x"]).first()
    want = np.quantile(df.toPandas()["x"], [0.25, 0.5, 0.75])
    assert [got["p25"], got["p50"], got["p75"]] == list(want)


@pytest.mark.parametrize("n", [2, 3, 4, 5])
def test_quartiles_of_few_values(spark, n):
    data = [float(i * i) for i in range(n)]
    got = stats.describe_numeric(spark.createDataFrame([(x,) for x in data], "x double"), ["x"])
    r = got.first()
    assert [r["p25"], r["p50"], r["p75"]] == list(np.quantile(data, [0.25, 0.5, 0.75]))


def test_describe_numeric_without_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    got = stats.describe_numeric(empty, ["x"]).first()
    assert (got["count"], got["mean"], got["p50"]) == (0, None, None)


def test_describe_categorical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    got = stats.describe_categorical(df, ["x"]).first()
    assert tuple(got) == ("x", 4, 2, "a", 2)


def test_histogram_integrates_to_one(frame, numbers):
    rows = sorted(stats.histogram(frame, "a", 30).collect(), key=lambda r: r["bin"])
    counts, edges = np.histogram(numbers, bins=30)
    assert [r["n"] for r in rows] == list(counts)
    width = edges[1] - edges[0]
    assert math.isclose(sum(r["density"] for r in rows) * width, 1.0, rel_tol=1e-9)


def test_histogram_of_one_value(spark):
    rows = stats.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert sorted((r["bin"], r["n"]) for r in rows) == [(0, 2), (1, 0), (2, 0), (3, 0)]


def test_density_curve(frame, numbers):
    rows = sorted(stats.density_curve(frame, "a", 9).collect(), key=lambda r: r["point"])
    h = statistics.stdev(numbers) * len(numbers) ** -0.2
    for r in rows:
        want = sum(math.exp(-(((x - r["x"]) / h) ** 2) / 2) for x in numbers)
        want /= len(numbers) * h * math.sqrt(2 * math.pi)
        assert math.isclose(r["density"], want, rel_tol=1e-9)


def test_correlation_matrix(frame):
    got = {(r["a"], r["b"]): r["r"] for r in stats.correlation_matrix(frame, ["a", "b"]).collect()}
    assert got["a", "a"] == got["b", "b"] == 1.0
    assert got["a", "b"] == got["b", "a"]
    known = frame.filter("b IS NOT NULL").toPandas()
    assert math.isclose(got["a", "b"], round(known["a"].corr(known["b"]), 6), abs_tol=1e-6)


def test_null_counts(frame):
    got = {r["column_name"]: (r["nulls"], r["row_count"]) for r in stats.null_counts(frame).collect()}
    assert got == {"a": (0, 997), "b": (frame.filter(F.col("b").isNull()).count(), 997)}

import math
import random
import struct
from fractions import Fraction

import pytest
from conftest import values
from pyspark.sql import functions as F

from millrace.functions import numbers as n
from millrace.functions import times
from millrace.operators.sums import exact_sums


def column(spark, rows, kind="double"):
    return spark.createDataFrame([(r,) for r in rows], f"x {kind}")


def test_half_up_is_symmetric(spark):
    df = column(spark, [0.125, -0.125, 2.5, -2.5, None])
    out = df.select(n.round_half_up("x", 2).alias("a"), n.round_half_up("x").alias("b"))
    assert values(out) == [(None, None), (-2.5, -3.0), (-0.13, -0.0), (0.13, 0.0), (2.5, 3.0)]


def test_exact_sum_is_independent_of_the_order(spark):
    cents = [0.1, 0.2, 0.3, -0.07, 1e9 + 0.01, -1e9] * 1000
    for parts in (1, 7):
        df = column(spark, cents).repartition(parts)
        got = df.agg(n.exact_sum("x").alias("s"), n.mean_round("x", 4).alias("m")).first()
        assert got == (540.0, 0.09)


def test_exact_sum_survives_amounts_a_long_of_cents_would_not(spark):
    df = column(spark, [4e15 + 0.5] * 40)
    assert df.agg(n.exact_total("x").alias("s")).first()["s"] == 160000000000000020


def test_dirty_numbers(spark):
    df = column(spark, ["T", " T ", "0.5", "M", "", None, "1T"], "string")
    got = [r[0] for r in df.select(n.to_number("x", marker="T")).collect()]
    assert got == [0.0, 0.0, 0.5, None, None, None, None]


def test_thousands(spark):
    df = column(spark, ["1,234,567", " 90 ", "—", "n/a", None], "string")
    got = [r[0] for r in df.select(n.parse_thousands("x")).collect()]
    assert got == [1234.57, 0.09, None, None, None]


def test_buckets_at_their_edges(spark):
    df = column(spark, [0.99, 1.0, 2.0, 2.01, None])
    left = [r[0] for r in df.select(n.bucketize("x", [1, 2], ["a", "b", "c"])).collect()]
    right = df.select(n.bucketize("x", [1, 2], ["a", "b", "c"], right_closed=True)).collect()
    assert left == ["a", "b", "c", "c", "Unknown"]
    assert [r[0] for r in right] == ["a", "a", "b", "c", "Unknown"]


def test_unknown_sorts_last(spark):
    df = column(spark, ["Unknown", "c", "a", "b"], "string")
    order = [r[0] for r in df.orderBy(n.bucket_rank("x", ["a", "b", "c"])).collect()]
    assert order == ["a", "b", "c", "Unknown"]


def test_units_and_labels(spark):
    df = column(spark, [32.0, 50.0, 68.0, 86.0])
    assert [r[0] for r in df.select(n.fahrenheit_to_celsius("x")).collect()] == [0, 10, 20, 30]
    assert column(spark, [10.0]).select(n.miles_to_km("x")).first()[0] == 16.09
    codes = column(spark, ["HV0003", "HV0004"], "string")
    assert [r[0] for r in codes.select(n.map_codes("x", {"HV0003": "Uber"})).collect()] == [
        "Uber",
        None,
    ]


def test_row_sum_with_and_without_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, c double")
    got = df.select(n.row_sum(["a", "b", "c"]), n.row_sum(["a", "b", "c"], skip_null=True)).first()
    assert tuple(got) == (None, 3.0)


def test_dates_from_text_parts(spark):
    df = spark.createDataFrame(
        [("2024", "01", "31"), ("2024", "2", "30"), ("2024", "x", "1")],
        "y string, m string, d string",
    )
    got = [r[0] for r in df.select(times.date_from_parts("y", "m", "d").cast("string")).collect()]
    assert got == ["2024-01-31", None, None]


def test_day_type_and_month_range(spark):
    days = ["2024-01-31", "2024-02-01", "2024-02-02", "2024-02-03", "2024-02-04", "2024-02-05"]
    df = spark.createDataFrame([(d,) for d in days], "s string").withColumn("d", F.to_date("s"))
    kinds = [r[0] for r in df.select(times.day_type("d")).collect()]
    assert kinds == ["weekday"] * 3 + ["weekend"] * 2 + ["weekday"]
    assert df.filter(times.month_range("d", 2024, 1)).count() == 1
    assert df.filter(times.month_range("d", 2023, 12)).count() == 0
    assert df.filter(times.year_range("d", 2024)).count() == 6


def test_minutes(spark):
    df = column(spark, [89, 90, 119], "bigint")
    got = df.select(times.minutes("x"), times.minutes("x", truncate=True)).collect()
    assert [tuple(r) for r in got] == [(1.0, 1.0), (2.0, 1.0), (2.0, 1.0)]


def test_values_are_not_rounded_before_they_are_summed(spark):
    df = spark.createDataFrame([(0.005,), (0.004,), (1.234,), (1.234,), (None,)], "x double")
    row = df.agg(n.exact_mean("x").alias("m"), n.mean_round("x", 3).alias("r")).first()
    assert (row["m"], row["r"]) == (0.61925, 0.619)


def test_odd_values_count_as_in_plain_sums(spark):
    def mean(*values):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        return df.agg(n.exact_mean("x").alias("m")).first()["m"]

    assert str(mean(1, "nan", 3)) == "nan"
    assert mean(1, "inf") == float("inf")
    assert mean(1e300, 1) == 5e299
    rounded = spark.createDataFrame([(1e17,), (float("inf"),), (-2.345,)], "x double")
    got = [r[0] for r in rounded.select(n.round_half_up("x", 2)).collect()]
    assert got == [1e17, float("inf"), -2.35]


def test_parts_below_a_millionth_are_not_lost(spark):
    tiny = column(spark, [1e-7] * 1000 + [4e-7, 1e-9, 2.5])
    got = tiny.agg(n.exact_sum("x").alias("s")).first()["s"]
    assert got == pytest.approx(2.500100401, rel=1e-15)
    parts = n.split_total("x")
    for extra, want in ((float("nan"), "nan"), (float("inf"), "inf"), (1e300, "1e+300")):
        df = column(spark, [1.25, extra])
        row = df.agg(parts[0].alias("d"), parts[1].alias("o")).first()
        assert float(row["d"]) == 1.25 and str(row["o"]) == want
    assert column(spark, [1.25, 0.1]).agg(parts[1].alias("o")).first()["o"] is None


def _doubles(rng, kind):
    if kind == "any":
        x = math.nan
        while not math.isfinite(x):
            x = struct.unpack("<d", rng.randbytes(8))[0]
        return x
    return {
        "amounts": lambda: round(rng.uniform(-1e4, 1e4), 2),
        "tiny": lambda: rng.uniform(-1, 1) * 10.0 ** rng.randint(-323, -290),
        "mixed": lambda: rng.uniform(-1, 1) * 10.0 ** rng.randint(-20, 20),
        "cancelling": lambda: rng.choice([1e300, -1e300, 1.0, 2.0**-1074, 1e16, 0.1, -1e16]),
        "large": lambda: rng.choice([1.7e308, -1.7e308, 9e307]),
        "halves": lambda: rng.choice([1.0, 2.0**-53, 2.0**-54, -(2.0**-53), 2.0**-105]),
    }[kind]()


def test_sums_of_any_doubles(spark):
    """The nearest double to the rational sum, however the rows are dealt."""
    rng = random.Random(11)
    kinds = ["any", "amounts", "tiny", "mixed", "cancelling", "large", "halves"]
    rows = [
        (g, _doubles(rng, kinds[g % 7]))
        for g in range(140)
        for _ in range(rng.choice([1, 2, 3, 30, 200]))
    ]
    want = {}
    for g, x in rows:
        want[g] = want.get(g, Fraction(0)) + Fraction(x)

    def nearest(f):
        try:
            return float(f)
        except OverflowError:
            return math.inf if f > 0 else -math.inf

    df = spark.createDataFrame(rows, "g int, x double")
    for parts in (1, 7):
        got = exact_sums(df.repartition(parts), ["g"], {"s": "x", "t": -F.col("x")}).collect()
        assert {r["g"]: r["s"] for r in got} == {g: nearest(f) for g, f in want.items()}
        assert all(r["t"] == -r["s"] for r in got)


def test_odd_sums(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, nan), (1, 1.0), (2, inf), (2, 1.0), (3, None), (4, 0.0), (4, -0.0), (5, inf), (5, -inf), (None, 1.5)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r["g"]: str(r["x"]) for r in exact_sums(df, ["g"], {"x": "x"}).collect()}
    assert got == {1: "nan", 2: "inf", 3: "None", 4: "0.0", 5: "nan", None: "1.5"}
    assert exact_sums(df.limit(0), ["g"], {"x": "x"}).collect() == []


def test_sums_split_their_rows_without_lambdas(spark):
    """Lambdas are interpreted per row: before the first aggregate only columns of plain code."""
    sums = exact_sums(spark.range(3).selectExpr("id % 2 AS g", "id * 0.1D AS x"), ["g"], {"x": "x"})
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [" in plan
    assert "lambda" not in plan.rsplit("Aggregate [", 1)[1].split("\n", 1)[1]

"""Planning against plain loops over small schedules."""

import math
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from millrace.operators import planning as ops
from millrace.plans import procurement

SCHEMA = "scenario string, idx int, supply bigint, base_price double, target bigint, noise double"
WEEK = [2, 1, 4, 6, 3, 5, 3]


def half_up(x, digits):
    return math.copysign(math.floor(abs(x) * 10**digits + 0.5) / 10**digits, x)


def price(base, supply, peak, noise):
    return half_up(base * (1 - 0.08 * (math.log(1 + supply) / math.log(1 + peak))) * (1 + noise), 1)


def fill(days, target):
    """days: (price, idx, supply) -> idx to bought, cheapest first."""
    bought = {}
    for _, idx, supply in sorted(days):
        bought[idx] = min(supply, target)
        target -= bought[idx]
    return bought


@pytest.fixture(scope="module")
def week(spark):
    rows = [("w", i, s, 1500.0, 10, 0.0) for i, s in enumerate(WEEK)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(8)
    rows = []
    for k in range(25):
        for i in range(rng.randint(1, 9)):
            rows.append(
                (f"s{k}", i, rng.randint(1, 6), 1000.0 + 10 * k, rng.randint(0, 1) * 12 + 3,
                 round(rng.gauss(0, 0.03), 4))
            )
    first = {r[0]: r[4] for r in rows}
    return spark.createDataFrame([(*r[:4], first[r[0]], r[5]) for r in rows], SCHEMA)


def by_scenario(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["scenario"], []).append(r)
    return {k: sorted(v, key=lambda r: r["idx"]) for k, v in out.items()}


def test_default_week(week):
    plan = procurement.baseline(week)
    assert values(plan, "idx", "buy") == [
        (0, 0), (1, 0), (2, 0), (3, 6), (4, 0), (5, 4), (6, 0),
    ]
    day = plan.filter("idx = 3").first()
    # 10 wanted of 24: the pressure is low and the spread decides the highest bid.
    assert (day["exp_price"], day["multiplier"], day["open_bid"]) == (1380.0, 0.97, 1338.6)
    assert (day["cap_bid"], day["cap_from_spread"]) == (1352.0, True)
    assert (day["sale_price"], day["reg_cost"], day["total_additional_cost"]) == (1518.0, 96.6, 111.6)
    assert day["unit_profit"] == 26.4
    summary = procurement.plan_summary(plan).first()
    assert summary["units"] == 10.0
    assert summary["spend"] == half_up(6 * 1380.0 + 4 * price(1500.0, 5, 6, 0), 1)


def test_pressure_limits(spark):
    df = spark.createDataFrame([(x,) for x in (0.44, 0.45, 0.6, 0.75)], "r double")
    got = df.select(ops.pressure_multiplier("r"), ops.risk_band("r")).collect()
    assert [tuple(r) for r in got] == [
        (0.97, "low"), (1.0, "medium"), (1.05, "high"), (1.1, "very high"),
    ]


def test_plan_against_loop(many):
    plan = by_scenario(procurement.baseline(many))
    for days in plan.values():
        peak = max(d["supply"] for d in days)
        offers = [(price(d["base_price"], d["supply"], peak, d["noise"]), d["idx"], d["supply"]) for d in days]
        assert [d["exp_price"] for d in days] == [o[0] for o in offers]
        assert {d["idx"]: d["buy"] for d in days} == fill(offers, days[0]["target"])
        total = sum(d["supply"] for d in days)
        assert sum(d["buy"] for d in days) == min(total, days[0]["target"])
        assert all(0 <= d["buy"] <= d["supply"] for d in days)


@pytest.fixture(scope="module")
def bought(many):
    """Entries that are missing, valid and too large."""
    kept = many.filter("pmod(hash(scenario, idx), 4) <> 0")
    return kept.select("scenario", "idx", F.expr("pmod(hash(idx, scenario), supply + 2)").alias("bought"))


def test_actuals_are_validated(many, bought):
    got = ops.with_actuals(many, bought)
    assert got.count() == many.count()
    entered = {(r["scenario"], r["idx"]): r["bought"] for r in bought.collect()}
    assert any(r["bought"] > r["supply"] for r in many.join(bought, ["scenario", "idx"]).collect())
    for r in got.collect():
        n = entered.get((r["scenario"], r["idx"]), 0)
        assert r["bought"] == (n if n <= r["supply"] else 0)


def test_rolling_replan_against_loop(many, bought):
    known = ops.with_actuals(many, bought)
    replanned = by_scenario(ops.rolling_replan(known))
    for scenario, days in by_scenario(known).items():
        left = days[0]["target"]
        for pos, (day, mine) in enumerate(zip(days, replanned[scenario])):
            rest = days[pos:]
            peak = max(d["supply"] for d in rest)
            offers = [(price(d["base_price"], d["supply"], peak, d["noise"]), d["idx"], d["supply"]) for d in rest]
            assert mine["remaining_target"] == left
            assert mine["remaining_supply"] == sum(d["supply"] for d in rest)
            assert mine["days_left"] == len(rest)
            assert mine["exp_price"] == offers[0][0]
            assert mine["planned"] == fill(offers, left)[day["idx"]]
            left = max(0, left - day["bought"])


def test_replan_from_a_period(many, bought):
    known = ops.with_actuals(many, bought)
    plan = by_scenario(ops.replan_from(known, 3))
    for scenario, days in by_scenario(known).items():
        rest = [d for d in days if d["idx"] >= 3]
        if not rest:
            assert scenario not in plan
            continue
        left = max(0, days[0]["target"] - sum(d["bought"] for d in days if d["idx"] < 3))
        peak = max(d["supply"] for d in rest)
        offers = [(price(d["base_price"], d["supply"], peak, d["noise"]), d["idx"], d["supply"]) for d in rest]
        assert {d["idx"]: d["buy"] for d in plan[scenario]} == fill(offers, left)


def test_lots_of_a_hot_scenario(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"c{i % 7}", i, rng.randint(1, 20) / 2, rng.randint(1, 4), 500) for i in range(2000)]
    df = spark.createDataFrame(rows, "s string, i int, p double, n bigint, t bigint").repartition(4)
    got = ops.greedy_lots(df, "s", "p", ["i"], "n", "t")
    for s in {r[0] for r in rows}:
        want = fill([(r[2], r[1], r[3]) for r in rows if r[0] == s], 500)
        assert {r["i"]: r["buy"] for r in got.filter(F.col("s") == s).collect()} == want


def test_plan_against_actual(week):
    actual = week.sparkSession.createDataFrame([("w", 3, 6), ("w", 5, 5)], "scenario string, idx int, bought bigint")
    got = procurement.compare(week, actual).first()
    assert (got["units"], got["units_diff"], got["achieved"]) == (11.0, 1.0, True)
    planned = 6 * 1380.0 + 4 * price(1500.0, 5, 6, 0)
    # From the day after the peak on, five units are the largest supply left.
    spent = 6 * 1380.0 + 5 * price(1500.0, 5, 5, 0)
    assert got["spend_diff"] == half_up(half_up(planned, 1) - half_up(spent, 1), 1)


def test_schedule_without_supply(spark):
    df = spark.createDataFrame([("z", 0, 0, 100.0, 5, 0.0)], SCHEMA)
    day = procurement.baseline(df).first()
    assert (day["buy"], day["exp_price"], day["multiplier"]) == (0, 100.0, 1.1)
    known = df.withColumn("bought", F.lit(0).cast("bigint"))
    assert ops.rolling_replan(known).first()["planned"] == 0


@pytest.mark.parametrize("shape", ["random", "rising", "falling"])
def test_long_schedules(spark, shape):
    """Several blocks and runs of one peak, against the loop."""
    rng = random.Random(3)
    n = {"random": 300, "rising": 200, "falling": 150}[shape]
    supply = [rng.randint(1, 40) for _ in range(n)]
    if shape != "random":
        supply.sort(reverse=shape == "falling")
    rows = [("s", i, q, 100.0, 60, rng.randint(-9, 9) / 100, rng.randint(0, 1)) for i, q in enumerate(supply)]
    df = spark.createDataFrame(rows, SCHEMA + ", bought bigint").repartition(5)
    got = {r["idx"]: r for r in ops.rolling_replan(df).collect()}
    left = 60
    for i, (_, _, q, base, _, noise, bought) in enumerate(rows):
        peak = max(supply[i:])
        offers = [(price(base, r[2], peak, r[5]), r[1], r[2]) for r in rows[i:]]
        assert got[i]["planned"] == fill(offers, left)[i]
        assert (got[i]["remaining_supply"], got[i]["days_left"]) == (sum(supply[i:]), n - i)
        left = max(0, left - bought)


def test_replan_spreads_its_rows_by_their_number(spark, monkeypatch):
    """Tasks hold so many rows, not a fixed share of the table; results stay."""
    from millrace.operators import windows

    rows = [(s, i, 1 + (s * 7 + i * 5) % 9, 1000.0 + i, 10, 0.0, s % 2) for s in range(40) for i in range(s + 45)]
    kind = "scenario long, idx int, supply long, base_price double, target long, noise double, bought long"
    df = spark.createDataFrame(rows, kind)
    want = sorted(map(tuple, ops.rolling_replan(df).collect()))
    monkeypatch.setattr(windows, "_TASK_ROWS", 32)
    many = ops.rolling_replan(df)
    assert many.rdd.getNumPartitions() >= len(rows) // 32
    assert sorted(map(tuple, many.collect())) == want
    short = df.filter("idx < 40")
    assert ops.rolling_replan(short).rdd.getNumPartitions() >= short.count() // 32

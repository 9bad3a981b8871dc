"""Procurement planning over schedules of many scenarios at once.

A schedule has one row per scenario and period::

    scenario, idx (order of the periods), supply, base_price, target, noise

``noise`` is the relative price deviation of the period; 0 when unknown.  The
periods of a scenario are calendar steps, so windows over a scenario are
bounded by the calendar however many records were aggregated into them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import ratio_or_zero, round_half_up
from millrace.operators.windows import running_total, spread
from millrace.storage import materialize


@dataclass(frozen=True)
class Terms:
    """Fixed values of the pricing model."""

    sensitivity: float = 0.08
    open_factor: float = 0.97
    min_spread: float = 0.01
    registration_rate: float = 0.07
    commoditisation: float = 10.0
    transport: float = 5.0
    margin: float = 0.10


DEFAULT_TERMS = Terms()

# Periods of a schedule that are compared inside a row.
_BLOCK_BITS = 6
_BLOCK = 1 << _BLOCK_BITS

# Upper limits of the fill ratio, bid multiplier, risk band.
PRESSURE = [(0.45, 0.97, "low"), (0.60, 1.00, "medium"), (0.75, 1.05, "high")]
PRESSURE_TOP = (1.10, "very high")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _by_pressure(ratio: Column, position: int) -> Column:
    out = F
    for row in PRESSURE:
        out = out.when(ratio < row[0], F.lit(row[position]))
    return out.otherwise(F.lit(PRESSURE_TOP[position - 1]))


def pressure_multiplier(ratio: Column | str) -> Column:
    """Factor on the expected price allowed for the highest bid."""
    return _by_pressure(_c(ratio), 1)


def risk_band(ratio: Column | str) -> Column:
    return _by_pressure(_c(ratio), 2)


def expected_price(
    base: Column | str,
    supply: Column | str,
    max_supply: Column | str,
    noise: Column | str,
    terms: Terms = DEFAULT_TERMS,
) -> Column:
    """Price falls with the logarithm of the supply, relative to its peak."""
    return _price(
        _c(base), F.log(1 + _c(supply)), F.log(1 + _c(max_supply)), _c(noise), terms
    )


def _price(base: Column, scaled: Column, peak: Column, noise: Column, terms: Terms) -> Column:
    share = F.when(peak > 0, scaled / peak).otherwise(F.lit(0.0))
    return round_half_up(base * (1 - terms.sensitivity * share) * (1 + noise), 1)


def with_prices(schedule: DataFrame, terms: Terms = DEFAULT_TERMS) -> DataFrame:
    """Adds ``exp_price`` using the scenario's largest supply."""
    peak = F.max("supply").over(Window.partitionBy("scenario"))
    price = expected_price("base_price", "supply", F.col("_peak"), "noise", terms)
    return (
        schedule.withColumn("_peak", peak).withColumn("exp_price", price).drop("_peak")
    )


def bid_columns(multiplier: Column, terms: Terms = DEFAULT_TERMS) -> dict[str, Column]:
    """Opening bid, highest bid, and whether the minimum spread decided it."""
    p = F.col("exp_price")
    open_bid = round_half_up(p * terms.open_factor, 1)
    raw, floor = p * multiplier, open_bid * (1 + terms.min_spread)
    return {
        "open_bid": open_bid,
        "cap_bid": round_half_up(F.greatest(raw, floor), 1),
        "cap_from_spread": raw <= floor,
    }


def cost_columns(terms: Terms = DEFAULT_TERMS) -> dict[str, Column]:
    """Sale price, costs and profit of one unit bought at the expected price."""
    p = F.col("exp_price")
    sale = round_half_up(p * (1 + terms.margin), 1)
    registration = round_half_up(p * terms.registration_rate, 1)
    fixed = F.lit(terms.commoditisation + terms.transport)
    return {
        "sale_price": sale,
        "reg_cost": registration,
        "fixed_cost": fixed,
        "total_additional_cost": registration + fixed,
        "unit_profit": round_half_up(sale - p - (registration + fixed), 1),
    }


def with_bids(schedule: DataFrame, terms: Terms = DEFAULT_TERMS) -> DataFrame:
    """Prices, pressure, bids and unit economics of the whole schedule."""
    total = F.sum("supply").over(Window.partitionBy("scenario"))
    # A schedule without any supply counts as one unit.
    ratio = F.col("target") / F.when(total == 0, 1).otherwise(total)
    priced = with_prices(schedule, terms).withColumn("fill_ratio", ratio)
    priced = priced.withColumn("multiplier", pressure_multiplier("fill_ratio"))
    return priced.withColumns(bid_columns(F.col("multiplier"), terms)).withColumns(
        cost_columns(terms)
    )


def _filled(supply: Column, target: Column, upto: Column) -> Column:
    return F.greatest(F.lit(0), F.least(supply, target - (upto - supply)))


def greedy_plan(priced: DataFrame) -> DataFrame:
    """Adds ``buy``: cheapest period first, ties in period order."""
    cheapest = (
        Window.partitionBy("scenario")
        .orderBy("exp_price", "idx")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.sum("supply").over(cheapest)
    return (
        priced.withColumn("_upto", upto)
        .withColumn("buy", _filled(F.col("supply"), F.col("target"), F.col("_upto")))
        .drop("_upto")
    )


def greedy_lots(
    lots: DataFrame, scenario: str, price: str, tiebreak: list[str], supply: str, target: str
) -> DataFrame:
    """Greedy allocation over single lots, where a scenario may hold any number.

    Same rule as :func:`greedy_plan`; the running supply is taken over many
    tasks because one scenario may own most of the lots.
    """
    filled = running_total(lots, [scenario], [price, *tiebreak], supply, "_upto")
    return filled.withColumn(
        "buy", _filled(F.col(supply), F.col(target), F.col("_upto"))
    ).drop("_upto")


def with_actuals(schedule: DataFrame, actuals: DataFrame) -> DataFrame:
    """Adds ``bought``; a period without an entry counts as 0.

    Entries outside 0..supply are rejected, which also leaves 0.
    """
    rows = schedule.count()
    side = actuals.select(
        F.col("scenario").alias("_s"), F.col("idx").alias("_i"), F.col("bought").alias("_b")
    )
    on = (F.col("scenario") == F.col("_s")) & (F.col("idx") == F.col("_i"))
    valid = F.when(F.col("_b").between(F.lit(0), F.col("supply")), F.col("_b"))
    return (
        spread(schedule, rows, "scenario", "idx")
        .join(spread(side, rows, "_s", "_i"), on, "left")
        .withColumn("bought", F.coalesce(valid, F.lit(0)).cast("bigint"))
        .drop("_s", "_i", "_b")
    )


def _later() -> Window:
    """A period and all after it, as a running frame from the last one back."""
    return (
        Window.partitionBy("scenario")
        .orderBy(F.desc("idx"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def remaining(schedule: DataFrame) -> DataFrame:
    """State at the start of each period: what is still to buy and to come."""
    past = (
        Window.partitionBy("scenario").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("bought").over(past), F.lit(0))
    return schedule.withColumns(
        {
            "remaining_target": F.greatest(F.lit(0), F.col("target") - before),
            "remaining_supply": F.sum("supply").over(_later()),
            "peak_supply": F.max("supply").over(_later()),
            "days_left": F.count(F.lit(1)).over(_later()),
        }
    )


def _cheaper_nearby(state: DataFrame, terms: Terms) -> Column:
    """Supply of the cheaper later periods of the same block, inside the row."""
    rest = (
        Window.partitionBy("scenario", "_block")
        .orderBy(F.desc("idx"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    listed = F.collect_list(F.struct("supply", "base_price", "noise", "_scaled")).over(rest)
    none = F.lit(0).cast("bigint")
    return F.aggregate(
        listed,
        none,
        lambda total, d: total
        + F.when(
            _price(d["base_price"], d["_scaled"], F.col("_peak"), d["noise"], terms)
            < F.col("exp_price"),
            d["supply"],
        ).otherwise(none),
    )


def _cheaper_beyond(state: DataFrame, terms: Terms) -> DataFrame:
    """``scenario, idx, _beyond``: supply of the cheaper periods of later blocks.

    Prices depend on the peak of what remains, which is the same for a run of
    periods, so every run prices the periods after its start once.  Of two
    periods the bits of their positions tell at which halving they part: there
    the earlier one asks and the later one answers, and one running sum by
    price serves a whole half.  Rows: runs times periods times halvings.
    """
    long = state.filter(F.col("_periods") > _BLOCK)
    # At most so many rows are sorted below: runs times periods times halvings.
    each = long.groupBy("scenario", "_periods").agg(F.countDistinct("peak_supply").alias("runs"))
    levels = F.ceil(F.log2(F.col("_periods"))) - _BLOCK_BITS + 1
    rows = each.agg(F.sum(F.col("runs") * F.col("_periods") * levels)).first()[0] or 0
    runs = long.groupBy(F.col("scenario").alias("_s"), F.col("peak_supply").alias("_run")).agg(
        F.min("_pos").alias("_first"), F.max("_pos").alias("_end")
    )
    priced = long.join(
        runs, (F.col("scenario") == F.col("_s")) & (F.col("_pos") >= F.col("_first"))
    )
    peak = F.log(1 + F.col("_run"))
    price = _price(F.col("base_price"), F.col("_scaled"), peak, F.col("noise"), terms)
    highest = F.ceil(F.log2(F.col("_periods"))).cast("int")
    halvings = priced.select(
        "scenario",
        "idx",
        "supply",
        "_run",
        "_pos",
        "_end",
        F.round(price * 10).cast("bigint").alias("_tenths"),
        F.explode(F.sequence(F.lit(_BLOCK_BITS), highest)).alias("_bit"),
    )
    half = F.floor(F.col("_pos") / F.pow(F.lit(2.0), F.col("_bit"))).cast("bigint")
    block = F.floor(half / 2)
    answers = half % 2 == 1
    starts = block * F.pow(F.lit(2.0), F.col("_bit") + 1)
    useful = (answers & (starts <= F.col("_end"))) | (~answers & (F.col("_pos") <= F.col("_end")))
    halves = halvings.filter(useful).withColumns({"_half": block, "_answers": answers})
    halves = spread(halves, rows, "scenario", "_run", "_bit", "_half")
    below = (
        Window.partitionBy("scenario", "_run", "_bit", "_half")
        .orderBy("_tenths")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    offered = F.sum(F.when(F.col("_answers"), F.col("supply")).otherwise(0)).over(below)
    asked = halves.withColumn("_below", offered).filter(~F.col("_answers"))
    return asked.groupBy("scenario", "idx").agg(F.sum("_below").alias("_beyond"))


def rolling_replan(schedule: DataFrame, terms: Terms = DEFAULT_TERMS) -> DataFrame:
    """Decision at the start of every period, re-planned from what was bought.

    Needs ``bought`` and one row per scenario and period.  Prices use the peak
    of the remaining schedule; the planned purchase of the period is what the
    cheapest-first rule leaves for it once all cheaper later periods are used.
    Inside a block of a few periods the later ones are looked at in the row;
    those of later blocks, where a scenario has any, come from running sums by
    price.  Rows are counted first and spread by their number over the tasks.
    """
    whole = Window.partitionBy("scenario")
    known = schedule.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"))
    rows, longest = known.agg(F.sum("n"), F.max("n")).first()
    rows = rows or 0
    # The logarithms are taken once per period, not once per pair of periods.
    scaled = schedule.withColumn("_scaled", F.log(1 + F.col("supply")))
    placed = remaining(spread(scaled, rows, "scenario")).withColumns(
        {
            "_pos": F.row_number().over(whole.orderBy("idx")) - 1,
            "_periods": F.count(F.lit(1)).over(whole),
            "_peak": F.log(1 + F.col("peak_supply")),
        }
    )
    state = placed.withColumn("_block", F.floor(F.col("_pos") / _BLOCK))
    if (longest or 0) > _BLOCK:
        # Read three times below; the windows run once.
        state = spread(materialize(state, "replan-state"), rows, "scenario")
    today = _price(F.col("base_price"), F.col("_scaled"), F.col("_peak"), F.col("noise"), terms)
    now = state.withColumn("exp_price", today)
    now = now.withColumn("_nearby", _cheaper_nearby(now, terms))
    if (longest or 0) > _BLOCK:
        beyond = spread(_cheaper_beyond(state, terms), rows, "scenario", "idx")
        now = spread(now, rows, "scenario", "idx").join(beyond, ["scenario", "idx"], "left")
    else:
        now = now.withColumn("_beyond", F.lit(None).cast("bigint"))
    cheaper = F.col("_nearby") + F.coalesce("_beyond", F.lit(0))
    ratio = F.col("remaining_target") / F.greatest(F.lit(1), F.col("remaining_supply"))
    return (
        now.withColumn("fill_ratio", ratio)
        .withColumn("multiplier", pressure_multiplier("fill_ratio"))
        .withColumns(bid_columns(F.col("multiplier"), terms))
        .withColumn(
            "planned",
            F.greatest(F.lit(0), F.least(F.col("supply"), F.col("remaining_target") - cheaper)),
        )
        .withColumn("risk", risk_band("fill_ratio"))
        .drop(
            "_nearby", "_beyond", "_scaled", "_peak", "_pos", "_periods", "_block", "peak_supply"
        )
    )


def replan_from(schedule: DataFrame, start: int, terms: Terms = DEFAULT_TERMS) -> DataFrame:
    """The plan for all periods from ``start`` on, given what was bought before."""
    everything = Window.partitionBy("scenario")
    before = F.sum(F.when(F.col("idx") < start, F.col("bought")).otherwise(0)).over(everything)
    open_part = (
        schedule.withColumn("_left", F.greatest(F.lit(0), F.col("target") - before))
        .filter(F.col("idx") >= start)
        .withColumn("target", F.col("_left"))
        .drop("_left")
    )
    return greedy_plan(with_bids(open_part, terms))


def plan_vs_actual(planned: DataFrame, actual: DataFrame, target: Column) -> DataFrame:
    """Differences of two spend summaries and whether the target was reached.

    Both sides have one row per scenario; a positive spend difference is a
    saving against the plan.
    """
    p = planned.select("scenario", F.col("spend").alias("p_spend"), F.col("total_profit").alias("p_profit"))
    a = actual.select(
        "*", F.col("spend").alias("a_spend"), F.col("total_profit").alias("a_profit")
    )
    saved = F.col("p_spend") - F.col("a_spend")
    gained = F.col("a_profit") - F.col("p_profit")
    return p.join(a, "scenario").select(
        "scenario",
        "units",
        (F.col("units") - target).alias("units_diff"),
        (F.col("units") >= target).alias("achieved"),
        round_half_up(saved, 1).alias("spend_diff"),
        round_half_up(ratio_or_zero(saved, F.col("p_spend")) * 100, 1).alias("spend_diff_pct"),
        round_half_up(gained, 1).alias("profit_diff"),
        round_half_up(ratio_or_zero(gained, F.col("p_profit")) * 100, 1).alias("profit_diff_pct"),
    )

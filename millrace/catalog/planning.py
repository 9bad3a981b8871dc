"""Procurement planning: every part is a scenario, every month a period."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.catalog.sqlparts import half_up, mean_round as mean_round_sql
from millrace.functions.numbers import mean_round, round_half_up
from millrace.operators import planning as ops
from millrace.operators.joins import lookup
from millrace.operators.windows import spread
from millrace.plans import procurement
from millrace.storage import materialize

TARGET = 10


def schedule(t: Tables) -> DataFrame:
    """Lines per part and month as supply, the retail price as base price."""
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("idx")
    lines = t.lineitem.select(
        F.col("l_partkey").alias("scenario"), month, "l_tax", "l_returnflag"
    )
    # A part and month have few lines: adding them up before the shuffle only
    # fills the memory of its tasks.
    monthly = spread(lines, t.lineitem.count(), "scenario").groupBy("scenario", "idx").agg(
        F.count(F.lit(1)).alias("supply"),
        (mean_round("l_tax", 4) - 0.04).alias("noise"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    priced = lookup(monthly, t.part, "scenario", "p_partkey", {"p_retailprice": "base_price"})
    return priced.withColumn("target", F.lit(TARGET).cast("bigint"))


def actuals(known: DataFrame) -> DataFrame:
    """Purchases entered by hand, two per returned line: some periods have no
    entry and some entries exceed the supply."""
    entered = known.filter("returned > 0")
    return entered.select("scenario", "idx", (F.col("returned") * 2).alias("bought"))


def written_schedule(t: Tables) -> DataFrame:
    """The schedule as a table, for plans that look at it more than once."""
    return materialize(schedule(t), "schedule")


def _price(base: str, supply: str, peak: str, noise: str) -> str:
    share = f"CASE WHEN ln(1 + {peak}) > 0 THEN ln(1 + {supply}) / ln(1 + {peak}) ELSE 0.0 END"
    return half_up(f"({base} * (1 - 0.08::DOUBLE * ({share})) * (1 + {noise}))", 1)


_MULTIPLIER = """CASE WHEN fill_ratio < 0.45 THEN 0.97::DOUBLE WHEN fill_ratio < 0.6 THEN 1.0
                 WHEN fill_ratio < 0.75 THEN 1.05 ELSE 1.1 END"""

SCHEDULE = f"""
    WITH monthly AS (
      SELECT l_partkey AS scenario, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS idx, count(*) AS supply,
             {mean_round_sql('l_tax', 4)} - 0.04::DOUBLE AS noise, count(*) FILTER (l_returnflag = 'R') AS returned
      FROM lineitem GROUP BY 1, 2),
    schedule AS (
      SELECT scenario, idx, supply, p_retailprice AS base_price, CAST({TARGET} AS BIGINT) AS target,
             noise, returned
      FROM monthly LEFT JOIN part ON scenario = p_partkey),
    peaked AS (SELECT *, max(supply) OVER (PARTITION BY scenario) AS peak,
                      CAST(target AS DOUBLE) / sum(supply) OVER (PARTITION BY scenario) AS fill_ratio FROM schedule),
    priced AS (SELECT *, {_price('base_price', 'supply', 'peak', 'noise')} AS exp_price FROM peaked),
    multiplied AS (SELECT *, {_MULTIPLIER} AS multiplier FROM priced),
    opened AS (SELECT *, {half_up('(exp_price * 0.97::DOUBLE)', 1)} AS open_bid FROM multiplied),
    bids AS (SELECT *, exp_price * multiplier AS raw, open_bid * (1 + 0.01::DOUBLE) AS floor_bid,
                    {half_up('(exp_price * 1.1::DOUBLE)', 1)} AS sale_price,
                    {half_up('(exp_price * 0.07::DOUBLE)', 1)} AS reg_cost FROM opened),
    costed AS (SELECT *, reg_cost + 15.0::DOUBLE AS total_additional_cost,
                      {half_up('(sale_price - exp_price - (reg_cost + 15.0::DOUBLE))', 1)} AS unit_profit FROM bids),
    filled AS (SELECT *, sum(supply) OVER (PARTITION BY scenario ORDER BY exp_price, idx ROWS UNBOUNDED PRECEDING) AS upto
               FROM costed),
    plan AS (SELECT *, CAST(greatest(0, least(supply, target - (upto - supply))) AS BIGINT) AS buy FROM filled),
    actuals AS (SELECT scenario, idx, returned * 2 AS entered FROM schedule WHERE returned > 0),
    valid AS (SELECT s.*, CASE WHEN entered BETWEEN 0 AND supply THEN CAST(entered AS BIGINT) ELSE 0 END AS bought
              FROM schedule s LEFT JOIN actuals a ON s.scenario = a.scenario AND s.idx = a.idx),
    state AS (SELECT *, greatest(0, target - coalesce(sum(bought) OVER (PARTITION BY scenario ORDER BY idx
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS remaining_target FROM valid),
    pairs AS (SELECT c.scenario, c.idx AS cursor, c.supply AS c_supply, c.base_price AS c_base, c.noise AS c_noise,
                     c.bought, c.remaining_target, d.idx, d.supply, d.base_price, d.noise,
                     max(d.supply) OVER w AS peak, sum(d.supply) OVER w AS remaining_supply, count(*) OVER w AS days_left
              FROM state c JOIN schedule d ON c.scenario = d.scenario AND d.idx >= c.idx
              WINDOW w AS (PARTITION BY c.scenario, c.idx)),
    repriced AS (SELECT *, {_price('base_price', 'supply', 'peak', 'noise')} AS exp_price FROM pairs),
    ordered AS (SELECT *, sum(supply) OVER (PARTITION BY scenario, cursor ORDER BY exp_price, idx ROWS UNBOUNDED PRECEDING) AS upto,
                       CAST(remaining_target AS DOUBLE) / greatest(1, remaining_supply) AS fill_ratio FROM repriced),
    today AS (SELECT scenario, idx, supply, base_price, noise, bought, exp_price, fill_ratio, days_left,
                     CAST(remaining_target AS BIGINT) AS remaining_target,
                     CAST(remaining_supply AS BIGINT) AS remaining_supply,
                     CAST(greatest(0, least(supply, remaining_target - (upto - supply))) AS BIGINT) AS planned,
                     {_MULTIPLIER} AS multiplier
              FROM ordered WHERE idx = cursor)
"""


@query(
    "G01",
    f"{SCHEDULE} SELECT scenario, idx, supply, exp_price FROM priced",
)
def expected_price(t: Tables):
    return ops.with_prices(schedule(t)).select("scenario", "idx", "supply", "exp_price")


@query(
    "G02",
    f"{SCHEDULE} SELECT scenario, idx, multiplier, {half_up('fill_ratio', 6)} AS fill_ratio FROM multiplied",
)
def pressure_multiplier(t: Tables):
    return ops.with_bids(schedule(t)).select(
        "scenario", "idx", "multiplier", round_half_up("fill_ratio", 6).alias("fill_ratio")
    )


@query(
    "G03",
    f"""{SCHEDULE} SELECT scenario, idx, open_bid, {half_up('greatest(raw, floor_bid)', 1)} AS cap_bid,
        raw <= floor_bid AS cap_from_spread FROM bids""",
)
def bid_bounds(t: Tables):
    return ops.with_bids(schedule(t)).select(
        "scenario", "idx", "open_bid", "cap_bid", "cap_from_spread"
    )


@query(
    "G04",
    f"{SCHEDULE} SELECT scenario, idx, sale_price, reg_cost, total_additional_cost, unit_profit FROM costed",
)
def unit_profit(t: Tables):
    return ops.with_bids(schedule(t)).select(
        "scenario", "idx", "sale_price", "reg_cost", "total_additional_cost", "unit_profit"
    )


@query(
    "G05 N02 E22",
    """
    WITH lots AS (
      SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS BIGINT) AS supply,
             floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS price
      FROM lineitem),
    f AS (SELECT *, sum(supply) OVER (PARTITION BY l_partkey ORDER BY price, l_orderkey, l_linenumber, l_suppkey
                                      ROWS UNBOUNDED PRECEDING) AS upto FROM lots)
    SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, price, supply,
           CAST(greatest(0, least(supply, 200 - (upto - supply))) AS BIGINT) AS buy
    FROM f
    """,
)
def greedy_allocation(t: Tables):
    """Cheapest lots first until the part's target is met; any number of lots."""
    price = round_half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2)
    lots = t.lineitem.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey",
        price.alias("price"), F.col("l_quantity").cast("bigint").alias("supply"),
        F.lit(200).cast("bigint").alias("target"),
    )
    tiebreak = ["l_orderkey", "l_linenumber", "l_suppkey"]
    return ops.greedy_lots(lots, "l_partkey", "price", tiebreak, "supply", "target").drop("target")


@query("G05", f"{SCHEDULE} SELECT scenario, idx, exp_price, supply, buy FROM plan")
def greedy_schedule(t: Tables):
    """The same rule over the months of a part."""
    return procurement.baseline(schedule(t)).select(
        "scenario", "idx", "exp_price", "supply", "buy"
    )


_SUMMARY = f"""{{sums}} SELECT scenario, u AS units, {half_up('sp', 1)} AS spend,
    {half_up('(CASE WHEN u <> 0 THEN sp / u ELSE 0.0 END)', 1)} AS avg_price,
    {half_up('pr', 1)} AS total_profit,
    {half_up('(CASE WHEN u <> 0 THEN pr / u ELSE 0.0 END)', 1)} AS avg_profit_per_unit,
    {half_up('(CASE WHEN sp <> 0 THEN pr / sp ELSE 0.0 END * 100)', 1)} AS avg_roi"""


def _sums(source: str, units: str) -> str:
    return f"""SELECT scenario, CAST(sum({units}) AS DOUBLE) AS u,
        CAST(sum(CAST({units} * exp_price AS DECIMAL(18,4))) AS DOUBLE) AS sp,
        CAST(sum(CAST({units} * unit_profit AS DECIMAL(18,4))) AS DOUBLE) AS pr
        FROM {source} GROUP BY 1"""


@query("G06 A33", f"{SCHEDULE}, p AS ({_sums('plan', 'buy')}) {_SUMMARY.format(sums='')} FROM p")
def plan_summary(t: Tables):
    return procurement.plan_summary(procurement.baseline(schedule(t)))


_TODAY_PROFIT = half_up(
    f"({half_up('(exp_price * 1.1::DOUBLE)', 1)} - exp_price - ({half_up('(exp_price * 0.07::DOUBLE)', 1)} + 15.0::DOUBLE))",
    1,
)


@query(
    "G06 A34",
    f"""{SCHEDULE},
    p AS ({_sums('plan', 'buy')}),
    h AS (SELECT *, {_TODAY_PROFIT} AS unit_profit FROM today),
    a AS ({_sums('h', 'bought')}),
    r AS (SELECT p.scenario, a.u AS units, {half_up('p.sp', 1)} AS ps, {half_up('p.pr', 1)} AS pp,
                 {half_up('a.sp', 1)} AS s, {half_up('a.pr', 1)} AS ap
          FROM p JOIN a ON p.scenario = a.scenario)
    SELECT scenario, units, units - {TARGET} AS units_diff, units >= {TARGET} AS achieved,
           {half_up('(ps - s)', 1)} AS spend_diff,
           {half_up('(CASE WHEN ps <> 0 THEN (ps - s) / ps ELSE 0.0 END * 100)', 1)} AS spend_diff_pct,
           {half_up('(ap - pp)', 1)} AS profit_diff,
           {half_up('(CASE WHEN pp <> 0 THEN (ap - pp) / pp ELSE 0.0 END * 100)', 1)} AS profit_diff_pct
    FROM r
    """,
)
def plan_vs_actual(t: Tables):
    known = written_schedule(t)
    return procurement.compare(known, actuals(known))


@query(
    "G07 N03",
    f"""{SCHEDULE} SELECT scenario, idx, remaining_target, remaining_supply, days_left, exp_price, multiplier,
        planned FROM today""",
)
def rolling_replan(t: Tables):
    """The decision at the start of every month, given the purchases so far."""
    known = written_schedule(t)
    day = ops.rolling_replan(ops.with_actuals(known, actuals(known)))
    return day.select(
        "scenario", "idx", F.col("remaining_target").cast("bigint").alias("remaining_target"),
        "remaining_supply", "days_left", "exp_price", "multiplier",
        F.col("planned").cast("bigint").alias("planned"),
    )


@query(
    "G07",
    f"""{SCHEDULE}, late AS (
      SELECT v.*, greatest(0, target - (SELECT coalesce(sum(bought), 0) FROM valid o
                                        WHERE o.scenario = v.scenario AND o.idx < 23976)) AS left_over
      FROM valid v WHERE idx >= 23976),
    late_peak AS (SELECT *, max(supply) OVER (PARTITION BY scenario) AS peak FROM late),
    late_price AS (SELECT *, {_price('base_price', 'supply', 'peak', 'noise')} AS exp_price FROM late_peak),
    late_fill AS (SELECT *, sum(supply) OVER (PARTITION BY scenario ORDER BY exp_price, idx ROWS UNBOUNDED PRECEDING) AS upto
                  FROM late_price)
    SELECT scenario, idx, exp_price, CAST(greatest(0, least(supply, left_over - (upto - supply))) AS BIGINT) AS buy
    FROM late_fill""",
)
def replan_from_month(t: Tables):
    """The remaining schedule from January 1998 on, planned anew."""
    known = written_schedule(t)
    plan = ops.replan_from(ops.with_actuals(known, actuals(known)), 1998 * 12)
    return plan.select("scenario", "idx", "exp_price", F.col("buy").cast("bigint").alias("buy"))


@query(
    "G08",
    f"""{SCHEDULE} SELECT scenario, idx, days_left,
        CASE WHEN fill_ratio < 0.45 THEN 'low' WHEN fill_ratio < 0.6 THEN 'medium'
             WHEN fill_ratio < 0.75 THEN 'high' ELSE 'very high' END AS risk
        FROM today""",
)
def risk_band(t: Tables):
    known = written_schedule(t)
    day = ops.rolling_replan(ops.with_actuals(known, actuals(known)))
    return day.select("scenario", "idx", "days_left", "risk")


@query("G09", f"{SCHEDULE} SELECT scenario, idx, supply, bought FROM valid")
def validated_actuals(t: Tables):
    """Purchases outside 0..supply and missing periods count as 0."""
    known = written_schedule(t)
    return ops.with_actuals(known, actuals(known)).select("scenario", "idx", "supply", "bought")

"""Sums of doubles without any loss, whatever their size and order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import let

# A limb holds so many bits.  The limbs of a double begin at a multiple of it;
# four hold all its bits wherever they lie, and 2**38 rows fit in a long sum.
_BITS = 24
_BASE = 1 << _BITS
_LIMBS = 4
# Limb numbers that a double and a sum of 2**38 of them can have.
_FIRST, _LAST = -50, 50
# Bits of a double's whole number part that are worth the name.
_MANTISSA = 53


def _scaled(x: Column, limbs: Column) -> Column:
    """``x`` times 2 to the power of ``limbs`` limbs, in two steps: one could overflow."""
    half = F.pow(F.lit(2.0), (limbs * (_BITS // 2)).cast("double"))
    return x * half * half


def _split(rows: DataFrame, x: str) -> DataFrame:
    """Adds ``at`` and ``p0`` to ``p3``: x is the sum of ``p[i] * 2**(24 * (at + i))``.

    All are whole numbers, null where x is null, 0 or not finite.  The logarithm
    may be off by one; a spare bit at either end allows for it.  Every step is a
    column of its own, so none is computed again by the next one.
    """
    value, pair = F.col(x), float(_BASE**2)
    mask = F.lit(_BASE - 1).cast("bigint")
    lowest = F.floor(F.log2(F.abs(value))) - (_MANTISSA + 1)
    at = F.greatest(F.floor(lowest / _BITS), F.lit(_FIRST)).cast("int")
    finite = ~F.isnan(value) & (F.abs(value) != float("inf")) & (value != 0)
    placed = rows.withColumn("at", F.when(finite, at))
    whole = placed.withColumn("_whole", F.when(F.col("at").isNotNull(), _scaled(value, -F.col("at"))))
    # What the upper two limbs take away is exact, as is what stays.
    upper = whole.withColumn("_upper", (F.col("_whole") / pair).cast("bigint"))
    both = upper.withColumn("_lower", (F.col("_whole") - F.col("_upper") * pair).cast("bigint"))
    return both.withColumns(
        {
            "p0": F.col("_lower").bitwiseAND(mask),
            "p1": F.shiftright("_lower", _BITS),
            "p2": F.col("_upper").bitwiseAND(mask),
            "p3": F.shiftright("_upper", _BITS),
        }
    ).drop("_whole", "_upper", "_lower")


def _carried(limbs: Column) -> Column:
    """Limbs from ``_FIRST`` on as digits 0 to 2**24 - 1 and a last carry with the sign."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits")
    )

    def step(state: Column, x: Column) -> Column:
        value = x + state["carry"]
        digit = F.pmod(value, F.lit(_BASE).cast("bigint"))
        return F.struct(
            F.shiftright(value - digit, _BITS).alias("carry"),
            F.concat(state["digits"], F.array(digit)).alias("digits"),
        )

    return F.aggregate(limbs, start, step)


def _nearest(limbs: Column) -> Column:
    """The double nearest to a sum of limbs, halves to even."""

    def read(y: Column) -> Column:
        digits = y["digits"]
        places = F.sequence(F.lit(0), F.size(digits) - 1)
        top = F.array_max(F.filter(places, lambda i: F.get(digits, i) > 0))

        def convert(z: Column) -> Column:
            t = z["top"]
            # Four digits are 73 to 96 bits.  The highest 62 of them and a mark
            # for any bit below decide how a double of 53 bits is rounded.
            high = [F.coalesce(F.get(digits, t - k), F.lit(0).cast("bigint")) for k in range(4)]
            below = F.exists(
                F.slice(digits, F.lit(1), F.greatest(t - 3, F.lit(0))), lambda d: d > 0
            )
            upper = high[0] * _BASE + high[1]
            lower = high[2] * _BASE + high[3]
            width = F.floor(F.log2(upper.cast("double"))).cast("int") + 1
            keep = F.least(F.lit(2 * _BITS), F.lit(62) - width)
            dropped = F.lit(2 * _BITS) - keep
            factor = F.pow(F.lit(2.0), keep.cast("double")).cast("bigint")
            unit = F.pow(F.lit(2.0), dropped.cast("double")).cast("bigint")
            whole = upper * factor + F.floor(lower / unit)
            sticky = ((lower % unit) > 0) | below
            odd = F.when(sticky & (whole % 2 == 0), 1).otherwise(0)
            place = (t - 3 + _FIRST) * _BITS + dropped
            half = F.floor(place / 2)
            return (
                (whole + odd).cast("double")
                * F.pow(F.lit(2.0), half.cast("double"))
                * F.pow(F.lit(2.0), (place - half).cast("double"))
            )

        found = let(F.struct(top.alias("top")), convert)
        return F.when(top.isNull(), F.lit(0.0)).otherwise(found)

    def signed(y: Column) -> Column:
        # A negative sum ends in a negative carry: its opposite has digits.
        flipped = let(_carried(F.transform(y["limbs"], lambda d: -d)), read)
        return F.when(y["sum"]["carry"] < 0, -flipped).otherwise(let(y["sum"], read))

    return let(
        limbs,
        lambda each: let(
            F.struct(each.alias("limbs"), _carried(each).alias("sum")), signed
        ),
    )


def exact_sums(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column | str]
) -> DataFrame:
    """``keys`` and for each name the exact sum of its doubles, rounded once.

    The result is the double nearest to the true sum of the values as they are
    stored: it depends on nothing but the values.  Nulls are passed over; a
    group without a value has null.  NaN and infinities count as in ``sum``,
    and a true sum beyond the largest double is infinite.

    Every value is split without error into whole-number limbs by its exponent.
    Limbs are summed as longs per group, name and exponent block, in the tasks
    before they are shuffled: at most about a hundred rows per group and name
    leave a task, whatever the number of rows.  A group may have 2**38 rows.
    """
    names = list(values)
    given = [
        F.struct(
            F.lit(i).alias("name"),
            (F.col(c) if isinstance(c, str) else c).cast("double").alias("_x"),
        )
        for i, c in enumerate(values.values())
    ]
    rows = df.select(*keys, F.explode(F.array(*given)).alias("_v")).select(*keys, "_v.*")
    plain = ~F.isnan("_x") & (F.abs("_x") != float("inf"))
    sums = _split(rows, "_x").groupBy(*keys, "name", "at").agg(
        F.count("_x").alias("known"),
        F.sum(F.when(~plain, F.col("_x"))).alias("odd"),
        *[F.sum(f"p{k}").alias(f"p{k}") for k in range(_LIMBS)],
    )
    one = F.struct("at", F.array(*[f"p{k}" for k in range(_LIMBS)]).alias("parts"))
    joined = sums.groupBy(*keys, "name").agg(
        F.sum("known").alias("known"),
        F.sum("odd").alias("odd"),
        F.collect_list(F.when(F.col("at").isNotNull(), one)).alias("blocks"),
    )
    # Limb by limb; a block adds to four of them, and there are few blocks.
    limbs = F.transform(
        F.sequence(F.lit(_FIRST), F.lit(_LAST)),
        lambda place: F.aggregate(
            "blocks",
            F.lit(0).cast("bigint"),
            lambda total, b: total
            + F.when(
                (place >= b["at"]) & (place < b["at"] + _LIMBS), F.get(b["parts"], place - b["at"])
            ).otherwise(F.lit(0).cast("bigint")),
        ),
    )
    total = F.when(F.col("known") > 0, F.coalesce(F.col("odd"), _nearest(limbs)))
    done = joined.select(*keys, "name", total.alias("total"))
    return done.groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == i, F.col("total"))).alias(n) for i, n in enumerate(names)]
    )

"""Descriptive statistics over whole columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A quantile sketch misses a rank by one in so many; and the distinct values of
# a range that one task may sort.
_ACCURACY = 10_000
_MOST_VALUES = 100_000


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every two columns in long form, from one scan."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")
                )
            )
    return one.select(F.inline(F.array(*cells))).select(
        "a", "b", F.round("r", digits).alias("r")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Rows and nulls per column, in long form."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    return one.select(F.inline(F.array(*cells)), F.col("_rows").alias("row_count"))


def long_form(df: DataFrame, columns: Sequence[str], as_type: str) -> DataFrame:
    """Rows (column_name, value) without the nulls."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast(as_type).alias("value"))
        for c in columns
    ]
    return df.select(F.inline(F.array(*cells))).filter("value IS NOT NULL")


@dataclass
class _Slice:
    """Range of a column's values that holds both ranks of one quantile."""

    column: str
    prob: float
    count: int
    low: float
    high: float
    below: int = 0
    inside: int = 0

    def ranks(self) -> tuple[int, int, float]:
        """Neighbouring ranks, from 0, and the share of the upper one."""
        exact = (self.count - 1) * self.prob
        return math.floor(exact), math.ceil(exact), exact - math.floor(exact)

    def holds(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


def _around(shares: Sequence[float]) -> list[float]:
    """Shares a little below and above each one, by twice the sketch's error."""
    return [min(1.0, max(0.0, p + d)) for p in shares for d in (-2 / _ACCURACY, 2 / _ACCURACY)]


def _narrow(
    numbers: DataFrame, slices: list[_Slice], extremes: dict[str, tuple[float, float]]
) -> None:
    """Count what lies below and inside; sketch again inside a slice of many values.

    A sketch of bounded size misses a rank by 1 in ``_ACCURACY`` at most, so
    each turn leaves a few thousandths of the values.
    """
    while True:
        sizes = numbers.agg(
            *[
                F.struct(
                    F.count_if(F.col(s.column) < s.low),
                    F.count_if(s.holds()),
                    F.approx_count_distinct(F.when(s.holds(), F.col(s.column))),
                )
                for s in slices
            ]
        ).first()
        wide, again = [], False
        for s, (below, inside, distinct) in zip(slices, sizes):
            s.below, s.inside = below, inside
            first, last, _ = s.ranks()
            if not below <= first <= last < below + inside:
                # Two ranks of a short column are further apart than the range.
                s.low, s.high = extremes[s.column]
                again = True
            elif distinct > _MOST_VALUES:
                wide.append(s)
        if not wide and not again:
            return
        if not wide:
            continue
        # Both ranks as shares of the inside.
        shares = [[(r - s.below + 0.5) / s.inside for r in s.ranks()[:2]] for s in wide]
        ends = numbers.agg(
            *[
                F.percentile_approx(
                    F.when(s.holds(), F.col(s.column)), _around(x), _ACCURACY
                )
                for s, x in zip(wide, shares)
            ]
        ).first()
        for s, found in zip(wide, ends):
            s.low, s.high = found[0], found[-1]


def describe_numeric(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    One scan takes the plain figures and a sketch of bounded size, whose error
    bound gives a narrow range around each quartile; one counts what lies below
    and inside the ranges; one counts the few distinct values inside and picks
    the ranks.  A column of so many values that a range still holds very many
    is sketched again inside it.  Values outside the ranges are never shuffled,
    nothing is written, and every size takes the same way.  Quartiles
    interpolate between the neighbouring ranks; a column of nulls has none.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    measures = [
        F.struct(
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
            F.percentile_approx(c, _around(probs), _ACCURACY).alias("ends"),
        )
        for c in columns
    ]
    plain = dict(zip(columns, numbers.agg(*measures).first()))
    slices = [
        _Slice(c, p, plain[c]["count"], *plain[c]["ends"][2 * i : 2 * i + 2])
        for c in columns
        if plain[c]["count"]
        for i, p in enumerate(probs)
    ]
    if slices:
        _narrow(numbers, slices, {c: (plain[c]["min"], plain[c]["max"]) for c in columns})
    cells = [
        F.struct(
            F.lit(i).alias("slice"), F.when(s.holds(), F.col(s.column)).alias("value")
        )
        for i, s in enumerate(slices)
    ] or [F.struct(F.lit(0).alias("slice"), F.lit(None).cast("double").alias("value"))]
    # Rows outside all slices are dropped by the scan.
    touched = reduce(lambda a, b: a | b, [s.holds() for s in slices], F.lit(False))
    counted = (
        numbers.filter(touched)
        .select(F.inline(F.array(*cells)))
        .filter("value IS NOT NULL")
        .groupBy("slice", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Bounded: the distinct values of one slice.
    upto = Window.partitionBy("slice").orderBy("value")
    ranked = counted.withColumn("upto", F.sum("n").over(upto))
    picks = [F.count(F.lit(1)).alias("found")]
    quantiles: dict[tuple[str, float], Column] = {}
    for i, s in enumerate(slices):
        first, last, share = s.ranks()
        for rank, name in ((first, f"low{i}"), (last, f"high{i}")):
            reached = (F.col("slice") == i) & (F.col("upto") + s.below > rank)
            picks.append(F.min(F.when(reached, F.col("value"))).alias(name))
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        quantiles[s.column, s.prob] = low + (high - low) * share
    missing = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(plain[c]["count"]).cast("bigint").alias("count"),
            *[F.lit(plain[c][k]).cast("double").alias(k) for k in ("mean", "std", "min")],
            *[quantiles.get((c, p), missing).alias(f"p{int(p * 100)}") for p in probs],
            F.lit(plain[c]["max"]).cast("double").alias("max"),
        )
        for c in columns
    ]
    return ranked.agg(*picks).select(F.inline(F.array(*rows)))


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column."""
    counted = long_form(df, columns, "string").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    top = counted.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max("n").alias("freq"),
    )
    # Of several values with the highest frequency the smallest is reported.
    # One row per profiled column, so the broadcast is bounded by the call.
    first = (
        counted.join(F.broadcast(top), "column_name")
        .filter(F.col("n") == F.col("freq"))
        .groupBy("column_name", "count", "unique", "freq")
        .agg(F.min("value").alias("top"))
    )
    return first.select("column_name", "count", "unique", "top", "freq")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included.

    ``density`` integrates to 1 over the range.
    """
    x = F.col(column).cast("double")
    known = df.select(x.alias("x")).filter("x IS NOT NULL")
    edges = known.agg(
        F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"))
    ).scalar()
    lo, width = edges["lo"], (edges["hi"] - edges["lo"]) / bins
    spot = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("x") - lo) / width)))
    counted = (
        known.select(F.coalesce(spot, F.lit(0)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = grid.join(counted, "bin", "left").fillna(0, subset=["n"])
    return full.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        "n",
        F.try_divide(F.col("n"), edges["n"] * width).alias("density"),
    )


def density_curve(df: DataFrame, column: str, points: int) -> DataFrame:
    """Gaussian kernel density at evenly spaced points between the extremes.

    Bandwidth: sample deviation times n^(-1/5).  One sum per point in one
    aggregate: rows are not repeated and a task shuffles one row.
    """
    known = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    shape = known.agg(
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.count("v").alias("n"),
        (F.stddev_samp("v") * F.pow(F.count("v"), F.lit(-0.2))).alias("h"),
    ).first()
    if not shape["n"]:
        return known.select(
            F.lit(0).alias("point"), F.col("v").alias("x"), F.col("v").alias("density")
        )
    lo, hi, h = shape["lo"], shape["hi"], shape["h"] or float("nan")
    at = [lo + (hi - lo) * i / max(1, points - 1) for i in range(points)]

    def kernel(x: float) -> Column:
        z = (F.col("v") - x) / h
        return F.sum(F.exp(-(z * z) / 2))

    sums = known.agg(*[kernel(x).alias(f"k{i}") for i, x in enumerate(at)])
    scale = shape["n"] * h * math.sqrt(2 * math.pi)
    cells = [
        F.struct(
            F.lit(i).alias("point"), F.lit(x).alias("x"), (F.col(f"k{i}") / scale).alias("density")
        )
        for i, x in enumerate(at)
    ]
    return sums.select(F.inline(F.array(*cells)))

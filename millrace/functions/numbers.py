"""Exact sums, half-up rounding, dirty numerics, units and buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MILES_TO_KM = 1.60934

# Doubles below this hold every whole number.
_WHOLE = float(2**53)
# Sums keep so many decimals of values below so much.
_DECIMALS = 6
_MOST = 1e17
# Share of a value that its own rounding may make up.
_NOISE = 2.0**-49


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 0) -> Column:
    """Round halves away from zero on the double itself.

    ``round`` goes through a decimal text form of the double, which other
    engines do not; the floor form gives the same bits everywhere.  A double
    without digits to round, infinity and NaN are returned as they are.
    """
    c = _col(c).cast("double")
    factor = float(10**digits)
    rounded = F.signum(c) * F.floor(F.abs(c) * factor + 0.5).cast("double") / factor
    return F.when(F.abs(c) * factor < _WHOLE, rounded).otherwise(c)


def _parts(c: Column) -> tuple[Column, Column, Column]:
    """Whole units, millionths, and what neither holds.

    The last is the value itself if it is huge, infinite or NaN, else the part
    below a millionth; null where that is no more than the rounding of a double.
    """
    plain = F.when(F.abs(c) < _MOST, c)
    whole = F.floor(plain)
    rest = F.floor((plain - whole) * float(10**_DECIMALS) + 0.5)
    below = plain - (whole + rest / float(10**_DECIMALS))
    other = F.when(plain.isNull(), c).when(F.abs(below) > F.abs(c) * _NOISE, below)
    return whole, rest, other


def split_total(c: Column | str) -> tuple[Column, Column]:
    """Sum as a decimal and a double part, both of which can be summed again.

    The decimal holds six decimals of all plain amounts and does not depend on
    the order of the rows; the double holds what it cannot (smaller parts,
    huge values, infinity, NaN) and is null where there is none.
    """
    whole, rest, other = _parts(_col(c).cast("double"))
    step = F.lit(Decimal(1).scaleb(-_DECIMALS))
    total = F.sum(whole).cast("decimal(20,0)") + F.sum(rest).cast("decimal(20,0)") * step
    return total, F.sum(other)


def whole_total(total: Column, other: Column) -> Column:
    """Both parts of ``split_total`` as one double."""
    return (
        F.when(other.isNull(), total.cast("double"))
        .when(total.isNull(), other)
        .otherwise(total.cast("double") + other)
    )


def exact_total(c: Column | str) -> Column:
    """Decimal sum that does not depend on the order in which rows arrive.

    For amounts with up to six decimals.  Whole units and the rest are summed
    as two long integers, which stays exact far beyond a single long and is
    much cheaper than a decimal per row; the decimal is built once per group.
    Values that are no such amounts (see ``split_total``) are an error here.
    """
    total, other = split_total(c)
    # None of a group's values may be left out without a word.
    return F.when(other.isNull(), total).when(
        F.raise_error(F.lit("a sum holds values that are no plain amounts")).isNull(), total
    )


def exact_sum(c: Column | str) -> Column:
    """Double sum: order-free for amounts with up to six decimals.

    Smaller parts, huge values, infinity and NaN are added as doubles, as
    ``sum`` does; ``operators.sums`` has a sum that is exact for any doubles.
    """
    return whole_total(*split_total(c))


def exact_mean(c: Column | str) -> Column:
    return exact_sum(c) / F.count(_col(c))


def mean_round(c: Column | str, digits: int = 2) -> Column:
    """Mean rounded half up; values are not rounded."""
    return round_half_up(exact_mean(c), digits)


def to_number(c: Column | str, marker: str | None = None, replacement: str = "0") -> Column:
    """Text to double; an unreadable value is null instead of an error.

    ``marker`` is a code that stands for ``replacement`` when it is the whole
    value (weather files write T for a trace of rain).
    """
    c = _col(c)
    if marker is not None:
        c = F.when(F.trim(c) == marker, F.lit(replacement)).otherwise(c)
    return c.try_cast("double")


def parse_thousands(
    c: Column | str, missing: str = "—", divisor: float = 1000.0, digits: int = 2
) -> Column:
    """'1,234,567' to 1234.57; the ``missing`` sentinel and bad text are null."""
    c = F.trim(_col(c))
    number = F.when(c != missing, F.replace(c, F.lit(","), F.lit("")).try_cast("double"))
    return round_half_up(number / divisor, digits)


def fahrenheit_to_celsius(c: Column | str, digits: int = 1) -> Column:
    return round_half_up((_col(c) - 32) * 5 / 9, digits)


def miles_to_km(c: Column | str, digits: int = 2) -> Column:
    return round_half_up(_col(c) * MILES_TO_KM, digits)


def row_sum(columns: Sequence[Column | str], skip_null: bool = False) -> Column:
    """Sum across columns; one null makes the result null unless skipped."""
    parts = [_col(c) for c in columns]
    if skip_null:
        parts = [F.coalesce(p, F.lit(0.0)) for p in parts]
    return reduce(lambda a, b: a + b, parts)


def floor_bin(c: Column | str, width: float) -> Column:
    """Lower edge of the equal-width bin that holds the value."""
    return F.floor(_col(c) / width) * width


def map_codes(c: Column | str, labels: Mapping, default: str | None = None) -> Column:
    """Code to label; a code without a label is null (or ``default``)."""
    c = _col(c)
    cases = [(c == F.lit(code), F.lit(label)) for code, label in labels.items()]
    out = reduce(lambda acc, case: acc.when(*case), cases[1:], F.when(*cases[0]))
    return out if default is None else out.otherwise(F.lit(default))


def bucketize(
    c: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    right_closed: bool = False,
    unknown: str | None = "Unknown",
) -> Column:
    """Label of the band a value falls into.

    ``edges`` are the inner boundaries, so ``len(labels) == len(edges) + 1``.
    A value equal to an edge belongs to the lower band when ``right_closed``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    c = _col(c)
    out = F.when(c.isNull(), F.lit(unknown))
    for edge, label in zip(edges, labels):
        out = out.when(c <= edge if right_closed else c < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def bucket_rank(c: Column | str, labels: Sequence[str]) -> Column:
    """Ordinal of an ordered label; anything else sorts last."""
    ranks = map_codes(c, {label: i for i, label in enumerate(labels)})
    return F.coalesce(ranks, F.lit(len(labels)))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient with 0 where nothing was counted (not null)."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))

"""Running values over an array inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that one step looks at; totals of so many form the next level.
_CHUNK, _LEVELS = 32, 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, total: Callable[[Column], Column], levels: int = _LEVELS) -> Column:
    """``total`` of the elements up to each one, in few steps each.

    ``total`` must be associative and pass over nulls.
    """

    def place(both: Column) -> Column:
        def one(_: Column, i: Column) -> Column:
            chunk = F.floor(i / _CHUNK).cast("int") if levels else F.lit(0)
            inside = F.slice(both["each"], chunk * _CHUNK + 1, i - chunk * _CHUNK + 1)
            if not levels:
                return total(inside)
            return total(F.concat(F.array(F.get(both["before"], chunk - 1)), inside))

        return F.transform(both["each"], one)

    def chunked(each: Column) -> Column:
        if not levels:
            return place(F.struct(each.alias("each")))
        starts = F.sequence(F.lit(0), F.size(each), F.lit(_CHUNK))
        totals = F.transform(starts, lambda c: total(F.slice(each, c + 1, F.lit(_CHUNK))))
        before = _running(totals, total, levels - 1)
        return let(F.struct(each.alias("each"), before.alias("before")), place)

    return let(values, chunked)


def running_sum(values: Column) -> Column:
    """Sums of integers up to each element."""
    zero = F.lit(0).cast("bigint")
    whole = F.transform(values, lambda x: x.cast("bigint"))
    return _running(whole, lambda a: F.aggregate(a, zero, lambda s, x: s + F.coalesce(x, zero)))


def running_max(values: Column) -> Column:
    """Largest element so far; nulls are passed over."""
    return _running(values, F.array_max)


def running_min(values: Column) -> Column:
    """Smallest element so far; nulls are passed over."""
    return _running(values, F.array_min)

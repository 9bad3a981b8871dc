"""Calendar fields, durations and day types."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.numbers import round_half_up


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", _ts(start), _ts(end))


def minutes(seconds: Column | str, truncate: bool = False) -> Column:
    """Seconds to minutes, rounded half up or cut off."""
    m = _ts(seconds) / 60
    return m.cast("int").cast("double") if truncate else round_half_up(m, 0)


def within(ts: Column | str, start: date, end: date) -> Column:
    """Half-open calendar range on the raw column, so that it reaches the scan."""
    ts = _ts(ts)
    return (ts >= F.lit(start)) & (ts < F.lit(end))


def year_range(ts: Column | str, year: int) -> Column:
    return within(ts, date(year, 1, 1), date(year + 1, 1, 1))


def month_range(ts: Column | str, year: int, month: int) -> Column:
    following = date(year + month // 12, month % 12 + 1, 1)
    return within(ts, date(year, month, 1), following)


def day_type(day: Column | str) -> Column:
    """'weekend' on Saturday and Sunday, else 'weekday'."""
    return F.when(F.dayofweek(_ts(day)).isin(1, 7), "weekend").otherwise("weekday")


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from number or text parts; parts that name no day give null."""
    parts = [_ts(p).try_cast("int") for p in (year, month, day)]
    text = F.format_string("%04d-%02d-%02d", *parts)
    known = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return F.when(known, text).try_cast("date")


def _ts(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

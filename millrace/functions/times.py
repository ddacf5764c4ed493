"""Timestamps without a zone, and whole microseconds where arithmetic needs them.

Written for sessions in UTC, which ``build_session`` sets. In a zone with clock changes only
the microsecond functions are affected, and only for local times that a change skips.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def to_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts)


def from_micros(us: Column) -> Column:
    """Zone-less timestamp from microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", us.cast("bigint"), _epoch())


def from_epoch(value: Column, unit: str) -> Column:
    """Epoch number in ``s``, ``ms``, ``us`` or ``ns`` to a zone-less timestamp.

    Nanoseconds are floored to the microseconds Spark can hold.
    """
    if unit == "ns":
        return from_micros(floor_div(value, 1000))
    factor = {"s": 1_000_000, "ms": 1_000, "us": 1}[unit]
    return from_micros(value.cast("bigint") * F.lit(factor))


def floor_div(value: Column, n: int) -> Column:
    """Whole-number division rounding down, exact for all of bigint."""
    by = F.lit(n).cast("bigint")
    whole = value.cast("bigint")
    return F.call_function("div", whole - F.pmod(whole, by), by)


def slot_number(ts: Column, slot: str | int) -> Column:
    """Number of the day, hour or minute a timestamp lies in.

    For whole-number times ``slot`` is the width. Much cheaper than going through microseconds.
    """
    if isinstance(slot, int):
        return floor_div(ts, slot)
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    if slot == "day":
        return day
    hour = day * 24 + F.hour(ts)
    if slot == "hour":
        return hour
    if slot == "minute":
        return hour * 60 + F.minute(ts)
    raise ValueError(f"slot must be day, hour, minute or a width, not {slot}")


def floor_micros(us: Column, width: int) -> Column:
    """Lower edge of the ``width``-microsecond slot; also right before 1970."""
    return us - F.pmod(us, F.lit(width).cast("bigint"))


def floor_ts(ts: Column, width: int) -> Column:
    return from_micros(floor_micros(to_micros(ts), width))


def truncate_precision(ts: Column, digits: int) -> Column:
    """Keep 0, 3 or 6 fractional digits; flooring, so times before 1970 do not move up."""
    if digits >= 6:
        return ts
    return floor_ts(ts, 10 ** (6 - digits))


def day_text(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def month_key(ts: Column) -> Column:
    """yyyyMM as a number."""
    return F.year(ts) * 100 + F.month(ts)


def sunday_zero(ts: Column) -> Column:
    """Day of week with Sunday = 0 (Spark counts Sunday as 1)."""
    return F.dayofweek(ts) - 1


def monday_of(ts: Column) -> Column:
    """First day of the Monday-based week."""
    return F.date_sub(F.to_date(ts), F.weekday(ts))


def parse_ts(text: Column, *patterns: str) -> Column:
    """First pattern that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in patterns])

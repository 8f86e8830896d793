"""Date and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PARTS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")
_SECONDS = {"hour": 3600, "minute": 60, "second": 1}
_PERIOD_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _check(part: str, allowed=PARTS) -> str:
    part = part.lower()
    if part not in allowed:
        raise ValueError(f"date part must be one of {tuple(allowed)}, got {part!r}")
    return part


def truncate(part: str, ts: Column) -> Column:
    """Start of the period ``ts`` lies in, without a time zone."""
    return F.date_trunc(_check(part), ts.cast("timestamp_ntz")).cast("timestamp_ntz")


def add_interval(part: str, amount: Column, ts: Column) -> Column:
    return F.timestamp_add(_check(part).upper(), amount.cast("int"), ts.cast("timestamp_ntz"))


def boundaries_between(start: Column, end: Column, part: str) -> Column:
    """Number of ``part`` boundaries crossed from ``start`` to ``end``.

    Unlike an elapsed-time difference, Jan 31 to Feb 1 is one month. Weeks begin on Monday.
    """
    part = _check(part)
    if part in ("year", "quarter", "month"):
        months = (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
        if part == "month":
            return months.cast("bigint")
        if part == "year":
            return (F.year(end) - F.year(start)).cast("bigint")
        quarters = (F.year(end) * 4 + F.quarter(end)) - (F.year(start) * 4 + F.quarter(start))
        return quarters.cast("bigint")
    if part == "day":
        return F.date_diff(end.cast("date"), start.cast("date")).cast("bigint")
    if part == "week":
        def monday(ts):
            return F.trunc(ts.cast("date"), "week")

        return (F.date_diff(monday(end), monday(start)) / 7).cast("bigint")
    unit = _SECONDS[part]

    def index(ts):
        ntz = ts.cast("timestamp_ntz")
        seconds = (F.unix_date(ntz.cast("date")).cast("bigint") * 86400 + F.hour(ntz) * 3600
                   + F.minute(ntz) * 60 + F.second(ntz))
        return F.floor(seconds / unit).cast("bigint")

    return index(end) - index(start)


def last_day_of(day: Column, part: str = "month") -> Column:
    """Last date of the month, quarter or year ``day`` lies in."""
    part = _check(part, _PERIOD_MONTHS)
    start = F.trunc(day.cast("date"), part)
    return F.date_sub(F.add_months(start, _PERIOD_MONTHS[part]), 1)


def now_utc() -> Column:
    """The current instant as a UTC wall-clock time, whatever the session time zone."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")

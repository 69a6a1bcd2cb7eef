"""Time anchors. Nothing in the library reads the clock: callers pass as_of."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

When = str | dt.datetime | dt.date


def to_datetime(when: When) -> dt.datetime:
    if isinstance(when, dt.datetime):
        return when
    if isinstance(when, dt.date):
        return dt.datetime.combine(when, dt.time())
    return dt.datetime.fromisoformat(when)


def ts(when: When) -> Column:
    """Timestamp literal; text goes through the session time zone (UTC)."""
    return F.lit(to_datetime(when).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def day(when: When) -> Column:
    return F.lit(to_datetime(when).date().isoformat()).cast("date")


def days_before(as_of: When, days: int) -> dt.datetime:
    return to_datetime(as_of) - dt.timedelta(days=days)


def since(column: Column, as_of: When, days: int) -> Column:
    """The window every report uses: the days up to the moment as_of, which still counts.

    Literal bounds, so the scan can skip files; closed above, so that a replay of
    a past moment sees nothing that came later.
    """
    return (column >= ts(days_before(as_of, days))) & (column <= ts(as_of))


def months_back(as_of: When, months: int) -> str:
    """yyyyMM of the month that lies ``months`` before the month of as_of."""
    at = to_datetime(as_of)
    index = at.year * 12 + (at.month - 1) - months
    return f"{index // 12:04d}{index % 12 + 1:02d}"


def week_start(c: Column) -> Column:
    return F.date_trunc("week", c).cast("date")


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)

"""Date/time parsing and arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c, fmt: str = ISO_Z, strict: bool = False) -> Column:
    """Parse text to timestamp. ``strict`` raises on bad input (ANSI), else NULL."""
    if strict:
        return F.to_timestamp(_c(c), fmt)
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def to_date_lenient(c) -> Column:
    """Timestamp/date/ISO text to date; unparsable text gives NULL."""
    col = _c(c)
    return F.coalesce(F.try_to_date(col.cast("string")), F.to_date(F.try_to_timestamp(col.cast("string"))))


def date_text(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_c(c), fmt)


def _second_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))


def elapsed_seconds(begin, end) -> Column:
    """Elapsed wall-clock seconds between two timestamps.

    Calendar days * 86400 plus the second-of-day difference: no time-zone
    arithmetic, so a daylight-saving change in the session zone cannot
    shorten a day.
    """
    b, e = _c(begin), _c(end)
    return (F.datediff(F.to_date(e), F.to_date(b)).cast("bigint") * 86400 + _second_of_day(e) - _second_of_day(b)).cast("bigint")


def elapsed_days(begin, end) -> Column:
    """Whole elapsed 24 h periods, floored (a timedelta's ``days``), F13.

    Differs from ``datediff`` (calendar days, F14) for spans across midnight.
    """
    return F.floor(elapsed_seconds(begin, end) / F.lit(86400)).cast("bigint")

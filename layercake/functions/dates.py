"""Date and time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def years_between(start: Column, end: Column) -> Column:
    """Number of year boundaries between two dates (31 December to 1 January is one)."""
    return F.year(end) - F.year(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries between two timestamps (10:00:59 to 10:01:01 is one)."""

    def minute_number(ts: Column) -> Column:
        # Zone-free: days since the epoch and the minute within the day.
        day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
        return day * 1440 + F.hour(ts) * 60 + F.minute(ts)

    return minute_number(end) - minute_number(start)


def dow0(column: Column) -> Column:
    """Day of the week with Sunday = 0."""
    return F.dayofweek(column) - 1


def month_of(column: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(column, "month")


def minute_of_day(ts: Column, match: str = "exact") -> Column:
    """Minute number 0..1439 within the day.

    ``exact`` gives NULL unless the timestamp lies on a whole minute; ``minute`` truncates.
    """
    if match not in ("exact", "minute"):
        raise ValueError(f"match must be 'exact' or 'minute', not {match!r}")
    number = F.hour(ts) * 60 + F.minute(ts)
    if match == "minute":
        return number
    return F.when(F.date_part(F.lit("SECOND"), ts) == 0, number)

"""Generated spines: days and minutes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A calendar of this many days (over 500 years) is still a few megabytes, so calendars may be
# broadcast without counting them.
MAX_DAYS = 200_000
MINUTES_PER_DAY = 1440


def _as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def date_spine(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """``date_day`` for every day from ``start`` up to, not including, ``end``."""
    first = _as_date(start)
    days = (_as_date(end) - first).days
    if not 0 <= days <= MAX_DAYS:
        raise ValueError(f"a calendar has 0 to {MAX_DAYS} days, not {days}")
    return spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_day")
    )


def time_spine(spark: SparkSession) -> DataFrame:
    """``minute_of_day`` 0..1439."""
    return spark.range(0, MINUTES_PER_DAY, 1, 1).select(F.col("id").cast("int").alias("minute_of_day"))

"""Calendar dimensions. Both have a fixed size, so they may be broadcast without counting."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.sources.calendar import date_spine, time_spine

c = F.col


def dim_date(
    spark: SparkSession,
    start: str | date = rules.CALENDAR_START,
    end: str | date = rules.CALENDAR_END,
) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    day = c("date_day")
    month, year, weekday = F.month(day), F.year(day), fn.dow0(day)
    shift = rules.FISCAL_FIRST_MONTH - 1
    fiscal_month = F.pmod(month - 1 - shift, F.lit(12)) + 1
    holiday = fn.first_match(
        [((month == m) & (F.dayofmonth(day) == d), name) for (m, d), name in rules.HOLIDAYS],
        F.lit(None).cast("string"),
    )
    return date_spine(spark, start, end).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        day.alias("date_actual"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.weekofyear(day).alias("week_of_year"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short_name"),
        F.quarter(day).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_name"),
        year.alias("year_number"),
        weekday.isin(0, 6).alias("is_weekend"),
        weekday.between(1, 5).alias("is_weekday"),
        F.year(F.add_months(day, -shift)).alias("fiscal_year"),
        F.ceil(fiscal_month / 3).cast("int").alias("fiscal_quarter"),
        fiscal_month.alias("fiscal_month"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    hour = F.floor(c("minute_of_day") / 60).cast("int")
    minute = F.pmod(c("minute_of_day"), F.lit(60))
    return time_spine(spark).select(
        (hour * 100 + minute).alias("time_sk"),
        F.format_string("%02d:%02d:00", hour, minute).alias("time_actual"),
        hour.alias("hour_24"),
        (F.pmod(hour + 11, F.lit(12)) + 1).alias("hour_12"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        minute.alias("minute_number"),
        F.format_string("%02d:%02d", hour, minute).alias("hour_minute"),
        fn.between_band(hour, rules.DAY_PARTS, "Night").alias("day_part"),
        fn.between_band(hour, rules.MEAL_HOURS, "Off Hours").alias("meal_period"),
    )

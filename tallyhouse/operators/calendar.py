"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.functions.expressions import date_key


def build_dim_date(spark: SparkSession, start: date = rules.CALENDAR_START, end: date = rules.CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    return calendar_between(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row with 19 attributes per day between a one-row frame's start and end.

    Days of the week run from 1 = Sunday; weeks are ISO weeks.
    """
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("full_date"))
    day = F.col("full_date")
    year, month, weekday = F.year(day), F.month(day), F.dayofweek(day)
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    weekend = weekday.isin(1, 7).cast("int")
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.day(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.left(F.date_format(day, "MMMM"), F.lit(3)).alias("month_name_short"),
        F.quarter(day).alias("quarter_number"),
        quarter.alias("quarter_name"),
        year.alias("year_number"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat(year.cast("string"), F.lit("-"), quarter).alias("year_quarter"),
        weekend.alias("is_weekend"),
        (1 - weekend).alias("is_weekday"),
        leap.cast("int").alias("is_leap_year"),
        F.day(F.last_day(day)).alias("days_in_month"),
    )

"""Time bins, calendars and number series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the bin of the given length that holds ``ts``."""
    bins = F.floor(F.minute(ts) / minutes).cast("int") * minutes
    return F.date_trunc("hour", ts) + F.make_dt_interval(mins=bins)


def calendar(spark: SparkSession, first: str, last: str, as_of: str) -> DataFrame:
    """One row per day with its keys, parts and flags relative to ``as_of``."""
    now = F.to_date(F.lit(as_of))
    day = F.col("day")
    day_row = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day")
    )

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    same_year = F.year(day) == F.year(now)
    return day_row.select(
        F.date_format(day, "yyyyMMdd").alias("DateKey"),
        F.date_format(day, "yyyy-MM-dd").alias("Date"),
        day.alias("Date2Key"),
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("Day"),
        F.weekofyear(day).alias("WeekOfYear"),
        F.date_format(day, "yyyy-MM").alias("YearMonth"),
        F.date_format(day, "E").alias("DayOfWeek"),
        F.dayofweek(day).alias("DayOfWeekNum"),
        flag(same_year).alias("IsCurrentYear"),
        flag(F.year(day) == F.year(now) - 1).alias("IsPreviousYear"),
        flag(same_year & (F.quarter(day) == F.quarter(now))).alias("IsCurrentQuarter"),
        flag(same_year & (F.month(day) == F.month(now))).alias("IsCurrentMonth"),
        flag(F.trunc(day, "month") == F.trunc(F.add_months(now, -1), "month")).alias("IsPreviousMonth"),
        *[
            flag(day.between(F.date_sub(now, n), now)).alias(f"IsInLast{n}Days")
            for n in (7, 14, 30, 60, 90)
        ],
    )


def series(spark: SparkSession, first: int, last: int, name: str = "Value") -> DataFrame:
    """Whole numbers first..last, one row each."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))

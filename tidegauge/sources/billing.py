"""Billing exports laid out by period folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidegauge.sources.files import exists


def periods(as_of: dt.date, from_month: int, to_month: int) -> list[dt.date]:
    """First days of the months at the given offsets from the month of the day before ``as_of``."""
    base = (as_of - dt.timedelta(days=1)).replace(day=1)
    months = [base.year * 12 + base.month - 1 + i for i in range(from_month, to_month + 1)]
    return [dt.date(m // 12, m % 12 + 1, 1) for m in months]


def folder_of(period: dt.date) -> str:
    following = dt.date(period.year + period.month // 12, period.month % 12 + 1, 1)
    return f"{period:%Y%m%d}-{following - dt.timedelta(days=1):%Y%m%d}"


def read_billing_period(
    spark: SparkSession, root: str, as_of: dt.date, from_month: int, to_month: int, layout: str = "{period}/*/*.parquet"
) -> DataFrame | None:
    """Billing rows of the wanted months; months without a folder are skipped."""
    globs = [f"{root}/{layout.format(period=folder_of(p))}" for p in periods(as_of, from_month, to_month)]
    found = [g for g in globs if exists(spark, g)]
    return spark.read.option("mergeSchema", True).parquet(*found) if found else None

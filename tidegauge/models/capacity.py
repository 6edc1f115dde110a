"""Measures over capacity metrics: item × operation × day, item kind × day, and timepoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.money import as_double
from tidegauge.operators import measures as M

# The counters a day row carries.
COUNTERS = (
    "CancelledOperationCount",
    "FailureOperationCount",
    "InvalidOperationCount",
    "OperationCount",
    "RejectedOperationCount",
    "SuccessOperationCount",
    "TotalCUs",
    "DurationInSec",
    "UserCount",
)
WINDOWS = ("7d", "14d", "30d", "90d")


def totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums of the counters that the rows carry, and total and largest throttling."""
    out = {c: F.sum(c) for c in COUNTERS if c in df.columns}
    if "ThrottlingInMin" in df.columns:
        out |= {"TotalThrottling": F.sum("ThrottlingInMin"), "MaxThrottling": F.max("ThrottlingInMin")}
    return M.by_groups(df, by, **out)


def item_day(df: DataFrame, by: Sequence[str], as_of: str) -> DataFrame:
    """Average and largest CU per item and day, overall and over windows, and the 14-to-30-day trend."""
    daily = M.by_groups(df, [*dict.fromkeys([*by, "ItemId", "Date"])], _cu=F.sum("TotalCUs"))
    cu = F.col("_cu")
    flags = M.period_flags(F.col("Date"), as_of)
    out = {"AvgCU": M.ratio(as_double(F.sum(cu)), F.count(cu)), "MaxCU": as_double(F.max(cu))}
    for n in WINDOWS:
        part = F.when(flags[n], cu)
        out[f"AvgCU_{n}"] = M.ratio(as_double(F.sum(part)), F.count(part))
        out[f"MaxCU_{n}"] = as_double(F.max(part))
    base = M.by_groups(daily, by, **out)
    return base.withColumn("AvgCU_14d_vs_30d", M.ratio(F.col("AvgCU_14d") - F.col("AvgCU_30d"), F.col("AvgCU_30d")))


def against_capacity(df: DataFrame, capacity: str, item: str, as_of: str) -> DataFrame:
    """Each item's last week against the 90-day average of its capacity, whatever the item."""
    whole = item_day(df, [capacity], as_of).select(capacity, F.col("AvgCU_90d").alias("CapacityAvg_90d"))
    own = item_day(df, [capacity, item], as_of).select(capacity, item, "AvgCU_7d")
    gap = F.col("AvgCU_7d") - F.col("CapacityAvg_90d")
    return own.join(whole, capacity).withColumns(
        {
            "Difference": gap,
            "DifferenceShare": M.ratio(gap, F.col("CapacityAvg_90d")),
            "IsAbove": F.coalesce(gap > 0, F.lit(False)),
        }
    )


def kind_day(df: DataFrame, by: Sequence[str], as_of: str) -> DataFrame:
    """Totals per item kind with calendar windows, average CU and duration in minutes."""
    cu = F.col("TotalCUs")
    flags = M.period_flags(F.col("Date"), as_of)
    out = {"TotalCUs": as_double(F.sum(cu)), "AvgCUs": M.ratio(as_double(F.sum(cu)), F.count(cu))}
    out |= {f"TotalCUs_{n}": as_double(F.sum(F.when(flags[n], cu))) for n in ("CM", "PM", "CY", "PY", "14d", "30d")}
    out |= {
        "AvgDurationMin": F.sum("DurationInSec") / F.count("DurationInSec") / 60,
        "TotalDurationMin": F.sum("DurationInSec") / 60,
    }
    return M.by_groups(df, by, **out)


def cu_growth(df: DataFrame, by: Sequence[str]) -> DataFrame:
    monthly = M.by_groups(df, [*by, F.trunc("Date", "month").alias("Month")], CUs=as_double(F.sum("TotalCUs")))
    return M.period_over_period(monthly, by, "Month", Growth="CUs")


def timepoints(df: DataFrame, by: Sequence[str], as_of: str) -> DataFrame:
    """Average and largest usage per timepoint, throttled timepoints, and used share of the capacity.

    Rows carry TimePoint, TotalCUUsagePercentage, InteractiveDelayPercentage, TotalCUs and
    SKUCUByTimePoint. The windows are open-ended: everything since the day n days before ``as_of``.
    """
    points = M.by_groups(
        df,
        [*by, "TimePoint"],
        _usage=F.sum("TotalCUUsagePercentage"),
        _throttled=F.count_if(F.col("InteractiveDelayPercentage") > 1),
        _cu=F.sum("TotalCUs"),
        _sku=F.sum("SKUCUByTimePoint"),
        _top=F.max("SKUCUByTimePoint"),
    )
    out = {
        "AvgUsage": M.ratio(as_double(F.sum("_usage")), F.count("_usage")),
        "MaxUsage": as_double(F.max("_usage")),
        "ThrottlingCount": F.sum("_throttled"),
        "UsedShare": M.ratio(as_double(F.sum("_cu")), as_double(F.sum("_sku"))),
        "TimePointSKU": as_double(F.max("_top")) / 30,
    }
    for n in (14, 30, 60, 90):
        recent = F.to_date("TimePoint") >= F.date_sub(F.to_date(F.lit(as_of)), n)
        used, sku = (F.sum(F.when(recent, F.col(c))) for c in ("_cu", "_sku"))
        out[f"UsedShare_{n}d"] = M.ratio(as_double(used), as_double(sku))
    return M.by_groups(points, by, **out)


# The metrics a timepoint row may carry that are plainly added up.
TIMEPOINT_METRICS = (
    "CarryOverAddedPercentage",
    "CarryOverBurndownPercentage",
    "CarryOverCumulativePercentage",
    "ExpectedBurndownInMin",
    "OverageReferenceLine",
    "BackgroundRejectionPercentage",
    "BackgroundRejectionThreshold",
    "InteractiveRejectionPercentage",
    "InteractiveRejectionThreshold",
    "AutoscalePercentage",
    "BackgroundPercentage",
    "BackgroundNonBillablePercentage",
    "CULimitPercentage",
    "InteractivePercentage",
    "InteractiveNonBillablePercentage",
    "InteractiveDelayPercentage",
    "SKUCUByTimePoint",
    "TotalCUUsagePercentage",
    "TotalCUs",
)


def timepoint_totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums of the metrics that the timepoint rows carry."""
    return M.by_groups(df, by, **{c: as_double(F.sum(c)) for c in TIMEPOINT_METRICS if c in df.columns})


def outliers(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """CU per day against the group's average day: the difference, and the outlier factor
    ((CU - average) - average) / average."""
    daily = M.by_groups(df, [*by, "Date"], CU=F.sum("TotalCUs"))
    out = M.whatever_day(daily, by, "CU", "AnyDay", "AvgDay").withColumn("CU", as_double(F.col("CU")))
    gap = F.col("CU") - F.col("AvgDay")
    return out.withColumns({"VsAvg": gap, "OutlierFactor": M.ratio(gap - F.col("AvgDay"), F.col("AvgDay"))})


def trend(df: DataFrame, by: Sequence[str], days: int = 30) -> DataFrame:
    """Average CU per item and day over the trailing days, and how far the day's average is below it."""
    items = M.by_groups(df, [*dict.fromkeys([*by, "ItemId", "Date"])], _cu=F.sum("TotalCUs"))
    daily = M.by_groups(items, [*by, "Date"], _total=F.sum("_cu"), _n=M.rows())
    out = M.trailing_average(daily, by, "Date", "_total", "_n", days, "Trend")
    day = M.ratio(as_double(F.col("_total")), F.col("_n").cast("double"))
    return out.select(
        *by, "Date", day.alias("AvgCU"), "Trend", M.ratio(F.col("Trend") - day, F.col("Trend")).alias("TrendDifference")
    )

"""Measures over activity rows: CreationDate, UserId, Activity, ReportId, ItemId."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import measures as M

# Activity names that count as a view and as a refresh.
VIEW, REFRESH = "ViewReport", "RefreshDataset"
WINDOWS = ("CM", "PM", "CY", "PY", "14d", "30d")


def measures(df: DataFrame, by: Sequence[str], as_of: str, view: str = VIEW) -> DataFrame:
    """Activities, users and viewed reports, overall and per calendar window."""
    day = F.col("CreationDate")
    flags = {n: cond for n, cond in M.period_flags(day, as_of).items() if n in WINDOWS}
    viewed = F.col("Activity") == view
    counts = M.by_groups(
        df, by, Activities=M.rows(), Viewed=F.count_if(viewed), **{
            f"Activities_{n}": F.count_if(c) for n, c in flags.items()
        }
    )
    users = M.entities_by_flags(
        df, by, F.col("UserId"), {"Users": F.lit(True), **{f"Users_{n}": c for n, c in flags.items()}}
    )
    views = {"ViewedReports": viewed, **{f"ViewedReports_{n}": viewed & flags[n] for n in ("14d", "30d")}}
    reports = M.entities_by_flags(df, by, F.col("ReportId"), views)
    return M.join_groups(by, counts, users, reports)


def monthly_growth(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Activities and users per month with their growth over the month before."""
    month = F.trunc("CreationDate", "month").alias("Month")
    monthly = M.by_groups(df, [*by, month], Activities=M.rows(), Users=M.distinct_values(F.col("UserId")))
    return M.period_over_period(monthly, by, "Month", ActivitiesGrowth="Activities", UsersGrowth="Users")


def item_day_averages(df: DataFrame, by: Sequence[str], item: str, as_of: str, kinds: dict[str, str]) -> DataFrame:
    """Average per item and day of the activities of each kind, overall and over the last 90 days.

    Items without an activity of the kind on a day do not count for that day.
    """
    counts = {k: F.nullif(F.count_if(F.col("Activity") == name), F.lit(0)) for k, name in kinds.items()}
    recent = M.period_flags(F.col("CreationDate"), as_of)["90d"]
    daily = M.by_groups(df, list(dict.fromkeys([*by, item, "CreationDate"])), **counts)

    def average(col, where):
        n = F.when(where, col)
        return M.ratio(F.sum(n).cast("double"), F.count(n))

    out = {}
    for k in kinds:
        out[f"Avg{k}"] = average(F.col(k), F.lit(True))
        out[f"Avg{k}_90d"] = average(F.col(k), recent)
    return M.by_groups(daily, by, **out)

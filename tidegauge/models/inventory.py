"""Measures over inventories: items, settings, accesses, refreshables and analyzer runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import measures as M


def item_counts(items: DataFrame, by: Sequence[str], types: Sequence[str] | None = None) -> DataFrame:
    """Items not marked as deleted, in all and per type."""
    alive = M.is_false(F.col("deleted"))
    if types is None:
        return M.by_groups(items.filter(alive), [*by, "type"], Items=F.count("id"))
    per = {f"n_{t}": F.count(F.when(alive & (F.col("type") == t), F.col("id"))) for t in types}
    return M.by_groups(items, by, Items=F.count(F.when(alive, F.col("id"))), **per)


def settings(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Enabled and disabled settings over all snapshots and in the latest one, and the snapshots."""
    newest = df.agg(F.max("TransferDateTime").alias("t")).scalar()
    last = F.col("TransferDateTime") == newest
    on, off = F.col("enabled") == F.lit(True), M.is_false(F.col("enabled"))
    return M.by_groups(
        df,
        by,
        Enabled=F.count_if(on),
        Disabled=F.count_if(off),
        LastEnabled=F.count_if(on & last),
        LastDisabled=F.count_if(off & last),
        Value=F.sum(F.when(on, 1).otherwise(0)),
        Snapshots=M.distinct_values(F.col("TransferDateTime")),
    )


def accesses(users: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct principals, in all and per principal type."""
    kinds = {f"Accesses_{k}": F.col("PrincipalType") == k for k in ("User", "App", "Group")}
    return M.entities_by_flags(users, by, F.col("GraphId"), {"Accesses": F.lit(True), **kinds})


def refreshables(items: DataFrame, summaries: DataFrame, details: DataFrame) -> DataFrame:
    """Scheduled, enabled and disabled refreshes, and durations; one row."""
    slots = F.coalesce(F.size("days"), F.lit(0)) * F.coalesce(F.size("times"), F.lit(0))
    on, off = F.col("IsRefreshEnabled") == F.lit(True), M.is_false(F.col("IsRefreshEnabled"))
    counts = M.by_groups(
        items,
        [],
        RefreshableItems=M.rows(),
        Scheduled=F.sum(slots),
        Enabled=F.sum(F.when(on, slots)),
        Disabled=F.sum(F.when(off, slots)),
    )
    median = M.percentiles(
        summaries, [], "RefreshMedianDuration", {"m": 0.5}
    ).select((F.col("m") / 60).alias("MedianMinutes"))
    times = M.by_groups(
        summaries,
        [],
        Refreshes=F.sum("RefreshCount"),
        AvgMinutes=F.sum("RefreshAverageDuration") / F.count("RefreshAverageDuration") / 60,
        ConsiderationStart=F.min("ConsideredStartTime"),
        ConsiderationEnd=F.min("ConsideredEndTime"),
        ConsideredDays=F.sum("ConsiderationDurationSeconds") / 86400,
    )
    last = M.by_groups(
        details, [], Minutes=F.sum(
            "DurationInSeconds"
        ) / 60, AvgMinutesDet=F.sum("DurationInSeconds") / F.count("DurationInSeconds") / 60
    )
    return M.join_groups([], counts, times, median, last)


def analyzer_runs(violations: DataFrame, by: Sequence[str], run: str = "RunId") -> DataFrame:
    """Rule violations by severity and impact, over all runs and in each group's latest run."""
    cases = {f"n_{s}": F.col("severity") == s for s in ("Error", "Warning", "Info")}
    cases |= {f"n_{i}": F.col("impact").startswith(i) for i in ("Background", "Query", "Usability")}
    every = M.by_groups(violations, by, Violations=M.rows(), **{n: F.count_if(c) for n, c in cases.items()})
    latest = M.latest_only(violations, run, by)
    last = M.by_groups(latest, by, LastRun=F.max(run), **{f"{n}_last": F.count_if(c) for n, c in cases.items()})
    return M.join_groups(by, every, last)


def table_sizes(tables: DataFrame, by: Sequence[str], unit: str) -> DataFrame:
    """Rows, columns and sizes of analysed tables in a unit; user hierarchies stay in bytes."""
    sizes = ("DataSize", "DictionarySize", "HierarchySize", "RelationshipSize", "TotalSize")
    scaled = {c: M.scaled(F.sum(c), unit) for c in sizes if c in tables.columns}
    plain = {c: F.sum(c) for c in ("UserHierarchySize", "Rows", "Columns", "Partitions") if c in tables.columns}
    return M.by_groups(tables, by, **scaled, **plain)

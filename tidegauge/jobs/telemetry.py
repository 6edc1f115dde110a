"""Telemetry loads: refresh schedules, settings, billing gold tables, model sizes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import seconds_between
from tidegauge.functions.texts import json_attribute
from tidegauge.models.cost import PAUSE
from tidegauge.operators.measures import SIZE_UNITS, by_groups
from tidegauge.operators.merge import continue_keys
from tidegauge.operators.ordered import earliest


def refresh_tables(refreshables: DataFrame) -> dict[str, DataFrame]:
    """Main, days, times, summaries and details tables of refreshable items.

    Summary columns that a drop does not carry are left out.
    """
    ids = {
        "CapacityId": F.upper("capacity.id"),
        "WorkspaceId": F.upper("group.id"),
        "ItemId": F.upper("id"),
    }
    rows = refreshables.withColumns(ids)
    keys = list(ids)
    main = rows.select(
        *keys,
        F.col("name").alias("ItemName"),
        F.col("refreshSchedule.enabled").alias("IsRefreshEnabled"),
        F.col("refreshSchedule.localTimeZoneId").alias("LocalTimeZoneId"),
        F.col("kind").alias("Kind"),
    )
    extra = {
        "averageDuration": "RefreshAverageDuration",
        "medianDuration": "RefreshMedianDuration",
        "refreshCount": "RefreshCount",
    }
    start, end = F.to_timestamp("startTime"), F.to_timestamp("endTime")
    summary = rows.filter(F.col("startTime").isNotNull() & ~F.startswith(F.col("endTime"), F.lit("0001-01-01"))).select(
        *keys,
        F.date_format(start, "yyyyMMdd").alias("ConsideredStartDateKey"),
        start.alias("ConsideredStartTime"),
        end.alias("ConsideredEndTime"),
        *[F.col(c).alias(n) for c, n in extra.items() if c in refreshables.columns],
        seconds_between(start, end).alias("ConsiderationDurationSeconds"),
    )
    last_start, last_end = F.to_timestamp("lastRefresh.startTime"), F.to_timestamp("lastRefresh.endTime")
    details = rows.filter(F.col("lastRefresh.requestId").isNotNull()).select(
        *keys,
        F.col("lastRefresh.requestId").alias("RequestId"),
        F.col("lastRefresh.status").alias("Status"),
        F.col("lastRefresh.refreshType").alias("RefreshType"),
        F.date_format(last_start, "yyyyMMdd").alias("LastRefreshStartDateKey"),
        last_start.alias("LastRefreshStartTime"),
        last_end.alias("LastRefreshEndTime"),
        seconds_between(last_start, last_end).alias("DurationInSeconds"),
    )
    tables = {
        "main": main,
        "days": rows.select(*keys, F.explode("refreshSchedule.days").alias("Day")),
        "times": rows.select(*keys, F.explode("refreshSchedule.times").alias("Time")),
        "summaries": summary,
        "details": details,
    }
    return {name: df.distinct() for name, df in tables.items()}


# Merge keys of the refresh tables.
REFRESH_KEYS = {
    "main": ["WorkspaceId", "ItemId"],
    "days": ["WorkspaceId", "ItemId", "Day"],
    "times": ["WorkspaceId", "ItemId", "Time"],
    "summaries": ["WorkspaceId", "ItemId", "ConsideredStartTime", "ConsideredEndTime"],
    "details": ["WorkspaceId", "ItemId", "RequestId"],
}

KEPT_EXTRA = ("x_SkuMeterName", "x_SkuMeterSubcategory", "x_ResourceGroupName")


def with_billing_type(focus: DataFrame) -> DataFrame:
    kind = json_attribute(F.col("x_SkuDetails"), "BillingType")
    return focus.withColumn("BillingType", kind)


def all_meters(meters: DataFrame, focus: DataFrame, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """Known meters plus a row with the next key for every meter seen in the billing rows only.

    ``renamed`` maps charge descriptions to meter categories; other descriptions are the category.
    """
    category = F.col("ChargeDescription")
    for description, name in (renamed or {}).items():
        category = F.when(F.col("ChargeDescription") == description, name).otherwise(category)
    seen = focus.select(
        F.lower("x_SkuMeterName").alias("Name_Lower"),
        category.alias("Category"),
        F.when(
            F.col("BillingType").isNotNull() & (F.col("BillingType") != PAUSE), "TRUE"
        ).otherwise("FALSE").alias("Included"),
    )
    first = earliest(seen.distinct(), ["Name_Lower"], [F.col("Category"), F.col("Included")])
    keyed = continue_keys(meters.select("Name_Lower", "MeterKey"), first, "Name_Lower", "MeterKey")
    return keyed.join(first, "Name_Lower", "left")


def billing_gold(focus: DataFrame, meters: DataFrame, service: str, periods: list[str]) -> DataFrame:
    """Billing rows of a service and periods with meter key, date key and savings; ``x_`` columns go,
    but for three."""
    rows = with_billing_type(
        focus.filter((F.col("ServiceName") == service) & F.col("BillingPeriodStart").isin(periods))
    )
    keys = all_meters(meters, rows).select("Name_Lower", "MeterKey")
    joined = rows.withColumn("Name_Lower", F.lower("x_SkuMeterName")).join(keys, "Name_Lower", "left")
    out = joined.withColumns(
        {
            "ChargePeriodStart_DateKey": F.date_format("ChargePeriodStart", "yyyyMMdd").cast("int"),
            "CommitmentSavings": F.col("ContractedCost") - F.col("EffectiveCost"),
        }
    )
    kept = [c for c in focus.columns if not c.startswith("x_") or c in KEPT_EXTRA]
    return out.select(*kept, "BillingType", "ChargePeriodStart_DateKey", "MeterKey", "CommitmentSavings")


def model_sizes(segments: DataFrame, by: list[str], unit: str = "bytes") -> DataFrame:
    """Sizes by storage class, told by the second character of the table id: ``H$`` column
    hierarchies (first segment only), ``U$`` user hierarchies, ``R$`` relationships, else data."""
    prefix, size = F.left("TABLE_ID", F.lit(2)), F.col("USED_SIZE")
    worth = F.lit(SIZE_UNITS[unit])

    def total(where):
        return F.coalesce(F.sum(F.when(where, size)), F.lit(0)) / worth

    out = by_groups(
        segments,
        by,
        data_size=total(F.substring("TABLE_ID", 2, 1) != "$"),
        hierarchy_size=total((prefix == "H$") & (F.col("SEGMENT_NUMBER") == 0)),
        user_hierarchy_size=total(prefix == "U$"),
        relationship_size=total(prefix == "R$"),
        avg_temperature=F.avg("TEMPERATURE"),
    )
    parts = [F.col(c) for c in ("data_size", "hierarchy_size", "user_hierarchy_size", "relationship_size")]
    return out.withColumn("total_size", parts[0] + parts[1] + parts[2] + parts[3])


def settings_rows(settings: DataFrame) -> DataFrame:
    """One row per setting and enabled security group; settings without groups keep one row."""
    return settings.withColumn("_g", F.explode_outer("enabledSecurityGroups")).select(
        "settingName", "title", "enabled", F.col("_g.graphId").alias("GroupId"), F.col("_g.name").alias("GroupName")
    )


def capacity_people(capacities: DataFrame) -> DataFrame:
    """Admins and users of each capacity with their role."""
    admins = capacities.select(
        F.col("Id").alias("CapacityId"), F.explode("admins").alias("Principal"), F.lit("Admin").alias("Role")
    )
    users = capacities.select(
        F.col("Id").alias("CapacityId"), F.explode("users").alias("Principal"), F.lit("User").alias("Role")
    )
    return admins.unionByName(users)

"""Profile of a data factory: component totals, activities, dependencies, insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def component_totals(components: DataFrame) -> DataFrame:
    return components.groupBy("kind").agg(F.count(F.lit(1)).alias("total"))


def activities_by_type(activities: DataFrame) -> DataFrame:
    return activities.groupBy(
        F.coalesce("type", F.lit("Unknown")).alias("type")
    ).agg(F.count(F.lit(1)).alias("activities"))


def activity_metrics(pipelines: DataFrame, activities: DataFrame) -> DataFrame:
    """Total, average and largest number of activities, counting pipelines without any.

    Of pipelines with equally many activities the first by name is reported.
    """
    counts = activities.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("type") == "ExecutePipeline").alias("calls")
    )
    per = pipelines.select(F.col("name").alias("pipeline")).join(counts, "pipeline", "left").fillna(0)
    top = F.min_by("pipeline", F.struct(-F.col("n"), F.col("pipeline")))
    return per.agg(
        F.count(F.lit(1)).alias("pipelines"),
        F.sum("n").alias("activities"),
        (F.sum("n") / F.count(F.lit(1))).alias("avg_activities"),
        F.max("n").alias("max_activities"),
        top.alias("max_pipeline"),
        F.sum("calls").alias("pipeline_dependencies"),
    )


def insights(
    metrics: DataFrame,
    by_type: DataFrame,
    dataset_usage: DataFrame,
    service_usage: DataFrame,
    triggers: DataFrame,
    dataflows: DataFrame,
) -> DataFrame:
    """Findings with severity and metric. Thresholds: more than 10 activities, dataset use above 5,
    service use above 10; the dominant activity type is reported with its share."""
    total = F.sum("activities")

    def finding(df: DataFrame, id_: str, severity: str, metric, detail=F.lit(None).cast("string")) -> DataFrame:
        return df.select(
            F.lit(id_).alias("insight"),
            F.lit(severity).alias("severity"),
            metric.cast("bigint").alias("metric"),
            detail.alias("detail"),
        )

    def above(usage: DataFrame, bar: int) -> DataFrame:
        return usage.filter(F.col("usage") > bar).agg(F.count(F.lit(1)).alias("n")).filter("n > 0")

    def present(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")

    dominant = by_type.agg(
        F.max_by(
            "type", F.struct("activities", "type")
        ).alias("type"), F.max("activities").alias("n"), total.alias("all")
    ).filter("n > 0")
    share = F.concat(F.col("type"), F.lit(" "), F.format_number(F.col("n") / F.col("all") * 100, 1), F.lit("%"))
    parts = [
        finding(metrics, "factory_scale", "info", F.col("pipelines")),
        finding(
            metrics.filter("max_activities > 10"),
            "complex_pipeline",
            "warning",
            F.col("max_activities"),
            F.col("max_pipeline"),
        ),
        finding(above(dataset_usage, 5), "high_usage_datasets", "warning", F.col("n")),
        finding(present(triggers), "trigger_migration", "info", F.col("n")),
        finding(dominant, "activity_distribution", "info", F.col("n"), share),
        finding(above(service_usage, 10), "critical_connections", "critical", F.col("n")),
        finding(present(dataflows), "unsupported_dataflows", "critical", F.col("n")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

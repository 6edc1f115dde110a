"""Star schema of a model audit: object, model, report and user dimensions, usage and log facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import hash_key
from tidegauge.operators.joins import latest_rows
from tidegauge.operators.sets import tagged_union, union_distinct
from tidegauge.session import cut_lineage


def dim_model_object(
    report_measures: DataFrame, columns: DataFrame, measures: DataFrame, unused: DataFrame, sources: DataFrame
) -> DataFrame:
    """Latest definition of every report measure, column, measure and unused column.

    Inputs hold ModelUuid, TableName, ObjectName, Expression, AsOfDate and AsOfDateTime; columns and
    measures not seen on the last day are flagged as deleted from the model, and objects not seen on
    the last day of all as deleted from the store.
    """
    keys = ["ModelUuid", "TableName", "ObjectName"]

    def newest(df: DataFrame, kind: str, deleted: Column | None = None) -> DataFrame:
        last = latest_rows(df, keys, "AsOfDateTime")
        flag = F.when(F.col("AsOfDate") == df.agg(F.max("AsOfDate").alias("d")).scalar(), "False").otherwise("True")
        return last.select(
            *keys, "Expression", "AsOfDate", "AsOfDateTime", F.lit(kind).alias("ObjectType"), (
                flag if deleted is None else deleted
            ).alias("DeletedFromModelFlag")
        )

    # The union of the latest definitions is read three times below.
    objects = cut_lineage(union_distinct(
        newest(report_measures, "REPORT MEASURE", F.lit("False")),
        newest(columns, "COLUMN"),
        newest(measures, "MEASURE"),
        newest(unused, "COLUMN", F.lit("True")),
    ))
    last = latest_rows(objects, [*keys, "Expression"], "AsOfDateTime")
    final_day = objects.agg(F.max("AsOfDate").alias("d")).scalar()
    named = last.join(sources, ["ModelUuid", "TableName", "ObjectName"], "left")
    identity = F.when(F.col("ObjectType") == "REPORT MEASURE", F.col("Expression")).otherwise(F.col("ObjectName"))
    return named.select(
        *keys,
        "ObjectType",
        "Expression",
        "DeletedFromModelFlag",
        F.coalesce("SourceTableName", F.lit("N/A")).alias("SourceTableName"),
        F.coalesce("SourceColumnName", F.lit("N/A")).alias("SourceColumnName"),
        F.when(F.col("AsOfDate") == final_day, "False").otherwise("True").alias("DeletedFromDatastoreFlag"),
        hash_key(F.col("ModelUuid"), F.col("TableName"), identity).alias("ModelObjectId"),
    )


def dim_model(runs: DataFrame) -> DataFrame:
    """Rows of each model's latest completed run."""
    done = runs.filter(F.col("Status") == "completed").groupBy("ModelUuid").agg(
        F.max("AsOfDateTime").alias("AsOfDateTime")
    )
    return runs.join(done, ["ModelUuid", "AsOfDateTime"], "left_semi")


def dim_report(reports: DataFrame, app_reports: DataFrame) -> DataFrame:
    """Latest state of each report; reports inside apps take the original's name and place."""
    latest = latest_rows(reports, ["ReportId"], "AsOfDateTime").drop("AsOfDateTime")
    original = latest.select(
        F.col("ReportId").alias("OriginalReportId"),
        F.col("ReportName").alias("OriginalName"),
        F.col("WorkspaceId").alias("OriginalWorkspace"),
    )
    mapped = app_reports.join(original, "OriginalReportId", "left").distinct()
    joined = latest.join(mapped, F.col("ReportId") == F.col("AppReportId"), "left")
    name = F.coalesce("OriginalName", "ReportName")
    return joined.select(
        F.col("ReportId").alias("ReportUuid"),
        F.when(F.col("ReportId") == "", "Non-Report").otherwise(name).alias("ReportName"),
        F.coalesce("OriginalWorkspace", "WorkspaceId").alias("WorkspaceUuid"),
        F.col("AppReportId").isNotNull().alias("IsAppReport"),
        F.coalesce("OriginalReportId", "ReportId").alias("OriginalReportUuid"),
    ).distinct()


def dim_user(query_counts: DataFrame, logs: DataFrame) -> DataFrame:
    both = query_counts.select(F.lit("Masked").alias("ExecutingUser"), "ExecutingUserGroup").unionByName(
        logs.select("ExecutingUser", "ExecutingUserGroup")
    )
    key = hash_key(F.col("ExecutingUser"), F.col("ExecutingUserGroup"))
    return both.distinct().withColumn("UserId", key)


def fact_query_count(query_counts: DataFrame, mapping: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Usage of each object, and the same usage credited to the objects it depends on."""
    named = query_counts.join(mapping, ["ModelUuid", "RunUuid", "ModelObject"], "left")
    identity = F.when(F.col("ObjectType") == "REPORT MEASURE", F.col("ModelObject")).otherwise(F.col("ObjectName"))
    user = hash_key(F.lit("Masked"), F.col("ExecutingUserGroup"))
    shown = ["ModelUuid", "AsOfDate", "AsOfHour", "ModelObjectId", "ReportUuid", "UserId", "QueryCount"]
    named = named.withColumns({"UserId": user, "ReportUuid": F.coalesce("ReportId", F.lit("N/A"))})
    direct = named.withColumn(
        "ModelObjectId", hash_key(F.col("ModelUuid"), F.col("TableName"), identity)
    ).select(*shown)
    refs = dependencies.select(
        "ModelUuid", "RunUuid", "TableName", "ObjectName", "ReferencedTableName", "ReferencedObjectName"
    ).distinct()
    indirect = (
        refs.join(named, ["ModelUuid", "RunUuid", "TableName", "ObjectName"])
        .withColumn(
            "ModelObjectId", hash_key(F.col("ModelUuid"), F.col("ReferencedTableName"), F.col("ReferencedObjectName"))
        )
        .select(*shown)
    )
    return tagged_union("DirectReferenceFlag", **{"True": direct, "False": indirect})


def fact_logs(logs: DataFrame) -> DataFrame:
    user = hash_key(F.col("ExecutingUser"), F.col("ExecutingUserGroup"))
    return logs.withColumns({"UserId": user, "DateTime": F.col("Timestamp"), "ReportUuid": F.col("ReportId")}).drop(
        "ExecutingUser", "ExecutingUserGroup", "Timestamp", "ReportId"
    )


def fact_statistics(columns: DataFrame, sizes: DataFrame, timings: DataFrame) -> DataFrame:
    """Residency, sizes and cold-cache timings per column and day; every side is averaged on its own
    before the joins, so that several measurements of one side cannot inflate another's counts."""
    keys = ["ModelUuid", "TableName", "ColumnName", "AsOfDate"]
    base = columns.groupBy(*keys).agg(
        F.count("IsResident").alias(
            "ColumnResidencyMeasuredCount"
        ), F.count_if("IsResident").alias("ColumnResidencyTrueCount")
    )
    size = sizes.groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in ("TotalSize", "DataSize", "DictionarySize", "HierarchySize") if c in sizes.columns]
    )
    cold = timings.groupBy(*keys).agg(F.avg("Duration").alias("DurationTime"), F.avg("CpuTime").alias("CpuTime"))
    out = base.join(size, keys, "left").join(cold, keys, "left")
    key = hash_key(F.col("ModelUuid"), F.col("TableName"), F.col("ColumnName"))
    return out.withColumn("ModelObjectId", key)

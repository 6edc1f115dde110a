"""Measures over SQL request history and gateway logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import measures as M


def request_history(df: DataFrame, by: Sequence[str], time_unit: str = "seconds", size_unit_mb: int = 1) -> DataFrame:
    """Runs, rows, cache hits, success rate, durations, CPU and scanned data per group."""

    def time(col: Column) -> Column:
        return M.scaled(col, time_unit, M.TIME_UNITS)

    return M.by_groups(
        df,
        by,
        Runs=M.rows(),
        RowCount=F.sum("row_count"),
        CacheHits=F.sum("result_cache_hit"),
        SuccessRate=M.ratio(F.count_if(F.col("status") == "Succeeded"), M.rows()),
        TotalElapsed=time(F.sum("total_elapsed_time_ms")),
        MaxElapsed=time(F.max("total_elapsed_time_ms")),
        AllocatedCpu=time(F.sum("allocated_cpu_time_ms")),
        MaxAllocatedCpu=F.max("allocated_cpu_time_ms"),
        DiskScanned=F.sum("data_scanned_disk_mb") / size_unit_mb,
        RemoteScanned=F.sum("data_scanned_remote_storage_mb") / size_unit_mb,
        LastTimestamp=F.max("end_time"),
    )


def gateway_queries(
    df: DataFrame, by: Sequence[str], time_unit: str = "seconds", size_unit: str = "megabytes"
) -> DataFrame:
    """Requests, trackings and durations of gateway query executions.

    Success is told per request: a request counts as succeeded or failed when one of its rows does.
    """
    times = {
        "ExecutionDuration": "QueryExecutionDurationMs",
        "ProcessingDuration": "DataProcessingDurationMs",
        "ReadingDuration": "DataReadingAndSerializationDurationMs",
        "SpoolReadingDuration": "SpoolingDiskReadingDurationMs",
        "SpoolWritingDuration": "SpoolingDiskWritingDurationMs",
    }
    sums = {n: M.scaled(F.sum(c), time_unit, M.TIME_UNITS) for n, c in times.items() if c in df.columns}
    if "SpoolingTotalDataSizeByte" in df.columns:
        sums["SpoolSize"] = M.scaled(F.sum("SpoolingTotalDataSizeByte"), size_unit)
    flags = {"Requests": F.lit(True), "_good": F.col("Success") == "Y", "FailedRequests": F.col("Success") == "N"}
    requests = M.entities_by_flags(df, by, F.col("RequestId"), flags)
    trackings = M.by_groups(df, by, QueryTrackings=M.distinct_values(F.col("QueryTrackingId")), **sums)
    out = M.join_groups(by, requests, trackings)
    return out.withColumn("SuccessRatio", M.ratio(F.col("_good"), F.col("Requests"))).drop("_good")


# System counters, and whether their average is a percentage.
COUNTERS = {
    "SystemCPUPercent": "percent",
    "SystemMEMUsedPercent": "percent",
    "GatewayCPUPercent": "percent per core",
    "GatewayMEMKb": "KB",
    "GatewayActiveAsyncIOThreadCount": "count",
    "GatewayActiveWorkerThreadCount": "count",
}


def gateway_counters(
    df: DataFrame, by: Sequence[str], cores: int = 1, kb_per_unit: int = 1, counters=COUNTERS
) -> DataFrame:
    """Average of each system counter: percentages as fractions, process CPU per core, memory in a unit."""
    worth = {"percent": 100, "percent per core": 100 * cores, "KB": kb_per_unit, "count": 1}

    def average(name: str) -> Column:
        value = F.when(F.col("CounterName") == name, F.col("Average"))
        return M.ratio(F.sum(value), F.count(value))

    return M.by_groups(df, by, **{n: average(n) / worth[kind] for n, kind in counters.items()})


def evaluations(df: DataFrame, day: str, time_unit: str = "seconds", size_unit: str = "megabytes") -> DataFrame:
    """Evaluation resources by their end day instead of the start day other measures go by."""

    def average(col: str) -> Column:
        return M.ratio(F.sum(col), F.count(col))

    return M.by_groups(
        df,
        [day],
        AvgCommit=M.scaled(average("AverageCommitByte"), size_unit),
        MaxCommit=M.scaled(F.max("MaxCommitByte"), size_unit),
        AvgWorkingSet=M.scaled(average("AverageWorkingSetByte"), size_unit),
        # The source model averages the largest working sets under this name.
        MaxWorkingSet=M.scaled(average("MaxWorkingSetByte"), size_unit),
        ProcessorTime=M.scaled(F.sum("TotalProcessorTimeMs"), time_unit, M.TIME_UNITS),
        Rows=F.sum("TotalRows"),
        QueryTrackings=M.distinct_values(F.col("QueryTrackingId")),
    )

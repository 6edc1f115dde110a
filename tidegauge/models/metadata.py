"""Measures over model metadata: counts, health, documentation, partitions and their series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import measures as M
from tidegauge.operators.joins import expand_series


def health(objects: Mapping[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Verdict per kind of object and for the model: no errors and every state Ready.

    Objects carry ``error`` and ``state``; the model is healthy when all kinds are. A group without
    objects of a kind has nothing faulty there.
    """
    parts = None
    for kind, df in objects.items():
        part = df.select(*by, F.lit(kind).alias("_kind"), "error", "state")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        raise ValueError("no objects")

    def bad(kind: str):
        mine = F.col("_kind") == kind
        return F.count_if(mine & F.col("error").isNotNull()), F.count_if(mine & (F.col("state") != "Ready"))

    verdicts = {f"{k}Healthy": M.health(*bad(k)) for k in objects}
    out = M.by_groups(parts, by, **verdicts)
    good = F.lit(True)
    for name in verdicts:
        good = good & (F.col(name) == "Healthy")
    return out.withColumn("ModelHealthy", F.when(good, "Healthy").otherwise("Faulty"))


def documented(objects: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of objects with a description."""
    filled = F.count_if(F.coalesce(F.col("description"), F.lit("")) != "")
    return M.by_groups(objects, by, Objects=M.rows(), DocumentedShare=M.ratio(filled, M.rows()))


def dependencies(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return M.by_groups(
        df, by, Objects=M.distinct_values(F.col("OBJECT")), Referenced=M.distinct_values(F.col("REFERENCED_OBJECT"))
    )


def dictionary_sizes(columns: DataFrame, by: Sequence[str], unit: str = "bytes") -> DataFrame:
    """Dictionary size of the data columns, and the average temperature of all dictionaries."""
    own = F.when(F.col("COLUMN_TYPE") == "BASIC_DATA", F.col("DICTIONARY_SIZE"))
    return M.by_groups(
        columns,
        by,
        DictionarySize=M.scaled(F.sum(own), unit),
        AvgTemperature=M.ratio(F.sum("DICTIONARY_TEMPERATURE"), F.count("DICTIONARY_TEMPERATURE")),
    )


def partition_statistics(partitions: DataFrame, by: Sequence[str], unit: str = "bytes") -> DataFrame:
    """Average, median, least and most rows per partition, and their data sizes in a unit."""
    simple = M.by_groups(
        partitions,
        by,
        AvgRows=M.ratio(F.sum("rows").cast("double"), F.count("rows")),
        MinRows=F.min("rows"),
        MaxRows=F.max("rows"),
        SumSize=M.scaled(F.sum("bytes"), unit),
        AvgSize=M.scaled(M.ratio(F.sum("bytes").cast("double"), F.count("bytes")), unit),
    )
    medians = M.percentiles(partitions, by, "rows", {"MedianRows": 0.5})
    return M.join_groups(by, simple, medians)


def partition_series(partitions: DataFrame, table: str, index: str, last: int = 64) -> DataFrame:
    """Running rows and bytes over a series of partitions 1..last of each table.

    Partitions that exist are Current, the rest Simulation; every step adds the table's average per
    existing partition, rounded.
    """
    averages = partitions.groupBy(table).agg(
        (F.sum("rows") / F.count("rows")).alias("_rows"), (F.sum("bytes") / F.count("bytes")).alias("_bytes")
    )
    grid = expand_series(averages, F.lit(1), F.lit(last), "value")
    existing = partitions.select(table, F.col(index).alias("value")).distinct().withColumn("_current", F.lit("Current"))
    # A table's series has at most `last` rows, and every step adds the same amount.
    return grid.join(existing, [table, "value"], "left").select(
        table,
        "value",
        F.coalesce("_current", F.lit("Simulation")).alias("version"),
        (F.floor(F.col("_rows") + 0.5) * F.col("value")).cast("double").alias("running_rows"),
        (F.floor(F.col("_bytes") + 0.5) * F.col("value")).cast("double").alias("running_bytes"),
    )

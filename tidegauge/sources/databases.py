"""Snapshot and incremental reads of database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_snapshot(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A whole table over JDBC, in parallel range scans of a numeric column.

    Rows outside the bounds are read too; the bounds only place the cuts.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
        )
        .options(**(options or {}))
        .load()
    )


def unmoved(changes: DataFrame, moved: DataFrame, change_id: str) -> DataFrame:
    """Change rows not yet recorded as moved; the source itself is never updated."""
    return changes.join(moved.select(change_id), change_id, "left_anti")


def record_moved(batch: DataFrame, change_id: str, ledger: str) -> None:
    """Append the ids of a batch to the ledger folder, so that a batch costs its own rows only.

    Earlier ids are not read again: ``unmoved`` has left them out. An append that is repeated after a failure repeats
    ids, which ``unmoved`` does not mind.
    """
    batch.select(change_id).distinct().write.mode("append").parquet(ledger)

"""Copies, backups, archives, change files and the run ledger."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.merge import MARKER
from tidegauge.sources.files import child_names, delete, exists, read_text, rename, write_text
from tidegauge.tables.versioned import append, read_current, write_version


def archive(df: DataFrame, path: str, day: Column) -> None:
    """Append to the history, in folders by year, month and day."""
    parts = {"y": F.date_format(day, "yyyy"), "m": F.date_format(day, "MM"), "d": F.date_format(day, "dd")}
    append(df.withColumns(parts), path, ["y", "m", "d"])


def back_up(df: DataFrame, path: str, day: str) -> None:
    """Dated copy of a table; a second backup of a day replaces the first."""
    df.withColumn("backup_date", F.lit(day).cast("date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("backup_date").parquet(path)


def kept_backups(backups: DataFrame, as_of: str, days: int) -> DataFrame:
    """Backups of the last days: the input of the rewrite that drops older ones (a partition filter)."""
    return backups.filter(F.col("backup_date") >= F.date_sub(F.to_date(F.lit(as_of)), days))


def moved_path(
    path: Column, workspace: tuple[str, str], lakehouse: tuple[str, str], by_id: bool = False, suffix: str = ""
) -> Column:
    """Where a table of one workspace and lakehouse belongs in another.

    ``workspace`` and ``lakehouse`` are (old, new) names, or ids with ``by_id``. Paths look like
    ``abfss://workspace@host/lakehouse.Lakehouse/...``, without the extension by id. ``suffix`` marks
    recovered tables and is added by name only. Only whole names are replaced; a path of another workspace
    or lakehouse keeps that part.
    """
    old, new = (f"abfss://{name}@" for name in workspace)
    kind = "" if by_id else ".Lakehouse"
    moved = F.when(path.startswith(old), F.concat(F.lit(new), F.substr(path, F.lit(len(old) + 1)))).otherwise(path)
    moved = F.replace(moved, F.lit(f"/{lakehouse[0]}{kind}/"), F.lit(f"/{lakehouse[1]}{kind}/"))
    return moved if by_id else F.concat(moved, F.lit(suffix))


def copy_tables(spark: SparkSession, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Copy parquet tables, with a log row per table: source, target, start, end and seconds.

    Spark copies each table in parallel; this loop only starts one job per table.
    """
    log = []
    for name, (source, target) in pairs.items():
        started = time.time()
        spark.read.parquet(source).write.mode("overwrite").parquet(target)
        ended = time.time()
        log.append((name, source, target, started, ended, ended - started))
    out = spark.createDataFrame(
        log, "table_name string, source string, target string, started double, ended double, seconds double"
    )
    return out.withColumns({c: F.timestamp_seconds(c) for c in ("started", "ended")})


def copy_in_batches(source: DataFrame, target_path: str, key: str, cuts: Sequence) -> None:
    """Copy a table in ranges of its high-water column; each range is one job over its rows only.

    Each range has a folder of its own below the target (partition column ``range``), which counts as done once its
    success marker exists. A restart with the same cuts writes the ranges that are not done, and those as a whole, so
    a broken job loses and doubles nothing. Rows without a key belong to the first range.
    """
    spark = source.sparkSession
    bounds = [None, *cuts, None]
    for number, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        folder = f"{target_path}/range={number}"
        if exists(spark, f"{folder}/_SUCCESS"):
            continue
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(key) > low)
        if high is not None:
            inside = inside & (F.col(key) <= high)
        if low is None:
            inside = inside | F.col(key).isNull()
        source.filter(inside).write.mode("overwrite").parquet(folder)


def reconcile(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of both sides per table."""
    out = None
    for name, df in source.items():
        row = df.agg(F.count(F.lit(1)).alias("source_rows")).select(
            F.lit(name).alias("table_name"),
            "source_rows",
            target[name].agg(F.count(F.lit(1)).alias("n")).scalar().alias("target_rows"),
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


# Change files -----------------------------------------------------------------------------------

# Names of the landing zone, its 20-digit file names and its marker column.
VALID_NAME = re.compile(r"[A-Za-z0-9_\-]+")


def landing_folder(root: str, schema: str, table: str) -> str:
    for name in (schema, table):
        if not VALID_NAME.fullmatch(name):
            raise ValueError(f"invalid name {name!r}")
    return f"{root}/{schema}.schema/{table}"


def create_landing_table(spark: SparkSession, root: str, schema: str, table: str, keys: Sequence[str]) -> str:
    folder = landing_folder(root, schema, table)
    write_text(spark, f"{folder}/_metadata.json", json.dumps({"keyColumns": list(keys)}, separators=(",", ":")))
    return folder


def key_columns(spark: SparkSession, folder: str) -> list[str]:
    return json.loads(read_text(spark, f"{folder}/_metadata.json"))["keyColumns"]


def published(spark: SparkSession, folder: str) -> int:
    """Number of the last file of the last complete change set; 0 before the first."""
    return max((int(n) for n in child_names(spark, f"{folder}/_published") if n.isdigit()), default=0)


def next_sequence(spark: SparkSession, folder: str) -> int:
    return published(spark, folder) + 1


def write_change_files(df: DataFrame, folder: str, order: Sequence[str] = ()) -> list[int]:
    """Add a change set as the next files of the sequence and return their numbers.

    Rows are spread by key, so that all changes of a key share a file, in ``order``. Tasks write the
    files in parallel under a temporary name; only the renames into the sequence happen here. The set counts once its
    last number stands in ``_published``: after a crash between renames readers see nothing of it, and a retry replaces
    what is there under the same numbers.
    """
    spark = df.sparkSession
    if not exists(spark, f"{folder}/_metadata.json"):
        raise ValueError("Table not found.")  # fixed value: the message that callers test for
    if not df.columns or df.columns[-1] != MARKER:
        raise ValueError(f"{MARKER} must be the last column")
    number = next_sequence(spark, folder)
    temp = f"{folder}/_tmp-{number:020d}"
    spread = df.repartition(*[F.col(c) for c in key_columns(spark, folder)])
    if order:
        spread = spread.sortWithinPartitions(*order)
    spread.write.mode("overwrite").parquet(temp)
    parts = [n for n in child_names(spark, temp) if n.endswith(".parquet")]
    for i, part in enumerate(parts):
        target = f"{folder}/{number + i:020d}.parquet"
        delete(spark, target)
        rename(spark, f"{temp}/{part}", target)
    last = number + len(parts) - 1
    write_text(spark, f"{folder}/_published/{last}", "")
    for name in child_names(spark, f"{folder}/_published"):
        if name.isdigit() and int(name) < last:
            delete(spark, f"{folder}/_published/{name}")
    return list(range(number, last + 1))


def read_change_files(spark: SparkSession, folder: str, after: int = 0) -> DataFrame:
    """Change rows of complete sets with their file number and place in the file."""
    name = F.col("_metadata.file_name")
    rows = spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)
    return rows.select(
        "*",
        F.substring(name, 1, 20).cast("bigint").alias("_file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_place"),
    ).filter(F.col("_file").between(after + 1, published(spark, folder)))


# Run ledger -------------------------------------------------------------------------------------


def start_run(ledger: DataFrame, run: str, at: Column) -> DataFrame:
    row = ledger.sparkSession.range(1).select(
        F.lit(run).alias("run_id"), F.lit("started").alias("status"), at.alias("at")
    )
    return ledger.unionByName(row)


def finish_run(ledger: DataFrame, run: str, status: str, at: Column) -> DataFrame:
    hit = F.col("run_id") == run
    return ledger.withColumns(
        {"status": F.when(hit, F.lit(status)).otherwise(F.col("status")), "at": F.when(hit, at).otherwise(F.col("at"))}
    )


def incomplete_runs(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") != "completed").select("run_id")


def purge_incomplete(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the runs that completed; rows of unknown runs stay."""
    return rows.join(incomplete_runs(ledger), "run_id", "left_anti")


def mark_removed(ledger: DataFrame) -> DataFrame:
    """Ledger after a purge: whatever did not complete is removed."""
    return ledger.withColumn("status", F.when(F.col("status") != "completed", "removed").otherwise(F.col("status")))


def purge_tables(spark: SparkSession, roots: Sequence[str], ledger: DataFrame) -> DataFrame:
    """Publish a version without the rows of incomplete runs of every table, and return the ledger with those removed.

    The ledger is marked last: a purge that breaks off is repeated for all tables, which changes nothing where it was done.
    """
    for root in roots:
        write_version(purge_incomplete(read_current(spark, root), ledger), root)
    return mark_removed(ledger)

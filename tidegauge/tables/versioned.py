"""Tables as parquet version folders, so that readers never see a half-written state.

``root/v=000007`` counts once its ``_SUCCESS`` marker exists, which the job writes last; readers
take the highest such version and an interrupted write is simply never seen. One writer per table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.merge import merge
from tidegauge.sources.files import child_names, exists



def _versions(spark: SparkSession, root: str) -> list[str]:
    return [n for n in child_names(spark, root) if n.startswith("v=")]


def current_path(spark: SparkSession, root: str) -> str | None:
    for name in reversed(_versions(spark, root)):
        if exists(spark, f"{root}/{name}/_SUCCESS"):
            return f"{root}/{name}"
    return None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    path = current_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"no published version below {root}")
    return spark.read.parquet(path)  # one job wrote the version, so all its files share a schema


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition before a write, so that a partition gets few files; partitions that
    are too big for one task are split, small ones share a task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Publish a new version and return its path. Fails if another writer took the same number."""
    names = _versions(df.sparkSession, root)
    number = int(names[-1][2:]) + 1 if names else 1
    path = f"{root}/v={number:06d}"
    laid_out(df, partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a plain parquet table; new columns show up for readers that merge schemas."""
    laid_out(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    laid_out(df, partition_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).parquet(path)


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str) -> None:
    """Merge into a table partitioned by ``partition``, rewriting only the partitions in the source.

    ``partition`` must be one of the keys, so that a row never moves. The old rows are joined with the touched
    partition values, which prunes the scan at run time; replaced files are moved in when the job commits, so the job
    may read the table it rewrites.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys")
    touched = source.select(F.col(partition).alias("_touched")).distinct()
    current = spark.read.parquet(path)
    old = current.join(touched, F.col(partition) == F.col("_touched"), "left_semi")
    overwrite_partitions(merge(old, source, keys), path, [partition])


def clean_name(name: str) -> str:
    """Column name without the characters that parquet tables refuse."""
    return re.sub(r"[ .]", "_", re.sub(r"[(),;{}\n\t]", "", name))


def sanitised(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    out = df.toDF(*[clean_name(c) for c in df.columns])
    return out.withColumn("load_timestamp", F.current_timestamp() if loaded_at is None else loaded_at)


def save_sanitised(df: DataFrame, path: str, loaded_at: Column | None = None) -> bool:
    """Append with clean names and a load timestamp; an empty input writes nothing."""
    if df.isEmpty():
        return False
    append(sanitised(df, loaded_at), path)
    return True


def ensure_table(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The current version, after publishing an empty one if there is none."""
    if current_path(spark, root) is None:
        write_version(spark.createDataFrame([], schema), root)
    return read_current(spark, root)


def missing_columns(definition: DataFrame, existing: DataFrame) -> DataFrame:
    """Defined (table, column) pairs that do not exist yet; struct columns are left to the loads."""
    wanted = definition.filter(~F.lower("data_type").startswith("struct"))
    return wanted.join(existing, ["table_name", "column_name"], "left_anti")


def with_columns(df: DataFrame, added: dict[str, str]) -> DataFrame:
    """Add missing columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in added.items() if c not in df.columns})


def retyped(df: DataFrame, **types: str) -> DataFrame:
    """Change column types, keeping order and all other columns."""
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def compacted(df: DataFrame, total_bytes: int, target_bytes: int = 256 << 20) -> DataFrame:
    """Same rows in about ``total_bytes / target_bytes`` evenly filled files."""
    return df.repartition(max(1, -(-total_bytes // target_bytes)))


def split_name(name: str) -> tuple[str, str]:
    """``schema__table`` → (schema, table)."""
    schema, _, table = name.partition("__")
    return schema, table


def insensitive(df: DataFrame, collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Text columns collated so that comparisons ignore case and accents."""
    return df.select(
        *[
            F.collate(
                F.col(f"`{f.name}`"), collation
            ).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )

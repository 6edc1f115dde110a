"""Delimited files: meters, load files with rejects, price-paid files and gateway logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import columns as C
from tidegauge.operators.merge import MARKER, status_marker
from tidegauge.operators.ordered import earliest, row_numbers

CORRUPT = "_corrupt_record"


def read_keyed_csv(spark: SparkSession, path: str, name: str, key: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with a lower-case key; of rows with the same key the first in column order stays."""
    rows = spark.read.option("header", True).schema(schema).csv(path).withColumn(key, F.lower(name))
    return earliest(rows, [key], [F.col(c) for c in rows.columns if c != key])


def load_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, out: str, sep: str = "|"
) -> tuple[DataFrame, DataFrame]:
    """Load delimited files into ``out``: rows that fit the schema, and rejected lines with their file.

    One pass writes all columns, split by outcome. The written rows are returned because a scan that
    needs few columns parses only those and would miss the errors in the others.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(full)
        .options(sep=sep, quote='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .csv(path)
    )
    rows.withColumns({"rejected": F.col(CORRUPT).isNotNull(), "file": F.col("_metadata.file_name")}).write.partitionBy(
        "rejected"
    ).parquet(out)
    loaded = spark.read.schema(
        T.StructType([*full.fields, T.StructField("file", T.StringType()), T.StructField("rejected", T.BooleanType())])
    ).parquet(out)
    good = loaded.filter(~F.col("rejected")).select(*schema.fieldNames())
    bad = loaded.filter("rejected").select("file", F.col(CORRUPT).alias("line"))
    return good, bad


# The positional fields of a price-paid line.
PRICE_PAID = (
    "TransactionId string, Price double, DateOfTransfer string, Postcode string, PropertyType string, IsNew string, "
    "DurationType string, PrimaryAddressableObjectName string, SecondaryAddressableObjectName string, Street string, "
    "Locality string, TownCity string, District string, County string, CategoryType string, RecordStatus string"
)


def read_price_paid(spark: SparkSession, path: str) -> DataFrame:
    """Headerless price-paid lines, decoded; the 16th field may be missing, unknown codes fail."""
    rows = spark.read.schema(PRICE_PAID).options(header=False, escape='"', nullValue="\0", emptyValue="").csv(path)
    return rows.withColumns(
        {
            "DateOfTransfer": F.to_timestamp("DateOfTransfer", "yyyy-MM-dd HH:mm"),
            "PropertyType": C.decode_strict(F.col("PropertyType"), C.PROPERTY_TYPES),
            "IsNew": C.decode_strict(F.col("IsNew"), {"Y": "true", "N": "false"}).cast("boolean"),
            "DurationType": C.decode_strict(F.col("DurationType"), C.DURATIONS),
            "CategoryType": C.decode_strict(F.col("CategoryType"), C.CATEGORIES),
        }
    )


def price_paid_changes(rows: DataFrame) -> DataFrame:
    """Change rows of price-paid lines; the marker comes last."""
    renamed = rows.withColumnsRenamed({"IsNew": "OldNew", "DurationType": "Duration"})
    marker = status_marker(F.col("RecordStatus"))
    return renamed.withColumn(MARKER, marker).drop("RecordStatus")


def read_logs(
    spark: SparkSession, folder: str, contains: str, schema: T.StructType | str, columns: Sequence[str] | None = None
) -> DataFrame:
    """All log files whose name contains a text; unreadable files are dropped."""
    rows = (
        spark.read.schema(schema)
        .options(
            header=True,
            quote='"',
            escape='"',
            pathGlobFilter=f"*{contains}*.log",
            recursiveFileLookup=True,
            ignoreCorruptFiles=True,
        )
        .csv(folder)
        .withColumn("file", F.col("_metadata.file_name"))
    )
    return rows.select(*columns, "file") if columns is not None else rows


def unparsable(logs_path_rows: DataFrame, json_col: str) -> DataFrame:
    """File and line number of the rows whose JSON column does not parse. The header is line 1.

    ``logs_path_rows`` must come straight from a file scan. A line's place in its file is its place in its split plus
    the rows of the splits before, so only one row per split is grouped: with its number of rows and its bad rows, which
    a split's length bounds.
    """
    broken = F.col(json_col).isNotNull() & F.expr(f"try_parse_json({json_col})").isNull()
    placed = logs_path_rows.select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.when(broken, F.col(json_col)).alias("_bad"),
    )
    splits = placed.groupBy("_path", "file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_at").alias("_first"),
        F.collect_list(F.when(F.col("_bad").isNotNull(), F.struct("_at", "_bad"))).alias("_found"),
    )
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    started = splits.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    found = started.select("file", "_start", "_first", F.explode("_found").alias("_b"))
    line = (F.col("_start") + F.col("_b._at") - F.col("_first") + 2).alias("line")
    return found.select("file", line, F.col("_b._bad").alias(json_col))

"""Tables about tables: columns, units and their drift."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.measures import SIZE_UNITS, TIME_UNITS

METADATA = "table_name string, column_name string, position int, data_type string, nullable boolean"


def column_metadata(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of the given tables."""
    rows = [
        (name, f.name, i + 1, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, METADATA)


def column_fill(name: str, df: DataFrame) -> DataFrame:
    """Rows and filled values per column of a table, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("filled")) for c in df.columns])
    return counts.select(
        F.lit(name).alias("table_name"), F.col("_rows").alias("rows"), F.explode(pairs).alias("p")
    ).select(
        "table_name", "p.*", "rows"
    )


UNITS = {"size": SIZE_UNITS, "time": TIME_UNITS}


def units(spark: SparkSession) -> DataFrame:
    """Size and time units with their worth in the stored unit."""
    rows = [(kind, n, v) for kind, table in UNITS.items() for n, v in table.items()]
    return spark.createDataFrame(rows, "kind string, unit string, unit_value bigint")


def with_units(df: DataFrame, kind: str) -> DataFrame:
    """Each row once per unit of a kind. The table is a handful of constants, so it is exploded in
    place; a join with it would have no key."""
    rows = F.array(
        *[F.struct(F.lit(n).alias("unit"), F.lit(v).cast("bigint").alias("unit_value")) for n, v in UNITS[kind].items()]
    )
    return df.withColumn("_u", F.explode(rows)).select(*df.columns, "_u.*")


# Regions of capacities with continent, latitude, longitude and place.
REGIONS = [
    ("Asia Pacific", "Australia East", 31.2532, 146.9211, "New South Wales"),
    ("Asia Pacific", "Australia Southeast", 36.9848, 143.3906, "Victoria"),
    ("Asia Pacific", "Central India", 18.5204, 73.8567, "Pune"),
    ("Asia Pacific", "East Asia", 22.3193, 114.1694, "Hong Kong"),
    ("Asia Pacific", "Japan East", 35.6764, 139.65, "Tokyo"),
    ("Asia Pacific", "Korea Central", 37.5519, 126.9918, "Seoul"),
    ("Asia Pacific", "Southeast Asia", 1.3521, 103.8198, "Singapore"),
    ("Asia Pacific", "South India", 13.0827, 80.2707, "Chennai"),
    ("Europe", "North Europe", 53.7798, 7.3055, "Ireland"),
    ("Europe", "West Europe", 52.1326, 5.2913, "Netherlands"),
    ("Europe", "France Central", 48.8566, 2.3522, "Paris"),
    ("Europe", "Germany West Central", 50.1109, 8.6821, "Frankfurt am Main"),
    ("Europe", "Norway East", 59.9139, 10.7522, "Oslo"),
    ("Europe", "Sweden Central", 60.6749, 17.1413, "Gävle"),
    ("Europe", "Switzerland North", 47.3769, 8.5417, "Zürich"),
    ("Europe", "Switzerland West", 46.2044, 6.1432, "Geneva"),
    ("Europe", "UK South", 51.5072, -0.1276, "London"),
    ("Europe", "UK West", 51.4837, -3.1681, "Cardiff"),
    ("Americas", "Brazil South", -23.5558, -46.6396, "São Paulo State"),
    ("Americas", "Canada Central", 43.6532, -79.3832, "Toronto"),
    ("Americas", "Canada East", 46.8131, -71.2075, "Quebec City"),
    ("Americas", "East US", 37.4316, -78.6569, "Virginia"),
    ("Americas", "East US 2", 37.4316, -78.6569, "Virginia"),
    ("Americas", "North Central US", 40.6331, -89.3985, "Illinois"),
    ("Americas", "South Central US", 31.9686, -99.9018, "Texas"),
    ("Americas", "West US", 36.7783, -119.4179, "California"),
    ("Americas", "West US 2", 47.7511, -120.7401, "Washington"),
    ("Americas", "West US 3", 34.0489, -111.0937, "Arizona"),
    ("Middle East and Africa", "South Africa North", -26.2056, 28.0337, "Johannesburg"),
    ("Middle East and Africa", "UAE North", 25.2048, 55.2708, "Dubai"),
]
REGION = "continent string, region string, latitude double, longitude double, location string"

# Content provider types with shown name, "included in the optimisation" and "default semantic model".
CONTENT_TYPES = [
    ("InCompositeMode", "Composite Mode", False, True),
    ("InDirectQueryMode", "DirectQuery Mode", False, True),
    ("InImportMode", "Import Mode", False, True),
    ("PbixInCompositeMode", "Composite Mode", True, False),
    ("PbixInDirectQueryMode", "DirectQuery Mode", True, False),
    ("PbixInImportMode", "Import Mode", True, False),
    ("PbixInLiveConnectionMode", "Live Connection Mode", False, False),
    ("RealTimeInPushMode", "Push Mode", False, False),
    ("RealTimeInStreamingMode", "Streaming Mode", False, False),
    ("Unknown", "Semantic Model in App", False, False),
    ("UsageMetricsUserReport", "Usage Metrics", False, False),
    ("UsageMetricsUserDashboard", "Usage Metrics", False, False),
    ("CSV", "CSV", False, False),
    ("Excel", "Excel", False, False),
]
CONTENT_TYPE = "content_type string, mapped_name string, in_optimization boolean, is_default boolean"


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, REGION)


def content_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONTENT_TYPES, CONTENT_TYPE)


def with_static(df: DataFrame, static: DataFrame, name: str, key: str) -> DataFrame:
    """Rows with the columns of a static table, by the value of ``name``; unknown and null values get nulls.

    The static tables above have at most 30 rows, so they are broadcast.
    """
    renamed = static.withColumnRenamed(key, "_static_key")
    return df.join(F.broadcast(renamed), F.col(name) == F.col("_static_key"), "left").drop("_static_key")


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Added, dropped and re-typed columns between two column-metadata tables."""
    o = old.select("table_name", "column_name", F.col("data_type").alias("old_type"))
    n = new.select("table_name", "column_name", F.col("data_type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "dropped")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return o.join(
        n, ["table_name", "column_name"], "full"
    ).withColumn("change", change).filter(F.col("change").isNotNull())


def drift_report(changes: DataFrame) -> DataFrame:
    """One line of column names per table and kind of change."""
    return changes.groupBy("table_name", "change").agg(
        F.expr("listagg(column_name, ', ') WITHIN GROUP (ORDER BY column_name)").alias("columns")
    )

"""Set operations and table comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(tag: str, **parts: DataFrame) -> DataFrame:
    """UNION ALL of the parts, each with its name in the tag column."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_distinct(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies`` = copies in a - copies in b.

    One grouping over both inputs: equal rows cancel before the shuffle.
    """
    both = a.withColumn("_copies", F.lit(1)).unionByName(b.withColumn("_copies", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("_copies").alias("copies")).filter(F.col("copies") != 0)


def equivalence(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row telling whether two results agree in columns, number of rows and rows as a multiset."""
    rows_a = a.agg(F.count(F.lit(1)).alias("n"))
    rows_b = b.agg(F.count(F.lit(1)).alias("n"))
    same_columns = sorted(a.columns) == sorted(b.columns)
    if same_columns:
        wrong = differences(a, b).agg(F.count(F.lit(1)).alias("different_rows"))
    else:
        wrong = rows_a.select(F.col("n").alias("different_rows"))
    return wrong.select(
        F.lit(same_columns).alias("same_columns"),
        (rows_a.scalar() == rows_b.scalar()).alias("same_count"),
        "different_rows",
        ((F.col("different_rows") == 0) & F.lit(same_columns)).alias("equal"),
    )


def content_signature(df: DataFrame) -> DataFrame:
    """Row count and an order-independent hash of the whole content, to recognise unchanged tables.

    Hashes are summed as decimals: unlike XOR, a sum does not let pairs of equal rows vanish.
    """
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row_hash = F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\0")) for c in cols]).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(row_hash).cast("string").alias("content_hash"))

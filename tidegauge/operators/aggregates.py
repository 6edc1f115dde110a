"""Grouped jobs: activity summaries, completed groups, pivots, text lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.ordered import earliest
from tidegauge.session import cut_lineage


def activity_summary(
    df: DataFrame, day: str, as_of: str, days: int, output: Sequence[str], user: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Count of activities and distinct users of the last days.

    ``extra`` are columns grouped by but not shown (the source's own grain, in which shown rows may
    repeat); leave it empty to get one row per shown combination.
    """
    recent = df.filter(F.col(day) >= F.date_sub(F.to_date(F.lit(as_of)), days))
    return (
        recent.groupBy(*output, *extra)
        .agg(F.count(F.lit(1)).alias("CountOfActivities"), F.count_distinct(user).alias("DistinctCountOfUsers"))
        .drop(*extra)
    )


def unique_rows(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """Distinct rows, or one row per key: the first in ``order``, so that runs agree."""
    return df.distinct() if keys is None else earliest(df, keys, order)


def completed_prefix(
    runs: DataFrame, combo: Sequence[str], query: str, success: Column, enough: int, too_many: int
) -> DataFrame:
    """First query id still to run.

    A combination is done for a query after ``enough`` successes or ``too_many`` failures; a query
    is complete when every combination seen is done; the answer follows the gapless prefix 1, 2, ….
    """
    counts = runs.groupBy(*combo, query).agg(
        F.count_if(success).alias("_good"), F.count_if(~success).alias("_bad")
    )
    # Read four times below; one row per combination and query is materialised instead of the runs.
    done = cut_lineage(counts.filter((F.col("_good") >= enough) | (F.col("_bad") >= too_many)).select(*combo, query))
    combos = done.select(*combo).distinct().agg(F.count(F.lit(1)).alias("_combos"))
    complete = (
        done.groupBy(query).agg(F.count(F.lit(1)).alias("_valid")).filter(F.col("_valid") == combos.scalar())
    )
    # Given that 1 is complete, the prefix ends at the smallest id whose successor is missing.
    following = complete.filter(F.col(query) >= 1).select((F.col(query) + 1).alias(query))
    missing = following.join(complete.select(query), query, "left_anti")
    has_first = complete.agg(F.coalesce(F.bool_or(F.col(query) == 1), F.lit(False)).alias("f"))
    return missing.agg(F.min(query).alias("m")).select(
        F.when(has_first.scalar(), F.col("m")).otherwise(F.lit(1).cast("bigint")).alias("starting_query_id")
    )


def pivot_pairs(df: DataFrame, by: Sequence[str], key: str, value: str, keys: Sequence[str]) -> DataFrame:
    """Key/value rows to one column per listed key."""
    return df.groupBy(*by).pivot(key, list(keys)).agg(F.first(value, ignorenulls=True))


def text_list(by: str, col: str, sep: str = ", ") -> str:
    """SQL of an ordered text list of a group's distinct values."""
    return f"listagg(DISTINCT {col}, '{sep}') WITHIN GROUP (ORDER BY {col})"


def above_share(df: DataFrame, by: Sequence[str], value: Column, fraction: str) -> DataFrame:
    """Groups whose total exceeds a decimal fraction of the grand total."""
    totals = df.groupBy(*by).agg(value.alias("total"))
    bar = totals.agg((F.sum("total") * F.expr(fraction)).alias("bar"))
    return totals.filter(F.col("total") > bar.scalar())



"""Gaps, unions and timelines of intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.ordered import Running, running


def missing_hours(hours: DataFrame, by: Sequence[str], hour: str) -> DataFrame:
    """Contiguous hours of a day without rows, as ``start_hour`` and exclusive ``end_hour``.

    A group holds at most 24 distinct hours, so its set is a small array and the islands are found
    row by row.
    """
    seen = hours.select(*by, hour).distinct().groupBy(*by).agg(F.collect_set(hour).alias("_seen"))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(23)), F.col("_seen"))
    starts = F.filter("_missing", lambda h: ~F.array_contains("_missing", h - 1))
    ends = F.filter("_missing", lambda h: ~F.array_contains("_missing", h + 1))
    return (
        seen.withColumn("_missing", missing)
        .withColumn("_gap", F.explode(F.arrays_zip(starts.alias("s"), ends.alias("e"))))
        .select(*by, F.col("_gap.s").alias("start_hour"), (F.col("_gap.e") + 1).alias("end_hour"))
    )


def covered(df: DataFrame, by: Sequence[str], start: str, end: str, tie_break: Sequence[str], name: str) -> DataFrame:
    """Each interval's part that no earlier interval of its group covers.

    The sum of the parts is the length of the union; overlapping time counts once.
    """
    order = [F.col(start), F.col(end), *[F.col(c) for c in tie_break]]
    reach = running(df, by, order, _reach=Running("max", F.col(end), inclusive=False))
    begin = F.greatest(F.col(start), F.col("_reach"))
    return reach.withColumn(name, F.greatest(F.lit(0), F.col(end) - begin)).drop("_reach")


def engine_split(
    df: DataFrame, by: Sequence[str], start: str, end: str, tie_break: Sequence[str], total: Column, cpu: Column
) -> DataFrame:
    """Net parallel duration of storage work, the rest of the total, and the parallelism."""
    parts = covered(df, by, start, end, tie_break, "_part")
    sums = parts.groupBy(*by).agg(F.sum("_part").alias("storage"), total.alias("total"), cpu.alias("cpu"))
    return sums.withColumns(
        {
            "formula": F.greatest(F.lit(0), F.col("total") - F.col("storage")),
            "parallelism": F.when(F.col("storage") > 0, F.col("cpu") / F.col("storage")).otherwise(F.lit(0.0)),
        }
    )


def timeline(
    df: DataFrame,
    by: Sequence[str],
    start: str,
    end: str,
    tie_break: Sequence[str],
    first: Column,
    last: Column,
    least_gap: int,
) -> DataFrame:
    """Events of a group in order, with idle gaps longer than ``least_gap`` as rows of their own.

    ``first`` and ``last`` bound the group's time and must be constant within it. A gap counts from
    the latest end so far, also when an earlier event ends after a later one.
    """
    order = [F.col(start), F.col(end), *[F.col(c) for c in tie_break]]
    bounded = df.withColumns({"_first": first, "_last": last})
    reach = running(bounded, by, order, _reach=Running("max", F.col(end), inclusive=False))
    since = F.greatest(F.col("_first"), F.col("_reach"))

    def row(kind: str, s: Column, e: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), s.alias("from_at"), e.alias("to_at"))

    gap = F.when(F.col(start) - since > least_gap, row("gap", since, F.col(start)))
    pieces = F.array_compact(F.array(gap, row("event", F.col(start), F.col(end))))
    keep = [*by, "_first", "_last"]
    body = reach.select(*keep, F.explode(pieces).alias("_p"))
    tail = (
        df.withColumns({"_first": first, "_last": last})
        .groupBy(*keep)
        .agg(F.max(end).alias("_end"))
        .filter(F.col("_last") - F.col("_end") > least_gap)
        .select(*keep, row("gap", F.col("_end"), F.col("_last")).alias("_p"))
    )
    span = F.col("_last") - F.col("_first")
    return body.unionByName(tail).select(
        *by,
        "_p.*",
        (F.col("_p.from_at") - F.col("_first")).alias("start_offset"),
        (F.col("_p.to_at") - F.col("_first")).alias("end_offset"),
        F.when(span > 0, (F.col("_p.from_at") - F.col("_first")) * 100 / span).otherwise(0.0).alias("relative_start"),
        F.when(span > 0, (F.col("_p.to_at") - F.col("_first")) * 100 / span).otherwise(0.0).alias("relative_end"),
    )


def label_with_latest(df: DataFrame, key: str, name: str, ts: Sequence[str], out: str) -> DataFrame:
    """Label every row of a key with the key's latest name."""
    names = df.groupBy(key).agg(F.max_by(name, F.struct(*ts)).alias(out))
    return df.join(names, key)

"""Mergeable sketches beside the exact measures: distinct counts (HyperLogLog) and quantiles (KLL) per day.

A sketch table has one row per group and day. Sketches of several days are united without going back to the rows, so that
a calendar window of any length reads its days only; an exact distinct count can't be added up like that. Estimates are
opt-in: every function here says how far off they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default sizes: 2^LOG_K registers of a distinct sketch, K of a quantile sketch.
LOG_K, K = 14, 400


def distinct_error(log_k: int = LOG_K, deviations: float = 4.0) -> float:
    """Relative error of a united distinct count that is exceeded with the odds of ``deviations`` standard deviations.

    1.04 / sqrt(registers) is the standard error of merged HyperLogLog registers.
    """
    return deviations * 1.04 / math.sqrt(1 << log_k)


def rank_error(k: int = K) -> float:
    """Normalised rank error of a quantile at 99 % confidence: 2.296 / k^0.9021, which is how KLL sketches scale."""
    return 2.296 / k**0.9021


def daily(
    df: DataFrame, by: Sequence[str], day: str, distinct: Mapping[str, str], quantiles: Mapping[str, str], log_k: int = LOG_K, k: int = K
) -> DataFrame:
    """One row per group and day: row count ``n``, a distinct sketch per name of ``distinct`` and a quantile sketch per
    name of ``quantiles`` (names to columns). Nulls are in neither; a group without values has an empty or null sketch.
    """
    counts = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(log_k)).alias(name) for name, c in distinct.items()]
    ranks = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(name) for name, c in quantiles.items()]
    return df.groupBy(*by, day).agg(F.count(F.lit(1)).alias("n"), *counts, *ranks)


def united(days: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = ()) -> DataFrame:
    """Sketches of the given days as one per group; also of what was united before."""
    counts = [F.hll_union_agg(c).alias(c) for c in distinct]
    ranks = [F.kll_merge_agg_double(c).alias(c) for c in quantiles]
    return days.groupBy(*by).agg(F.sum("n").alias("n"), *counts, *ranks)


def distinct_estimate(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_estimate(sketch: str, fraction: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(fraction))


def over_windows(days: DataFrame, day: str, windows: DataFrame) -> DataFrame:
    """Each day once per window (name, first, last) that it lies in.

    Windows become one row per window and calendar day, so that rows meet them by the day and not by comparing ranges.
    A window that ends before it begins, or has no bounds, holds no day.
    """
    of_day = windows.filter(F.col("first") <= F.col("last")).withColumn(day, F.explode(F.sequence("first", "last")))
    return days.join(of_day, day)

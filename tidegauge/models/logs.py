"""Metrics over operation logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.measures import by_groups, ratio


def metrics(df: DataFrame, by: Sequence[str], totals: Mapping[str, str], maxima: Mapping[str, str]) -> DataFrame:
    """Unique operations by kind and outcome, users, and totals and maxima of the given columns.

    Rows carry ``OperationId``, ``ExecutingUser``, ``Status`` and ``Kind`` (Query, Refresh or other).
    """
    kind = F.col("Kind")
    known = kind.isin("Query", "Refresh")
    flags = {
        "operations": known,
        "_good": known & (F.col("Status") == "Succeeded"),
        "queries": kind == "Query",
        "refreshes": kind == "Refresh",
        "errors": F.col("Status") == "Failed",
    }
    # Operations are reduced to one row each first: counting five distinct sets of them directly
    # would send every row through the shuffle five times.
    inner = by_groups(
        df,
        [*by, "OperationId"],
        **{f"_{n}": F.bool_or(F.coalesce(cond, F.lit(False))).cast("int") for n, cond in flags.items()},
        **{f"_{n}_total": F.sum(c) for n, c in totals.items()},
        **{f"_{n}_max": F.max(c) for n, c in {**totals, **maxima}.items()},
    )
    out = by_groups(
        inner,
        by,
        **{n: F.sum(f"_{n}") for n in flags},
        **{f"{n}_total": F.sum(f"_{n}_total") for n in totals},
        **{f"{n}_max": F.max(f"_{n}_max") for n in [*totals, *maxima]},
    )
    users = by_groups(df, by, users=F.count_distinct("ExecutingUser"))
    joined = out.join(users, list(by)) if by else out.withColumn("users", users.scalar())
    return joined.withColumn("success_ratio", ratio(F.col("_good"), F.col("operations"))).drop("_good")

"""Grouped aggregates kept up to date from changes, instead of being built again from the whole table.

A batch of change rows becomes signed rows: the old row of every changed key is retracted (-1), its new row added (+1).
Counts and sums add up with their signs. A least or greatest value can only get out of date when a row that had it is
retracted; such groups, and no others, are read again from the table. The stored state has one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.merge import DELETE, MARKER
from tidegauge.operators.ordered import latest
from tidegauge.session import stored

SIGN = "_sign"


@dataclass(frozen=True)
class Kept:
    """What is kept per group of ``by``: the row count, and per column its sum (of an exact type) or least and greatest.

    A state has the columns ``by``, ``n``, ``sum_x`` and ``some_x`` (number of values) for sums, ``min_x`` and ``max_x``.
    """

    by: Sequence[str]
    sums: Sequence[str] = ()
    extremes: Sequence[str] = ()

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.by, *self.sums, *self.extremes]))


def build(kept: Kept, rows: DataFrame) -> DataFrame:
    """The state of a whole table."""
    return _grouped(kept, rows.select(*kept.columns()).withColumn(SIGN, F.lit(1))).select(*_names(kept))


def _grouped(kept: Kept, signed: DataFrame) -> DataFrame:
    """Signed counts and sums; extremes of what is added and, as ``out_min_x`` and ``out_max_x``, of what is retracted."""
    added = F.col(SIGN) > 0
    out = [F.sum(SIGN).cast("long").alias("n")]
    for x in kept.sums:
        wide = f"decimal(38,{_scale(dict(signed.dtypes)[x])})"
        out.append(F.coalesce(F.sum(F.when(added, F.col(x)).otherwise(-F.col(x))), F.lit(0)).cast(wide).alias(f"sum_{x}"))
        out.append(F.sum(F.when(F.col(x).isNull(), 0).otherwise(F.col(SIGN))).cast("long").alias(f"some_{x}"))
    for x in kept.extremes:
        out += [F.min(F.when(added, F.col(x))).alias(f"min_{x}"), F.max(F.when(added, F.col(x))).alias(f"max_{x}")]
        out += [F.min(F.when(~added, F.col(x))).alias(f"out_min_{x}"), F.max(F.when(~added, F.col(x))).alias(f"out_max_{x}")]
    return signed.groupBy(*kept.by).agg(*out)


def _scale(kind: str) -> int:
    if kind.startswith("decimal"):
        return int(kind.rstrip(")").partition(",")[2])
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return 0
    raise ValueError(f"sums are kept of whole numbers and decimals only, not of {kind}: others depend on the order")


def plain(kept: Kept, state: DataFrame) -> DataFrame:
    """The state's results: sums are null where no value is left, as in a grouping."""
    sums = [F.when(F.col(f"some_{x}") > 0, F.col(f"sum_{x}")).alias(f"sum_{x}") for x in kept.sums]
    return state.select(*kept.by, "n", *sums, *[f"{m}_{x}" for x in kept.extremes for m in ("min", "max")])


def signed_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What a batch of change rows retracts from ``target`` and adds to it: its columns and the sign.

    The last change per key counts; a deletion or an update of a key that the target lacks retracts nothing. Keys are not
    null. The target is only searched for the changed keys.
    """
    last = latest(changes, keys, [F.col(c) for c in order])
    old = target.join(last.select(*keys), list(keys), "left_semi").withColumn(SIGN, F.lit(-1))
    new = last.filter(F.col(MARKER) != DELETE).select(*target.columns).withColumn(SIGN, F.lit(1))
    return old.unionByName(new)


def refresh(kept: Kept, state: DataFrame, signed: DataFrame, table: DataFrame) -> DataFrame:
    """The state after signed rows. ``table`` has the rows after the changes; only groups whose extreme went are read.

    Groups without rows vanish. Null is a group like others.
    """
    news = _grouped(kept, signed.select(*kept.columns(), SIGN))
    own = state.select(*[F.col(c).alias(f"old_{c}") for c in state.columns], F.lit(True).alias("_known"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in kept.by], F.lit(True))
    both = own.join(news.withColumn("_touched", F.lit(True)), same, "full_outer")
    touched, known = F.col("_touched").isNotNull(), F.col("_known").isNotNull()

    def added(name: str) -> Column:
        return (F.coalesce(F.col(f"old_{name}"), F.lit(0)) + F.coalesce(F.col(name), F.lit(0))).cast(dict(state.dtypes)[name]).alias(name)

    gone = F.lit(False)
    out = [F.when(known, F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) for c in kept.by]
    out += [added("n"), *[added(f"{m}_{x}") for x in kept.sums for m in ("sum", "some")]]
    for x in kept.extremes:
        low, high = F.least(f"old_min_{x}", f"min_{x}"), F.greatest(f"old_max_{x}", f"max_{x}")
        gone = gone | F.coalesce(F.col(f"out_min_{x}") <= low, F.lit(False)) | F.coalesce(F.col(f"out_max_{x}") >= high, F.lit(False))
        out += [low.alias(f"min_{x}"), high.alias(f"max_{x}")]
    after = both.select(*out, (touched & gone).alias("_again")).filter("n > 0")
    if not kept.extremes:
        return after.drop("_again")
    after = stored(after, "incremental-state")
    groups = after.filter("_again").select(*[F.col(c).alias(f"again_{c}") for c in kept.by])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"again_{c}")) for c in kept.by], F.lit(True))
    redone = build(kept, table.join(groups, same, "left_semi"))
    return after.filter(~F.col("_again")).drop("_again").unionByName(redone)


def _names(kept: Kept) -> list[str]:
    sums = [f"{m}_{x}" for x in kept.sums for m in ("sum", "some")]
    return [*kept.by, "n", *sums, *[f"{m}_{x}" for x in kept.extremes for m in ("min", "max")]]

"""Numbering and running values over an order that no single task has to hold.

A window function sorts each of its groups inside one task, so a group with a third of all rows is
a straggler, and a window without groups is one task for everything. Here rows are range-sorted by
(group, order) into slices, the slices are stored as a table, each slice computes its own prefix,
and a table with at most one row per slice carries the prefix of a group that crosses slices. As the
slices are columns of a file, the pass that makes the carries reads keys and inputs only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import stored

_OVER_PARTS = {"count": "sum"}  # counts of slices add up
SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above 33 bits of row position


@dataclass(frozen=True)
class Running:
    """One running value: ``sum``, ``max``, ``min``, ``count`` or ``last`` (last non-null) of ``col``.

    ``inclusive=False`` leaves the row itself out, which makes ``last`` a lag over non-null values.
    """

    how: str
    col: Column
    inclusive: bool = True


def _reduce(how: str, col: str, position: str) -> Column:
    if how == "sum":
        return F.sum(col)
    if how == "max":
        return F.max(col)
    if how == "min":
        return F.min(col)
    if how == "count":
        return F.count(col)
    if how == "last":
        return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(position)))
    raise ValueError(f"unknown running value {how}")


def _windowed(how: str, col: str) -> Column:
    if how == "last":
        return F.last(col, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[how](col)


def _combine(how: str, local: Column, carry: Column) -> Column:
    if how in ("sum", "count"):
        total = F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
        return F.when(local.isNotNull() | carry.isNotNull(), total)
    if how == "last":
        return F.coalesce(local, carry)
    return (F.greatest if how == "max" else F.least)(local, carry)


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column], **values: Running) -> DataFrame:
    """Add running values per group ``by`` in ``order`` (which must be unique within a group)."""
    keys = [F.col(c) for c in by]
    inputs = {f"_in_{name}": spec.col for name, spec in values.items()}
    sliced = stored(
        df.withColumns(inputs)
        .sort(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_at", SLICE_BITS).cast("int")),
        "slices",
    )
    upto = Window.partitionBy("_slice", *by).orderBy("_at")
    local = {
        f"_local_{name}": _windowed(spec.how, f"_in_{name}").over(
            upto.rowsBetween(Window.unboundedPreceding, 0 if spec.inclusive else -1)
        )
        for name, spec in values.items()
    }

    # One row per (group, slice); groups inside a single slice carry nothing and are dropped.
    parts = sliced.groupBy("_slice", *by).agg(
        F.max("_at").alias("_end"),
        *[_reduce(spec.how, f"_in_{name}", "_at").alias(f"_part_{name}") for name, spec in values.items()],
    )
    slices = Window.partitionBy(*by).orderBy("_slice")
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        parts.withColumns(
            {f"_carry_{n}": _windowed(_OVER_PARTS.get(s.how, s.how), f"_part_{n}").over(before) for n, s in values.items()}
        )
        .withColumn("_nth", F.row_number().over(slices))
        .filter(F.col("_nth") > 1)
        .select(
            F.col("_slice").alias("_cslice"),
            *[F.col(c).alias(f"_key_{c}") for c in by],
            *[f"_carry_{n}" for n in values],
        )
    )
    # At most one group continues into each slice, so this side has at most one row per slice.
    on = F.col("_slice") == F.col("_cslice")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    joined = sliced.withColumns(local).join(F.broadcast(carried), on, "left")
    out = {n: _combine(s.how, F.col(f"_local_{n}"), F.col(f"_carry_{n}")) for n, s in values.items()}
    return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rn") -> DataFrame:
    """row_number() per group, or over the whole table when ``by`` is empty."""
    if by:
        return running(df, by, order, **{name: Running("count", F.lit(1))})
    sliced = stored(df.sort(*order).withColumn("_at", F.monotonically_increasing_id()), "slices")
    slice_no = F.shiftright("_at", SLICE_BITS)
    sizes = sliced.groupBy(slice_no.alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per slice of the sort: a bounded table, so a window over all of it is safe.
    before = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = F.col("_at").bitwiseAND(F.lit((1 << SLICE_BITS) - 1))
    return (
        sliced.join(F.broadcast(starts), slice_no == F.col("_s"))
        .withColumn(name, F.col("_start") + position + 1)
        .select(*df.columns, name)
    )


def ranks(df: DataFrame, by: Sequence[str], value: Column, name: str = "rank") -> DataFrame:
    """rank() per group, largest value first: ties share a rank and gaps follow.

    Only the distinct values are ordered: a value's rank is one more than the rows above it.
    """
    valued = df.withColumn("_v", value)
    counted = valued.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = running(counted, by, [F.col("_v").desc()], _above=Running("sum", F.col("_n"), inclusive=False))
    right = placed.select(
        F.col("_v").alias("_rv"),
        *[F.col(c).alias(f"_r_{c}") for c in by],
        (F.coalesce("_above", F.lit(0)) + 1).alias(name),
    )
    cond = F.col("_v").eqNullSafe(F.col("_rv"))
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return valued.join(right, cond).select(*df.columns, name)


def latest(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row per group, as an aggregate: rows are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in by]
    picked = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*by, "_row.*").select(*df.columns)


def earliest(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per group."""
    rest = [c for c in df.columns if c not in by]
    picked = df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*by, "_row.*").select(*df.columns)

"""Measure families: aggregate expressions and group-wise calculations over star-schema facts.

Blank rules: a ratio over zero is blank, a distinct count sees blank as one value, ``x = false``
also matches blank, ``x <> v`` keeps blank, and ``+ 0`` turns a blank sum into 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.ordered import Running, running

# What one unit is worth in the stored unit (bytes, milliseconds).
SIZE_UNITS = {"bytes": 1, "kilobytes": 1024, "megabytes": 1048576, "gigabytes": 1073741824}
TIME_UNITS = {"milliseconds": 1, "seconds": 1000, "minutes": 60000, "hours": 3600000}


def rows() -> Column:
    return F.count(F.lit(1))


def filtered(agg, value: Column, where: Column) -> Column:
    """An aggregate over the rows that satisfy a predicate."""
    return agg(F.when(where, value))


def entities_by_flags(df: DataFrame, by: Sequence[str], entity: Column, flags: Mapping[str, Column]) -> DataFrame:
    """Distinct entities per group that have a row satisfying each predicate; blank is one entity.

    Entities are reduced to a row of flags first, so any number of predicates costs one shuffle of
    the reduced rows instead of one copy of every row per distinct count.
    """
    met = {f"_{n}": F.bool_or(F.coalesce(cond, F.lit(False))).cast("int") for n, cond in flags.items()}
    inner = by_groups(df.withColumn("_entity", entity), [*by, "_entity"], **met)
    return by_groups(inner, by, **{n: F.sum(f"_{n}") for n in flags})


def join_groups(by: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Measures of several grain computed per the same groups, side by side."""
    out = parts[0]
    for part in parts[1:]:
        if by:
            out = out.join(part, list(by), "left")
        else:
            out = out.withColumns({c: part.select(c).scalar() for c in part.columns})
    return out


def or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def is_false(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) == F.lit(False)


def differs(col: Column, value) -> Column:
    return ~col.eqNullSafe(F.lit(value))


def distinct_values(col: Column) -> Column:
    """Distinct count in which blank counts as a value."""
    return F.count_distinct(col) + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def scaled(total: Column, unit: str, units: Mapping[str, int] = SIZE_UNITS) -> Column:
    return total / F.lit(units[unit])


def by_groups(df: DataFrame, by: Sequence, **measures: Column) -> DataFrame:
    """One row per group with the given measures; no group columns give one row in all."""
    cols = [c.alias(n) for n, c in measures.items()]
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def two_level(df: DataFrame, inner: Sequence[str], value: Column, outer: Sequence[str], **measures) -> DataFrame:
    """Sum per inner group, then aggregate those sums per outer group.

    Each measure is a function such as ``F.avg`` applied to the inner sums.
    """
    sums = df.groupBy(*dict.fromkeys([*inner, *outer])).agg(value.alias("_inner"))
    return by_groups(sums, outer, **{n: f(F.col("_inner")) for n, f in measures.items()})


def period_flags(day: Column, as_of: str) -> dict[str, Column]:
    """Predicates for calendar windows around ``as_of``."""
    now = F.to_date(F.lit(as_of))
    flags = {
        "CM": F.trunc(day, "month") == F.trunc(now, "month"),
        "PM": F.trunc(day, "month") == F.trunc(F.add_months(now, -1), "month"),
        "CY": F.year(day) == F.year(now),
        "PY": F.year(day) == F.year(now) - 1,
    }
    flags.update({f"{n}d": day.between(F.date_sub(now, n), now) for n in (7, 14, 30, 60, 90)})
    return flags


def period_over_period(monthly: DataFrame, by: Sequence[str], month: str, **growth: str) -> DataFrame:
    """(current - previous) / previous per calendar month; a missing previous month gives blank.

    ``growth`` names the result of each value column. The input is one row per group and month, so
    a window holds as many rows as there are months; a row further back than a month does not count.
    """
    months = Window.partitionBy(*by).orderBy(month)
    adjacent = F.lag(month).over(months) == F.add_months(month, -1)
    out = {}
    for name, value in growth.items():
        previous = F.when(adjacent, F.lag(value).over(months))
        out[name] = ratio(F.col(value) - previous, previous)
    return monthly.withColumns(out)


def to_date_totals(daily: DataFrame, by: Sequence[str], day: str, value: str) -> DataFrame:
    """Month-to-date and year-to-date running totals over one row per group and day.

    The input is already one row per day, so a window holds at most 366 rows per group and year.
    """
    year, month = F.year(day), F.trunc(day, "month")
    upto = (Window.unboundedPreceding, 0)
    mtd = Window.partitionBy(*by, month).orderBy(day).rowsBetween(*upto)
    ytd = Window.partitionBy(*by, year).orderBy(day).rowsBetween(*upto)
    return daily.withColumns({f"{value}_mtd": F.sum(value).over(mtd), f"{value}_ytd": F.sum(value).over(ytd)})


def latest_only(df: DataFrame, run: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the latest run, overall or per group."""
    if not by:
        return df.filter(F.col(run) == df.agg(F.max(run)).scalar())
    newest = df.groupBy(*by).agg(F.max(run).alias(run))
    return df.join(newest, [*by, run], "left_semi")


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: Column, name: str) -> DataFrame:
    return running(df, by, order, **{name: Running("sum", value)})


def share_of_total(df: DataFrame, by: Sequence[str], value: Column, name: str) -> DataFrame:
    """Total per group and its share of everything; the grand total is a one-row subquery."""
    totals = df.groupBy(*by).agg(value.alias("total"))
    return totals.withColumn(name, ratio(F.col("total"), totals.agg(F.sum("total")).scalar()))


def whatever_day(daily: DataFrame, by: Sequence[str], total: str, any_day: str, average: str) -> DataFrame:
    """Total over all days and average per day, whatever day the row is filtered to.

    ``daily`` holds one row per group and day, so a window holds as many rows as there are days.
    """
    days = Window.partitionBy(*by)
    whole = F.sum(total).over(days).cast("double")
    return daily.withColumns({any_day: whole, average: whole / F.count(F.lit(1)).over(days)})


def trailing_average(
    daily: DataFrame, by: Sequence[str], day: str, total: str, n: str, days: int, name: str
) -> DataFrame:
    """Average over the trailing days up to each day, whatever day the row is filtered to.

    ``daily`` holds one row per group and day with a total and the number of values in it, so a
    frame spans at most ``days`` + 1 rows.
    """
    number = F.datediff(F.col(day), F.lit("1970-01-01"))
    frame = Window.partitionBy(*by).orderBy(number).rangeBetween(-days, 0)
    sums = [F.sum(c).over(frame).cast("double") for c in (total, n)]
    return daily.withColumn(name, ratio(*sums))


def health(errors: Column, not_ready: Column) -> Column:
    return F.when(errors + not_ready == 0, "Healthy").otherwise("Faulty")


def percentiles(
    df: DataFrame, by: Sequence[str], value: str, wanted: Mapping[str, float], method: str = "linear"
) -> DataFrame:
    """Exact percentiles per group, without bringing a group into one task.

    Equal values are counted first; a running count over the ordered values then tells which value
    sits at each position. ``linear`` interpolates between neighbours, ``nearest`` takes one value.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(rows().alias("_n"))
    placed = running(counted, by, [F.col(value)], _upto=Running("sum", F.col("_n")))
    sizes = placed.groupBy(*by).agg(F.max("_upto").alias("_size"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    sizes = sizes.select("_size", *[F.col(c).alias(f"_s_{c}") for c in by])
    if by:
        sized = placed.join(sizes, on)
    else:
        sized = placed.withColumn("_size", sizes.scalar())
    out = []
    for name, q in wanted.items():
        place = F.lit(q) * (F.col("_size") - 1)
        low, high = F.floor(place), F.ceil(place)
        if method == "nearest":
            low = high = F.floor(place + 0.5)
        elif method != "linear":
            raise ValueError(f"unknown method {method}")

        def at(position: Column) -> Column:
            # 0-based position p is held by the value whose running count first exceeds p
            held = (F.col("_upto") > position) & (F.col("_upto") - F.col("_n") <= position)
            return F.max(F.when(held, F.col(value)))

        weight = F.max(place - F.floor(place)) if method == "linear" else F.lit(0.0)
        out.append((at(low) * (1 - weight) + at(high) * weight).alias(name))
    return sized.groupBy(*by).agg(*out) if by else sized.agg(*out)

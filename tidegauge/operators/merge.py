"""Upserts, snapshots and change data as DataFrame functions.

Each function returns the new state of the target; ``tables.versioned`` publishes it. Inputs hold
one row per key; reduce the source with ``ordered.latest`` first where a key may repeat.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.ordered import latest, row_numbers

DELETED, MODIFIED = "deleted", "modified_at"


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    t = target.select(*[F.col(f"`{c}`").alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(f"`{c}`").alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    on = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return t.join(s, cond, how)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: bool = True,
    when: Column | None = None,
) -> DataFrame:
    """Update matched rows (all columns or the listed ones) and insert new keys.

    ``when`` is an extra condition for the update, over columns prefixed ``t_`` and ``s_``. Source
    columns the target lacks are added and stay null on rows without a source.
    """
    update = [c for c in source.columns if c not in keys] if update is None else list(update)
    hit = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    new = F.col("_in_t").isNull()
    out = []
    for c in dict.fromkeys([*target.columns, *source.columns]):
        old = F.col(f"t_{c}") if c in target.columns else F.lit(None)
        if c not in source.columns:
            out.append(old.alias(c))
        elif c in update:
            out.append(F.when(hit | new, F.col(f"s_{c}")).otherwise(old).alias(c))
        else:
            out.append(F.when(new, F.col(f"s_{c}")).otherwise(old).alias(c))
    return _sides(target, source, keys, "full" if insert else "left").select(*out)


def merge_snapshot(target: DataFrame, source: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Full-snapshot merge: update all, insert all, and mark rows that left the source as deleted.

    Rows already marked keep their stamp; a key that reappears loses its mark.
    """
    stamped = source.withColumns({MODIFIED: at, DELETED: F.lit(False)})
    gone = F.col("_in_s").isNull()
    marking = gone & ~F.coalesce(F.col(f"t_{DELETED}"), F.lit(False))
    out = []
    for c in dict.fromkeys([*target.columns, *stamped.columns]):
        old = F.col(f"t_{c}") if c in target.columns else F.lit(None)
        if c not in stamped.columns:
            out.append(old.alias(c))
            continue
        if c == DELETED:
            old = F.when(marking, F.lit(True)).otherwise(old)
        elif c == MODIFIED:
            old = F.when(marking, at).otherwise(old)
        out.append(F.when(~gone, F.col(f"s_{c}")).otherwise(old).alias(c))
    return _sides(target, stamped, keys, "full").select(*out)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key is new."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def reload_from_watermark(gold: DataFrame, silver: DataFrame, day: str) -> DataFrame:
    """Replace gold from ``min(first day of silver, last day of gold)`` on by silver's rows.

    Gold days at or after the watermark that silver does not hold are lost, as in the source job;
    ``days_lost`` lists them.
    """
    mark = _watermark(gold, silver, day)
    kept = gold.filter(F.col(day) < mark)
    return kept.unionByName(silver.filter(F.col(day) >= mark), allowMissingColumns=True)


def days_lost(gold: DataFrame, silver: DataFrame, day: str) -> DataFrame:
    mark = _watermark(gold, silver, day)
    return gold.filter(F.col(day) >= mark).select(day).distinct().join(silver.select(day).distinct(), day, "left_anti")


def _watermark(gold: DataFrame, silver: DataFrame, day: str) -> Column:
    first, last = silver.agg(F.min(day).alias("d")), gold.agg(F.max(day).alias("d"))
    return first.select(F.least(F.col("d"), last.scalar())).scalar()


def replace_periods(target: DataFrame, source: DataFrame, period: str) -> DataFrame:
    """Delete the periods present in the source and append the source."""
    periods = source.select(period).distinct()
    return target.join(periods, period, "left_anti").unionByName(source, allowMissingColumns=True)


def add_snapshot(history: DataFrame, today: DataFrame, day: Column, ids: Mapping[str, str]) -> DataFrame:
    """Append today's snapshot with date_id keys, replacing an earlier snapshot of the same day."""
    keys = {k: F.concat_ws("_", F.date_format(day, "yyyyMMdd"), F.col(c)) for k, c in ids.items()}
    stamped = today.withColumns({"Snapshot_Date": day, **keys})
    return history.filter(F.col("Snapshot_Date") != day).unionByName(stamped, allowMissingColumns=True)


def append_stamped(target: DataFrame, rows: DataFrame, at: Column) -> DataFrame:
    stamped = rows.withColumns({"TransferDate": F.to_date(at), "TransferDateTime": at})
    return target.unionByName(stamped, allowMissingColumns=True)


# Row markers of change files.
INSERT, UPDATE, DELETE = 0, 1, 2
MARKER = "__rowMarker__"


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Apply change rows: the last change per key wins; markers 0 and 1 upsert, 2 deletes."""
    last = latest(changes, keys, [F.col(c) for c in order])
    plain = [c for c in target.columns]
    untouched = target.join(last.select(*keys), list(keys), "left_anti")
    alive = last.filter(F.col(MARKER) != DELETE)
    return untouched.unionByName(alive.select(*[c for c in last.columns if c in plain]), allowMissingColumns=True)


def row_marker(operation: Column, soft_delete: bool = False, strict: bool = True) -> Column:
    """Marker of an operation code: I → 0, U → 1, D → 2, or 1 where deletes only flag the row."""
    marker = (
        F.when(operation == "I", INSERT).when(operation == "U", UPDATE).when(
            operation == "D", UPDATE if soft_delete else DELETE
        )
    )
    if strict:
        return marker.otherwise(
            F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(operation, F.lit("null")))).cast("int")
        )
    return marker


def status_marker(status: Column) -> Column:
    """Marker of a price-paid record status: A added, C changed, D deleted; anything else fails."""
    return (
        F.when(status == "A", INSERT)
        .when(status == "C", UPDATE)
        .when(status == "D", DELETE)
        .otherwise(
            F.raise_error(F.concat(F.lit("unknown record status "), F.coalesce(status, F.lit("null")))).cast("int")
        )
    )


def changes_since(table: DataFrame, version: str, mark: int | None) -> DataFrame:
    """All rows as inserts on the first run, later only the rows changed after the high-water mark."""
    if mark is None:
        return table.withColumn(MARKER, F.lit(INSERT))
    return table.filter(F.col(version) > mark).withColumn(MARKER, F.lit(UPDATE))


def not_recorded(rows: DataFrame, recorded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not recorded yet."""
    return rows.join(recorded.select(*keys).distinct(), list(keys), "left_anti")


def skip_saturated(rows: DataFrame, recorded: DataFrame, keys: Sequence[str], enough: int) -> DataFrame:
    """Rows whose keys have fewer than ``enough`` recorded rows."""
    full = recorded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= enough)
    return rows.join(full.select(*keys), list(keys), "left_anti")


def continue_keys(existing: DataFrame, wanted: DataFrame, name: str, key: str) -> DataFrame:
    """Existing keys plus keys for the new names: numbered by name after the largest existing key."""
    new = wanted.select(name).filter(F.col(name).isNotNull()).distinct().join(existing, name, "left_anti")
    numbered = row_numbers(new, [], [F.col(name)], "_rn")
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top"))
    return existing.select(name, key).unionByName(
        numbered.select(name, (F.col("_rn") + top.scalar()).alias(key))
    )

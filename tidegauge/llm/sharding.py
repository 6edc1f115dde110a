"""Shards of nearly equal bytes by longest-processing-time scheduling.

Groups of equal texts stay together. Groups sorted by size go, largest first, to the shard with the least load so far,
which a heap yields. Scheduling every group one by one would need one task for all of them, so only groups above
1/(shards * FINE) of all bytes are scheduled by themselves; the others, each below that size, are pooled by hash into
shards * FINE units first. There are at most twice that many units whatever the input, and no unit but a large group
weighs more than a small fraction of a shard.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import stored

FINE = 256
LAW = "bytes"


def schedule(sizes: Sequence[int], shards: int) -> list[int]:
    """Shard of each unit: units by descending size, each to the least-loaded shard (the lowest number on a tie)."""
    heap = [(0, s) for s in range(shards)]
    assigned = [0] * len(sizes)
    for unit in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heap[0]
        assigned[unit] = shard
        heapq.heapreplace(heap, (load + sizes[unit], shard))
    return assigned


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, group): bytes of the text plus ``overhead``; equal texts have equal groups, a null
    text counts as empty."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(overhead).cast("long")).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.unhex(F.sha2(body, 256)).alias("group"),
    )


def placed(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (size, group, ...) with the shard of their group."""
    spark = rows.sparkSession
    units = shards * FINE
    total = rows.agg(F.sum("size").alias("total")).first()["total"] or 0
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") >= total / units
    pool = F.pmod(F.xxhash64("group"), F.lit(units)).cast("int")
    # At most ``units`` large groups and ``units`` pools.
    listed = (
        groups.groupBy(F.when(large, F.col("group")).alias("group"), F.when(~large, pool).alias("pool"))
        .agg(F.sum("bytes").alias("bytes"))
        .orderBy(F.desc("bytes"), "group", "pool")
        .collect()
    )
    shard = schedule([r["bytes"] for r in listed], shards)
    named = [(bytes(r["group"]), s) for r, s in zip(listed, shard) if r["group"] is not None]
    pooled = [(r["pool"], s) for r, s in zip(listed, shard) if r["group"] is None]
    by_group = spark.createDataFrame(named, "group binary, own_shard int")
    by_pool = spark.createDataFrame(pooled, "pool int, pool_shard int")
    return (
        rows.withColumn("pool", pool)
        .join(F.broadcast(by_group), "group", "left")
        .join(F.broadcast(by_pool), "pool", "left")
        .withColumn("shard", F.coalesce("own_shard", "pool_shard"))
        .drop("pool", "own_shard", "pool_shard")
    )


def slotted(rows: DataFrame, count: int, order: Sequence[str]) -> DataFrame:
    """``rows`` with their gapless position (``slot``) in their shard.

    A shard can hold a third of all rows, so it is numbered in cells: rows fall into about sqrt(count) cells by a hash
    of the ``order`` columns, each cell is numbered by itself, and what lies before it in its shard is added.
    """
    cells = max(1, math.isqrt(count) // 4)
    celled = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        celled.groupBy("shard", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    here = Window.partitionBy("shard", "cell").orderBy(*order)
    return (
        celled.withColumn("nth", F.row_number().over(here))
        .join(starts, ["shard", "cell"])
        .withColumn("slot", F.col("start") + F.col("nth") - 1)
        .drop("cell", "nth", "start")
    )


def sharded(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard and slot: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    The law is ``bytes``: shards' sizes are as near to equal as whole groups allow. Repeated rows are rows of their own
    in the same group; null texts share a group with empty ones; null ids are kept. ``grown_shard`` belongs to another
    law and is null. An empty table gives an empty result. Only ids, sizes and digests are stored and shuffled.
    """
    rows = stored(sized(docs, doc_id, text), "shard-sizes")
    found = slotted(placed(rows, shards), rows.count(), ["doc_id", "group"])
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Difference digests: which keys of two tables differ, without joining or shuffling the tables.

A table is summed up in cells (an invertible Bloom lookup table): every row adds its sign and its key and row hashes to
one cell in each of three parts. Tasks add up their own rows, so only cells are shuffled. Subtracting the cells of two
tables leaves those of the rows that differ; a cell that holds a single row names it, and taking that row out of its
other cells frees further ones, until all are empty. If they don't get empty there were too few cells for the
difference: they are made again, more of them. Keys found are looked up in both tables and compared by their columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import stored

PARTS = 3
#: Cells per part at first, as a power of two, and by how much it grows when the difference does not fit.
FIRST_BITS, MORE_BITS = 13, 3

ONLY_A, ONLY_B, CHANGED = "only_a", "only_b", "changed"


def hash_of(columns: Sequence[str]) -> Column:
    """64-bit hash of the columns in which a null is unlike any value."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def _check(key: str, row: str) -> Column:
    return F.xxhash64(F.col(key), F.col(row), F.lit("check"))


def _in_cells(rows: DataFrame, bits: int) -> DataFrame:
    """Rows (n, k, r) summed up in their cells: (cell, n, k, r, c) of the cells that are not empty."""
    places = [F.pmod(F.xxhash64("k", "r", F.lit(i)), F.lit(1 << bits)) + (i << bits) for i in range(PARTS)]
    return _summed(rows.withColumn("c", _check("k", "r")).select(F.explode(F.array(*places)).alias("cell"), "n", "k", "r", "c"))


def _summed(parts: DataFrame) -> DataFrame:
    cells = parts.groupBy("cell").agg(F.sum("n").alias("n"), *[F.bit_xor(x).alias(x) for x in ("k", "r", "c")])
    return cells.filter("n != 0 OR k != 0 OR r != 0 OR c != 0")


def digest(df: DataFrame, keys: Sequence[str], bits: int = FIRST_BITS, sign: int = 1) -> DataFrame:
    """The cells of a table, to be kept with a version of it; ``subtract`` two of the same ``bits``."""
    rows = df.select(F.lit(sign).cast("long").alias("n"), hash_of(keys).alias("k"), hash_of(sorted(df.columns)).alias("r"))
    return _in_cells(rows, bits)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return _summed(a.unionByName(b.withColumn("n", -F.col("n"))))


def peel(cells: DataFrame, bits: int) -> DataFrame | None:
    """(n, k, r) of all rows that the cells hold, n 1 or -1; None if not all of them can be told.

    A round takes out all rows that stand alone in some cell and writes the cells that are left; a difference that fits
    takes few rounds.
    """
    spark = cells.sparkSession
    cells = stored(cells, "digest-cells")
    found = [spark.createDataFrame([], "n long, k long, r long")]
    while cells.limit(1).count() > 0:
        alone = cells.filter((F.abs("n") == 1) & (F.col("c") == _check("k", "r"))).select("n", "k", "r").distinct()
        alone = stored(alone, "digest-rows")
        if alone.limit(1).count() == 0:
            return None
        found.append(alone)
        taken = _in_cells(alone.withColumn("n", -F.col("n")), bits)
        cells = stored(_summed(cells.unionByName(taken)), "digest-cells")
    return reduce(DataFrame.unionByName, found)


def differing(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = FIRST_BITS) -> DataFrame:
    """The keys whose rows differ, with ``difference``: only_a, only_b or changed. Both tables have the same columns.

    Rows of a key that repeats are compared as a multiset. A row that is in one table at least twice more than in the
    other never stands alone; when cells outnumber the rows and still do not empty, the rows are grouped instead, at the
    price of a shuffle of both tables. Null keys are keys like others. The result is exact up to collisions of 64-bit hashes.
    """
    rows = max(a.count(), b.count())
    while True:
        told = peel(subtract(digest(a, keys, bits), digest(b, keys, bits)), bits)
        if told is not None or (1 << bits) > 2 * rows:
            break
        bits += MORE_BITS
    sides = [a.withColumn("_n", F.lit(1)), b.withColumn("_n", F.lit(-1))]
    if told is not None:
        wanted = stored(told.select(F.col("k").alias("_k")).distinct(), "digest-keys")
        sides = [s.withColumn("_k", hash_of(keys)).join(wanted, "_k", "left_semi").drop("_k") for s in sides]
    one_row = reduce(DataFrame.unionByName, sides).groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.sum("_n").alias("_n"))
    sides_left = one_row.filter("_n != 0").groupBy(*keys).agg(F.max("_n").alias("_most"), F.min("_n").alias("_least"))
    kind = F.when(F.col("_least") > 0, ONLY_A).when(F.col("_most") < 0, ONLY_B).otherwise(CHANGED)
    return sides_left.select(*keys, kind.alias("difference"))

"""Exact money arithmetic.

Prices arrive as doubles with two decimals. Casting them to decimals that still fit a 64-bit
word keeps sums independent of the order in which partitions are added up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(col: str | Column) -> Column:
    return F.col(col).cast("decimal(12,2)") if isinstance(col, str) else col.cast("decimal(12,2)")


def rate(col: str | Column) -> Column:
    return F.col(col).cast("decimal(4,2)") if isinstance(col, str) else col.cast("decimal(4,2)")


def net_price(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """price * (1 - discount), exact to four decimals."""
    return money(price) * (F.lit(Decimal("1.00")) - rate(discount))


def as_double(col: Column) -> Column:
    return col.cast("double")

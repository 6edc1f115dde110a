import random

import pytest

from tests.conftest import rows
from tidegauge.operators import digest as D

SCHEMA = "k int, part string, v double"


def plain(a, b):
    keys = {(r[0], r[1]) for r in a + b}
    out = []
    for key in keys:
        mine, other = (sorted(((r for r in t if (r[0], r[1]) == key)), key=repr) for t in (a, b))
        more = any(mine.count(r) > other.count(r) for r in mine)
        less = any(other.count(r) > mine.count(r) for r in other)
        if more or less:
            out.append((*key, D.CHANGED if more and less else D.ONLY_A if more else D.ONLY_B))
    return sorted(out, key=repr)


def tables(spark, seed, n, change):
    rnd = random.Random(seed)
    a = [(i if i % 50 else None, rnd.choice(["x", None]), rnd.random()) for i in range(n)]
    b = [r if rnd.random() > change else (r[0], r[1], None) for r in a if rnd.random() > change]
    b += [(n + i, "new", 0.0) for i in range(int(n * change))]
    rnd.shuffle(b)
    return a, b, spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)


@pytest.mark.parametrize("change,bits", [(0.0, 6), (0.02, 6), (0.9, 4)])
def test_differences_against_plain(spark, change, bits):
    """Also with far too few cells at first, which are then made again."""
    a, b, left, right = tables(spark, 5, 600, change)
    assert rows(D.differing(left, right, ["k", "part"], bits)) == plain(a, b)


def test_repeated_rows(spark):
    """One row more can be told from the cells; two or three more are found by grouping."""
    a = [(1, "x", 1.0)] * 3 + [(2, "y", 2.0)] * 2 + [(3, "z", 3.0)] * 2 + [(4, "w", 4.0)]
    b = [(1, "x", 1.0)] * 2 + [(3, "z", 3.0)] * 2 + [(4, "w", 4.0)] * 4
    found = D.differing(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k", "part"], 3)
    assert rows(found) == plain(a, b) == [(1, "x", D.ONLY_A), (2, "y", D.ONLY_A), (4, "w", D.ONLY_B)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    assert rows(D.differing(none, none, ["k"])) == []
    assert rows(D.differing(none, some, ["k"])) == [(1, D.ONLY_B)]


def test_only_cells_are_shuffled(spark):
    """Rows are summed up before the exchange, and the exchange carries cells."""
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = D.digest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_xor" in plan and plan.count("Exchange") == 1

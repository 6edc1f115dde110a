import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators import incremental as I
from tidegauge.operators import merge as U
from tidegauge.session import stored

SCHEMA = "k int, g string, v int, price decimal(12,2)"
KEPT = I.Kept(["g"], ["v", "price"], ["v"])


def row(rnd, key):
    price = None if rnd.random() < 0.2 else Decimal(rnd.randrange(1000)) / 100
    return key, rnd.choice(["a", "b", None]), rnd.choice([None, *range(6)]), price


def test_equals_the_rebuild_after_every_batch(spark):
    """Inserts, updates and deletes, null groups and values, keys changed twice in a batch, emptied groups."""
    rnd = random.Random(3)
    table = spark.createDataFrame([row(rnd, k) for k in range(40)], SCHEMA)
    state = stored(I.build(KEPT, table), "state")
    for batch in range(4):
        data = [(*row(rnd, rnd.randrange(60)), rnd.choice([0, 1, 2]), n) for n in range(25)]
        if batch == 3:
            data = [(k, None, None, None, 2, k) for k in range(60)]
        changes = spark.createDataFrame(data, f"{SCHEMA}, {U.MARKER} int, seq int")
        signed = I.signed_rows(table, changes, ["k"], ["seq"])
        after = stored(U.apply_changes(table, changes, ["k"], ["seq"]), "table")
        state = stored(I.refresh(KEPT, state, signed, after), "state")
        assert rows(I.plain(KEPT, state)) == rows(I.plain(KEPT, I.build(KEPT, after)))
        assert rows(state) == rows(I.build(KEPT, after))
        table = after
    assert rows(state) == []


def test_results_are_those_of_a_grouping(spark):
    table = spark.createDataFrame([row(random.Random(5), k) for k in range(30)] + [(99, "z", None, None)], SCHEMA)
    want = table.groupBy("g").agg(F.count(F.lit(1)), F.sum("v"), F.sum("price"), F.min("v"), F.max("v"))
    assert rows(I.plain(KEPT, I.build(KEPT, table))) == rows(want)


def test_only_groups_that_lost_an_extreme_are_read(spark):
    """The table given for the others is not looked at: it could not change their result."""
    table = spark.createDataFrame([(1, "a", 1, None), (2, "a", 5, None), (3, "b", 1, None), (4, "b", 3, None), (5, "b", 9, None)], SCHEMA)
    changes = spark.createDataFrame([(2, "a", None, None, 2, 1), (4, "b", 4, None, 1, 2)], f"{SCHEMA}, {U.MARKER} int, seq int")
    signed = I.signed_rows(table, changes, ["k"], ["seq"])
    only_a = table.filter("g = 'a' AND k = 1")
    found = I.plain(KEPT, I.refresh(KEPT, I.build(KEPT, table), signed, only_a))
    assert rows(found.select("g", "n", "sum_v", "min_v", "max_v")) == [("a", 1, 1, 1, 1), ("b", 3, 14, 1, 9)]


def test_sums_of_doubles_are_refused(spark):
    with pytest.raises(ValueError):
        I.build(I.Kept(["g"], ["v"]), spark.createDataFrame([("a", 1.0)], "g string, v double"))

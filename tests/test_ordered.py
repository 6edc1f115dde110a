"""Numbering and running values when a group spans many slices of the sort."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators import ordered as O
from tidegauge.operators.measures import percentiles


def skewed(spark, n=4000):
    """A third of all rows in one group, some null values, values with ties."""
    rnd = random.Random(7)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else f"g{rnd.randrange(40)}"
        data.append((group, i, rnd.randrange(50), None if rnd.random() < 0.2 else rnd.randrange(100)))
    return data, spark.createDataFrame(data, "g string, id int, v int, w int").repartition(16)


def by_group(data):
    out = {}
    for row in sorted(data, key=lambda r: (r[0], r[2], r[1])):
        out.setdefault(row[0], []).append(row)
    return out


def test_running_values(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data, df = skewed(spark)
        out = O.running(
            df,
            ["g"],
            [F.col("v"), F.col("id")],
            total=O.Running("sum", F.col("w")),
            top=O.Running("max", F.col("w"), inclusive=False),
            n=O.Running("count", F.lit(1)),
            before=O.Running("last", F.col("w"), inclusive=False),
        )
        got = {r["id"]: (r["total"], r["top"], r["n"], r["before"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(data)
    for group in by_group(data).values():
        seen = []
        for i, (_, id_, _, w) in enumerate(group):
            top = max(seen) if seen else None
            before = seen[-1] if seen else None
            if w is not None:
                seen.append(w)
            assert got[id_] == (sum(seen) if seen else None, top, i + 1, before)


def test_row_numbers_over_everything(spark):
    data, df = skewed(spark)
    got = {r["id"]: r["rn"] for r in O.row_numbers(df, [], [F.col("v"), F.col("id")]).collect()}
    want = {r[1]: i + 1 for i, r in enumerate(sorted(data, key=lambda r: (r[2], r[1])))}
    assert got == want


def test_ranks_share_ties(spark):
    data, df = skewed(spark)
    got = {r["id"]: r["rank"] for r in O.ranks(df, ["g"], F.col("v")).collect()}
    for _, group in by_group(data).items():
        for _, id_, v, _ in group:
            assert got[id_] == 1 + sum(1 for r in group if r[2] > v)


def test_latest_and_earliest(spark):
    data, df = skewed(spark)
    order = [F.col("v"), F.col("id")]
    last = {r["g"]: r["id"] for r in O.latest(df, ["g"], order).collect()}
    first = {r["g"]: r["id"] for r in O.earliest(df, ["g"], order).collect()}
    groups = by_group(data)
    assert last == {g: rs[-1][1] for g, rs in groups.items()}
    assert first == {g: rs[0][1] for g, rs in groups.items()}


def test_percentiles(spark):
    data, df = skewed(spark)
    out = {r["g"]: (r["p50"], r["p90"]) for r in percentiles(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}).collect()}
    near = {r["g"]: r["p90"] for r in percentiles(df, ["g"], "v", {"p90": 0.9}, "nearest").collect()}
    for g, group in by_group(data).items():
        values = sorted(r[2] for r in group)

        def linear(q):
            place = q * (len(values) - 1)
            low = int(place)
            high = min(low + 1, len(values) - 1)
            return values[low] + (values[high] - values[low]) * (place - low)

        assert abs(out[g][0] - linear(0.5)) < 1e-9 and abs(out[g][1] - linear(0.9)) < 1e-9
        assert near[g] == values[int(0.9 * (len(values) - 1) + 0.5)]
    whole = percentiles(df, [], "v", {"p50": 0.5}).first()["p50"]
    values = sorted(r[2] for r in data)
    middle = (values[len(values) // 2 - 1] + values[len(values) // 2]) / 2
    assert whole == middle


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, id int, v int")
    assert O.row_numbers(df, [], [F.col("id")]).count() == 0
    assert O.running(df, ["g"], [F.col("id")], t=O.Running("sum", F.col("v"))).count() == 0
    assert rows(O.latest(df, ["g"], [F.col("id")])) == []

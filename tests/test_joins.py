import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators import intervals as I
from tidegauge.operators import joins as J


@pytest.mark.parametrize("chars", [0, J.AUTOMATON_CHARS])
def test_texts_containing_finds_every_substring(spark, chars):
    rnd = random.Random(3)
    letters = "ab é\n😀c"
    texts = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 120)))) for i in range(60)]
    names = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 7))) for _ in range(60)}
    names |= {t[5 : 5 + n] for _, t in texts for n in (8, 9, 17, 30) if len(t) >= 5 + n}
    names |= {t[-10:] for _, t in texts if len(t) >= 10}
    df = spark.createDataFrame(texts, "id int, body string")
    objs = spark.createDataFrame([(n,) for n in sorted(names)] + [("",)], "name string")
    odd = spark.createDataFrame([(900, None), (901, ""), (None, "a b c"), (7, "a b c")], "id int, body string")
    found = J.texts_containing(df.unionByName(odd), "id", "body", objs, "name", chars)
    got = sorted((r["id"], r["body"], r["name"]) for r in found.collect())
    assert got == sorted((i, t, n) for i, t in [*texts, (7, "a b c")] for n in names if n in t)
    assert J.texts_containing(df, "id", "body", objs.limit(0), "name", chars).count() == 0


def test_points_in_intervals_of_all_lengths(spark):
    rnd = random.Random(5)
    spans = []
    for i in range(200):
        start = rnd.randrange(0, 5_000_000)
        spans.append((i, start, start + rnd.choice([0, 1, 59, 60, 3600, 90_000, 4_000_000]) + rnd.randrange(3)))
    spans.append((999, 50, 40))  # ends before it starts: never matches
    points = [(p, rnd.choice([s[1] for s in spans] + [s[2] for s in spans])) for p in range(80)]
    sdf = spark.createDataFrame(spans, "i int, s bigint, e bigint").select(
        "i", F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("e").alias("e")
    )
    pdf = spark.createDataFrame(points, "p int, t bigint").select("p", F.timestamp_seconds("t").alias("t"))
    got = sorted((r["p"], r["i"]) for r in J.points_in_intervals(pdf, "t", sdf, "s", "e").collect())
    assert got == sorted((p, i) for p, t in points for i, s, e in spans if s <= t <= e)


def test_begin_end_keeps_unmatched_ends(spark):
    ends = spark.createDataFrame([(1, "a", 100_000), (2, "a", 500_000), (3, "b", 10)], "id int, k string, t bigint")
    begins = spark.createDataFrame(
        [(11, "a", 100_000), (12, "a", 13_600), (13, "a", 13_599), (14, "b", 11)], "bid int, k string, u bigint"
    )
    e = ends.withColumn("t", F.timestamp_seconds("t"))
    b = begins.withColumn("u", F.timestamp_seconds("u"))
    out = rows(J.pair_begin_end(e, b, ["k"], "u").select("id", "bid"))
    assert out == [(1, 11), (1, 12), (1, 13), (2, 11), (2, 12), (2, 13), (3, 14)]
    batch = J.pair_begin_end(e, b, ["k"], "u", since=F.timestamp_seconds(F.lit(100_000)))
    assert rows(batch.select("id", "bid")) == [(1, 11), (1, 12), (2, 11), (2, 12), (3, None)]


def test_placeholders(spark):
    known = spark.createDataFrame([(1, "one")], "id int, name string")
    wanted = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    assert rows(J.placeholders(wanted, known, "id", name=F.lit("Unknown"))) == [(1, "one"), (2, "Unknown")]


def test_interval_union_is_at_most_the_sum(spark):
    rnd = random.Random(9)
    spans = [("q", i, s := rnd.randrange(1000), s + rnd.randrange(60)) for i in range(300)]
    df = spark.createDataFrame(spans, "g string, i int, s bigint, e bigint")
    got = I.engine_split(df, ["g"], "s", "e", ["i"], F.lit(2000), F.sum(F.col("e") - F.col("s"))).first()
    covered = set()
    for _, _, s, e in spans:
        covered.update(range(s, e))
    assert got["storage"] == len(covered) <= got["cpu"]
    assert got["formula"] == 2000 - len(covered)


def test_timeline_counts_from_the_latest_end(spark):
    # The first event ends after the second: no gap may open before 50.
    df = spark.createDataFrame(
        [("q", 1, 10, 50), ("q", 2, 20, 30), ("q", 3, 60, 70)], "g string, i int, s bigint, e bigint"
    )
    out = I.timeline(df, ["g"], "s", "e", ["i"], F.lit(0), F.lit(100), 1)
    got = sorted((r["kind"], r["from_at"], r["to_at"]) for r in out.collect())
    assert got == [
        ("event", 10, 50), ("event", 20, 30), ("event", 60, 70), ("gap", 0, 10), ("gap", 50, 60), ("gap", 70, 100)
    ]


def test_missing_hours(spark):
    seen = [("d1", h) for h in range(24) if h not in (0, 1, 5, 23)] + [("d2", h) for h in range(24)]
    df = spark.createDataFrame(seen, "day string, h int")
    assert rows(I.missing_hours(df, ["day"], "h")) == [("d1", 0, 2), ("d1", 23, 24), ("d1", 5, 6)]


def test_rewrite_references_keeps_order(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"])], "k int, refs array<string>")
    mapping = spark.createDataFrame([("a", "A")], "old string, new string")
    out = {r["k"]: r["refs"] for r in J.rewrite_references(df, "refs", mapping, "old", "new", "k").collect()}
    assert out == {1: ["A", "b", "A"], 2: ["c"]}


def test_rewrite_references_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(
        [(1, "x", ["a"]), (2, "y", []), (3, "z", None), (3, "w", ["b"]), (None, "v", ["a", "b"])],
        "k int, name string, refs array<string>",
    )
    mapping = spark.createDataFrame([("a", "A")], "old string, new string")
    out = {r["name"]: r["refs"] for r in J.rewrite_references(df, "refs", mapping, "old", "new", "k").collect()}
    assert out == {"x": ["A"], "y": [], "z": None, "w": ["b"], "v": ["A", "b"]}


def test_first_list_gives_the_group(spark):
    users = spark.createDataFrame([("u",), ("v",), ("n",)], "user string")
    members = spark.createDataFrame([("u", "Zeta", 1), ("u", "Alpha", 2), ("v", "Alpha", 2)], "user string, user_group string, position int")
    assert rows(J.with_user_group(users, members, "user", "Others")) == [("n", "Others"), ("u", "Zeta"), ("v", "Alpha")]

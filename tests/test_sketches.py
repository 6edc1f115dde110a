import bisect

from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators import sketches as K


def test_united_days_against_exact(spark):
    """Values repeat between days; counts stay within the stated error, quantiles within the stated rank error."""
    df = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 9_000).alias("who"),
        F.when(F.col("id") % 5 != 0, (F.hash("id") % 100_000).cast("double")).alias("v"),
    )
    days = K.daily(df, ["g"], "day", {"users": "who"}, {"values": "v"})
    assert days.count() == 20
    found = K.united(K.united(days, ["g", "day"], ["users"], ["values"]), ["g"], ["users"], ["values"])
    got = found.select(
        "g", "n", K.distinct_estimate("users").alias("users"), *[K.quantile_estimate("values", q).alias(f"q{q}") for q in (0.1, 0.5, 0.9)]
    )
    for r in got.collect():
        part = df.filter(F.col("g") == r["g"])
        assert r["n"] == part.count()
        exact = part.agg(F.count_distinct("who")).first()[0]
        assert abs(r["users"] - exact) <= K.distinct_error() * exact
        values = sorted(x["v"] for x in part.filter("v IS NOT NULL").select("v").collect())
        for q in (0.1, 0.5, 0.9):
            low, high = bisect.bisect_left(values, r[f"q{q}"]), bisect.bisect_right(values, r[f"q{q}"])
            assert low - K.rank_error() * len(values) <= q * len(values) <= high + K.rank_error() * len(values)


def test_windows_read_days_only(spark):
    days = spark.createDataFrame([("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-05", 5)], "d string, n int")
    days = days.withColumn("d", F.to_date("d"))
    windows = spark.createDataFrame([("all", "2024-01-01", "2024-01-31"), ("first", "2024-01-01", "2024-01-02")], "w string, first string, last string")
    windows = windows.withColumns({"first": F.to_date("first"), "last": F.to_date("last")})
    found = K.over_windows(days, "d", windows).groupBy("w").agg(F.sum("n"))
    assert rows(found) == [("all", 10), ("first", 5)]


def test_empty(spark):
    none = spark.createDataFrame([], "g string, day date, who long, v double")
    assert rows(K.united(K.daily(none, ["g"], "day", {"users": "who"}, {"values": "v"}), ["g"], ["users"], ["values"])) == []
    nulls = spark.createDataFrame([("a", None, None, None)], "g string, day date, who long, v double")
    days = K.daily(nulls, ["g"], "day", {"users": "who"}, {})
    assert rows(K.united(days, ["g"], ["users"]).select("g", "n", K.distinct_estimate("users"))) == [("a", 1, 0)]

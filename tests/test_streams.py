import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators.merge import MARKER
from tidegauge.plans.streams import unchanged_snapshots
from tidegauge.session import work_path
from tidegauge.streaming import pairing as P
from tidegauge.streaming import streams as X
from tidegauge.tables import maintenance as K
from tidegauge.tables.versioned import read_current


def changes(spark, data):
    return spark.createDataFrame(data, f"k int, a string, {MARKER} int, _file bigint, _place bigint")


def test_change_batches_in_any_order_and_twice(spark):
    first = changes(spark, [(1, "x", 0, 1, 0), (2, "y", 0, 1, 1), (3, "z", 0, 1, 2)])
    second = changes(spark, [(1, None, 2, 2, 0), (2, "Y", 1, 2, 1)])
    results = []
    for order in ([first, second], [second, first], [first, second, second]):
        root = work_path(spark, "state")
        each = X.apply_change_batches(root, ["k"], ["k", "a"])
        for i, df in enumerate(order):
            each(df, i)
            each(df, i)  # the batch is replayed after a failure
        results.append(rows(X.visible(read_current(spark, root))))
    assert results == [[(2, "Y"), (3, "z")]] * 3


def test_logged_changes_survive_replay_order_and_compaction(spark):
    first = changes(spark, [(1, "x", 0, 1, 0), (2, "y", 0, 1, 1), (3, "z", 0, 1, 2)])
    second = changes(spark, [(1, None, 2, 2, 0), (2, "Y", 1, 2, 1)])
    third = changes(spark, [(4, "w", 0, 3, 0)])
    want = [(2, "Y"), (3, "z"), (4, "w")]
    for order, compact_after in (((first, second, third), 1), ((second, first, third), 0), ((third, second, first), 2)):
        root = work_path(spark, "state")
        each = X.log_changes(root, ["k"], ["k", "a"])
        for i, df in enumerate(order):
            each(df, i)
            each(df, i)
            if i == compact_after:
                X.compact(spark, root, ["k"])
                X.compact(spark, root, ["k"])
        assert rows(X.visible(X.logged_state(spark, root, ["k"]))) == want


def test_open_operations_with_late_begins(spark):
    root = work_path(spark, "open")
    each = X.track_open(root, "op", ["who"])
    schema = "op int, who string, phase string, t int"

    def batch(data):
        return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_seconds("t")).drop("t")

    each(batch([(1, "a", "begin", 0), (2, None, "end", 10)]), 0)
    each(batch([(2, "b", "begin", 5), (3, "a", "begin", 20)]), 1)
    assert rows(X.open_operations(read_current(spark, root), ["who"])) == [("a", 2)]
    each(batch([(1, None, "end", 30)]), 2)
    assert rows(X.open_operations(read_current(spark, root), ["who"])) == [("a", 1)]


def test_suppression_against_a_cache(spark):
    rnd = random.Random(11)
    root, out = work_path(spark, "ledger"), work_path(spark, "out")
    each = X.suppress_unchanged(root, out, "t", "h", "at", "10 hours")
    cache, want = {}, []
    for batch in range(8):
        data = [(t, rnd.choice("ab"), batch * 4 * 3600 + t) for t in range(12) if rnd.random() < 0.8]
        for t, h, at in data:
            known = cache.get(t)
            if known is None or known[0] != h or at >= known[1] + 36000:
                cache[t] = (h, at)
                want.append((t, h, at))
        df = spark.createDataFrame(data, "t int, h string, at int").withColumn("at", F.timestamp_seconds("at"))
        each(df, batch)
        each(df, batch)
    got = spark.read.parquet(out).select("t", "h", F.unix_timestamp("at").cast("int"))
    assert rows(got) == sorted(want, key=repr)


def test_snapshots_of_one_batch_in_order(spark):
    """A, then B and A again in one batch: all three go on, as they would in three batches."""
    for cuts in ([[0], [1, 2, 3]], [[0], [1], [2], [3]], [[0, 1, 2, 3]]):
        root, out = work_path(spark, "ledger"), work_path(spark, "out")
        each = X.suppress_unchanged(root, out, "t", "h", "at", "10 hours")
        data = [(1, "A", 0), (1, "B", 10), (1, "A", 20), (1, "A", 30)]
        for batch, part in enumerate(cuts):
            df = spark.createDataFrame([data[i] for i in part], "t int, h string, at int")
            each(df.withColumn("at", F.timestamp_seconds("at")), batch)
        got = spark.read.parquet(out).select("h", F.unix_timestamp("at").cast("int"))
        assert rows(got) == [("A", 0), ("A", 20), ("B", 10)]


def test_suppression_goes_on_after_a_restart(spark):
    """A new function over the same folders, a batch tried twice and a folded ledger: as if nothing had happened."""
    data = [(i % 3, "ab"[i % 7 < 4], i * 3 * 3600) for i in range(30)] + [(3, "a", i * 1800) for i in range(60)]
    root, out = work_path(spark, "ledger"), work_path(spark, "out")
    for batch in range(3):
        part = [r for r in data if r[2] // (30 * 3600) == batch]
        df = spark.createDataFrame(part, "t int, h string, at int").withColumn("at", F.timestamp_seconds("at"))
        for _ in range(2):
            X.suppress_unchanged(root, out, "t", "h", "at", "10 hours")(df, batch)
        if batch == 1:
            X.compact(spark, root, ["t"])
    cache, want = {}, []
    for t, h, at in sorted(data, key=lambda r: r[2]):
        if t not in cache or cache[t][0] != h or at >= cache[t][1] + 36000:
            cache[t] = (h, at)
            want.append((t, h, at))
    got = spark.read.parquet(out).select("t", "h", F.unix_timestamp("at").cast("int"))
    assert rows(got) == sorted(want, key=repr)


def test_snapshots_of_any_time(spark, tmp_path):
    """Events before and after January go on like others; those without a time all go on and change nothing else."""
    data = [(1, "a", "2023-05-01"), (1, "a", "2024-01-05"), (1, "b", "2024-03-01"), (1, "b", "2024-03-02")]
    data += [(2, "c", None), (2, "c", None), (2, "c", "2024-01-25"), (2, "c", "2024-01-26")]
    df = spark.createDataFrame(data, "user_id long, event_type string, ts string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    got = [(r["user_id"], r["content_hash"], r["at"] and r["at"][:10], r["batch"]) for r in unchanged_snapshots(spark, str(tmp_path)).collect()]
    want = [(1, "a", "2023-05-01", 0), (1, "a", "2024-01-05", 0), (1, "b", "2024-03-01", 2), (2, "c", "2024-01-25", 2)]
    assert sorted(got, key=repr) == sorted(want + [(2, "c", None, 2)] * 2, key=repr)


def test_late_rows_count(spark):
    path, root, checkpoint = (work_path(spark, n) for n in ("in", "counts", "checkpoint"))
    each = X.count_by_status(root, "ts", F.col("s"), "1 minute")

    def push(*seconds):
        df = spark.createDataFrame(
            [(s, "ok") for s in seconds], "t int, s string"
        ).select(F.timestamp_seconds("t").alias("ts"), "s")
        df.coalesce(1).write.mode("append").parquet(path)
        X.run_available(X.drop_stream(spark, path, "parquet", "ts timestamp, s string", "*.parquet"), checkpoint, each)

    push(0, 10, 70)
    push(4000)
    push(20, 5000)  # 20 s is an hour late
    push(9000)
    got = {r["start"].timestamp(): r["operations"] for r in read_current(spark, root).collect()}
    assert got == {0: 3, 60: 1, 3960: 1, 4980: 1, 9000: 1}


def test_very_late_begins_are_matched(spark):
    root = work_path(spark, "open")
    each = X.track_open(root, "op", ["who"])
    schema = "op int, who string, phase string, t int"

    def batch(*data):
        return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_seconds("t")).drop("t")

    each(batch((1, None, "end", 0)), 0)
    each(batch((2, "b", "begin", 10**7)), 1)
    assert rows(X.unmatched_ends(read_current(spark, root)).select("op")) == [(1,)]
    each(batch((1, "a", "begin", -10)), 2)
    assert rows(X.open_operations(read_current(spark, root), ["who"])) == [("b", 1)]


def test_due_tables(spark):
    now = F.to_timestamp(F.lit("2024-01-01 01:00:00"))
    config = spark.createDataFrame(
        [
            ("a", "Enabled", 60, None),
            ("b", "Running", 60, "2024-01-01 00:59:30"),
            ("c", "Running", 60, "2024-01-01 00:58:00"),
            ("d", "Disabled", 60, None),
        ],
        "name string, status string, interval_seconds int, last string",
    ).withColumn("last_run", F.to_timestamp("last"))
    assert rows(X.due(config, now).select("name")) == [("a",), ("c",)]


def test_paired_streams(spark):
    """Pairs at once, the rest once the watermark is past them, late rows visible, repeats without effect."""
    p = P.Pairing(work_path(spark, "pairing"), ["op"], "row", ["who"], ["who"], "1 hour", "2 hours")
    path = work_path(spark, "dropped")
    schema = "op int, row int, who string, phase string, ts timestamp"

    def drop(*data):
        rows_ = [(op, row, who, phase, None if hour is None else 3600 * (100 + hour)) for op, row, who, phase, hour in data]
        df = spark.createDataFrame(rows_, "op int, row int, who string, phase string, t double")
        df.withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(path)
        P.run_pairing(p, X.drop_stream(spark, path, "parquet", schema, "*.parquet"))

    def found(outcome):
        return rows(P.outcomes(spark, p).filter(F.col("outcome") == outcome).select("begin_id", "end_id"))

    drop((1, 1, "a", "begin", 0.0), (2, 2, "a", "begin", 0.5), (None, 3, "b", "begin", 0.5), (9, 4, None, "end", 0.2))
    assert rows(P.running_now(spark, p)) == [("a", 2), ("b", 1)] and found(P.PAIRED) == []
    drop((1, 5, None, "end", 1.0))  # its begin came a batch before
    assert found(P.PAIRED) == [(1, 5)] and rows(P.running_now(spark, p)) == [("a", 1), ("b", 1)]
    drop((3, 6, "c", "begin", 10.0), (7, 7, None, "end", 10.0), (4, 8, None, "begin", None), (4, 15, "e", "begin", -100.0))
    drop((2, 9, None, "end", 1.5), (3, 10, None, "end", 10.5))  # the first is late by more than an hour
    assert rows(P.late_rows(spark, p).select("row")) == [(15,), (8,), (9,)]
    assert found(P.PAIRED) == [(1, 5), (6, 10)]
    drop((5, 11, "d", "begin", 30.0), (8, 12, None, "end", 30.0))
    drop((6, 13, "d", "begin", 30.1), (8, 14, None, "end", 30.1))
    assert found(P.OPEN) == [(2, None), (3, None)] and found(P.UNMATCHED) == [(None, 4), (None, 7)]
    assert rows(P.running_now(spark, p)) == [("a", 1), ("b", 1), ("d", 2)]
    assert rows(P.ends_with_begins(spark, p)) == sorted([(4, None), (5, 1), (7, None), (10, 6), (12, None), (14, None)], key=repr)


def test_a_repeated_admission_overwrites_itself(spark):
    p = P.Pairing(work_path(spark, "pairing"), ["op"], "row", ["who"], ["who"], "1 hour", "2 hours")

    def batch(*data):
        df = spark.createDataFrame(data, "op int, row int, who string, phase string, t int")
        return df.withColumn("ts", F.timestamp_seconds("t")).drop("t")

    for _ in range(2):
        P.admit(p, batch((1, 1, "a", "begin", 1), (2, 2, "a", "begin", 90_000)), 0)
    for _ in range(2):
        P.admit(p, batch((3, 3, "a", "begin", 80_000), (4, 4, "a", "begin", 89_000)), 1)
    assert rows(P.late_rows(spark, p).select("row")) == [(3,)]
    assert rows(P.running_now(spark, p)) == [("a", 3)]


def test_settings_of_the_session_are_put_back(spark):
    before = spark.conf.get(P.PROVIDER, None)
    with P.state_on_disk(spark):
        assert "RocksDB" in spark.conf.get(P.PROVIDER)
    assert spark.conf.get(P.PROVIDER, None) == before


def test_polls_mirror_what_is_due(spark):
    """A disabled or unknown table is left alone; a table that is not due again keeps its last run."""
    at = lambda s: F.timestamp_seconds(F.lit(s))
    config = spark.createDataFrame([("a", "Enabled", 60), ("b", "Disabled", 60), ("c", "Enabled", 60)], "name string, status string, interval_seconds int")
    config = config.withColumn("last_run", F.lit(None).cast("timestamp"))
    folders = {n: K.create_landing_table(spark, work_path(spark, "landing"), "s", n, ["k"]) for n in "ab"}
    marks = {n: work_path(spark, "mark") for n in "ab"}
    for second, count in ((100, 5), (130, 7), (160, 7)):
        mirrors = {n: (spark.range(count).withColumnRenamed("id", "k"), "k", folders[n], marks[n]) for n in "ab"}
        config = X.mirror_due(config, mirrors, at(second))
        got = rows(K.read_change_files(spark, folders["a"]).groupBy(MARKER).count())
        assert got == ([(0, 5)] if second < 160 else [(0, 5), (1, 2)])
    seen = rows(config.select("name", "status", F.unix_timestamp("last_run")))
    assert seen == [("a", "Running", 160), ("b", "Disabled", None), ("c", "Enabled", None)]

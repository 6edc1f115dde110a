import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators import merge as U
from tidegauge.session import work_path
from tidegauge.tables import maintenance as K
from tidegauge.tables import versioned as V


def at(text):
    return F.to_timestamp(F.lit(text))


def frame(spark, data):
    return spark.createDataFrame(data, "k int, a string, b int")


def test_merge_twice_is_merge_once(spark):
    target, source = frame(spark, [(1, "x", 1), (2, "y", 2)]), frame(spark, [(2, "Y", 20), (3, "z", 3)])
    once = U.merge(target, source, ["k"])
    assert rows(once) == [(1, "x", 1), (2, "Y", 20), (3, "z", 3)]
    assert rows(U.merge(once, source, ["k"])) == rows(once)


def test_merge_writes_nulls_of_the_source(spark):
    out = U.merge(frame(spark, [(1, "x", 1)]), frame(spark, [(1, None, 5)]), ["k"])
    assert rows(out) == [(1, None, 5)]


def test_merge_with_column_subset_condition_and_new_column(spark):
    target = frame(spark, [(1, "x", 1), (2, "y", 2)])
    source = frame(spark, [(1, "X", 10), (2, "Y", 0)]).withColumn("c", F.lit("new"))
    out = U.merge(target, source, ["k"], update=["a", "c"], when=F.col("s_b") > 5)
    assert rows(out) == [(1, "X", 1, "new"), (2, "y", 2, None)]


def test_snapshot_merge_marks_and_revives(spark):
    first = frame(spark, [(1, "x", 1), (2, "y", 2)]).withColumns(
        {U.MODIFIED: at("2024-01-01"), U.DELETED: F.lit(False)}
    )
    second = U.merge_snapshot(first, frame(spark, [(2, "y", 2)]), ["k"], at("2024-01-02"))
    third = U.merge_snapshot(second, frame(spark, [(2, "y", 2)]), ["k"], at("2024-01-03"))
    fourth = U.merge_snapshot(third, frame(spark, [(1, "x", 9), (2, "y", 2)]), ["k"], at("2024-01-04"))

    def state(df):
        return {r["k"]: (r["b"], r[U.DELETED], str(r[U.MODIFIED])[:10]) for r in df.collect()}

    assert state(second) == {1: (1, True, "2024-01-02"), 2: (2, False, "2024-01-02")}
    assert state(third)[1] == (1, True, "2024-01-02")  # already marked: the stamp stays
    assert state(fourth)[1] == (9, False, "2024-01-04")


def test_watermark_reload_reports_lost_days(spark):
    gold = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "d string, v int")
    silver = spark.createDataFrame([("2024-01-02", 20)], "d string, v int")
    assert rows(U.reload_from_watermark(gold, silver, "d")) == [("2024-01-01", 1), ("2024-01-02", 20)]
    assert rows(U.days_lost(gold, silver, "d")) == [("2024-01-03",)]


def test_changes_last_one_wins(spark):
    target = frame(spark, [(1, "x", 1), (2, "y", 2)])
    changes = spark.createDataFrame(
        [
            (1, "u", 5, 1, 1),
            (1, "u", 6, 1, 2),
            (2, "y", 2, 2, 1),
            (3, "n", 1, 0, 1),
            (3, "n", 1, 2, 2),
            (4, "m", 4, 0, 3),
        ],
        f"k int, a string, b int, {U.MARKER} int, seq int",
    )
    want = [(1, "u", 6), (4, "m", 4)]
    assert rows(U.apply_changes(target, changes, ["k"], ["seq"])) == want
    assert rows(U.apply_changes(target, changes.orderBy(F.desc("seq")), ["k"], ["seq"])) == want


def test_unknown_codes_fail(spark):
    codes = spark.createDataFrame([("U",)], "c string")
    with pytest.raises(Exception, match="unknown record status U"):
        codes.select(U.status_marker(F.col("c"))).collect()
    with pytest.raises(Exception, match="unknown operation Z"):
        spark.createDataFrame([("Z",)], "c string").select(U.row_marker(F.col("c"))).collect()


def test_continue_keys(spark):
    existing = spark.createDataFrame([("b", 7)], "n string, key bigint")
    wanted = spark.createDataFrame([("c",), ("a",), ("b",), ("a",), (None,)], "n string")
    assert rows(U.continue_keys(existing, wanted, "n", "key")) == [("a", 8), ("b", 7), ("c", 9)]


def test_readers_ignore_unfinished_versions(spark):
    root = work_path(spark, "t")
    V.write_version(spark.range(3).toDF("a"), root)
    spark.range(9).toDF("a").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{root}/v=000002")
    assert V.read_current(spark, root).count() == 3
    assert V.write_version(spark.range(5).toDF("a"), root).endswith("v=000003")
    assert V.read_current(spark, root).count() == 5


def test_change_file_numbering(spark):
    root = work_path(spark, "landing")
    with pytest.raises(ValueError, match="Table not found"):
        K.write_change_files(spark.range(1).withColumn(K.MARKER, F.lit(0)), K.landing_folder(root, "s", "absent"))
    with pytest.raises(ValueError, match="invalid name"):
        K.landing_folder(root, "s", "a/b")
    folder = K.create_landing_table(spark, root, "s", "t", ["key1", "key2"])
    from tidegauge.sources.files import child_names, read_text

    assert read_text(spark, f"{folder}/_metadata.json") == '{"keyColumns":["key1","key2"]}'
    rows_ = spark.range(1).select(F.col("id").alias("key1"), F.col("id").alias("key2"), F.lit(0).alias(K.MARKER))
    with pytest.raises(ValueError, match="last column"):
        K.write_change_files(rows_.select(K.MARKER, "key1", "key2"), folder)
    assert K.write_change_files(rows_, folder) == [1]
    assert K.write_change_files(rows_, folder) == [2]
    # The first file is cleaned up by the consumer: numbering goes on.
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{1:020d}.parquet")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    assert K.write_change_files(rows_, folder) == [3]
    names = [n for n in child_names(spark, folder) if n.endswith(".parquet")]
    assert names == [f"{2:020d}.parquet", f"{3:020d}.parquet"]


def test_broken_change_set_is_replaced(spark):
    from tidegauge.sources.files import child_names, rename

    folder = K.create_landing_table(spark, work_path(spark, "landing"), "s", "t", ["k"])
    change = spark.range(20).select(F.col("id").alias("k"), F.lit(0).alias(K.MARKER))
    last = K.write_change_files(change.filter("k < 5"), folder)[-1]
    # A job that broke off after its first rename: half a set under the next number, nothing published.
    stray = work_path(spark, "stray")
    change.filter("k between 10 and 12").coalesce(1).write.parquet(stray)
    part = next(n for n in child_names(spark, stray) if n.endswith(".parquet"))
    rename(spark, f"{stray}/{part}", f"{folder}/{last + 1:020d}.parquet")
    assert K.read_change_files(spark, folder).count() == 5
    assert K.write_change_files(change.filter("k >= 5"), folder)[0] == last + 1
    assert sorted(r["k"] for r in K.read_change_files(spark, folder).collect()) == list(range(20))


def test_batched_copy_resumes(spark):
    path = work_path(spark, "copy")
    source = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    K.copy_in_batches(source, path, "k", [10, 30, 70])
    # A broken commit: a range with high keys has files but no success marker.
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/range=2/_SUCCESS")
    marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(marker, False)
    K.copy_in_batches(source, path, "k", [10, 30, 70])
    assert rows(spark.read.parquet(path).drop("range")) == rows(source)

"""What tasks hold and what is written must not grow faster than the input."""

import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import tidegauge.plans  # noqa: F401  (fills the registry)
from tidegauge import session
from tidegauge.operators import graph as G
from tidegauge.registry import QUERIES
from tidegauge.sources import files

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WRITE = """
import sys
from pyspark.sql import SparkSession, functions as F
from tidegauge.sources import files
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": sys.argv[1], "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
}).getOrCreate()
rows = spark.range(300000).select("id", F.concat(F.lit("v"), F.col("id") % 3).alias("k"), F.repeat(F.lit("x"), 50).alias("t"))
files.write_one_each(rows, "k", sys.argv[2])
spark.stop()
"""


def test_writing_one_file_per_value_holds_no_rows(tmp_path):
    """A sort of all rows by the column would show as execution memory of the writing task."""
    events = tmp_path / "events"
    events.mkdir()
    env = os.environ | {"PYTHONPATH": f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"}
    subprocess.run([sys.executable, "-c", WRITE, f"file://{events}", str(tmp_path / "out")], env=env, check=True, timeout=300)
    ends = [json.loads(x) for f in events.iterdir() for x in f.read_text().splitlines() if '"SparkListenerTaskEnd"' in x]
    writing = [e["Task Metrics"] for e in ends if e["Task Metrics"]["Output Metrics"]["Records Written"]]
    assert sum(m["Output Metrics"]["Records Written"] for m in writing) == 300000
    assert max(m["Peak Execution Memory"] for m in writing) == 0


def test_one_file_per_value_also_beyond_the_open_writers(spark, tmp_path):
    rows = spark.range(500).select("id", F.when(F.col("id") % 25 > 0, F.col("id") % 25).alias("k")).repartition(5)
    files.write_one_each(rows, "k", str(tmp_path / "out"))
    assert len(glob.glob(f"{tmp_path}/out/k=*/*.parquet")) == 25
    assert spark.read.parquet(str(tmp_path / "out")).select("id", "k").exceptAll(rows).count() == 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_closure_stores_each_pair_once(spark):
    before = set(glob.glob(f"{session.shared_dir(spark)}/closure-*"))
    edges = spark.range(40).select(F.col("id").alias("s"), (F.col("id") + 1).alias("d"))
    out = G.closure(edges, "s", "d")
    folders = set(glob.glob(f"{session.shared_dir(spark)}/closure-*")) - before
    assert sum(spark.read.parquet(f).count() for f in folders) == out.count() == 40 * 41 // 2


def test_closure_with_null_ends_and_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 5)
    edges = [(None, "a"), ("a", "b"), ("a", "b"), ("b", None), ("b", "c"), ("c", "a"), ("c", None), ("a", None)]
    out = G.closure(spark.createDataFrame(edges, "s string, d string"), "s", "d")
    cycle = {("a", "b"): 1, ("a", "c"): 2, ("a", "a"): 3, ("b", "c"): 1, ("b", "a"): 2, ("b", "b"): 3}
    cycle |= {("c", "a"): 1, ("c", "b"): 2, ("c", "c"): 3, (None, "a"): 1, (None, "b"): 2, (None, "c"): 3}
    cycle |= {("a", None): 1, ("b", None): 1, ("c", None): 1, (None, None): 2}
    rows = out.collect()
    assert len(rows) == len(cycle)
    assert {(r["root"], r["node"]): r["level"] for r in rows} == cycle
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("closure")]


def small_tables(spark, folder):
    keys = spark.range(1, 401)
    keys.selectExpr("id AS o_orderkey").write.parquet(f"{folder}/orders.parquet")
    keys.selectExpr("id AS p_partkey", "'b' || id % 5 AS p_brand").write.parquet(f"{folder}/part.parquet")
    keys.selectExpr("id AS s_suppkey", "id % 3 AS s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    spark.range(3).selectExpr("id AS n_nationkey", "'n' || id AS n_name").write.parquet(f"{folder}/nation.parquet")
    keys.crossJoin(spark.range(3).withColumnRenamed("id", "l")).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(l AS DOUBLE) AS l_quantity",
        "CAST('1995-01-31' AS TIMESTAMP) + make_dt_interval(CAST(l AS INT)) AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("name, key, tasks", [("M15_alternate_date", "l_orderkey", 16), ("R3_upstream_edges", "l_partkey", 12)])
def test_rows_are_dealt_to_as_many_tasks_as_there_are_rows_for(spark, tmp_path, monkeypatch, name, key, tasks):
    """Partitions of a stated number are not merged, so a task's memory does not follow the input."""
    small_tables(spark, tmp_path)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    out = QUERIES[name](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if f"hashpartitioning({key}#" in x and f", {tasks}), REPARTITION_BY_NUM" in x]
    assert out.count() > 0

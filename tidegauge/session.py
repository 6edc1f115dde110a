"""Session helpers: settings the library relies on, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 200_000

_LOCAL_FOLDERS: dict[str, str] = {}
_USED: dict[str, list[str]] = {}  # paths handed out, by application


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: UTC calendar maths and adaptive, skew-aware execution.

    Skewed joins are split even where that costs a further shuffle for the grouping after them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for the actions started within; what held before is put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a machine-local
    folder would lose data with its executor, so the missing setting is an error there.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = sc.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tidegauge-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
    return _LOCAL_FOLDERS[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. It stays until ``release``, as results may still read it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _USED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete everything this application has put below the shared folder; call it when no result is read any more.

    Returns the number of paths deleted.
    """
    paths = _USED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so a lost executor costs no recompute."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table of the shared folder and read back.

    Like a checkpoint it ends the lineage; unlike one it tells the planner the real size, so that a
    small result is broadcast and a big one is not.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(rows: int) -> int:
    """In how many tasks so many rows are worked on, each with about the same number however many there are."""
    return max(1, -(-rows // ROWS_PER_TASK))


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to ``tasks_for(rows)`` partitions.

    Adaptive execution merges the partitions of its own shuffles up to a size, and a task's memory with
    them; it leaves a stated number alone.
    """
    return df.repartition(tasks_for(rows), *keys)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table of the data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")

"""File-system helpers on Hadoop paths: they work the same on local disks and object stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import settings

OPEN_FILES = 8  # writers a task holds open, each with a row group in memory


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, glob: str) -> bool:
    p, fs = _path(spark, glob)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def child_names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _path(spark, old)
    q, _ = _path(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove one file, if it is there."""
    p, fs = _path(spark, path)
    fs.delete(p, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, such as a metadata document."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_one_each(df: DataFrame, column: str, folder: str) -> None:
    """One Parquet file per value of a column.

    A value's rows meet in one task, which has a writer open per value it meets, up to ``OPEN_FILES``, and passes
    rows on as they come. Without that setting it sorts all its rows by the column first.
    """
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        df.repartition(column).write.partitionBy(column).parquet(folder)


def sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of every file below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    )


def storage_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and MB per kind of file: data, log or other."""
    kind = F.when(
        F.col("path").endswith(".parquet"), "data"
    ).when(F.col("path").endswith(".json"), "log").otherwise("other")
    return (
        sizes(spark, folder)
        .groupBy(kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .withColumn("mb", F.round(F.col("bytes") / 1048576, 2))
    )

"""Begins and ends of operations paired as two streams, with bounded state on disk.

Arriving rows are admitted first: a row earlier than the latest one of the batches before by more than ``delay``, without a
time or not after 1 January 1970, goes to a visible table of late rows. What is admitted can't be late for the join, whose watermark follows the same
rows: neither loses a row in silence. The join is a full outer one of begins and ends, each within ``within`` of the
other: pairs come out at once, what found no partner once the watermark has passed it. Its state holds what can still
be matched, whatever the stream's length, and a batch writes its own changes only (RocksDB with a changelog).

How many operations run is a log of signed counts: a batch's begins add, its pairs subtract. No batch rewrites a table.

Below ``root``: admitted/, late/, seen/ (latest time per batch), pairs/ (all outcomes), deltas/ (signed counts).
Every batch writes folders named by its number, so that a repeated batch overwrites what it wrote before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.sources.files import exists
from tidegauge.streaming.streams import run_available

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SETTINGS = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
PAIRED, OPEN, UNMATCHED = "paired", "begin without end", "end without begin"


@dataclass(frozen=True)
class Pairing:
    """What is paired: rows with ``keys``, ``phase`` (begin or end), a timestamp ``ts`` and an ``id`` of the row.

    ``kept`` columns are taken from the begin; ``by`` are those among them that running operations are counted by.
    """

    root: str
    keys: Sequence[str]
    id: str
    kept: Sequence[str] = field(default_factory=tuple)
    by: Sequence[str] = field(default_factory=tuple)
    delay: str = "1 day"
    within: str = "1 day"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB; the session's settings are put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def admit(p: Pairing, df: DataFrame, batch: int) -> None:
    """Split a batch into admitted and late rows; it is compared with the batches before, never with itself."""
    spark = df.sparkSession
    reached = None
    if batch > 0 and exists(spark, f"{p.root}/seen"):
        seen = spark.read.option("basePath", f"{p.root}/seen").schema("ts timestamp, batch int").parquet(f"{p.root}/seen")
        reached = seen.filter(F.col("batch") < batch).agg(F.max("ts").alias("ts")).first()["ts"]  # one row per batch
    on_time = F.coalesce(F.col("ts").cast("timestamp") > F.timestamp_seconds(F.lit(0)), F.lit(False))  # a watermark starts there
    if reached is not None:
        on_time = on_time & (F.col("ts") >= F.lit(reached) - F.expr(f"interval {p.delay}"))
    df = df.select(*p.keys, p.id, *p.kept, "phase", F.col("ts").cast("timestamp").alias("ts")).withColumn("_on_time", on_time)
    df = df.persist()
    try:
        good = df.filter("_on_time").drop("_on_time")
        good.write.mode("overwrite").parquet(f"{p.root}/admitted/batch={batch}")
        df.filter(~F.col("_on_time")).drop("_on_time").write.mode("overwrite").parquet(f"{p.root}/late/batch={batch}")
        begun = good.filter(F.col("phase") == "begin").groupBy(*p.by).agg(F.count(F.lit(1)).alias("change"))
        begun.write.mode("overwrite").parquet(f"{p.root}/deltas/side=begun/batch={batch}")
        good.agg(F.max("ts").alias("ts")).coalesce(1).write.mode("overwrite").parquet(f"{p.root}/seen/batch={batch}")
    finally:
        df.unpersist()


def joined(p: Pairing, admitted: DataFrame, again: DataFrame) -> DataFrame:
    """The outer join of two readings of the admitted stream, one row per pair or row without a partner."""
    begins = admitted.filter(F.col("phase") == "begin").select(
        *[F.col(k).alias(f"b_{k}") for k in p.keys], F.col(p.id).alias("begin_id"), *p.kept, F.col("ts").alias("begin_ts")
    )
    ends = again.filter(F.col("phase") == "end").select(
        *[F.col(k).alias(f"e_{k}") for k in p.keys], F.col(p.id).alias("end_id"), F.col("ts").alias("end_ts")
    )
    same = (F.col("end_ts") >= F.col("begin_ts")) & (F.col("end_ts") <= F.col("begin_ts") + F.expr(f"interval {p.within}"))
    for k in p.keys:
        same = same & (F.col(f"b_{k}") == F.col(f"e_{k}"))
    both = begins.withWatermark("begin_ts", p.delay).join(ends.withWatermark("end_ts", p.delay), same, "full_outer")
    outcome = F.when(F.col("end_ts").isNull(), OPEN).when(F.col("begin_ts").isNull(), UNMATCHED).otherwise(PAIRED)
    keys = [F.coalesce(f"b_{k}", f"e_{k}").alias(k) for k in p.keys]
    return both.select(*keys, "begin_id", "end_id", *p.kept, "begin_ts", "end_ts", outcome.alias("outcome"))


def collect_pairs(p: Pairing, df: DataFrame, batch: int) -> None:
    """Write a batch's outcomes, and one operation less for every begin that found its first end in it."""
    df = df.persist()
    try:
        df.write.mode("overwrite").parquet(f"{p.root}/pairs/batch={batch}")
        ended = df.filter(F.col("outcome") == PAIRED).groupBy(*p.by).agg((-F.count(F.lit(1))).alias("change"))
        ended.write.mode("overwrite").parquet(f"{p.root}/deltas/side=ended/batch={batch}")
    finally:
        df.unpersist()


def run_pairing(p: Pairing, stream: DataFrame) -> None:
    """Admit everything that has arrived, then join what was admitted, and stop.

    The two queries run one after the other with checkpoints of their own. An interrupted run is repeated from its last
    complete batch: admission is complete before the join looks at its files.
    """
    spark = stream.sparkSession
    run_available(stream, f"{p.root}/checkpoints/admission", lambda df, batch: admit(p, df, batch))
    if not exists(spark, f"{p.root}/admitted"):
        return
    types = dict((f.name, f.dataType) for f in stream.schema.fields)
    names = [*p.keys, p.id, *p.kept, "phase", "ts"]
    schema = T.StructType([T.StructField(n, T.TimestampType() if n == "ts" else types[n]) for n in dict.fromkeys(names)])

    def reading() -> DataFrame:
        return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{p.root}/admitted/batch=*")

    with state_on_disk(spark):
        run_available(joined(p, reading(), reading()), f"{p.root}/checkpoints/join", lambda df, batch: collect_pairs(p, df, batch))


def _read(spark: SparkSession, p: Pairing, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{p.root}/{name}").parquet(f"{p.root}/{name}")


def outcomes(spark: SparkSession, p: Pairing) -> DataFrame:
    """Pairs, and rows given up as the watermark has passed all partners they could have."""
    return _read(spark, p, "pairs").drop("batch")


def late_rows(spark: SparkSession, p: Pairing) -> DataFrame:
    """Rows that came too late to be paired, or have no time that a watermark can follow."""
    return _read(spark, p, "late").drop("batch")


def ends_with_begins(spark: SparkSession, p: Pairing) -> DataFrame:
    """(end_id, begin_id) as of now: every admitted end with its begins, null if there is none so far."""
    pairs = outcomes(spark, p).filter(F.col("outcome") == PAIRED).select("end_id", "begin_id")
    ends = _read(spark, p, "admitted").filter(F.col("phase") == "end").select(F.col(p.id).alias("end_id"))
    alone = ends.join(pairs.select("end_id"), "end_id", "left_anti").withColumn("begin_id", F.lit(None).cast(dict(pairs.dtypes)["begin_id"]))
    return pairs.unionByName(alone)


def running_now(spark: SparkSession, p: Pairing) -> DataFrame:
    """How many operations have begun and not ended, for operations that end once: the sum of the signed counts."""
    summed = _read(spark, p, "deltas").groupBy(*p.by).agg(F.sum("change").alias("running"))
    return summed.filter(F.col("running") != 0)

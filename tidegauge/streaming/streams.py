"""Streams of files: ingest, change apply, status over time, running operations, suppression.

Late rows count like all others: what a window or an operation needs to know is kept as state.
Every sink is idempotent per batch id: a replayed batch rewrites what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.merge import DELETE, MARKER, changes_since
from tidegauge.operators.ordered import Running, latest, running
from tidegauge.session import stored
from tidegauge.sources.files import child_names, exists
from tidegauge.tables.maintenance import write_change_files
from tidegauge.tables.versioned import current_path, read_current, write_version

def drop_stream(
    spark: SparkSession, folder: str, fmt: str, schema: str, glob: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """New files of a folder as a stream. Names that start with ``_`` or ``.`` are never read."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process everything that is there now, batch by batch, then stop."""
    start(stream, checkpoint, each, available_now=True).awaitTermination()


def start(
    stream: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None],
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return writer.trigger(availableNow=True).start() if available_now else writer.trigger(processingTime=every).start()


def ingest(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append the stream to a parquet table, exactly once."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option(
            "checkpointLocation", checkpoint
        ).outputMode("append")
    )
    query.trigger(availableNow=True).start().awaitTermination()


def import_batches(
    path: str, load: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Callable[[DataFrame, int], None]:
    """Batch function that imports each batch into its own partition; a replay overwrites it."""

    def each(df: DataFrame, batch: int) -> None:
        load(df).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return each


# Versioned state --------------------------------------------------------------------------------


def state_after(spark: SparkSession, root: str, batch: int) -> DataFrame | None:
    """The state a batch starts from: what the batch before it left. None before the first."""
    for number in range(batch, -1, -1):
        if exists(spark, f"{root}/v={number:06d}/_SUCCESS"):
            return spark.read.parquet(f"{root}/v={number:06d}")
    return None


def save_state(df: DataFrame, root: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/v={batch + 1:06d}")


def change_state(rows: DataFrame, keys: Sequence[str], file: str = "_file") -> DataFrame:
    """Rows of a table as change state: the file number of the last change, and a deletion mark."""
    return rows.withColumns({file: F.lit(0).cast("bigint"), "_gone": F.lit(False)})


def apply_change_batches(root: str, keys: Sequence[str], columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch function that applies change rows to the versioned state below ``root``.

    The state remembers the file number of each key's last change, deletions included, so batches
    may arrive in any order and twice. Rows carry ``_file``, ``_place`` and the marker.
    """

    def each(df: DataFrame, batch: int) -> None:
        last = latest(df, keys, [F.col("_file"), F.col("_place")])
        news = last.select(*columns, "_file", (F.col(MARKER) == DELETE).alias("_gone"))
        old = state_after(df.sparkSession, root, batch)
        both = news if old is None else old.unionByName(news)
        save_state(latest(both, keys, [F.col("_file")]), root, batch)

    return each


def log_changes(root: str, keys: Sequence[str], columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch function that only logs each batch's last change per key, next to the state.

    A batch costs its own rows however big the table is; ``logged_state`` merges on reading and
    ``compact`` folds the log into a new state from time to time.
    """

    def each(df: DataFrame, batch: int) -> None:
        last = latest(df, keys, [F.col("_file"), F.col("_place")])
        news = last.select(*columns, "_file", (F.col(MARKER) == DELETE).alias("_gone"))
        news.write.mode("overwrite").parquet(f"{root}/log/batch={batch}")

    return each


def _folded(spark: SparkSession, root: str) -> int:
    """Number of batches that the newest state contains."""
    path = current_path(spark, root)
    return 0 if path is None else int(path.rpartition("v=")[2])


def logged_state(spark: SparkSession, root: str, keys: Sequence[str], before: int | None = None) -> DataFrame:
    """State with the logged batches that it does not contain yet, or with those of them ``before`` a batch."""
    parts = []
    if current_path(spark, root) is not None:
        parts.append(read_current(spark, root))
    if exists(spark, f"{root}/log"):
        log = spark.read.option("basePath", f"{root}/log").parquet(f"{root}/log")
        log = log.filter(F.col("batch") >= _folded(spark, root))
        parts.append((log if before is None else log.filter(F.col("batch") < before)).drop("batch"))
    if not parts:
        raise FileNotFoundError(f"neither state nor log below {root}")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest(both, keys, [F.col("_file")])


def compact(spark: SparkSession, root: str, keys: Sequence[str]) -> None:
    """Publish a state that contains every batch logged so far. Run it between batches."""
    batches = [int(n.rpartition("=")[2]) for n in child_names(spark, f"{root}/log") if n.startswith("batch=")]
    if batches and max(batches) >= _folded(spark, root):
        save_state(logged_state(spark, root, keys), root, max(batches))


def upsert_batches(root: str, keys: Sequence[str], columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch function for streams of whole rows: each batch's row per key replaces the one before.

    Like all logged changes a batch costs its own rows only. The greatest row counts if a batch has several of a key.
    """
    log = log_changes(root, keys, columns)

    def each(df: DataFrame, batch: int) -> None:
        place = F.struct(*[F.col(c) for c in columns])
        log(df.withColumns({"_file": F.lit(batch + 1).cast("bigint"), "_place": place, MARKER: F.lit(0)}), batch)

    return each


def visible(state: DataFrame) -> DataFrame:
    return state.filter(~F.col("_gone")).drop("_file", "_gone")


def track_open(root: str, op: str, kept: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch function that keeps the operations begun but not ended.

    Rows carry ``phase`` (begin or end) and ``ts``. An end may come before its begin, however much earlier: it stays in
    the state until its begin arrives, and ``unmatched_ends`` shows those that wait.
    """

    def each(df: DataFrame, batch: int) -> None:
        begun = F.col("phase") == "begin"
        old = state_after(df.sparkSession, root, batch)
        news = df.select(op, *kept, "phase", "ts")
        rows = news if old is None else old.unionByName(news)
        pairs = rows.groupBy(op).agg(
            F.max_by(F.struct(*kept, "phase", "ts"), F.struct(begun, F.col("ts"))).alias("r"),
            F.count_if(begun).alias("_begins"),
            F.count_if(~begun).alias("_ends"),
        )
        alone = (F.col("_ends") == 0) | (F.col("_begins") == 0)
        save_state(pairs.filter(alone).select(op, "r.*"), root, batch)

    return each


def unmatched_ends(state: DataFrame) -> DataFrame:
    """Ends whose begin has not arrived yet."""
    return state.filter(F.col("phase") == "end")


def open_operations(state: DataFrame, by: Sequence[str]) -> DataFrame:
    return state.filter(F.col("phase") == "begin").groupBy(*by).agg(F.count(F.lit(1)).alias("running"))


def count_by_status(
    root: str, ts: str, status: Column, every: str, utc_offset_minutes: int = 0
) -> Callable[[DataFrame, int], None]:
    """Batch function that counts operations by status per tumbling window of local time.

    Each batch is counted by itself and added to the state, one row per window and status, so that late rows count
    in their window and windows still open show what has arrived.
    """

    def each(df: DataFrame, batch: int) -> None:
        local = F.col(ts) + F.make_dt_interval(mins=F.lit(utc_offset_minutes))
        news = (
            df.select(F.window(local, every).alias("w"), status.alias("status"))
            .groupBy(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "status")
            .agg(F.count(F.lit(1)).alias("operations"))
        )
        old = state_after(df.sparkSession, root, batch)
        both = news if old is None else old.unionByName(news)
        save_state(both.groupBy("start", "end", "status").agg(F.sum("operations").alias("operations")), root, batch)

    return each


def recent(df: DataFrame, ingested: str, now: Column, within: str = "1 hour") -> DataFrame:
    """Rows ingested within the last hour of ``now``."""
    return df.filter((F.col(ingested) > now - F.expr(f"interval {within}")) & (F.col(ingested) <= now))


def suppress_unchanged(
    root: str, out: str, table: str, signature: str, at: str, ttl: str = "10 hours"
) -> Callable[[DataFrame, int], None]:
    """Batch function that forwards a table's snapshot only when its content hash changed or the
    last forwarded one is older than ``ttl``.

    Snapshots of a table are looked at one after another in time, each against the last one forwarded, so that the
    result does not depend on how they are cut into batches. Snapshots without a time have no place in that order: they
    are all forwarded and nothing is compared with them.

    A snapshot that is kept back has the content of the one before it, so changes show between neighbours, whose order is
    dealt over slices: a table with very many snapshots is in no single task. Within a run of equal content, what
    outlives ``ttl`` is found for all runs at once, as many times as ``ttl`` fits into the longest of them. The ledger is a
    log with the last forwarded snapshots of each batch, so a batch writes what it has forwarded only.
    """
    log = log_changes(root, [table], [table, signature, at])

    def each(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        news = df.select(F.col(table).alias("of"), F.col(signature).alias("hash"), F.col(at).alias("at"), F.lit(False).alias("known"))
        timed = news.filter(F.col("at").isNotNull())
        ledger = ledger_before(spark, root, table, batch)
        if ledger is not None:
            # What was forwarded last comes before everything in the batch, late snapshots included.
            last = ledger.select(F.col(table).alias("of"), F.col(signature).alias("hash"), F.col(at).alias("at"), F.lit(True).alias("known"))
            here = timed.select(F.col("of").alias("here")).distinct()
            timed = timed.unionByName(last.join(here, F.col("of").eqNullSafe(F.col("here")), "left_semi"))
        # Rows of one place are equal, so it does not matter which comes first.
        order = [F.col("known").desc(), F.col("at"), F.col("hash")]
        compared = running(timed, ["of"], order, before=Running("last", F.struct("hash"), inclusive=False))
        changed = F.col("before").isNull() | ~F.col("before.hash").eqNullSafe(F.col("hash"))
        compared = compared.withColumn("begins", F.when(changed, F.col("at")))
        runs = running(compared, ["of"], order, begun=Running("last", F.col("begins"))).drop("before")

        passed = [runs.filter(F.col("begins").isNotNull() & ~F.col("known")).select("of", "hash", "at")]
        # What is still kept back, with the time of the last snapshot of its run that was forwarded.
        waiting = runs.filter(F.col("begins").isNull()).withColumn("mark", F.col("begun"))
        outlived = F.col("at") >= F.col("mark") + F.expr(f"interval {ttl}")
        while True:
            waiting = stored(waiting.filter(outlived).select("of", "hash", "at", "begun"), "snapshots-waiting")
            if waiting.limit(1).count() == 0:
                break
            marks = waiting.groupBy("of", "hash", "begun").agg(F.min("at").alias("at"))
            passed.append(marks.select("of", "hash", "at"))
            marks = marks.select(F.col("of").alias("mark_of"), F.col("hash").alias("mark_hash"), F.col("begun").alias("mark_begun"), F.col("at").alias("mark"))
            same = F.col("of").eqNullSafe(F.col("mark_of")) & F.col("hash").eqNullSafe(F.col("mark_hash")) & (F.col("begun") == F.col("mark_begun"))
            waiting = waiting.join(marks, same)
        timeless = news.filter(F.col("at").isNull()).select("of", "hash", "at")
        fresh = reduce(DataFrame.unionByName, [*passed, timeless]).toDF(table, signature, at)
        fresh.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        forwarded = spark.read.schema(fresh.schema).parquet(f"{out}/batch={batch}").filter(F.col(at).isNotNull())
        place = F.struct(F.col(at), F.col(signature))
        log(forwarded.withColumns({"_file": F.lit(batch + 1).cast("bigint"), "_place": place, MARKER: F.lit(0)}), batch)

    return each


def ledger_before(spark: SparkSession, root: str, key: str, batch: int) -> DataFrame | None:
    """The logged rows, one per key, as they were before ``batch``, which may have been tried already. None at first."""
    if batch == 0 or not (exists(spark, f"{root}/log") or current_path(spark, root)):
        return None
    return visible(logged_state(spark, root, [key], batch))


# Polled mirror ----------------------------------------------------------------------------------


def due(config: DataFrame, now: Column) -> DataFrame:
    """Enabled or running tables whose interval has passed since their last run."""
    waited = F.col("last_run").isNull() | (
        F.timestamp_add("SECOND", F.col("interval_seconds"), F.col("last_run")) <= now
    )
    return config.filter(F.col("status").isin("Enabled", "Running") & waited)


def mirror_once(df: DataFrame, version: str, folder: str, state_root: str) -> list[int]:
    """One polling round of a table: a full extract first, later the rows above the stored mark.

    The mark is published after the change files, so an interrupted round is repeated, and applying
    its rows twice changes nothing.
    """
    spark = df.sparkSession
    known = current_path(spark, state_root) is not None
    mark = read_current(spark, state_root).first()["mark"] if known else None  # one stored number
    changes = changes_since(df, version, mark)
    top = changes.agg(F.max(version).cast("bigint").alias("mark")).first()["mark"]
    if top is None:
        return []
    numbers = write_change_files(changes, folder, order=[version])
    write_version(spark.range(1).select(F.lit(top).alias("mark"), F.lit("Running").alias("status")), state_root)
    return numbers


def mirror_due(
    config: DataFrame, mirrors: Mapping[str, tuple[DataFrame, str, str, str]], now: Column
) -> DataFrame:
    """One poll over all tables: those that are due are mirrored, each by ``mirror_once`` with its (rows, version column,
    folder, state root). Returns the configuration afterwards: what was mirrored is Running, with ``now`` as last run.

    The configuration has one row per table and comes to the driver, which starts a job per due table.
    """
    names = [r["name"] for r in due(config, now).select("name").collect() if r["name"] in mirrors]
    for name in names:
        mirror_once(*mirrors[name])
    done = F.col("name").isin(names) if names else F.lit(False)
    return config.withColumns(
        {"status": F.when(done, F.lit("Running")).otherwise(F.col("status")), "last_run": F.when(done, now).otherwise(F.col("last_run"))}
    )

"""Streaming (X rows of the inventory): events are dropped as files and streamed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import columns as C
from tidegauge.operators import merge as U
from tidegauge.plans.changes import base, change_rows, target_of
from tidegauge.plans.expressions import STATUS
from tidegauge.registry import query
from tidegauge.session import stored, table, work_path
from tidegauge.streaming import pairing as P
from tidegauge.streaming import streams as X
from tidegauge.tables import maintenance as K
from tidegauge.tables.versioned import read_current

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def drop(spark: SparkSession, sf: str, fmt: str = "json") -> str:
    path = work_path(spark, "drop")
    table(spark, sf, "events").write.format(fmt).save(path)
    return path


@query(
    "X1_ingest",
    "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, min(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS first_at FROM events GROUP BY 1",
)
def ingest(spark: SparkSession, sf: str) -> DataFrame:
    out = work_path(spark, "ingested")
    X.ingest(X.drop_stream(spark, drop(spark, sf), "json", EVENTS), out, work_path(spark, "checkpoint"))
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.date_format(
            F.min("ts"), "yyyy-MM-dd HH:mm:ss"
        ).alias("first_at")
    )


@query("X2_file_watch", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def file_watch(spark: SparkSession, sf: str) -> DataFrame:
    """Dropped twice with the same checkpoint: only the new files are imported the second time."""
    path, out, checkpoint = work_path(spark, "watched"), work_path(spark, "imported"), work_path(spark, "checkpoint")
    events = table(spark, sf, "events")
    for wanted in (F.col("event_type") == "error", F.col("event_type") != "error"):
        events.filter(wanted).write.mode("append").parquet(path)
        X.run_available(X.drop_stream(spark, path, "parquet", EVENTS, "*.parquet"), checkpoint, X.import_batches(out))
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "X3_polled_mirror",
    """SELECT 0 AS marker, count(*) AS n FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 1, count(*) FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)""",
)
def polled_mirror(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds over a growing table and a third that finds nothing new."""
    orders = base(spark, sf)
    folder = K.create_landing_table(spark, work_path(spark, "landing"), "sales", "orders", ["o_orderkey"])
    state = work_path(spark, "mark")
    half = orders.agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    for grown in (orders.filter(F.col("o_orderkey") <= half), orders, orders):
        X.mirror_once(grown, "o_orderkey", folder, state)
    return K.read_change_files(spark, folder).groupBy(F.col(U.MARKER).alias("marker")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "X3_scheduled_mirrors",
    """SELECT 'orders' AS name, 'Running' AS status, 0 AS marker, count(*) AS n FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 'orders', 'Running', 1, count(*) FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 'customer', 'Running', 0, count(*) FROM customer WHERE c_custkey <= (SELECT max(c_custkey) // 2 FROM customer)
    UNION ALL SELECT 'part', 'Disabled', NULL, 0""",
)
def scheduled_mirrors(spark: SparkSession, sf: str) -> DataFrame:
    """Two polls two minutes apart: orders are due in both, customers every ten minutes only, parts are disabled."""
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    folders = {n: K.create_landing_table(spark, work_path(spark, "landing"), "sales", n, [k]) for n, k in keys.items()}
    marks = {n: work_path(spark, "mark") for n in keys}
    config = spark.createDataFrame(
        [("orders", "Enabled", 60), ("customer", "Enabled", 600), ("part", "Disabled", 60)], "name string, status string, interval_seconds int"
    ).withColumn("last_run", F.lit(None).cast("timestamp"))
    for minute, whole in ((0, False), (2, True)):
        mirrors = {}
        for name, key in keys.items():
            rows = table(spark, sf, name).select(key)
            half = rows.agg(F.floor(F.max(key) / 2)).first()[0]
            mirrors[name] = (rows if whole else rows.filter(F.col(key) <= half), key, folders[name], marks[name])
        config = stored(X.mirror_due(config, mirrors, F.timestamp_seconds(F.lit(1_704_067_200 + 60 * minute))), "mirror-config")
    counted = None
    for name in ("orders", "customer"):
        rows = K.read_change_files(spark, folders[name]).groupBy(F.col(U.MARKER).alias("marker")).agg(F.count(F.lit(1)).alias("n"))
        rows = rows.withColumn("of", F.lit(name))
        counted = rows if counted is None else counted.unionByName(rows)
    return config.join(counted, F.col("name") == F.col("of"), "left").select(
        "name", "status", "marker", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


@query(
    "X4_change_apply",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders WHERE o_orderkey % 11 <> 0""",
)
def change_apply(spark: SparkSession, sf: str) -> DataFrame:
    orders = base(spark, sf)
    folder = K.create_landing_table(spark, work_path(spark, "landing"), "sales", "orders", ["o_orderkey"])
    root, keys = work_path(spark, "state"), ["o_orderkey"]
    X.save_state(X.change_state(target_of(orders), keys), root, -1)
    changes = change_rows(orders)
    for seq in (1, 2):
        K.write_change_files(changes.filter(F.col("seq") == seq).drop("seq"), folder)
    schema = spark.read.option("pathGlobFilter", "*.parquet").parquet(folder).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(folder)
    numbered = stream.select(
        "*",
        F.substring(F.col("_metadata.file_name"), 1, 20).cast("bigint").alias("_file"),
        F.col("_metadata.file_block_start").alias("_place"),  # a change set holds a key once
    )
    X.run_available(numbered, work_path(spark, "checkpoint"), X.log_changes(root, keys, orders.columns))
    return X.visible(X.logged_state(spark, root, keys))


@query(
    "X5_recent",
    """SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '2024-01-30 00:00:00'""",
)
def recent(spark: SparkSession, sf: str) -> DataFrame:
    now = F.expr("timestamp_ntz '2024-01-30 00:00:00'")
    return X.recent(table(spark, sf, "events"), "ts", now).select("event_id", "event_type")


@query(
    "X6_running_operations",
    """SELECT user_id, event_type AS application, count(*) AS running FROM events WHERE event_id % 4 = 0 GROUP BY 1, 2""",
)
def running_operations(spark: SparkSession, sf: str) -> DataFrame:
    """Every event begins an operation; all but each fourth end a minute later. Files come in three drops."""
    events = table(spark, sf, "events")
    begins = events.select("event_id", "user_id", F.col("event_type").alias("application"), F.lit("begin").alias("phase"), "ts")
    ended = F.col("ts") + F.expr("interval 1 minute")
    ends = events.filter(F.col("event_id") % 4 != 0).select(
        "event_id", F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("string").alias("application"), F.lit("end").alias("phase"), ended.alias("ts")
    )
    kept = ["user_id", "application"]
    pairing = P.Pairing(work_path(spark, "operations"), ["event_id"], "row", kept, kept)
    _pair_in_drops(spark, pairing, begins.unionByName(ends).withColumn("row", F.col("event_id")))
    return P.running_now(spark, pairing)


def _pair_in_drops(spark: SparkSession, pairing: P.Pairing, rows: DataFrame) -> None:
    """The rows before 11 January, those before the 21st and the rest, each dropped and paired before the next comes."""
    path = work_path(spark, "dropped")
    part = F.when(F.col("ts") < F.expr("timestamp_ntz '2024-01-11'"), 0)
    part = part.when(F.col("ts") < F.expr("timestamp_ntz '2024-01-21'"), 1).otherwise(2)
    for number in range(3):
        rows.filter(part == number).write.mode("append").parquet(path)
        schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
        P.run_pairing(pairing, X.drop_stream(spark, path, "parquet", schema, "*.parquet"))


@query(
    "J12_streamed_pairs",
    """SELECT e.event_id AS end_id, b.event_id AS begin_id FROM (SELECT * FROM events WHERE event_type IN ('error', 'purchase') AND ts IS NOT NULL) e
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') b ON e.user_id = b.user_id AND e.props = b.props
        AND e.ts >= b.ts AND e.ts <= b.ts + INTERVAL 1 DAY""",
)
def streamed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Ends with the begins of the day before them on both keys, as two streams."""
    kind = F.col("event_type")
    phase = F.when(kind == "click", "begin").when(kind.isin("error", "purchase"), "end")
    rows = table(spark, sf, "events").select("user_id", "props", "event_id", phase.alias("phase"), "ts").filter("phase IS NOT NULL")
    pairing = P.Pairing(work_path(spark, "paired"), ["user_id", "props"], "event_id")
    _pair_in_drops(spark, pairing, rows)
    return P.ends_with_begins(spark, pairing)


@query(
    "X7_status_over_time",
    f"""SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, status, CAST(count(*) AS BIGINT) AS operations
    FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts + INTERVAL 60 MINUTE) AS s, {STATUS} AS status FROM events) GROUP BY 1, 2""",
)
def status_over_time(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly windows in UTC+1 over all events, whatever order their files arrive in."""
    kind = F.col("event_type")
    result = F.when(kind == "error", "Failed").when(kind == "view", "InProgress").when(kind == "purchase", "Succeeded")
    status = C.status_of(result, F.when(kind == "click", 1).otherwise(0))
    root = work_path(spark, "status")
    stream = X.drop_stream(spark, drop(spark, sf, "parquet"), "parquet", EVENTS, "*.parquet")
    X.run_available(stream, work_path(spark, "checkpoint"), X.count_by_status(root, "ts", status, "1 hour", 60))
    return read_current(spark, root).select(
        F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "status", "operations"
    )


@query(
    "X8_unchanged_snapshots",
    """WITH RECURSIVE s AS (SELECT user_id, event_type AS h, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) AS n,
        CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch
        FROM events WHERE ts IS NOT NULL),
    r AS (SELECT user_id, n, h AS last_h, ts AS last_ts, h, ts, batch, true AS passed FROM s WHERE n = 1
        UNION ALL SELECT s.user_id, s.n, CASE WHEN s.h = last_h AND s.ts < last_ts + INTERVAL 480 HOUR THEN last_h ELSE s.h END,
            CASE WHEN s.h = last_h AND s.ts < last_ts + INTERVAL 480 HOUR THEN last_ts ELSE s.ts END, s.h, s.ts, s.batch,
            NOT (s.h = last_h AND s.ts < last_ts + INTERVAL 480 HOUR) FROM r JOIN s ON s.user_id = r.user_id AND s.n = r.n + 1)
    SELECT user_id, h AS content_hash, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(batch AS INTEGER) AS batch FROM r WHERE passed
    UNION ALL SELECT user_id, event_type, NULL, 2 FROM events WHERE ts IS NULL""",
)
def unchanged_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Users as tables and their event types as contents, in three batches: changed ones go on.

    The first batch has all before 11 January, the last all from the 21st on and events without a time.
    """
    path, root, out = (work_path(spark, n) for n in ("snapshots", "ledger", "forwarded"))
    checkpoint = work_path(spark, "checkpoint")
    events = table(spark, sf, "events").select("user_id", F.col("event_type").alias("content_hash"), "ts")
    part = F.when(F.col("ts") < F.expr("timestamp_ntz '2024-01-11'"), 0)
    part = part.when(F.col("ts") < F.expr("timestamp_ntz '2024-01-21'"), 1).otherwise(2)
    for number in range(3):
        events.filter(part == number).write.mode("append").parquet(path)
        stream = X.drop_stream(
            spark, path, "parquet", "user_id bigint, content_hash string, ts timestamp_ntz", "*.parquet"
        )
        X.run_available(
            stream, checkpoint, X.suppress_unchanged(root, out, "user_id", "content_hash", "ts", "480 hours")
        )
    return spark.read.parquet(out).select(
        "user_id", "content_hash", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "batch"
    )

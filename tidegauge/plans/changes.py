"""Upserts, snapshots and change data (U rows of the inventory).

Orders play the target; change rows are derived from their keys and dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.money import as_double, money
from tidegauge.operators import incremental as I
from tidegauge.operators import merge as U
from tidegauge.registry import query
from tidegauge.session import stored, table, work_path
from tidegauge.streaming import streams as X
from tidegauge.tables import maintenance as K
from tidegauge.tables import versioned as V

AT = "2024-01-30 00:00:00"


def stamp():
    return F.to_timestamp(F.lit(AT))


def base(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def target_of(df: DataFrame) -> DataFrame:
    """The old state: orders not divisible by 5."""
    return df.filter(F.col("o_orderkey") % 5 != 0)


def source_of(df: DataFrame) -> DataFrame:
    """The new state: orders not divisible by 3, those divisible by 7 changed."""
    changed = F.col("o_orderkey") % 7 == 0
    return df.filter(F.col("o_orderkey") % 3 != 0).withColumns(
        {
            "o_orderstatus": F.when(changed, "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(changed, F.lit(0.0)).otherwise(F.col("o_totalprice")),
        }
    )


NEW_STATE = """WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0),
    s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)"""


@query(
    "U1_merge",
    f"""{NEW_STATE} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
        coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey""",
)
def merge(spark: SparkSession, sf: str) -> DataFrame:
    orders, root = base(spark, sf), work_path(spark, "merged")
    V.write_version(target_of(orders), root)
    V.write_version(U.merge(V.read_current(spark, root), source_of(orders), ["o_orderkey"]), root)
    return V.read_current(spark, root)


@query(
    "U1_merge_partitions",
    f"""WITH t AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0),
    s AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
    SELECT coalesce(s.month, t.month) AS month, coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey""",
)
def merge_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by month; the months of 2001 arrive again and only their partitions are rewritten."""
    path = work_path(spark, "monthly")
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", "o_orderstatus", "o_orderdate"
    )
    V.overwrite_partitions(target_of(rows).drop("o_orderdate"), path, ["month"])
    late = rows.filter(
        F.col("o_orderdate") >= F.expr("timestamp_ntz '2001-01-01'")
    ).withColumn("o_orderstatus", F.lit("X")).drop("o_orderdate")
    V.merge_partitions(spark, path, late, ["month", "o_orderkey"], "month")
    return spark.read.schema("o_orderkey bigint, o_orderstatus string, month string").parquet(path)


@query(
    "U2_snapshot_merge",
    f"""{NEW_STATE} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
        s.o_orderkey IS NULL AS deleted, CASE WHEN s.o_orderkey IS NULL AND t.o_orderkey % 4 = 0 THEN '2024-01-01 00:00:00' ELSE '{AT}' END AS modified
    FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey""",
)
def snapshot_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Rows divisible by 4 were already marked deleted earlier: they keep their stamp or reappear."""
    orders = base(spark, sf)
    old = target_of(orders).withColumns(
        {U.MODIFIED: F.to_timestamp(F.lit("2024-01-01 00:00:00")), U.DELETED: F.col("o_orderkey") % 4 == 0}
    )
    out = U.merge_snapshot(old, source_of(orders), ["o_orderkey"], stamp())
    return out.select(
        "o_orderkey", "o_orderstatus", U.DELETED, F.date_format(U.MODIFIED, "yyyy-MM-dd HH:mm:ss").alias("modified")
    )


@query(
    "U3_insert_only",
    f"""{NEW_STATE} SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""",
)
def insert_only(spark: SparkSession, sf: str) -> DataFrame:
    orders = base(spark, sf)
    return U.insert_only(target_of(orders), source_of(orders), ["o_orderkey"])


@query(
    "U4_partial_update",
    f"""{NEW_STATE} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
        coalesce(t.o_totalprice, s.o_totalprice) AS o_totalprice FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey""",
)
def partial_update(spark: SparkSession, sf: str) -> DataFrame:
    orders = base(spark, sf)
    return U.merge(target_of(orders), source_of(orders), ["o_orderkey"], update=["o_orderstatus"])


@query(
    "U5_watermark_reload",
    """WITH g AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'),
    s AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-18'), w AS (SELECT least((SELECT min(d) FROM s), (SELECT max(d) FROM g)) AS w)
    SELECT strftime(d, '%Y-%m-%d') AS day, count(*) AS n FROM (SELECT * FROM g WHERE d < (SELECT w FROM w) UNION ALL SELECT * FROM s WHERE d >= (SELECT w FROM w)) GROUP BY 1""",
)
def watermark_reload(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("d"))
    gold = events.filter(F.col("d") <= F.lit("2024-01-20").cast("date"))
    silver = events.filter(F.col("d") >= F.lit("2024-01-18").cast("date"))
    out = U.reload_from_watermark(gold, silver, "d")
    return out.groupBy(F.col("d").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "U6_replace_periods",
    """SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) * CASE WHEN year(o_orderdate) = 2000 THEN 2 ELSE 1 END AS n FROM orders GROUP BY strftime(o_orderdate, '%Y-%m'), year(o_orderdate)""",
)
def replace_periods(spark: SparkSession, sf: str) -> DataFrame:
    """The year 2000 is delivered again, twice as long; only its partitions are rewritten."""
    path = work_path(spark, "periods")
    rows = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"))
    V.overwrite_partitions(rows, path, ["period"])
    again = rows.filter(F.col("period").startswith("2000"))
    V.overwrite_partitions(again.unionByName(again), path, ["period"])
    stored = spark.read.schema("o_orderkey bigint, period string").parquet(path)
    return stored.groupBy("period").agg(F.count(F.lit(1)).alias("n"))


@query(
    "U6_replace_periods_frame",
    "SELECT strftime(o_orderdate, '%Y') AS period, count(*) FILTER (year(o_orderdate) <> 2000 OR o_orderstatus = 'F') AS n FROM orders GROUP BY 1",
)
def replace_periods_frame(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("period"))
    again = rows.filter((F.col("period") == "2000") & (F.col("o_orderstatus") == "F"))
    return U.replace_periods(rows, again, "period").groupBy("period").agg(F.count(F.lit(1)).alias("n"))


@query(
    "U7_snapshot_history",
    """SELECT d AS day, replace(d, '-', '') || '_' || s_suppkey AS date_id, s_acctbal FROM supplier, (VALUES ('2024-01-29'), ('2024-01-30')) v(d)""",
)
def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    yesterday, today = (F.to_date(F.lit(d)) for d in ("2024-01-29", "2024-01-30"))
    empty = U.add_snapshot(
        suppliers.limit(0).withColumns(
            {"Snapshot_Date": today, "date_id": F.lit("")}
        ), suppliers, yesterday, {"date_id": "s_suppkey"}
    )
    history = U.add_snapshot(empty, suppliers.withColumn("s_acctbal", F.lit(0.0)), today, {"date_id": "s_suppkey"})
    history = U.add_snapshot(history, suppliers, today, {"date_id": "s_suppkey"})  # replaces today's first snapshot
    return history.select(F.col("Snapshot_Date").cast("string").alias("day"), "date_id", "s_acctbal")


@query(
    "U8_append_stamped",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '{AT[:10]}' END AS transfer_day FROM orders""",
)
def append_stamped(spark: SparkSession, sf: str) -> DataFrame:
    orders = base(spark, sf).select("o_orderkey")
    out = U.append_stamped(target_of(orders), orders.filter(F.col("o_orderkey") % 5 == 0), stamp())
    return out.select("o_orderkey", F.col("TransferDate").cast("string").alias("transfer_day"))


def change_rows(orders: DataFrame) -> DataFrame:
    """Two change sets: updates (and inserts) first, then deletes that win over them."""
    key = F.col("o_orderkey")
    first = orders.filter((key % 5 == 0) | (key % 7 == 0)).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice", F.lit(1).cast("bigint").alias("seq"), F.lit(U.UPDATE).alias(U.MARKER)
    )
    second = orders.filter(key % 11 == 0).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.lit(2).cast("bigint").alias("seq"), F.lit(U.DELETE).alias(U.MARKER)
    )
    return first.unionByName(second)


@query(
    "U9_apply_changes",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders WHERE o_orderkey % 11 <> 0""",
)
def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change files written in sequence, read back and applied: the last change per key wins."""
    orders = base(spark, sf)
    folder = K.create_landing_table(spark, work_path(spark, "landing"), "sales", "orders", ["o_orderkey"])
    changes = change_rows(orders)
    for seq in (1, 2):
        K.write_change_files(changes.filter(F.col("seq") == seq).drop("seq"), folder)
    rows = K.read_change_files(spark, folder)
    return U.apply_changes(target_of(orders), rows, K.key_columns(spark, folder), ["_file", "_place"])


@query(
    "U10_row_marker",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS marker, CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS soft,
        count(*) AS n FROM orders GROUP BY 1, 2""",
)
def row_marker(spark: SparkSession, sf: str) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "F", "I").when(F.col("o_orderstatus") == "O", "U").otherwise("D")
    marker, soft = U.row_marker(code), U.row_marker(code, soft_delete=True)
    return table(spark, sf, "orders").groupBy(
        marker.alias("marker"), soft.alias("soft")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "U11_extracts",
    """SELECT 'full' AS extract, 0 AS marker, count(*) AS n FROM orders UNION ALL SELECT 'increment', 1, count(*) FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)""",
)
def extracts(spark: SparkSession, sf: str) -> DataFrame:
    orders = base(spark, sf)
    mark = orders.agg((F.max("o_orderkey") / 2).cast("bigint")).first()[0]  # one number: the stored high-water mark
    full = U.changes_since(orders, "o_orderkey", None).withColumn("extract", F.lit("full"))
    increment = U.changes_since(orders, "o_orderkey", mark).withColumn("extract", F.lit("increment"))
    return full.unionByName(increment).groupBy(
        "extract", F.col(U.MARKER).alias("marker")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "U12_second_destination",
    f"""{NEW_STATE} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
        coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey""",
)
def second_destination(spark: SparkSession, sf: str) -> DataFrame:
    """Source rows streamed into a second table: batches are logged and merged on reading."""
    orders, path, root = base(spark, sf), work_path(spark, "arriving"), work_path(spark, "second")
    X.save_state(X.change_state(target_of(orders), ["o_orderkey"]), root, -1)
    checkpoint, news = work_path(spark, "checkpoint"), source_of(orders)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    for part in (news.filter(F.col("o_orderstatus") == "X"), news.filter(F.col("o_orderstatus") != "X")):
        part.write.mode("append").parquet(path)
        stream = X.drop_stream(spark, path, "parquet", schema, "*.parquet")
        X.run_available(stream, checkpoint, X.upsert_batches(root, ["o_orderkey"], orders.columns))
    return X.visible(X.logged_state(spark, root, ["o_orderkey"]))


@query(
    "U13_not_recorded",
    "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE (l_partkey, l_suppkey) NOT IN (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')",
)
def not_recorded(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    recorded = pairs.filter(F.col("l_returnflag") == "A")
    wanted = pairs.select("l_partkey", "l_suppkey").distinct()
    return U.not_recorded(wanted, recorded, ["l_partkey", "l_suppkey"])


@query(
    "U14_skip_saturated",
    "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) >= 30)",
)
def skip_saturated(spark: SparkSession, sf: str) -> DataFrame:
    recorded = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return U.skip_saturated(table(spark, sf, "part").select("p_partkey"), recorded, ["p_partkey"], 30)


@query(
    "U9_incremental_aggregates",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
        CAST(min(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS least, CAST(max(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS most
    FROM (SELECT CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
        FROM orders WHERE o_orderkey % 11 <> 0) GROUP BY 1""",
)
def incremental_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregates of the old orders, brought up to date by each of two change sets in turn."""
    orders = base(spark, sf).withColumn("price", money("o_totalprice"))
    kept = I.Kept(["o_orderstatus"], ["price"], ["price"])
    now = target_of(orders)
    state = I.build(kept, now)
    changes = change_rows(orders).withColumn("price", money("o_totalprice"))
    for seq in (1, 2):
        batch = changes.filter(F.col("seq") == seq)
        signed = I.signed_rows(now, batch, ["o_orderkey"], ["seq"])
        now = stored(U.apply_changes(now, batch, ["o_orderkey"], ["seq"]), "orders-now")
        state = stored(I.refresh(kept, state, signed, now), "orders-aggregates")
    return I.plain(kept, state).select(
        "o_orderstatus", "n", as_double(F.col("sum_price")).alias("total"), as_double(F.col("min_price")).alias("least"), as_double(F.col("max_price")).alias("most")
    )

"""The measure models of the catalogue (MA keys) on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.money import money, net_price
from tidegauge.functions.times import floor_minutes
from tidegauge.models import activity, capacity, inventory, metadata, requests
from tidegauge.plans.aggregations import PERIODS_AS_OF
from tidegauge.plans.tpch import NET
from tidegauge.registry import query
from tidegauge.session import table

NOW = f"DATE '{PERIODS_AS_OF}'"
FLAGS = {
    "CM": f"date_trunc('month', d) = date_trunc('month', {NOW})",
    "PM": f"date_trunc('month', d) = date_trunc('month', {NOW} - INTERVAL 1 MONTH)",
    "CY": f"year(d) = year({NOW})",
    "PY": f"year(d) = year({NOW}) - 1",
    **{f"{n}d": f"d BETWEEN {NOW} - {n} AND {NOW}" for n in (7, 14, 30, 90)},
}


def activities(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderstatus",
        F.to_date("o_orderdate").alias("CreationDate"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("UserId"),
        F.when(kind == "1-URGENT", activity.VIEW).when(
            kind == "2-HIGH", activity.REFRESH
        ).otherwise(kind).alias("Activity"),
        (F.col("o_orderkey") % 500).alias("ReportId"),
        (F.col("o_orderkey") % 20).alias("ItemId"),
    )


ACT = """a AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_custkey % 50 = 0 THEN -1 ELSE o_custkey END AS u, o_orderpriority = '1-URGENT' AS v,
    o_orderpriority = '2-HIGH' AS rf, o_orderkey % 500 AS r, o_orderkey % 20 AS i FROM orders)"""


@query(
    "MA_activity",
    f"""WITH {ACT} SELECT o_orderstatus, count(*) AS "Activities", count(*) FILTER (v) AS "Viewed", count(DISTINCT u) AS "Users", count(DISTINCT r) FILTER (v) AS "ViewedReports",
        {", ".join(f'count(*) FILTER ({FLAGS[n]}) AS "Activities_{n}", count(DISTINCT u) FILTER ({FLAGS[n]}) AS "Users_{n}"' for n in activity.WINDOWS)},
        {", ".join(f'count(DISTINCT r) FILTER (v AND {FLAGS[n]}) AS "ViewedReports_{n}"' for n in ("14d", "30d"))} FROM a GROUP BY 1""",
)
def activity_measures(spark: SparkSession, sf: str) -> DataFrame:
    return activity.measures(activities(spark, sf), ["o_orderstatus"], PERIODS_AS_OF)


@query(
    "MA_activity_growth",
    f"""WITH {ACT}, m AS (SELECT date_trunc('month', d) AS m, count(*) AS n, count(DISTINCT u) AS u FROM a GROUP BY 1)
    SELECT strftime(c.m, '%Y-%m') AS mon, c.n AS "Activities", c.u AS "Users", (c.n - p.n) / p.n AS "ActivitiesGrowth", (c.u - p.u) / p.u AS "UsersGrowth" FROM m c LEFT JOIN m p ON p.m + INTERVAL 1 MONTH = c.m""",
)
def activity_growth(spark: SparkSession, sf: str) -> DataFrame:
    out = activity.monthly_growth(activities(spark, sf), [])
    return out.withColumn("mon", F.date_format("Month", "yyyy-MM")).drop("Month")


@query(
    "MA_activity_item_day",
    f"""WITH {ACT}, x AS (SELECT o_orderstatus, i, d, nullif(count(*) FILTER (v), 0) AS v, nullif(count(*) FILTER (rf), 0) AS r FROM a GROUP BY 1, 2, 3)
    SELECT o_orderstatus, {", ".join(f'CAST(sum({c}) AS DOUBLE) / count({c}) AS "Avg{n}", CAST(sum({c}) FILTER ({FLAGS["90d"]}) AS DOUBLE) / nullif(count({c}) FILTER ({FLAGS["90d"]}), 0) AS "Avg{n}_90d"' for c, n in (("v", "Views"), ("r", "Refreshes")))} FROM x GROUP BY 1""",
)
def activity_item_day(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {"Views": activity.VIEW, "Refreshes": activity.REFRESH}
    return activity.item_day_averages(activities(spark, sf), ["o_orderstatus"], "ItemId", PERIODS_AS_OF, kinds)


def item_days(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as item × operation × day rows: supplier = item, nation of the supplier = capacity."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.select(
        F.col("s_nationkey").alias("CapacityId"),
        F.col("l_suppkey").alias("ItemId"),
        F.col("l_returnflag").alias("Operation"),
        F.to_date("l_shipdate").alias("Date"),
        net_price().alias("TotalCUs"),
        F.col("l_quantity").cast("bigint").alias("DurationInSec"),
        F.lit(1).alias("OperationCount"),
        (F.col("l_linestatus") == "F").cast("int").alias("FailureOperationCount"),
        F.col("l_linenumber").alias("ThrottlingInMin"),
    )


LINES = f"x AS (SELECT s_nationkey AS cap, l_suppkey AS item, l_returnflag AS op, CAST(l_shipdate AS DATE) AS d, {NET} AS cu, CAST(l_quantity AS BIGINT) AS q, l_linestatus AS st, l_linenumber AS ln FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"


@query(
    "MA_capacity_totals",
    f"""WITH {LINES} SELECT op AS "Operation", CAST(sum(cu) AS DOUBLE) AS "TotalCUs", CAST(sum(q) AS BIGINT) AS "DurationInSec", count(*) AS "OperationCount", count(*) FILTER (st = 'F') AS "FailureOperationCount",
        CAST(sum(ln) AS BIGINT) AS "TotalThrottling", max(ln) AS "MaxThrottling" FROM x GROUP BY 1""",
)
def capacity_totals(spark: SparkSession, sf: str) -> DataFrame:
    return capacity.totals(item_days(spark, sf), ["Operation"]).withColumn("TotalCUs", F.col("TotalCUs").cast("double"))


@query(
    "MA_capacity_item_day",
    f"""WITH {LINES}, s AS (SELECT op, item, d, sum(cu) AS cu FROM x GROUP BY 1, 2, 3), m AS (SELECT op AS "Operation", CAST(sum(cu) AS DOUBLE) / count(*) AS "AvgCU", CAST(max(cu) AS DOUBLE) AS "MaxCU",
        {", ".join(f'CAST(sum(cu) FILTER ({FLAGS[n]}) AS DOUBLE) / count(*) FILTER ({FLAGS[n]}) AS "AvgCU_{n}", CAST(max(cu) FILTER ({FLAGS[n]}) AS DOUBLE) AS "MaxCU_{n}"' for n in capacity.WINDOWS)} FROM s GROUP BY 1)
    SELECT *, ("AvgCU_14d" - "AvgCU_30d") / "AvgCU_30d" AS "AvgCU_14d_vs_30d" FROM m""",
)
def capacity_item_day(spark: SparkSession, sf: str) -> DataFrame:
    return capacity.item_day(item_days(spark, sf), ["Operation"], PERIODS_AS_OF)


@query(
    "MA_capacity_against",
    f"""WITH {LINES}, s AS (SELECT cap, item, d, sum(cu) AS cu FROM x GROUP BY 1, 2, 3), c AS (SELECT cap, CAST(sum(cu) AS DOUBLE) / count(*) AS a FROM s WHERE {FLAGS["90d"]} GROUP BY 1),
    i AS (SELECT cap, item, CAST(sum(cu) FILTER ({FLAGS["7d"]}) AS DOUBLE) / nullif(count(*) FILTER ({FLAGS["7d"]}), 0) AS a FROM s GROUP BY 1, 2)
    SELECT i.cap AS "CapacityId", i.item AS "ItemId", i.a AS "AvgCU_7d", c.a AS "CapacityAvg_90d", i.a - c.a AS "Difference", (i.a - c.a) / c.a AS "DifferenceShare", coalesce(i.a - c.a > 0, false) AS "IsAbove" FROM i LEFT JOIN c ON c.cap = i.cap""",
)
def capacity_against(spark: SparkSession, sf: str) -> DataFrame:
    return capacity.against_capacity(item_days(spark, sf), "CapacityId", "ItemId", PERIODS_AS_OF)


@query(
    "MA_capacity_kind_day",
    f"""WITH {LINES} SELECT op AS "Operation", CAST(sum(cu) AS DOUBLE) AS "TotalCUs", CAST(sum(cu) AS DOUBLE) / count(*) AS "AvgCUs", CAST(sum(q) AS DOUBLE) / count(*) / 60 AS "AvgDurationMin", CAST(sum(q) AS DOUBLE) / 60 AS "TotalDurationMin",
        {", ".join(f'CAST(sum(cu) FILTER ({FLAGS[n]}) AS DOUBLE) AS "TotalCUs_{n}"' for n in ("CM", "PM", "CY", "PY", "14d", "30d"))} FROM x GROUP BY 1""",
)
def capacity_kind_day(spark: SparkSession, sf: str) -> DataFrame:
    return capacity.kind_day(item_days(spark, sf), ["Operation"], PERIODS_AS_OF)


@query(
    "MA_capacity_growth",
    f"""WITH {LINES}, m AS (SELECT op, date_trunc('month', d) AS m, CAST(sum(cu) AS DOUBLE) AS v FROM x GROUP BY 1, 2)
    SELECT c.op AS "Operation", strftime(c.m, '%Y-%m') AS mon, c.v AS "CUs", (c.v - p.v) / p.v AS "Growth" FROM m c LEFT JOIN m p ON p.op = c.op AND p.m + INTERVAL 1 MONTH = c.m""",
)
def capacity_growth(spark: SparkSession, sf: str) -> DataFrame:
    out = capacity.cu_growth(item_days(spark, sf), ["Operation"])
    return out.withColumn("mon", F.date_format("Month", "yyyy-MM")).drop("Month")


@query(
    "MA_capacity_outliers",
    f"""WITH {LINES}, s AS (SELECT item, d, sum(cu) AS cu FROM x GROUP BY 1, 2),
    w AS (SELECT item, d, CAST(cu AS DOUBLE) AS cu, CAST(sum(cu) OVER (PARTITION BY item) AS DOUBLE) AS a, count(*) OVER (PARTITION BY item) AS n FROM s)
    SELECT item AS "ItemId", strftime(d, '%Y-%m-%d') AS day, cu AS "CU", a AS "AnyDay", a / n AS "AvgDay", cu - a / n AS "VsAvg", (cu - a / n - a / n) / (a / n) AS "OutlierFactor" FROM w""",
)
def capacity_outliers(spark: SparkSession, sf: str) -> DataFrame:
    out = capacity.outliers(item_days(spark, sf), ["ItemId"])
    return out.withColumn("day", F.col("Date").cast("string")).drop("Date")


@query(
    "MA_capacity_trend",
    f"""WITH {LINES}, s AS (SELECT op, item, d, sum(cu) AS cu FROM x GROUP BY 1, 2, 3), y AS (SELECT op, d, sum(cu) AS t, count(*) AS n FROM s GROUP BY 1, 2),
    z AS (SELECT op, d, CAST(t AS DOUBLE) / n AS a, CAST(sum(t) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE) AS trend FROM y WINDOW w AS (PARTITION BY op ORDER BY d RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW))
    SELECT op AS "Operation", strftime(d, '%Y-%m-%d') AS day, a AS "AvgCU", trend AS "Trend", (trend - a) / trend AS "TrendDifference" FROM z""",
)
def capacity_trend(spark: SparkSession, sf: str) -> DataFrame:
    out = capacity.trend(item_days(spark, sf), ["Operation"])
    return out.withColumn("day", F.col("Date").cast("string")).drop("Date")


@query(
    "MA_timepoint_totals",
    """SELECT event_type, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS "TotalCUUsagePercentage", CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS "TotalCUs",
        CAST(sum(user_id) AS DOUBLE) AS "SKUCUByTimePoint" FROM events GROUP BY 1""",
)
def timepoint_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_type",
        money("value").alias("TotalCUUsagePercentage"),
        money("value").alias("TotalCUs"),
        F.col("user_id").alias("SKUCUByTimePoint"),
    )
    return capacity.timepoint_totals(rows, ["event_type"])


@query(
    "MA_dictionary_sizes",
    """SELECT l_suppkey, sum(l_partkey) FILTER (l_returnflag <> 'N') / 1024 AS "DictionarySize", sum(l_quantity) / count(*) AS "AvgTemperature" FROM lineitem GROUP BY 1""",
)
def dictionary_sizes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_returnflag") != "N", "BASIC_DATA").otherwise("ROWNUMBER").alias("COLUMN_TYPE"),
        F.col("l_partkey").alias("DICTIONARY_SIZE"),
        F.col("l_quantity").alias("DICTIONARY_TEMPERATURE"),
    )
    return metadata.dictionary_sizes(rows, ["l_suppkey"], "kilobytes")


POINTS = "p AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS t, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS u, sum(CAST(value AS DECIMAL(12,2))) AS cu, sum(user_id) AS sku, max(user_id) AS top, count(*) FILTER (value > 1) AS th FROM events GROUP BY 1, 2)"


@query(
    "MA_timepoints",
    f"""WITH {POINTS} SELECT event_type, CAST(sum(cu) AS DOUBLE) / count(*) AS "AvgUsage", CAST(max(cu) AS DOUBLE) AS "MaxUsage", CAST(sum(th) AS BIGINT) AS "ThrottlingCount", CAST(sum(cu) AS DOUBLE) / CAST(sum(sku) AS DOUBLE) AS "UsedShare",
        CAST(max(top) AS DOUBLE) / 30 AS "TimePointSKU", {", ".join(f'''CAST(sum(cu) FILTER (CAST(t AS DATE) >= DATE '2024-01-30' - {n}) AS DOUBLE) / CAST(sum(sku) FILTER (CAST(t AS DATE) >= DATE '2024-01-30' - {n}) AS DOUBLE) AS "UsedShare_{n}d"''' for n in (14, 30, 60, 90))} FROM p GROUP BY 1""",
)
def timepoints(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_type",
        floor_minutes(F.col("ts"), 5).alias("TimePoint"),
        money("value").alias("TotalCUUsagePercentage"),
        money("value").alias("InteractiveDelayPercentage"),
        money("value").alias("TotalCUs"),
        F.col("user_id").alias("SKUCUByTimePoint"),
    )
    return capacity.timepoints(rows, ["event_type"], "2024-01-30")


@query(
    "MA_item_counts",
    f"""SELECT p_brand, count(*) FILTER (NOT p_size % 5 = 0) AS "Items", {", ".join(f"count(*) FILTER (NOT p_size % 5 = 0 AND p_type = '{t}') AS n_{t}" for t in ("PROMO", "SMALL"))} FROM part GROUP BY 1""",
)
def item_counts(spark: SparkSession, sf: str) -> DataFrame:
    deleted = F.when(F.col("p_size") % 5 == 0, True).when(F.col("p_size") % 5 == 1, False)
    items = table(spark, sf, "part").select(
        "p_brand", F.col("p_partkey").alias("id"), F.col("p_type").alias("type"), deleted.alias("deleted")
    )
    return inventory.item_counts(items, ["p_brand"], ["PROMO", "SMALL"])


@query(
    "MA_settings",
    """WITH s AS (SELECT o_orderstatus AS st, CAST(o_orderdate AS DATE) AS t, o_orderkey % 3 = 0 AS e FROM orders), l AS (SELECT max(t) AS m FROM s)
    SELECT st, count(*) FILTER (e) AS "Enabled", count(*) FILTER (NOT e) AS "Disabled", count(*) FILTER (e AND t = m) AS "LastEnabled", count(*) FILTER (NOT e AND t = m) AS "LastDisabled", count(*) FILTER (e) AS "Value",
        count(DISTINCT t) AS "Snapshots" FROM s, l GROUP BY 1""",
)
def settings(spark: SparkSession, sf: str) -> DataFrame:
    third = F.col("o_orderkey") % 3
    rows = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("st"), F.to_date("o_orderdate").alias("TransferDateTime"), F.when(third == 0, True).when(third == 1, False).alias("enabled")
    )
    return inventory.settings(rows, ["st"])


@query(
    "MA_accesses",
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS "Accesses", count(DISTINCT l_partkey) FILTER (l_returnflag = 'A') AS "Accesses_User", count(DISTINCT l_partkey) FILTER (l_returnflag = 'N') AS "Accesses_App",
        count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS "Accesses_Group" FROM lineitem GROUP BY 1""",
)
def accesses(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "User").when(flag == "N", "App").otherwise("Group")
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", F.col("l_partkey").alias("GraphId"), kind.alias("PrincipalType")
    )
    return inventory.accesses(rows, ["l_suppkey"])


@query(
    "MA_refreshables",
    """SELECT count(*) AS "RefreshableItems", CAST(sum(s) AS BIGINT) AS "Scheduled", CAST(sum(s) FILTER (p_size > 10) AS BIGINT) AS "Enabled", CAST(sum(s) FILTER (p_size <= 10) AS BIGINT) AS "Disabled",
        CAST(sum(p_size) AS BIGINT) AS "Refreshes", CAST(sum(p_size) AS DOUBLE) / count(*) / 60 AS "AvgMinutes", quantile_cont(CAST(p_size AS DOUBLE), 0.5) / 60 AS "MedianMinutes", CAST(min(p_partkey) AS BIGINT) AS "ConsiderationStart",
        CAST(min(p_partkey) + 1 AS BIGINT) AS "ConsiderationEnd", CAST(sum(p_size) AS DOUBLE) / 86400 AS "ConsideredDays", CAST(sum(p_size) AS DOUBLE) / 60 AS "Minutes", CAST(sum(p_size) AS DOUBLE) / count(*) / 60 AS "AvgMinutesDet"
    FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 4 ELSE 2 END AS s FROM part)""",
)
def refreshables(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    days = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("Mon"), F.lit("Fri"))).otherwise(F.array(F.lit("Mon")))
    items = part.select(
        days.alias("days"),
        F.array(F.lit("06:00"), F.lit("18:00")).alias("times"),
        (F.col("p_size") > 10).alias("IsRefreshEnabled"),
    )
    summaries = part.select(
        F.col("p_size").alias("RefreshCount"),
        F.col("p_size").alias("RefreshAverageDuration"),
        F.col("p_size").alias("RefreshMedianDuration"),
        F.col("p_size").alias("ConsiderationDurationSeconds"),
        F.col("p_partkey").alias("ConsideredStartTime"),
        (F.col("p_partkey") + 1).alias("ConsideredEndTime"),
    )
    return inventory.refreshables(items, summaries, part.select(F.col("p_size").alias("DurationInSeconds")))


SEVERITY = "CASE l_returnflag WHEN 'A' THEN 'Error' WHEN 'N' THEN 'Warning' ELSE 'Info' END"
IMPACT = "CASE WHEN l_linenumber % 3 = 0 THEN 'Background' WHEN l_linenumber % 3 = 1 THEN 'Query' ELSE 'Usability' END"
CASES = {
    **{f"n_{s}": f"sev = '{s}'" for s in ("Error", "Warning", "Info")},
    **{f"n_{i}": f"imp = '{i}'" for i in ("Background", "Query", "Usability")},
}


@query(
    "MA_analyzer_runs",
    f"""WITH v AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, {SEVERITY} AS sev, {IMPACT} AS imp FROM lineitem), l AS (SELECT l_suppkey AS k, max(d) AS m FROM v GROUP BY 1)
    SELECT l_suppkey, count(*) AS "Violations", strftime(max(m), '%Y-%m-%d') AS "LastRun", {", ".join(f'count(*) FILTER ({c}) AS "{n}", count(*) FILTER ({c} AND d = m) AS "{n}_last"' for n, c in CASES.items())} FROM v JOIN l ON k = l_suppkey GROUP BY 1""",
)
def analyzer_runs(spark: SparkSession, sf: str) -> DataFrame:
    flag, third = F.col("l_returnflag"), F.col("l_linenumber") % 3
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("RunId"),
        F.when(flag == "A", "Error").when(flag == "N", "Warning").otherwise("Info").alias("severity"),
        F.when(
            third == 0, "Background Operation"
        ).when(third == 1, "Query Operation").otherwise("Usability").alias("impact"),
    )
    return inventory.analyzer_runs(rows, ["l_suppkey"])


@query(
    "MA_table_sizes",
    """SELECT lang, sum(n_chars) / 1024 AS "DataSize", sum(n_chars * 2) / 1024 AS "TotalSize", CAST(sum(n_chars) AS BIGINT) AS "UserHierarchySize", count(*) AS "Rows" FROM documents GROUP BY 1""",
)
def table_sizes(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    rows = table(spark, sf, "documents").select(
        "lang", n.alias("DataSize"), (n * 2).alias("TotalSize"), n.alias("UserHierarchySize"), F.lit(1).alias("Rows")
    )
    return inventory.table_sizes(rows, ["lang"], "kilobytes")


@query(
    "MA_request_history",
    """SELECT o_orderpriority, count(*) AS "Runs", CAST(sum(o_custkey) AS BIGINT) AS "RowCount", CAST(sum(o_custkey % 2) AS BIGINT) AS "CacheHits", CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) AS "SuccessRate",
        sum(o_orderkey) / 1000 AS "TotalElapsed", max(o_orderkey) / 1000 AS "MaxElapsed", sum(o_custkey) / 1000 AS "AllocatedCpu", max(o_custkey) AS "MaxAllocatedCpu", sum(o_orderkey) / 1 AS "DiskScanned", sum(o_custkey) / 1 AS "RemoteScanned",
        strftime(max(o_orderdate), '%Y-%m-%d') AS "LastTimestamp" FROM orders GROUP BY 1""",
)
def request_history(spark: SparkSession, sf: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf, "orders").select(
        "o_orderpriority",
        cust.alias("row_count"),
        (cust % 2).alias("result_cache_hit"),
        F.when(F.col("o_orderstatus") == "F", "Succeeded").otherwise("Failed").alias("status"),
        key.alias("total_elapsed_time_ms"),
        cust.alias("allocated_cpu_time_ms"),
        key.alias("data_scanned_disk_mb"),
        cust.alias("data_scanned_remote_storage_mb"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("end_time"),
    )
    return requests.request_history(rows, ["o_orderpriority"])


@query(
    "MA_gateway_queries",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS "Requests", count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS "FailedRequests", count(DISTINCT l_partkey) AS "QueryTrackings",
        CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 1000 AS "ExecutionDuration", sum(l_linenumber) / 1048576 AS "SpoolSize", count(DISTINCT l_orderkey) FILTER (l_returnflag = 'A') / count(DISTINCT l_orderkey) AS "SuccessRatio" FROM lineitem GROUP BY 1""",
)
def gateway_queries(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.col("l_orderkey").alias("RequestId"),
        F.col("l_partkey").alias("QueryTrackingId"),
        F.when(flag == "A", "Y").when(flag == "R", "N").alias("Success"),
        F.col("l_quantity").cast("bigint").alias("QueryExecutionDurationMs"),
        F.col("l_linenumber").alias("SpoolingTotalDataSizeByte"),
    )
    return requests.gateway_queries(rows, ["l_suppkey"])


@query(
    "MA_gateway_counters",
    """SELECT l_suppkey, CAST(sum(l_linenumber) FILTER (l_returnflag = 'A') AS DOUBLE) / count(*) FILTER (l_returnflag = 'A') / 100 AS "SystemCPUPercent",
        CAST(sum(l_linenumber) FILTER (l_returnflag = 'N') AS DOUBLE) / count(*) FILTER (l_returnflag = 'N') / 400 AS "GatewayCPUPercent", CAST(sum(l_linenumber) FILTER (l_returnflag = 'R') AS DOUBLE) / count(*) FILTER (l_returnflag = 'R') / 1024 AS "GatewayMEMKb"
    FROM lineitem GROUP BY 1""",
)
def gateway_counters(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    name = F.when(flag == "A", "SystemCPUPercent").when(flag == "N", "GatewayCPUPercent").otherwise("GatewayMEMKb")
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", name.alias("CounterName"), F.col("l_linenumber").alias("Average")
    )
    wanted = {n: requests.COUNTERS[n] for n in ("SystemCPUPercent", "GatewayCPUPercent", "GatewayMEMKb")}
    return requests.gateway_counters(rows, ["l_suppkey"], cores=4, kb_per_unit=1024, counters=wanted)


@query(
    "MA_evaluations",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, CAST(sum(l_partkey) AS DOUBLE) / count(*) / 1048576 AS "AvgCommit", max(l_partkey) / 1048576 AS "MaxCommit", CAST(sum(l_suppkey) AS DOUBLE) / count(*) / 1048576 AS "AvgWorkingSet",
        CAST(sum(l_suppkey) AS DOUBLE) / count(*) / 1048576 AS "MaxWorkingSet", sum(l_linenumber) / 1000 AS "ProcessorTime", CAST(sum(l_linenumber) AS BIGINT) AS "Rows", count(DISTINCT l_partkey) AS "QueryTrackings" FROM lineitem GROUP BY 1""",
)
def evaluations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.col("l_partkey").alias("AverageCommitByte"),
        F.col("l_partkey").alias("MaxCommitByte"),
        F.col("l_suppkey").alias("AverageWorkingSetByte"),
        F.col("l_suppkey").alias("MaxWorkingSetByte"),
        F.col("l_linenumber").alias("TotalProcessorTimeMs"),
        F.col("l_linenumber").alias("TotalRows"),
        F.col("l_partkey").alias("QueryTrackingId"),
    )
    return requests.evaluations(rows, "day")


@query(
    "MA_model_health",
    """WITH h AS (SELECT p_brand, CASE WHEN count(*) FILTER (p_size = 50 AND p_type = 'PROMO') > 0 THEN 'Faulty' ELSE 'Healthy' END AS c, CASE WHEN count(*) FILTER (p_size = 49) > 0 THEN 'Faulty' ELSE 'Healthy' END AS p FROM part GROUP BY 1)
    SELECT p_brand, c AS "ColumnsHealthy", p AS "PartitionsHealthy", CASE WHEN c = 'Healthy' AND p = 'Healthy' THEN 'Healthy' ELSE 'Faulty' END AS "ModelHealthy" FROM h""",
)
def model_health(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    broken = (F.col("p_size") == 50) & (F.col("p_type") == "PROMO")
    columns = part.select("p_brand", F.when(broken, "bad").alias("error"), F.lit("Ready").alias("state"))
    partitions = part.select(
        "p_brand",
        F.lit(None).cast("string").alias("error"),
        F.when(F.col("p_size") == 49, "NoData").otherwise("Ready").alias("state"),
    )
    return metadata.health({"Columns": columns, "Partitions": partitions}, ["p_brand"])


@query(
    "MA_documented",
    """SELECT p_type, count(*) AS "Objects", CAST(count(*) FILTER (p_size > 30) AS DOUBLE) / count(*) AS "DocumentedShare" FROM part GROUP BY 1""",
)
def documented(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_size") > 30, F.col("p_name")).when(F.col("p_size") > 10, "")
    return metadata.documented(table(spark, sf, "part").select("p_type", text.alias("description")), ["p_type"])


@query(
    "MA_dependencies",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS "Objects", count(DISTINCT l_suppkey) AS "Referenced" FROM lineitem GROUP BY 1""",
)
def dependencies(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_partkey").alias("OBJECT"), F.col("l_suppkey").alias("REFERENCED_OBJECT")
    )
    return metadata.dependencies(rows, ["l_returnflag"])


def partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a supplier as partitions by line number, with rows and bytes."""
    return table(spark, sf, "lineitem").groupBy("l_suppkey", F.col("l_linenumber").alias("idx")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_partkey").alias("bytes")
    )


PARTS = "p AS (SELECT l_suppkey, l_linenumber AS idx, count(*) AS n, sum(l_partkey) AS b FROM lineitem GROUP BY 1, 2)"


@query(
    "MA_partition_statistics",
    f"""WITH {PARTS} SELECT l_suppkey, CAST(sum(n) AS DOUBLE) / count(*) AS "AvgRows", min(n) AS "MinRows", max(n) AS "MaxRows", sum(b) / 1024 AS "SumSize", CAST(sum(b) AS DOUBLE) / count(*) / 1024 AS "AvgSize", median(n) AS "MedianRows" FROM p GROUP BY 1""",
)
def partition_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.partition_statistics(partitions(spark, sf), ["l_suppkey"], "kilobytes")


@query(
    "MA_partition_series",
    f"""WITH {PARTS}, a AS (SELECT l_suppkey, floor(CAST(sum(n) AS DOUBLE) / count(*) + 0.5) AS r, floor(CAST(sum(b) AS DOUBLE) / count(*) + 0.5) AS b FROM p GROUP BY 1)
    SELECT a.l_suppkey, CAST(v AS INTEGER) AS value, CASE WHEN p.idx IS NULL THEN 'Simulation' ELSE 'Current' END AS version, a.r * v AS running_rows, a.b * v AS running_bytes
    FROM a CROSS JOIN (SELECT unnest(range(1, 65)) AS v) LEFT JOIN p ON p.l_suppkey = a.l_suppkey AND p.idx = v""",
)
def partition_series(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.partition_series(partitions(spark, sf), "l_suppkey", "idx")

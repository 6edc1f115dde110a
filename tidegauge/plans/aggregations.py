"""Aggregations and measure families (A and M rows of the inventory) on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions import columns as C
from tidegauge.functions import times
from tidegauge.functions.money import as_double, money, net_price
from tidegauge.models import cost, logs
from tidegauge.operators import aggregates as A
from tidegauge.operators import joins as J
from tidegauge.operators import measures as M
from tidegauge.operators import sketches as K
from tidegauge.operators.ordered import Running, running
from tidegauge.plans.expressions import AS_OF, STATUS, activity_rows
from tidegauge.plans.tpch import NET
from tidegauge.registry import query
from tidegauge.session import spread, stored, table

DAY = "strftime(CAST(ts AS DATE), '%Y-%m-%d')"
ITEM = """coalesce(upper(CASE WHEN event_type = 'view' THEN 'a' || user_id END),
    upper('o' || json_extract_string(props, '$.k')))"""


def cents(col: str = "value"):
    return money(col)


def summary_rows(spark: SparkSession, sf: str) -> DataFrame:
    return activity_rows(spark, sf).select(
        "CreationDate",
        "CreationHour",
        "Activity",
        F.coalesce(F.upper("ArtifactId"), F.upper("ObjectId")).alias("item_id"),
        C.status_of(F.col("ResultStatus"), F.col("IsSuccess")).alias("status"),
        "UserId",
        "ResultStatus",
        "IsSuccess",
        "ObjectId",
    )


SHOWN = ["CreationDate", "CreationHour", "Activity", "item_id", "status"]


@query(
    "A1_activity_summary",
    f"""SELECT {DAY} AS "CreationDate", CAST(hour(ts) AS INTEGER) AS "CreationHour", event_type AS "Activity", {ITEM} AS item_id,
        {STATUS} AS status, count(*) AS "CountOfActivities", count(DISTINCT user_id) AS "DistinctCountOfUsers"
    FROM events WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 30 GROUP BY ALL""",
)
def activity_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = A.activity_summary(summary_rows(spark, sf), "CreationDate", AS_OF, 30, SHOWN, "UserId")
    return out.withColumn("CreationDate", F.col("CreationDate").cast("string"))


@query(
    "A1_activity_summary_source_grain",
    f"""SELECT "CreationDate", "CreationHour", "Activity", item_id, status, "CountOfActivities", "DistinctCountOfUsers" FROM (
      SELECT {DAY} AS "CreationDate", CAST(hour(ts) AS INTEGER) AS "CreationHour", event_type AS "Activity", {ITEM} AS item_id,
        {STATUS} AS status, props, count(*) AS "CountOfActivities", count(DISTINCT user_id) AS "DistinctCountOfUsers"
      FROM events WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 30 GROUP BY ALL)""",
)
def activity_summary_source(spark: SparkSession, sf: str) -> DataFrame:
    hidden = ["ResultStatus", "IsSuccess", "ObjectId"]
    out = A.activity_summary(summary_rows(spark, sf), "CreationDate", AS_OF, 30, SHOWN, "UserId", hidden)
    return out.withColumn("CreationDate", F.col("CreationDate").cast("string"))


COUNTERS = """CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS "TotalCUs", sum(l_quantity) AS "DurationInSec",
    count(*) AS "OperationCount", count(*) FILTER (l_returnflag = 'A') AS "SuccessCount",
    count(*) FILTER (l_returnflag = 'R') AS "RejectedCount", count(*) FILTER (l_linestatus = 'F') AS "FailureCount",
    count(*) FILTER (l_returnflag = 'N') AS "InvalidCount", count(*) FILTER (l_discount = 0) AS "CancelledCount",
    count(*) FILTER (l_tax = 0) AS "ThrottlingCount", max(l_linenumber) AS "MaxPercent" """


def counters() -> dict:
    return {
        "TotalCUs": as_double(F.sum(money("l_extendedprice"))),
        "DurationInSec": F.sum("l_quantity"),
        "OperationCount": M.rows(),
        "SuccessCount": F.count_if(F.col("l_returnflag") == "A"),
        "RejectedCount": F.count_if(F.col("l_returnflag") == "R"),
        "FailureCount": F.count_if(F.col("l_linestatus") == "F"),
        "InvalidCount": F.count_if(F.col("l_returnflag") == "N"),
        "CancelledCount": F.count_if(F.col("l_discount") == 0),
        "ThrottlingCount": F.count_if(F.col("l_tax") == 0),
        "MaxPercent": F.max("l_linenumber"),
    }


@query(
    "A2_item_operation_day",
    f"""SELECT l_suppkey, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS day, {COUNTERS} FROM lineitem
    GROUP BY l_suppkey, l_returnflag, l_shipdate HAVING sum(CAST(l_extendedprice AS DECIMAL(12,2))) > 0""",
)
def item_operation_day(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")
    out = M.by_groups(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag", day], **counters())
    return out.filter(F.col("TotalCUs") > 0)


@query(
    "A2_item_kind_day",
    f"""SELECT p_type, strftime(l_shipdate, '%Y-%m-%d') AS day, {COUNTERS} FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY p_type, l_shipdate HAVING sum(CAST(l_extendedprice AS DECIMAL(12,2))) > 0""",
)
def item_kind_day(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")
    return M.by_groups(lines, ["p_type", day], **counters()).filter(F.col("TotalCUs") > 0)


@query("A3_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return A.unique_rows(table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(
    "A3_drop_duplicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice")]
    return A.unique_rows(lines, ["l_orderkey", "l_linenumber"], order)


@query(
    "A4_completed_prefix",
    """WITH c AS (SELECT l_returnflag AS f, l_linestatus AS s, l_suppkey + 1 AS q, count(*) FILTER (l_quantity > 10) AS good,
        count(*) FILTER (NOT l_quantity > 10) AS bad FROM lineitem GROUP BY ALL),
    d AS (SELECT * FROM c WHERE good >= 60 OR bad >= 40),
    v AS (SELECT q FROM d GROUP BY q HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT f, s FROM d)))
    SELECT coalesce(min(n), 1) AS starting_query_id FROM (SELECT 1 AS n UNION SELECT q + 1 FROM v) WHERE n NOT IN (SELECT q FROM v)""",
)
def completed_prefix(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "lineitem").withColumn("query_id", F.col("l_suppkey") + 1)
    return A.completed_prefix(runs, ["l_returnflag", "l_linestatus"], "query_id", F.col("l_quantity") > 10, 60, 40)


@query(
    "A5_set_per_group",
    """SELECT l_suppkey, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS kinds FROM lineitem
    JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def set_per_group(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    kinds = F.array_join(F.sort_array(F.collect_set("p_type")), ",")
    return lines.select("l_suppkey", "p_type").distinct().groupBy("l_suppkey").agg(kinds.alias("kinds"))


@query(
    "A6_text_list",
    """SELECT p_type, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands FROM part GROUP BY 1""",
)
def text_list(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy("p_type").agg(F.expr(A.text_list("p_type", "p_brand")).alias("brands"))


@query(
    "A7_percentiles_joined_back",
    """SELECT event_id, value, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS h, round(p50, 6) AS p50, round(p90, 6) AS p90, mean FROM events e JOIN (
        SELECT date_trunc('hour', ts) AS hh, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90,
            CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1) q
    ON date_trunc('hour', ts) = hh""",
)
def percentiles_joined_back(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "value", F.date_format("ts", "yyyy-MM-dd HH").alias("h")
    )
    exact = M.percentiles(events, ["h"], "value", {"p50": 0.5, "p90": 0.9})
    exact = exact.select("h", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"))
    mean = M.by_groups(events, ["h"], mean=as_double(F.sum(cents())) / M.rows())
    return events.join(exact, "h").join(mean, "h")


@query(
    "A7_percentiles_nearest",
    """SELECT event_type, list_extract(list_sort(list(value)), CAST(floor(0.9 * (count(*) - 1) + 0.5) AS BIGINT) + 1) AS p90
    FROM events GROUP BY 1""",
)
def percentiles_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return M.percentiles(table(spark, sf, "events"), ["event_type"], "value", {"p90": 0.9}, "nearest")


@query(
    "A8_pivot",
    """SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS "A", count(*) FILTER (l_returnflag = 'N') AS "N",
        count(*) FILTER (l_returnflag = 'R') AS "R" FROM lineitem GROUP BY 1""",
)
def pivot(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(M.rows().alias("n"))
    return A.pivot_pairs(pairs, ["l_suppkey"], "l_returnflag", "n", ["A", "N", "R"]).fillna(0)


@query(
    "A9_group_by_all", "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_tax) AS t FROM lineitem GROUP BY ALL"
)
def group_by_all(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_tax) AS t FROM {lines} GROUP BY ALL",
        lines=table(spark, sf, "lineitem"),
    )


@query(
    "A10_having_subquery",
    f"""SELECT l_returnflag, l_linestatus, l_linenumber, CAST(sum({NET}) AS DOUBLE) AS total FROM lineitem GROUP BY 1, 2, 3
    HAVING sum({NET}) > (SELECT sum({NET}) * 0.024 FROM lineitem)""",
)
def having_subquery(spark: SparkSession, sf: str) -> DataFrame:
    groups = ["l_returnflag", "l_linestatus", "l_linenumber"]
    out = A.above_share(table(spark, sf, "lineitem"), groups, F.sum(net_price()), "0.024")
    return out.withColumn("total", as_double(F.col("total")))


# Measures ---------------------------------------------------------------------------------------


@query(
    "M1_plain",
    """SELECT event_type, count(*) AS activities, count(json_extract_string(props, '$.k')) AS with_k,
        CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY 1""",
)
def plain(spark: SparkSession, sf: str) -> DataFrame:
    return M.by_groups(
        table(spark, sf, "events"),
        ["event_type"],
        activities=M.rows(),
        with_k=F.count(F.get_json_object("props", "$.k")),
        total=as_double(F.sum(cents())),
    )


@query(
    "M2_filtered",
    """SELECT count(*) FILTER (event_type = 'view') AS viewed, count(DISTINCT user_id) FILTER (event_type = 'view') AS viewers,
        CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase') AS DOUBLE) AS bought,
        count(*) FILTER (coalesce(CASE WHEN user_id % 3 = 0 THEN true WHEN user_id % 3 = 1 THEN false END, false) = false) AS not_flagged,
        coalesce(sum(value) FILTER (event_type = 'none'), 0) AS nothing FROM events""",
)
def filtered(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    flag = F.when(F.col("user_id") % 3 == 0, True).when(F.col("user_id") % 3 == 1, False)
    return M.by_groups(
        table(spark, sf, "events"),
        [],
        viewed=F.count_if(kind == "view"),
        viewers=M.filtered(F.count_distinct, F.col("user_id"), kind == "view"),
        bought=as_double(M.filtered(F.sum, cents(), kind == "purchase")),
        not_flagged=F.count_if(M.is_false(flag)),
        nothing=M.or_zero(M.filtered(F.sum, F.col("value"), kind == "none")),
    )


@query(
    "M3_distinct",
    """SELECT event_type, count(DISTINCT user_id) AS users,
        count(DISTINCT nullif(user_id, 8)) + max(CASE WHEN user_id = 8 THEN 1 ELSE 0 END) AS users_with_blank FROM events GROUP BY 1""",
)
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    blank = F.nullif(F.col("user_id"), F.lit(8))
    return M.by_groups(
        table(
            spark, sf, "events"
        ), ["event_type"], users=F.count_distinct("user_id"), users_with_blank=M.distinct_values(blank)
    )


@query(
    "M4_statistics",
    """SELECT event_type, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean, median(value) AS middle,
        min(value) AS least, max(value) AS most FROM events GROUP BY 1""",
)
def statistics(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    simple = M.by_groups(
        events, ["event_type"], mean=as_double(F.sum(cents())) / M.rows(), least=F.min("value"), most=F.max("value")
    )
    return simple.join(M.percentiles(events, ["event_type"], "value", {"middle": 0.5}), "event_type")


COST_SQL = f"""WITH focus AS (SELECT l.*, o_orderdate, p_brand, p_type, p_name, p_size, {NET} AS eff,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS con,
        CASE l_returnflag WHEN 'R' THEN 'Reservation' WHEN 'A' THEN 'Plan' END AS discount_type, p_size <= 25 AS included,
        p_size % 10 = 0 AS main_meter, CASE WHEN l_tax = 0.08 THEN 'Capacity Pause/Delete Surcharge' END AS billing
      FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
    SELECT *, "OtherPAYG" / "TotalCost" AS other_share FROM (SELECT p_type,
      CAST(sum(eff) AS DOUBLE) AS "TotalCost",
      CAST(sum(eff) FILTER (main_meter) AS DOUBLE) AS "AvailableCapacity",
      CAST(sum(eff) FILTER (included) AS DOUBLE) AS "ProvisionedCapacity",
      CAST(coalesce(sum(eff) FILTER (billing IS NOT NULL), 0) AS DOUBLE) AS "PauseCost",
      CAST(sum(eff) FILTER (included AND discount_type IS DISTINCT FROM 'Reservation') - coalesce(sum(eff) FILTER (billing IS NOT NULL), 0) AS DOUBLE) AS "CapacityPAYG",
      CAST(coalesce(sum(eff) FILTER (included AND discount_type = 'Reservation'), 0) AS DOUBLE) AS "Reservation",
      CAST(sum(eff) FILTER (NOT included AND p_brand = 'Brand#3') AS DOUBLE) AS "Storage",
      CAST(coalesce(sum(eff) FILTER (p_name = 'red bolt'), 0) AS DOUBLE) AS "AutoScale",
      CAST(coalesce(sum(eff) FILTER (billing IS NOT NULL), 0) + coalesce(sum(eff) FILTER (p_name = 'red bolt'), 0) AS DOUBLE) AS "OtherPAYG",
      CAST(coalesce(sum(eff) FILTER (contains(p_name, 'gear')), 0) AS DOUBLE) AS "RecoveryCost",
      CAST(sum(con - eff) + sum(eff) AS DOUBLE) AS "CostWithoutCommitment",
      CASE WHEN sum(con - eff) > 1 THEN CAST(sum(con - eff) AS DOUBLE) ELSE 0 END AS "CommitmentSavings",
      CAST(sum(eff) FILTER (included) - sum(eff) FILTER (main_meter) AS DOUBLE) AS "UsedCapacity",
      CAST(sum(eff) FILTER (included) - sum(eff) FILTER (main_meter) AS DOUBLE) / CAST(sum(eff) FILTER (included) AS DOUBLE) AS "UsageRatio",
      CAST(coalesce(sum(eff) FILTER (included AND discount_type = 'Reservation'), 0) AS DOUBLE) / CAST(sum(eff) AS DOUBLE) AS "ReservationShare",
      count(DISTINCT l_suppkey) AS "Capacities", count(DISTINCT p_brand) AS "Regions", count(*) AS "Rows"
    FROM focus GROUP BY p_type)"""


def billing_rows(spark: SparkSession, sf: str, dated: bool = True) -> DataFrame:
    """Order lines in the shape of billing rows with their meter columns; ``dated`` ones also with their order's
    dates and category, which costs a join of the two largest tables."""
    lines, of_order = table(spark, sf, "lineitem"), []
    if dated:
        orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        of_order = [
            F.to_date("o_orderdate").alias("ChargePeriodStart"),
            F.trunc(F.to_date("o_orderdate"), "month").alias("BillingPeriodStart"),
            F.col("o_orderpriority").alias("ChargeCategory"),
        ]
    flag = F.col("l_returnflag")
    return lines.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "p_type",
        *of_order,
        net_price().alias("EffectiveCost"),
        money("l_extendedprice").alias("ContractedCost"),
        F.when(flag == "R", "Reservation").when(flag == "A", "Plan").alias("CommitmentDiscountType"),
        F.when(F.col("l_tax") == 0.08, cost.PAUSE).alias("BillingType"),
        F.col("l_suppkey").alias("ResourceName"),
        F.col("p_brand").alias("RegionName"),
        F.col("p_name").alias("MeterName"),
        F.col("p_brand").alias("MeterCategory"),
        (F.col("p_size") <= 25).alias("Included"),
        (F.col("p_size") % 10 == 0).alias("Main"),
    )


@query("M5_cost_measures", COST_SQL)
def cost_measures(spark: SparkSession, sf: str) -> DataFrame:
    out = cost.measures(
        billing_rows(spark, sf, dated=False), ["p_type"], storage="Brand#3", autoscale="red bolt", recovery="gear"
    )
    wanted = (
        "p_type TotalCost AvailableCapacity ProvisionedCapacity PauseCost CapacityPAYG Reservation Storage AutoScale OtherPAYG "
        "RecoveryCost CostWithoutCommitment CommitmentSavings UsedCapacity UsageRatio ReservationShare Capacities Regions Rows"
    ).split()
    return out.select(*wanted, M.ratio(F.col("OtherPAYG"), F.col("TotalCost")).alias("other_share"))


@query(
    "M6_unit_scaled",
    """SELECT source, sum(n_chars) / 1024 AS kb, max(n_chars) / 1024 AS max_kb, sum(n_chars) / 1048576 AS mb FROM documents GROUP BY 1""",
)
def unit_scaled(spark: SparkSession, sf: str) -> DataFrame:
    return M.by_groups(
        table(spark, sf, "documents"),
        ["source"],
        kb=M.scaled(F.sum("n_chars"), "kilobytes"),
        max_kb=M.scaled(F.max("n_chars"), "kilobytes"),
        mb=M.scaled(F.sum("n_chars"), "megabytes"),
    )


@query(
    "M7_two_level",
    f"""SELECT p_type, CAST(sum(cu) AS DOUBLE) / count(*) AS avg_cu, CAST(max(cu) AS DOUBLE) AS max_cu, count(*) AS item_days FROM (
        SELECT p_type, l_suppkey, l_shipdate, sum({NET}) AS cu FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3) GROUP BY 1""",
)
def two_level(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return M.two_level(
        lines,
        ["l_shipdate", "l_suppkey"],
        F.sum(net_price()),
        ["p_type"],
        avg_cu=lambda x: as_double(F.sum(x)) / F.count(x),
        max_cu=lambda x: as_double(F.max(x)),
        item_days=F.count,
    )


PERIODS_AS_OF = "2000-03-15"


@query(
    "M8_calendar_windows",
    f"""WITH e AS (SELECT *, CAST(o_orderdate AS DATE) AS d, DATE '{PERIODS_AS_OF}' AS n FROM orders)
    SELECT o_orderpriority, count(*) FILTER (date_trunc('month', d) = date_trunc('month', n)) AS n_cm,
        count(*) FILTER (date_trunc('month', d) = date_trunc('month', n - INTERVAL 1 MONTH)) AS n_pm,
        count(*) FILTER (year(d) = year(n)) AS n_cy, count(*) FILTER (year(d) = year(n) - 1) AS n_py,
        count(*) FILTER (d BETWEEN n - 7 AND n) AS n_7d, count(*) FILTER (d BETWEEN n - 14 AND n) AS n_14d,
        count(*) FILTER (d BETWEEN n - 30 AND n) AS n_30d, count(*) FILTER (d BETWEEN n - 60 AND n) AS n_60d,
        count(*) FILTER (d BETWEEN n - 90 AND n) AS n_90d,
        count(DISTINCT o_custkey) FILTER (d BETWEEN n - 30 AND n) AS users_30d FROM e GROUP BY 1""",
)
def calendar_windows(spark: SparkSession, sf: str) -> DataFrame:
    flags = M.period_flags(F.to_date("o_orderdate"), PERIODS_AS_OF)
    counts = {f"n_{name.lower()}": F.count_if(cond) for name, cond in flags.items()}
    users = M.filtered(F.count_distinct, F.col("o_custkey"), flags["30d"])
    return M.by_groups(table(spark, sf, "orders"), ["o_orderpriority"], users_30d=users, **counts)


@query(
    "M9_month_over_month",
    """WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS mm, count(*) AS n, count(DISTINCT o_custkey) AS users
        FROM orders GROUP BY 1, 2)
    SELECT c.o_orderpriority, strftime(c.mm, '%Y-%m') AS mon, c.n, (c.n - p.n) / p.n AS growth, (c.users - p.users) / p.users AS user_growth
    FROM m c LEFT JOIN m p ON p.o_orderpriority = c.o_orderpriority AND p.mm + INTERVAL 1 MONTH = c.mm""",
)
def month_over_month(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("m")
    monthly = M.by_groups(
        table(spark, sf, "orders"), ["o_orderpriority", month], n=M.rows(), users=F.count_distinct("o_custkey")
    )
    grown = M.period_over_period(monthly, ["o_orderpriority"], "m", growth="n", user_growth="users")
    return grown.select("o_orderpriority", F.date_format("m", "yyyy-MM").alias("mon"), "n", "growth", "user_growth")


@query(
    "M10_to_date",
    """WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS v FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority, strftime(day, '%Y-%m-%d') AS day, CAST(sum(v) OVER (PARTITION BY o_orderpriority, date_trunc('month', day) ORDER BY day) AS DOUBLE) AS cost_mtd,
        CAST(sum(v) OVER (PARTITION BY o_orderpriority, year(day) ORDER BY day) AS DOUBLE) AS cost_ytd FROM d""",
)
def to_date(spark: SparkSession, sf: str) -> DataFrame:
    daily = M.by_groups(
        table(spark, sf, "orders"),
        ["o_orderpriority", F.to_date("o_orderdate").alias("day")],
        cost=F.sum(money("o_totalprice")),
    )
    out = M.to_date_totals(daily, ["o_orderpriority"], "day", "cost")
    return out.select(
        "o_orderpriority", F.col("day").cast("string"), as_double(F.col("cost_mtd")).alias("cost_mtd"), as_double(F.col("cost_ytd")).alias("cost_ytd")
    )


@query(
    "M11_latest_run",
    """SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders
    WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders) GROUP BY 1""",
)
def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    last = M.latest_only(table(spark, sf, "orders"), "o_orderdate")
    return M.by_groups(last, ["o_orderstatus"], n=M.rows(), customers=F.count_distinct("o_custkey"))


@query(
    "M11_latest_run_per_group",
    """SELECT o_custkey, count(*) AS n, max(o_totalprice) AS most FROM orders o WHERE o_orderdate =
        (SELECT max(o_orderdate) FROM orders i WHERE i.o_custkey = o.o_custkey) GROUP BY 1""",
)
def latest_run_per_group(spark: SparkSession, sf: str) -> DataFrame:
    last = M.latest_only(table(spark, sf, "orders"), "o_orderdate", ["o_custkey"])
    return M.by_groups(last, ["o_custkey"], n=M.rows(), most=F.max("o_totalprice"))


SERIES_SQL = """WITH parts AS (SELECT l_suppkey, l_linenumber AS idx, count(*) AS n FROM lineitem GROUP BY 1, 2),
    avgs AS (SELECT l_suppkey, CAST(sum(n) AS DOUBLE) / count(*) AS avg_rows FROM parts GROUP BY 1),
    grid AS (SELECT l_suppkey, avg_rows, unnest(range(1, 65)) AS value FROM avgs),
    tagged AS (SELECT g.l_suppkey, g.value, p.idx IS NOT NULL AS cur, floor(avg_rows + 0.5) AS a FROM grid g LEFT JOIN parts p ON p.l_suppkey = g.l_suppkey AND p.idx = g.value)
    SELECT l_suppkey, CAST(value AS INTEGER) AS value, CASE WHEN cur THEN 'Current' ELSE 'Simulation' END AS version,
        CAST(sum(a) OVER (PARTITION BY l_suppkey ORDER BY value) AS DOUBLE) AS running_rows FROM tagged"""


@query("M12_running_series", SERIES_SQL)
def running_series(spark: SparkSession, sf: str) -> DataFrame:
    """Running rows over a partition series 1..64: existing partitions, then simulated ones."""
    parts = M.by_groups(table(spark, sf, "lineitem"), ["l_suppkey", F.col("l_linenumber").alias("idx")], n=M.rows())
    averages = parts.groupBy("l_suppkey").agg((F.sum("n") / F.count("n")).alias("avg_rows"))
    grid = J.expand_series(averages, F.lit(1), F.lit(64), "value")
    existing = parts.select("l_suppkey", F.col("idx").alias("value"), F.lit("Current").alias("version"))
    tagged = grid.join(existing, ["l_suppkey", "value"], "left").withColumn(
        "version", F.coalesce("version", F.lit("Simulation"))
    )
    step = F.floor(F.col("avg_rows") + 0.5).cast("double")
    upto = Window.partitionBy("l_suppkey").orderBy("value")  # 64 rows a group
    out = tagged.withColumn("running_rows", F.sum(step).over(upto))
    return out.select("l_suppkey", "value", "version", "running_rows")


CONTEXT_SQL = """WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(12,2))) AS total, count(DISTINCT user_id) AS n FROM events GROUP BY 1, 2),
    w AS (SELECT *, CAST(sum(total) OVER (PARTITION BY event_type) AS DOUBLE) AS any_day,
        CAST(sum(total) OVER (PARTITION BY event_type) AS DOUBLE) / count(*) OVER (PARTITION BY event_type) AS avg_any_day,
        CAST(sum(total) OVER () AS DOUBLE) AS selected,
        CAST(sum(total) OVER t AS DOUBLE) / CAST(sum(n) OVER t AS DOUBLE) AS trailing_avg
      FROM daily WINDOW t AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW))
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, CAST(total AS DOUBLE) AS total, any_day, avg_any_day, selected, trailing_avg,
        CAST(total AS DOUBLE) - avg_any_day AS vs_avg, (CAST(total AS DOUBLE) - avg_any_day - avg_any_day) / avg_any_day AS outlier FROM w"""


@query("M13_context_removal", CONTEXT_SQL)
def context_removal(spark: SparkSession, sf: str) -> DataFrame:
    """Totals and averages that ignore the day filter, trailing average, and the outlier factor."""
    daily = M.by_groups(
        table(spark, sf, "events"),
        ["event_type", F.to_date("ts").alias("day")],
        total=F.sum(cents()),
        n=F.count_distinct("user_id"),
    )
    selected = daily.agg(as_double(F.sum("total")).alias("selected"))
    shaped = M.trailing_average(daily, ["event_type"], "day", "total", "n", 7, "trailing_avg")
    shaped = M.whatever_day(shaped, ["event_type"], "total", "any_day", "avg_any_day")
    shaped = shaped.withColumns({"total": as_double(F.col("total")), "selected": selected.scalar()})
    vs_avg = F.col("total") - F.col("avg_any_day")
    return shaped.select(
        "event_type",
        F.col("day").cast("string").alias("day"),
        "total",
        "any_day",
        "avg_any_day",
        "selected",
        "trailing_avg",
        vs_avg.alias("vs_avg"),
        M.ratio(vs_avg - F.col("avg_any_day"), F.col("avg_any_day")).alias("outlier"),
    )


@query(
    "M14_health",
    """SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'error') + count(*) FILTER (value > 60) = 0
        THEN 'Healthy' ELSE 'Faulty' END AS verdict FROM events GROUP BY 1""",
)
def health(spark: SparkSession, sf: str) -> DataFrame:
    errors, not_ready = F.count_if(F.col("event_type") == "error"), F.count_if(F.col("value") > 60)
    return M.by_groups(table(spark, sf, "events"), ["user_id"], verdict=M.health(errors, not_ready))


@query(
    "M15_alternate_date",
    """SELECT strftime(l_shipdate, '%Y-%m') AS mon, sum(l_quantity) / count(*) AS avg_quantity, max(l_quantity) AS max_quantity,
        count(DISTINCT o_orderkey) AS requests FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_shipdate IS NOT NULL GROUP BY 1""",
)
def alternate_date(spark: SparkSession, sf: str) -> DataFrame:
    """Order measures by ship date instead of order date, through a calendar of all days that the data spans."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", F.to_date("l_shipdate").alias("shipped"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    first, last, rows = lines.agg(
        F.min("shipped").cast("string"), F.max("shipped").cast("string"), F.count(F.lit(1))
    ).first()
    rows += orders.count()
    days = times.calendar(spark, first or AS_OF, last or AS_OF, AS_OF).select("Date2Key", "YearMonth")
    facts = spread(orders, rows, "o_orderkey").join(
        spread(lines, rows, "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    dated = facts.join(days, F.col("shipped") == F.col("Date2Key"))
    return M.by_groups(
        dated,
        [F.col("YearMonth").alias("mon")],
        avg_quantity=F.sum("l_quantity") / M.rows(),
        max_quantity=F.max("l_quantity"),
        requests=F.count_distinct("o_orderkey"),
    )


@query(
    "M16_share_of_total",
    """SELECT source, CAST(sum(n_chars) AS BIGINT) AS total, sum(n_chars) / (SELECT sum(n_chars) FROM documents) AS share FROM documents GROUP BY 1""",
)
def share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    return M.share_of_total(table(spark, sf, "documents"), ["source"], F.sum("n_chars"), "share")


LOG_SQL = """SELECT l_suppkey, count(DISTINCT l_orderkey) FILTER (l_returnflag <> 'N') AS operations,
    CAST(count(DISTINCT l_orderkey) FILTER (l_returnflag <> 'N' AND l_linestatus = 'O') AS DOUBLE)
        / count(DISTINCT l_orderkey) FILTER (l_returnflag <> 'N') AS success_ratio,
    count(DISTINCT l_partkey) AS users, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'A') AS queries,
    count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS refreshes,
    count(DISTINCT l_orderkey) FILTER (l_linestatus = 'F') AS errors,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS cpu_total, max(l_extendedprice) AS cpu_max,
    sum(l_quantity) AS duration_total, max(l_quantity) AS duration_max,
    max(l_linenumber) AS memory_max FROM lineitem GROUP BY 1"""


@query("M17_log_metrics", LOG_SQL)
def log_metrics(spark: SparkSession, sf: str) -> DataFrame:
    shaped = table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.col("l_orderkey").alias("OperationId"),
        F.col("l_partkey").alias("ExecutingUser"),
        F.when(F.col("l_returnflag") == "A", "Query").when(F.col("l_returnflag") == "R", "Refresh").alias("Kind"),
        F.when(F.col("l_linestatus") == "O", "Succeeded").otherwise("Failed").alias("Status"),
        money("l_extendedprice").alias("CpuTimeMs"),
        F.col("l_quantity").alias("DurationMs"),
        F.col("l_linenumber").alias("PeakMemoryKb"),
    )
    out = logs.metrics(
        shaped, ["l_suppkey"], totals={"cpu": "CpuTimeMs", "duration": "DurationMs"}, maxima={"memory": "PeakMemoryKb"}
    )
    return out.withColumns({"cpu_total": as_double(F.col("cpu_total")), "cpu_max": as_double(F.col("cpu_max"))})


@query(
    "M18_heatmap",
    """SELECT user_id, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'error') AS error,
        max(value) FILTER (event_type = 'purchase') AS purchase, max(value) FILTER (event_type = 'signup') AS signup,
        max(value) FILTER (event_type = 'view') AS "view" FROM events GROUP BY 1""",
)
def heatmap(spark: SparkSession, sf: str) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, sf, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.max("value"))


@query(
    "M18_top_users",
    "SELECT user_id, max(value) AS max_cpu, count(*) AS n FROM events GROUP BY 1 ORDER BY max_cpu DESC, user_id LIMIT 10",
)
def top_users(spark: SparkSession, sf: str) -> DataFrame:
    per_user = M.by_groups(table(spark, sf, "events"), ["user_id"], max_cpu=F.max("value"), n=M.rows())
    return per_user.orderBy(F.desc("max_cpu"), "user_id").limit(10)


@query(
    "M19_ingestion",
    """SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M') AS slot, event_type AS db,
        CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (user_id % 2 = 0) AS DOUBLE) AS batch_volume,
        CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (user_id % 2 = 1) AS DOUBLE) AS stream_volume,
        count(*) FILTER (user_id % 2 = 0) AS blobs, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_latency, max(value) AS max_latency FROM events GROUP BY ALL""",
)
def ingestion(spark: SparkSession, sf: str) -> DataFrame:
    batch = F.col("user_id") % 2 == 0
    slot = F.date_format(F.window("ts", "6 hours")["start"], "yyyy-MM-dd HH:mm").alias("slot")
    return M.by_groups(
        table(spark, sf, "events"),
        [slot, F.col("event_type").alias("db")],
        batch_volume=as_double(M.filtered(F.sum, cents(), batch)),
        stream_volume=as_double(M.filtered(F.sum, cents(), ~batch)),
        blobs=F.count_if(batch),
        avg_latency=as_double(F.sum(cents())) / M.rows(),
        max_latency=F.max("value"),
    )


@query(
    "M20_daily_peaks",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, p_type, max(l_extendedprice) AS max_cpu, max(l_quantity) AS max_memory,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) FILTER (l_returnflag = 'R') AS DOUBLE) AS refresh_cpu
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_shipdate, p_type""",
)
def daily_peaks(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    refresh = F.col("l_returnflag") == "R"
    return M.by_groups(
        lines,
        [F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "p_type"],
        max_cpu=F.max("l_extendedprice"),
        max_memory=F.max("l_quantity"),
        refresh_cpu=as_double(M.filtered(F.sum, money("l_extendedprice"), refresh)),
    )


@query(
    "M20_sub_operations",
    """SELECT conv_id, turn, role, CAST(sum(length(text)) OVER w - length(text) AS BIGINT) AS start_at, CAST(sum(length(text)) OVER w AS BIGINT) AS end_at,
        lag(role) OVER w AS previous FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)""",
)
def sub_operations(spark: SparkSession, sf: str) -> DataFrame:
    """Sub-operations of a refresh in sequence, with start and end for a Gantt view."""
    size = F.length("text").cast("bigint")
    turns = table(spark, sf, "conversations").withColumn("size", size)
    out = running(
        turns,
        ["conv_id"],
        [F.col("turn"), F.col("role"), F.col("text")],
        end_at=Running("sum", F.col("size")),
        previous=Running("last", F.col("role"), inclusive=False),
    )
    return out.select(
        "conv_id", "turn", "role", (F.col("end_at") - F.col("size")).alias("start_at"), "end_at", "previous"
    )


WINDOWS = """(SELECT 'month' AS window_name, date_trunc('month', max(CAST(ts AS DATE))) AS first, max(CAST(ts AS DATE)) AS last FROM events
    UNION ALL SELECT 'week', max(CAST(ts AS DATE)) - 6, max(CAST(ts AS DATE)) FROM events
    UNION ALL SELECT 'all', min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events)"""


@query(
    "M8_distinct_sketches",
    f"""SELECT window_name, event_type, count(*) AS n, count(DISTINCT event_id // 3) AS exact, true AS within_error
    FROM events JOIN {WINDOWS} ON CAST(ts AS DATE) BETWEEN first AND last GROUP BY 1, 2""",
)
def distinct_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sessions of calendar windows, from rows and from sketches per day, and whether they agree as stated."""
    events = table(spark, sf, "events").select("event_type", F.expr("event_id div 3").alias("session"), F.to_date("ts").alias("day"))
    ends = events.agg(F.min("day").alias("low"), F.max("day").alias("high"))
    spans = {"month": (F.trunc("high", "month"), F.col("high")), "week": (F.date_sub("high", 6), F.col("high")), "all": (F.col("low"), F.col("high"))}
    named = [F.struct(F.lit(n).alias("window_name"), a.alias("first"), z.alias("last")) for n, (a, z) in spans.items()]
    windows = ends.select(F.inline(F.array(*named)))
    days = stored(K.daily(events, ["event_type"], "day", {"sessions": "session"}, {}), "daily-sketches")
    by = ["window_name", "event_type"]
    told = K.united(K.over_windows(days, "day", windows), by, ["sessions"])
    told = told.select(F.col("window_name").alias("in"), F.col("event_type").alias("of"), "n", K.distinct_estimate("sessions").alias("estimate"))
    exact = K.over_windows(events, "day", windows).groupBy(*by).agg(F.count_distinct("session").alias("exact"))
    off = F.abs(F.col("estimate") - F.col("exact"))
    same = (F.col("in") == F.col("window_name")) & F.col("of").eqNullSafe(F.col("event_type"))
    return told.join(exact, same).select(*by, "n", "exact", (off <= K.distinct_error() * F.col("exact")).alias("within_error"))


@query(
    "A7_quantile_sketches",
    "SELECT event_type, count(value) AS n, true AS p50_within_error, true AS p90_within_error FROM events GROUP BY 1",
)
def quantile_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Median and 90th percentile united from sketches per day, and whether their true ranks are as near as stated."""
    events = table(spark, sf, "events").select("event_type", "value", F.to_date("ts").alias("day"))
    days = stored(K.daily(events, ["event_type"], "day", {}, {"values": "value"}), "daily-quantiles")
    wanted = {"p50": 0.5, "p90": 0.9}
    told = K.united(days, ["event_type"], quantiles=["values"])
    told = told.select(F.col("event_type").alias("of"), *[K.quantile_estimate("values", q).alias(p) for p, q in wanted.items()])
    ranks = events.join(told, F.col("event_type").eqNullSafe(F.col("of"))).groupBy("event_type").agg(
        F.count("value").alias("n"),
        *[F.count_if(F.col("value") < F.col(p)).alias(f"below_{p}") for p in wanted],
        *[F.count_if(F.col("value") <= F.col(p)).alias(f"upto_{p}") for p in wanted],
    )
    room = K.rank_error() * F.col("n")
    near = {p: (F.col(f"below_{p}") - room <= q * F.col("n")) & (q * F.col("n") <= F.col(f"upto_{p}") + room) for p, q in wanted.items()}
    return ranks.select("event_type", "n", *[c.alias(f"{p}_within_error") for p, c in near.items()])

"""Log, quality, profiling and load jobs (Q rows of the inventory) on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import hash_key
from tidegauge.functions.money import as_double, money, net_price
from tidegauge.jobs import audit, perf, profile, rules, telemetry
from tidegauge.plans.relations import WORDS
from tidegauge.plans.tpch import NET
from tidegauge.registry import query
from tidegauge.session import table, work_path
from tidegauge.sources import json_drop


@query(
    "Q1_improvement",
    """SELECT *, improvement >= 10 AS meets_threshold, improvement >= 20 AS significant FROM (SELECT l_suppkey, baseline, current,
        CASE WHEN baseline > 0 THEN round((baseline - current) / baseline * 100, 2) ELSE 0 END AS improvement FROM
        (SELECT l_suppkey, sum(l_quantity) AS baseline FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) JOIN
        (SELECT l_suppkey, sum(l_quantity) AS current FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (l_suppkey))""",
)
def improvement(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")

    def total(flag: str) -> DataFrame:
        return lines.filter(F.col("l_returnflag") == flag).groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total"))

    return perf.improvement(total("A"), total("R"), "l_suppkey", "total")


@query(
    "Q2_load_test_logs",
    """SELECT e.event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS started, value AS duration, round(p50, 6) AS p50, round(p90, 6) AS p90, mean
    FROM events e JOIN (SELECT date_trunc('hour', ts) AS h, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1) ON h = date_trunc('hour', ts)""",
)
def load_test_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Logs written per event type; starts carry fractions of a second, which the reader cuts off."""
    root = work_path(spark, "loadtests")
    started = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss.SSS")
    log = table(spark, sf, "events").select(
        "event_id", F.col("value").alias("duration"), started.alias("start_time_dt"), "event_type"
    )
    log.write.partitionBy("event_type").option("header", True).csv(root)
    rows = perf.read_load_test_logs(spark, f"{root}/*/*.csv", "event_id bigint, duration double, start_time_dt string")
    out = perf.with_second_statistics(rows, "start_time_dt", "duration")
    return out.select(
        "event_id",
        F.date_format("start_time_dt", "yyyy-MM-dd HH:mm:ss").alias("started"),
        "duration",
        *[F.round(c, 6).alias(c) for c in ("p50", "p90")],
        "mean",
    )


@query(
    "Q3_query_list",
    """SELECT user_id, visual, query_text FROM (SELECT *, last_value(CASE WHEN event_type = 'view' THEN 'v' || event_id END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visual, props AS query_text FROM events) WHERE event_type = 'click'""",
)
def query_list(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("title", F.concat(F.lit("v"), "event_id"))
    order = [F.col("ts"), F.col("event_id")]
    return perf.query_list(events, ["user_id"], order, "event_type", "view", "click", "title", "props")


@query(
    "Q4_filtered_trace",
    """WITH t AS (SELECT *, strftime(ts, '%Y-%m-%d') AS run FROM events), f AS (SELECT run, arg_min(user_id, (ts, event_id)) AS s, arg_min(props, (ts, event_id)) AS p FROM t WHERE event_type = 'click' GROUP BY 1)
    SELECT t.run, event_id, user_id, p AS begin_property FROM t JOIN f ON t.run = f.run AND user_id = s""",
)
def filtered_trace(spark: SparkSession, sf: str) -> DataFrame:
    trace = table(spark, sf, "events").withColumn("run", F.date_format("ts", "yyyy-MM-dd"))
    out = perf.filtered_trace(trace, "run", "event_type", "user_id", ["ts", "event_id"], "props", begin="click")
    return out.select("run", "event_id", "user_id", "begin_property")


@query(
    "Q5_object_usage",
    f"""SELECT w, CAST(n_chars % 24 AS INTEGER) AS as_of_hour, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'core' WHEN source = 'src4' THEN 'all' ELSE 'Others' END AS user_group, lang, count(*) AS query_count
    FROM documents JOIN ({WORDS}) ON contains(text, w) GROUP BY ALL""",
)
def object_usage(spark: SparkSession, sf: str) -> DataFrame:
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    docs = table(spark, sf, "documents")
    sources = docs.select("source").distinct()
    core = sources.filter(F.col("source").isin("src1", "src2", "src3")).withColumns(
        {"user_group": F.lit("core"), "position": F.lit(1)}
    )
    every = sources.filter(F.col("source").isin("src3", "src4")).withColumns(
        {"user_group": F.lit("all"), "position": F.lit(2)}
    )
    members = core.unionByName(every)
    hour = (F.col("n_chars") % 24).cast("int")
    return perf.object_usage(docs, "doc_id", "text", words, "w", hour, "source", members, "lang", "Others")


@query(
    "Q6_cold_cache",
    """SELECT p_brand AS column_name, sum(l_quantity) / count(*) AS duration, CAST(sum(l_linenumber) AS DOUBLE) / count(*) AS cpu, count(*) AS probes FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_linestatus = 'O' AND l_returnflag <> 'N' GROUP BY 1""",
)
def cold_cache(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    probe = F.format_string("EVALUATE TOPN(1, 'part'[%s])", "p_brand")
    logs = lines.withColumn("text", F.when(F.col("l_returnflag") != "N", probe).otherwise("EVALUATE ROW(1)"))
    return perf.cold_cache(
        logs, "text", r"'[^']+'\[([^\]]+)\]", F.col("l_linestatus") == "O", "l_quantity", "l_linenumber"
    )


COLUMN_OBJECTS = """c AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Order Date' WHEN 1 THEN 'month' WHEN 2 THEN 'City' WHEN 3 THEN ' Trailing' WHEN 4 THEN 'IsOpen' WHEN 5 THEN 'Done flag'
        WHEN 6 THEN 'Sales Month' ELSE 'Value' END AS name, CASE p_size % 5 WHEN 0 THEN 'Double' WHEN 1 THEN 'Int64' WHEN 2 THEN 'DateTime' WHEN 3 THEN 'String' ELSE 'Decimal' END AS data_type,
        CASE WHEN p_type = 'PROMO' THEN 'Calculated' ELSE 'Data' END AS column_type, p_brand = 'Brand#1' AS is_hidden, p_brand = 'Brand#2' AS table_hidden,
        CASE WHEN p_partkey % 3 = 0 THEN 'text' END AS description, CASE WHEN p_partkey % 2 = 0 THEN 'mm/dd/yyyy' ELSE 'MMMM yyyy' END AS format_string, CASE WHEN p_size > 25 THEN 'None' ELSE 'Sum' END AS summarize_by,
        p_size % 4 AS relationships, p_size % 7 = 0 AS in_hierarchy, p_size % 11 = 0 AS sorts_others, p_partkey % 4 = 0 AS in_mdx, p_type = 'STANDARD' AS direct, p_type FROM part)"""

COLUMN_RULES = f"""WITH {COLUMN_OBJECTS}, v AS (
    SELECT p_type AS table_name, name, 1 AS rule_id, 'Performance' AS category, 'Warning' AS severity, 'Query Operation' AS impact FROM c WHERE data_type = 'Double'
    UNION ALL SELECT p_type, name, 2, 'Performance', 'Warning', 'Background Operation' FROM c WHERE column_type = 'Calculated'
    UNION ALL SELECT p_type, name, 7, 'Performance', 'Warning', 'Query Operation' FROM c WHERE in_mdx AND (is_hidden OR table_hidden) AND NOT sorts_others AND NOT in_hierarchy AND NOT direct
    UNION ALL SELECT p_type, name, 16, 'Performance', 'Warning', 'Query Operation' FROM c WHERE column_type = 'Calculated'
    UNION ALL SELECT p_type, name, 25, 'Error Prevention', 'Error', 'Usability' FROM c WHERE column_type = 'Data' AND p_partkey % 9 = 0
    UNION ALL SELECT p_type, name, 26, 'Error Prevention', 'Warning', 'Query Operation' FROM c WHERE NOT in_mdx AND (sorts_others OR in_hierarchy) AND NOT direct
    UNION ALL SELECT p_type, name, 41, 'Maintenance', 'Warning', 'Usability' FROM c WHERE (is_hidden OR table_hidden) AND relationships = 0 AND NOT in_hierarchy AND NOT sorts_others
    UNION ALL SELECT p_type, name, 45, 'Maintenance', 'Info', 'Usability' FROM c WHERE NOT is_hidden AND description IS NULL
    UNION ALL SELECT p_type, name, 46, 'Formatting', 'Warning', 'Usability' FROM c WHERE name = 'Order Date' AND data_type = 'DateTime' AND format_string <> 'mm/dd/yyyy'
    UNION ALL SELECT p_type, name, 47, 'Formatting', 'Warning', 'Query Operation' FROM c WHERE data_type IN ('Int64', 'Decimal', 'Double') AND summarize_by <> 'None' AND NOT is_hidden AND NOT table_hidden
    UNION ALL SELECT p_type, name, 49, 'Formatting', 'Info', 'Usability' FROM c WHERE name = 'City'
    UNION ALL SELECT p_type, name, 52, 'Formatting', 'Info', 'Usability' FROM c WHERE NOT is_hidden AND relationships = 3
    UNION ALL SELECT p_type, name, 53, 'Formatting', 'Info', 'Usability' FROM c WHERE relationships = 2 AND NOT in_hierarchy
    UNION ALL SELECT p_type, name, 54, 'Formatting', 'Info', 'Usability' FROM c WHERE name IN ('month', 'Sales Month') AND data_type = 'String'
    UNION ALL SELECT p_type, name, 56, 'Formatting', 'Warning', 'Usability' FROM c WHERE name IN ('month', 'Sales Month') AND data_type = 'DateTime' AND format_string <> 'MMMM yyyy'
    UNION ALL SELECT p_type, name, 57, 'Formatting', 'Info', 'Usability' FROM c WHERE NOT is_hidden AND NOT table_hidden AND ((name = 'IsOpen' AND data_type = 'Int64') OR (name = 'Done flag' AND data_type <> 'String'))
    UNION ALL SELECT p_type, name, 58, 'Formatting', 'Error', 'Usability' FROM c WHERE name = ' Trailing'
    UNION ALL SELECT p_type, name, 59, 'Formatting', 'Info', 'Usability' FROM c WHERE name = 'month')"""


def column_objects(spark: SparkSession, sf: str) -> DataFrame:
    def cases(col, names: list[str]):
        return F.element_at(F.array(*[F.lit(n) for n in names]), (col + 1).cast("int"))

    key, size = F.col("p_partkey"), F.col("p_size")
    names = ["Order Date", "month", "City", " Trailing", "IsOpen", "Done flag", "Sales Month", "Value"]
    return table(spark, sf, "part").select(
        cases(key % 8, names).alias("name"),
        F.col("p_type").alias("table_name"),
        cases(size % 5, ["Double", "Int64", "DateTime", "String", "Decimal"]).alias("data_type"),
        F.when(F.col("p_type") == "PROMO", "Calculated").otherwise("Data").alias("column_type"),
        (F.col("p_brand") == "Brand#1").alias("is_hidden"),
        (F.col("p_brand") == "Brand#2").alias("table_hidden"),
        F.when(key % 3 == 0, "text").alias("description"),
        F.when(key % 2 == 0, "mm/dd/yyyy").otherwise("MMMM yyyy").alias("format_string"),
        F.when(size > 25, "None").otherwise("Sum").alias("summarize_by"),
        F.lit(None).cast("string").alias("data_category"),
        F.lit(None).cast("string").alias("table_category"),
        F.when(key % 9 != 0, F.col("p_name")).alias("source_column"),
        (size % 7 == 0).alias("is_key"),
        F.lit(None).cast("string").alias("sort_by"),
        (key % 4 == 0).alias("in_mdx"),
        F.lit("RELATED ( x )").alias("expression"),
        (size % 4).alias("relationships"),
        (size % 4 == 3).cast("int").alias("many_side"),
        (size % 4 == 2).cast("int").alias("one_side"),
        (size % 7 == 0).alias("in_hierarchy"),
        (size % 11 == 0).alias("sorts_others"),
        (F.col("p_type") == "STANDARD").alias("direct"),
    )


@query(
    "Q7_column_rules",
    f"""{COLUMN_RULES} SELECT 'Column' AS object_type, table_name, name AS object_name, rule_id, category, severity, impact, count(*) AS n FROM v GROUP BY ALL""",
)
def column_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = rules.violations({"Column": column_objects(spark, sf)})
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "Q7_measure_rules",
    """WITH m AS (SELECT p_partkey, 'm' || p_partkey AS name, CASE p_partkey % 6 WHEN 0 THEN '0 + SUM(x)' WHEN 1 THEN 'IFERROR(a, 1)' WHEN 2 THEN '[m' || p_partkey - 1 || ']' WHEN 3 THEN 'SUM(a[b]) / COUNT(c)'
        WHEN 4 THEN 'SUM(p' || p_size || ')' ELSE 'MAX(k' || p_partkey || ')' END AS expr, p_size % 2 = 0 AS hidden FROM part),
    d AS (SELECT regexp_replace(expr, '\\s+', '', 'g') AS e, count(*) AS n FROM m GROUP BY 1)
    SELECT rule_id, count(*) AS n FROM (SELECT 14 AS rule_id FROM m WHERE p_partkey % 6 = 0 UNION ALL SELECT 28 FROM m WHERE p_partkey % 6 = 1 UNION ALL SELECT 31 FROM m WHERE p_partkey % 6 = 2
        UNION ALL SELECT 32 FROM m JOIN d ON e = regexp_replace(expr, '\\s+', '', 'g') WHERE n > 1 UNION ALL SELECT 37 FROM m WHERE p_partkey % 6 = 3
        UNION ALL SELECT 42 FROM m WHERE hidden AND NOT EXISTS (SELECT 1 FROM m r WHERE r.p_partkey % 6 = 2 AND r.p_partkey - 1 = m.p_partkey)
        UNION ALL SELECT 45 FROM m WHERE NOT hidden UNION ALL SELECT 48 FROM m WHERE NOT hidden UNION ALL SELECT 51 FROM m UNION ALL SELECT 59 FROM m) GROUP BY 1""",
)
def measure_rules(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    bodies = [
        F.lit("0 + SUM(x)"),
        F.lit("IFERROR(a, 1)"),
        F.format_string("[m%d]", key - 1),
        F.lit("SUM(a[b]) / COUNT(c)"),
        F.format_string("SUM(p%d)", "p_size"),
        F.format_string("MAX(k%d)", key),
    ]
    measures = table(spark, sf, "part").select(
        F.concat(F.lit("m"), key).alias("name"),
        (F.col("p_size") % 2 == 0).alias("is_hidden"),
        F.lit("").alias("description"),
        F.lit("").alias("format_string"),
        F.element_at(F.array(*bodies), (key % 6 + 1).cast("int")).alias("expression"),
        F.lit(0).alias("unqualified_columns"),
        F.lit(0).alias("qualified_measures"),
    )
    found = rules.violations({"Measure": rules.with_definition_facts(measures)})
    return found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "Q8_violation_summary",
    f"""{COLUMN_RULES} SELECT 'severity' AS grouped_by, severity AS value, count(*) AS violations FROM v GROUP BY severity UNION ALL SELECT 'category', category, count(*) FROM v GROUP BY category
    UNION ALL SELECT 'object_type', 'Column', count(*) FROM v""",
)
def violation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rules.summary(rules.violations({"Column": column_objects(spark, sf)}))


def factory(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers as pipelines and their orders as activities."""
    customers = table(spark, sf, "customer")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "ExecutePipeline").when(
        F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")
    )
    activities = (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_name").alias("pipeline"), kind.alias("type"))
    )
    return customers.select(F.col("c_name").alias("name")), activities


PROFILE_SQL = """a AS (SELECT c_name AS pipeline, CASE o_orderpriority WHEN '1-URGENT' THEN 'ExecutePipeline' WHEN '5-LOW' THEN 'Unknown' ELSE o_orderpriority END AS type FROM orders JOIN customer ON o_custkey = c_custkey),
    per AS (SELECT c_name AS pipeline, count(type) AS n FROM customer LEFT JOIN a ON a.pipeline = c_name GROUP BY 1)"""


@query(
    "Q9_factory_profile",
    f"""WITH {PROFILE_SQL} SELECT count(*) AS pipelines, CAST(sum(n) AS BIGINT) AS activities, CAST(sum(n) AS DOUBLE) / count(*) AS avg_activities, max(n) AS max_activities,
        (SELECT pipeline FROM per ORDER BY n DESC, pipeline LIMIT 1) AS max_pipeline, (SELECT count(*) FROM a WHERE type = 'ExecutePipeline') AS pipeline_dependencies FROM per""",
)
def factory_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.activity_metrics(*factory(spark, sf))


@query("Q9_activities_by_type", f"WITH {PROFILE_SQL} SELECT type, count(*) AS activities FROM a GROUP BY 1")
def activities_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return profile.activities_by_type(factory(spark, sf)[1])


@query(
    "Q10_insights",
    f"""WITH {PROFILE_SQL}, bt AS (SELECT type, count(*) AS n FROM a GROUP BY 1), du AS (SELECT l_partkey, count(*) AS u FROM lineitem GROUP BY 1), su AS (SELECT l_suppkey, count(*) AS u FROM lineitem GROUP BY 1)
    SELECT 'factory_scale' AS insight, 'info' AS severity, count(*) AS metric, NULL AS detail FROM per
    UNION ALL SELECT 'complex_pipeline', 'warning', n, pipeline FROM (SELECT * FROM per ORDER BY n DESC, pipeline LIMIT 1) WHERE n > 10
    UNION ALL SELECT 'high_usage_datasets', 'warning', count(*), NULL FROM du WHERE u > 5 HAVING count(*) > 0
    UNION ALL SELECT 'trigger_migration', 'info', count(*), NULL FROM nation
    UNION ALL SELECT 'activity_distribution', 'info', n, type || ' ' || printf('%.1f', n * 100.0 / (SELECT sum(n) FROM bt)) || '%' FROM (SELECT * FROM bt ORDER BY n DESC, type DESC LIMIT 1)
    UNION ALL SELECT 'critical_connections', 'critical', count(*), NULL FROM su WHERE u > 10 HAVING count(*) > 0""",
)
def insights(spark: SparkSession, sf: str) -> DataFrame:
    pipelines, activities = factory(spark, sf)
    lines = table(spark, sf, "lineitem")
    usage = [lines.groupBy(c).agg(F.count(F.lit(1)).alias("usage")) for c in ("l_partkey", "l_suppkey")]
    none = table(spark, sf, "part").filter(F.col("p_size") > 1000)
    return profile.insights(
        profile.activity_metrics(
            pipelines, activities
        ), profile.activities_by_type(activities), *usage, table(spark, sf, "nation"), none
    )


@query(
    "Q11_model_sizes",
    """SELECT l_suppkey, CAST(coalesce(sum(l_partkey) FILTER (l_returnflag = 'N' AND l_linestatus = 'O'), 0) AS DOUBLE) / 1024 AS data_size,
        CAST(coalesce(sum(l_partkey) FILTER (l_returnflag = 'A' AND l_linenumber = 1), 0) AS DOUBLE) / 1024 AS hierarchy_size,
        CAST(coalesce(sum(l_partkey) FILTER (l_returnflag = 'R'), 0) AS DOUBLE) / 1024 AS user_hierarchy_size,
        CAST(coalesce(sum(l_partkey) FILTER (l_returnflag = 'N' AND l_linestatus = 'F'), 0) AS DOUBLE) / 1024 AS relationship_size, sum(l_quantity) / count(*) AS avg_temperature FROM lineitem GROUP BY 1""",
)
def model_sizes(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    table_id = (
        F.when(flag == "A", "H$col").when(flag == "R", "U$hier").when(
            F.col("l_linestatus") == "F", "R$rel"
        ).otherwise("Orders")
    )
    segments = table(spark, sf, "lineitem").select(
        "l_suppkey",
        table_id.alias("TABLE_ID"),
        F.col("l_partkey").alias("USED_SIZE"),
        (F.col("l_linenumber") - 1).alias("SEGMENT_NUMBER"),
        F.col("l_quantity").alias("TEMPERATURE"),
    )
    return telemetry.model_sizes(segments, ["l_suppkey"], "kilobytes").drop("total_size")


# Audit star schema ------------------------------------------------------------------------------

MD5_KEY = "CAST(CASE WHEN u >= 9223372036854775808 THEN CAST(u AS HUGEINT) - 18446744073709551616 ELSE u END AS BIGINT)"


def md5_of(text: str) -> str:
    return f"CAST('0x' || right(md5({text}), 16) AS UBIGINT)"


def definitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as dated definitions: customer = model, priority = table, status = object."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("ModelUuid"),
        F.col("o_orderpriority").alias("TableName"),
        F.col("o_orderstatus").alias("ObjectName"),
        F.concat(F.lit("E"), (F.col("o_orderkey") % 3).cast("string")).alias("Expression"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("AsOfDate"),
        F.concat_ws(
            " ", F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
        ).alias("AsOfDateTime"),
    )


@query(
    "Q12_dim_model_object",
    f"""WITH d AS (SELECT CAST(o_custkey AS VARCHAR) AS m, o_orderpriority AS t, o_orderstatus AS o, 'E' || o_orderkey % 3 AS e, strftime(o_orderdate, '%Y-%m-%d') AS day,
        strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS tm FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY m, t, o, k ORDER BY tm DESC) AS rn, max(day) OVER (PARTITION BY k) AS last_day FROM (SELECT *, CASE o WHEN 'F' THEN 'COLUMN' WHEN 'O' THEN 'MEASURE' ELSE 'REPORT MEASURE' END AS k FROM d)),
    x AS (SELECT * FROM n WHERE rn = 1), f AS (SELECT max(day) AS final FROM x)
    SELECT m AS "ModelUuid", t AS "TableName", o AS "ObjectName", e AS "Expression", k AS "ObjectType", CASE WHEN k = 'REPORT MEASURE' OR day = last_day THEN 'False' ELSE 'True' END AS "DeletedFromModelFlag",
        CASE WHEN t = '1-URGENT' THEN 'src_table' ELSE 'N/A' END AS "SourceTableName", CASE WHEN t = '1-URGENT' THEN 'src_column' ELSE 'N/A' END AS "SourceColumnName",
        CASE WHEN day = final THEN 'False' ELSE 'True' END AS "DeletedFromDatastoreFlag", {MD5_KEY} AS "ModelObjectId"
    FROM (SELECT *, {md5_of("m || t || CASE WHEN k = 'REPORT MEASURE' THEN e ELSE o END")} AS u FROM x, f)""",
)
def dim_model_object(spark: SparkSession, sf: str) -> DataFrame:
    rows = definitions(spark, sf)
    columns, measures, reports = (rows.filter(F.col("ObjectName") == s) for s in ("F", "O", "P"))
    sources = (
        rows.filter(F.col("TableName") == "1-URGENT")
        .select("ModelUuid", "TableName", "ObjectName")
        .distinct()
        .withColumns({"SourceTableName": F.lit("src_table"), "SourceColumnName": F.lit("src_column")})
    )
    return audit.dim_model_object(reports, columns, measures, rows.limit(0), sources)


@query(
    "Q12_dim_model",
    """SELECT "ModelUuid", run FROM (SELECT o_custkey AS "ModelUuid", o_orderkey AS run, o_orderdate AS d, max(o_orderdate) FILTER (o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE d = m""",
)
def dim_model(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("ModelUuid"),
        F.col("o_orderkey").alias("run"),
        F.col("o_orderdate").alias("AsOfDateTime"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("Status"),
    )
    return audit.dim_model(runs).select("ModelUuid", "run")


@query(
    "Q12_dim_report",
    """SELECT CAST(c_custkey AS VARCHAR) AS "ReportUuid", CASE WHEN c_custkey % 10 = 3 THEN 'Customer#' || lpad(CAST(c_custkey - 1 AS VARCHAR), 9, '0') ELSE c_name END AS "ReportName",
        c_custkey % 10 = 3 AS "IsAppReport", CAST(CASE WHEN c_custkey % 10 = 3 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) AS "OriginalReportUuid" FROM customer""",
)
def dim_report(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    reports = table(spark, sf, "customer").select(
        key.cast("string").alias("ReportId"), F.col("c_name").alias("ReportName"), F.col("c_nationkey").cast("string").alias("WorkspaceId"), F.lit("2024-01-30").alias("AsOfDateTime")
    )
    older = reports.withColumns({"ReportName": F.lit("old"), "AsOfDateTime": F.lit("2023-12-01")})
    apps = table(spark, sf, "customer").filter(key % 10 == 3).select(
        key.cast("string").alias("AppReportId"), (key - 1).cast("string").alias("OriginalReportId")
    )
    return audit.dim_report(reports.unionByName(older), apps).drop("WorkspaceUuid")


@query(
    "Q12_dim_user",
    f"""SELECT un AS "ExecutingUser", g AS "ExecutingUserGroup", {MD5_KEY} AS "UserId" FROM (SELECT *, {md5_of("un || g")} AS u FROM (
        SELECT DISTINCT 'Masked' AS un, event_type AS g FROM events UNION SELECT DISTINCT 'user' || user_id, event_type FROM events))""",
)
def dim_user(spark: SparkSession, sf: str) -> DataFrame:
    logs = table(spark, sf, "events").select(
        F.concat(F.lit("user"), "user_id").alias("ExecutingUser"), F.col("event_type").alias("ExecutingUserGroup")
    )
    return audit.dim_user(logs.select("ExecutingUserGroup"), logs)


@query(
    "Q12_fact_query_count",
    f"""WITH q AS (SELECT l_suppkey AS m, l_partkey AS o, l_returnflag AS g, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
    f AS (SELECT m, {md5_of("CAST(m AS VARCHAR) || 't' || o")} AS u, g, 'True' AS d, n FROM q UNION ALL SELECT m, {md5_of("CAST(m AS VARCHAR) || 't' || (o // 2)")}, g, 'False', n FROM q WHERE o > 0)
    SELECT CAST(m AS VARCHAR) AS "ModelUuid", {MD5_KEY} AS "ModelObjectId", g, d AS "DirectReferenceFlag", CAST(sum(n) AS BIGINT) AS "QueryCount" FROM f GROUP BY ALL""",
)
def fact_query_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    model, obj = F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")
    counts = lines.groupBy(
        model.alias("ModelUuid"), obj.alias("ModelObject"), F.col("l_returnflag").alias("ExecutingUserGroup")
    ).agg(
        F.count(F.lit(1)).alias("QueryCount")
    )
    counts = counts.withColumns(
        {
            "RunUuid": F.lit("r1"),
            "ObjectType": F.lit("MEASURE"),
            "ReportId": F.lit(None).cast("string"),
            "AsOfDate": F.lit("2024-01-30"),
            "AsOfHour": F.lit(1),
        }
    )
    pairs = lines.select(
        model.alias("ModelUuid"), obj.alias("ModelObject"), "l_partkey"
    ).distinct().withColumn("RunUuid", F.lit("r1"))
    mapping = pairs.select(
        "ModelUuid", "RunUuid", "ModelObject", F.lit("t").alias("TableName"), F.col("ModelObject").alias("ObjectName")
    )
    refs = pairs.filter(F.col("l_partkey") > 0).select(
        "ModelUuid", "RunUuid", F.lit("t").alias("TableName"), F.col("ModelObject").alias("ObjectName"), F.lit("t").alias("ReferencedTableName"), F.shiftright("l_partkey", 1).cast("string").alias("ReferencedObjectName")
    )
    facts = audit.fact_query_count(counts, mapping, refs)
    # The names behind the three user ids, as a mapping of literals: no join of the facts.
    names = F.create_map(*[x for g in ("A", "N", "R") for x in (hash_key(F.lit("Masked"), F.lit(g)), F.lit(g))])
    return facts.groupBy(
        "ModelUuid", "ModelObjectId", names[F.col("UserId")].alias("g"), "DirectReferenceFlag"
    ).agg(F.sum("QueryCount").alias("QueryCount"))


@query(
    "Q12_fact_logs",
    f"""SELECT event_id AS "OperationId", strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS "ReportUuid", value AS "DurationMs", {MD5_KEY} AS "UserId" FROM (SELECT *, {md5_of("'user' || user_id || 'all'")} AS u FROM events)""",
)
def fact_logs(spark: SparkSession, sf: str) -> DataFrame:
    logs = table(spark, sf, "events").select(
        F.col("event_id").alias("OperationId"),
        F.col("ts").alias("Timestamp"),
        F.col("event_type").alias("ReportId"),
        F.col("value").alias("DurationMs"),
        F.concat(F.lit("user"), "user_id").alias("ExecutingUser"),
        F.lit("all").alias("ExecutingUserGroup"),
    )
    out = audit.fact_logs(logs)
    return out.select(
        "OperationId",
        F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss").alias("at"),
        "ReportUuid",
        "DurationMs",
        "UserId",
    )


@query(
    "Q12_fact_statistics",
    """SELECT p_type, p_brand, measured, resident, size, cpu FROM (SELECT p_type, p_brand, count(*) AS measured, count(*) FILTER (p_size > 25) AS resident, CAST(sum(p_size) AS DOUBLE) / count(*) AS size FROM part GROUP BY 1, 2)
    LEFT JOIN (SELECT p_type, p_brand, CAST(sum(l_linenumber) AS DOUBLE) / count(*) AS cpu FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand <> 'Brand#1' GROUP BY 1, 2) USING (p_type, p_brand)""",
)
def fact_statistics(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    keyed = {
        "ModelUuid": F.lit("m"),
        "TableName": F.col("p_type"),
        "ColumnName": F.col("p_brand"),
        "AsOfDate": F.lit("2024-01-30"),
    }
    columns = part.withColumns(keyed).withColumn("IsResident", F.col("p_size") > 25)
    sizes = part.withColumns(keyed).withColumn("TotalSize", F.col("p_size"))
    cold = table(spark, sf, "lineitem").join(
        part.filter(F.col("p_brand") != "Brand#1"), F.col("l_partkey") == F.col("p_partkey")
    )
    cold = cold.withColumns(keyed).withColumns({"Duration": F.col("l_quantity"), "CpuTime": F.col("l_linenumber")})
    out = audit.fact_statistics(columns, sizes, cold)
    return out.select(
        F.col("TableName").alias("p_type"),
        F.col("ColumnName").alias("p_brand"),
        F.col("ColumnResidencyMeasuredCount").alias("measured"),
        F.col("ColumnResidencyTrueCount").alias("resident"),
        F.col("TotalSize").alias("size"),
        F.col("CpuTime").alias("cpu"),
    )


# Inventory and telemetry loads ------------------------------------------------------------------

SCAN_SCHEMA = (
    "workspaces array<struct<id:string,name:string,datasets:array<struct<id:string,name:string,createdDate:string,targetStorageMode:string,"
    "endorsement:struct<level:string>,users:array<struct<identifier:string,graphId:string,datasetUserAccessRight:string,groupUserAccessRight:string>>>>,"
    "Lakehouse:array<struct<id:string,displayName:string,users:array<struct<identifier:string,graphId:string,artifactUserAccessRight:string>>>>>>"
)


def scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as workspaces holding two datasets and a lakehouse, written and read as scan documents."""
    key = F.col("c_custkey").cast("string")

    def user(right: str, value):
        return F.struct(
            F.concat(F.lit("u"), key).alias("identifier"),
            F.concat(F.lit("g"), key).alias("graphId"),
            value.alias(right),
        )

    def dataset(n: int):
        id_ = F.when(
            F.lit(n == 1) & (F.col("c_custkey") % 4 == 0), F.lit(None).cast("string")
        ).otherwise(F.concat(F.lit(f"d{n}-"), key))
        return F.struct(
            id_.alias("id"),
            F.col("c_mktsegment").alias("name"),
            F.lit("2024-01-05T10:00:00").alias("createdDate"),
            F.lit("Abf").alias("targetStorageMode"),
            F.struct(F.lit("Promoted").alias("level")).alias("endorsement"),
            F.array(
                user(
                    "datasetUserAccessRight" if n == 0 else "groupUserAccessRight",
                    F.lit("Read") if n == 0 else F.lit("Admin"),
                )
            ).alias("users"),
        )

    def as_json(col):
        return F.to_json(col)

    lake = F.struct(
        F.concat(F.lit("l-"), key).alias("id"),
        F.lit("lake").alias("displayName"),
        F.array(user("artifactUserAccessRight", F.lit("Write"))).alias("users"),
    )
    # The two datasets differ in their fields, so their JSON texts are joined instead of one array.
    datasets = F.concat(F.lit("["), as_json(dataset(0)), F.lit(","), as_json(dataset(1)), F.lit("]"))
    workspace = F.concat(
        F.lit(
            '{"workspaces":[{"id":"w'
        ), key, F.lit('","name":"'), F.col("c_name"), F.lit('","datasets":'), datasets, F.lit(',"Lakehouse":['), as_json(lake), F.lit("]}]}")
    )
    path = work_path(spark, "scan")
    table(spark, sf, "customer").select(workspace.alias("value")).write.text(path)
    docs = json_drop.read_documents(spark, path, SCAN_SCHEMA, multi_line=False)
    return json_drop.records(docs, "workspaces").withColumnRenamed("id", "WorkspaceId")


@query(
    "Q13_inventory",
    """SELECT 'w' || c_custkey AS "WorkspaceId", 'D0-' || c_custkey AS "DatasetId", c_mktsegment AS "Name", '2024-01-05' AS "CreatedDate", 'Promoted' AS endorsement_level FROM customer
    UNION ALL SELECT 'w' || c_custkey, 'D1-' || c_custkey, c_mktsegment, '2024-01-05', 'Promoted' FROM customer WHERE c_custkey % 4 <> 0""",
)
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    rows = json_drop.artifact_rows(
        scan(spark, sf),
        "WorkspaceId",
        "datasets",
        rename={
            "id": "DatasetId", "name": "Name", "createdDate": "CreatedDateTime", "targetStorageMode": "StorageMode"
        },
        upper=["DatasetId"],
        drop=["users"],
        dates={"CreatedDate": "CreatedDateTime"},
    )
    return rows.select("WorkspaceId", "DatasetId", "Name", "CreatedDate", F.col("`endorsement.level`").alias("endorsement_level"))


@query(
    "Q14_access_matrix",
    """SELECT 'W' || c_custkey AS "WorkspaceId", 'D0-' || c_custkey AS "ItemId", 'datasets' AS "ItemType", c_mktsegment AS "ItemName", 'Read' AS "AccessRight", 'G' || c_custkey AS "GraphId" FROM customer
    UNION ALL SELECT 'W' || c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'D1-' || c_custkey END, 'datasets', c_mktsegment, 'Admin', 'G' || c_custkey FROM customer
    UNION ALL SELECT 'W' || c_custkey, 'L-' || c_custkey, 'Lakehouse', 'lake', 'Write', 'G' || c_custkey FROM customer""",
)
def access_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return json_drop.access_matrix(scan(spark, sf), "WorkspaceId").select(
        "WorkspaceId", "ItemId", "ItemType", "ItemName", "AccessRight", "GraphId"
    )


REFRESH_SCHEMA = (
    "value array<struct<id:string,name:string,kind:string,startTime:string,endTime:string,averageDuration:double,medianDuration:double,refreshCount:bigint,"
    "capacity:struct<id:string>,group:struct<id:string>,refreshSchedule:struct<enabled:boolean,days:array<string>,times:array<string>,localTimeZoneId:string>,"
    "lastRefresh:struct<requestId:string,startTime:string,endTime:string,status:string,refreshType:string>>>"
)


@query(
    "Q15_refresh_tables",
    """SELECT 'main' AS part, count(*) AS n, 0 AS total FROM part UNION ALL SELECT 'days', CAST(sum(CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT), 0 FROM part
    UNION ALL SELECT 'times', count(*), 0 FROM part UNION ALL SELECT 'summaries', count(*), CAST(sum(p_size * 60) AS BIGINT) FROM part WHERE p_size <> 7
    UNION ALL SELECT 'details', count(*), CAST(sum(p_size) AS BIGINT) FROM part WHERE p_partkey % 3 <> 0""",
)
def refresh_tables(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    begin = F.to_timestamp(F.lit("2024-01-05 06:00:00"))

    def text(ts):
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    days = F.when(size % 2 == 0, F.array(F.lit("Mon"), F.lit("Fri"))).otherwise(F.array(F.lit("Mon")))
    schedule = F.struct(
        F.lit(True).alias("enabled"),
        days.alias("days"),
        F.array(F.lit("06:00")).alias("times"),
        F.lit("UTC").alias("localTimeZoneId"),
    )
    refresh = F.when(
        F.col("p_partkey") % 3 != 0,
        F.struct(
            F.concat(F.lit("r"), key).alias("requestId"),
            text(begin).alias("startTime"),
            text(begin + F.make_dt_interval(secs=size)).alias("endTime"),
            F.lit("Completed").alias("status"),
            F.lit("Scheduled").alias("refreshType"),
        ),
    )
    end = F.when(size == 7, F.lit("0001-01-01T00:00:00Z")).otherwise(text(begin + F.make_dt_interval(mins=size)))
    item = F.struct(
        F.concat(F.lit("i"), key).alias("id"),
        F.col("p_name").alias("name"),
        F.lit("Dataset").alias("kind"),
        text(begin).alias("startTime"),
        end.alias("endTime"),
        size.cast("double").alias("averageDuration"),
        size.cast("double").alias("medianDuration"),
        size.cast("bigint").alias("refreshCount"),
        F.struct(F.col("p_brand").alias("id")).alias("capacity"),
        F.struct(F.col("p_type").alias("id")).alias("group"),
        schedule.alias("refreshSchedule"),
        refresh.alias("lastRefresh"),
    )
    path = work_path(spark, "refreshables")
    table(spark, sf, "part").select(F.to_json(F.struct(F.array(item).alias("value"))).alias("value")).write.text(path)
    rows = json_drop.read_json_drop(spark, path, "value", schema=REFRESH_SCHEMA, multi_line=False)
    measure = {"summaries": "ConsiderationDurationSeconds", "details": "DurationInSeconds"}
    out = None
    for name, df in telemetry.refresh_tables(rows).items():
        total = F.sum(measure[name]) if name in measure else F.lit(0).cast("bigint")
        part = df.agg(
            F.count(F.lit(1)).alias("n"), total.alias("total")
        ).select(F.lit(name).alias("part"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "Q16_billing_gold",
    f"""WITH b AS (SELECT p_name, o_orderdate, {NET} AS eff, CAST(l_extendedprice AS DECIMAL(12,2)) AS con, l_tax FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE l_linestatus = 'O' AND year(o_orderdate) = 2000 AND month(o_orderdate) IN (1, 2)),
    known AS (SELECT p_name, min(p_partkey) AS k FROM part WHERE p_name LIKE 'red%' OR p_name LIKE 'blue%' GROUP BY 1),
    fresh AS (SELECT p_name, (SELECT max(k) FROM known) + row_number() OVER (ORDER BY lower(p_name)) AS k FROM (SELECT DISTINCT p_name FROM b) WHERE p_name NOT IN (SELECT p_name FROM known)),
    keys AS (SELECT * FROM known UNION ALL SELECT * FROM fresh)
    SELECT k AS "MeterKey", CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS "ChargePeriodStart_DateKey", CASE WHEN l_tax = 0.08 THEN 'Capacity Pause/Delete Surcharge' END AS "BillingType",
        count(*) AS n, CAST(sum(con - eff) AS DOUBLE) AS savings FROM b JOIN keys USING (p_name) GROUP BY ALL""",
)
def billing_gold(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    part = table(spark, sf, "part")
    details = F.when(
        F.col("l_tax") == 0.08, F.to_json(F.struct(F.lit("Capacity Pause/Delete Surcharge").alias("BillingType")))
    )
    focus = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("l_linestatus") == "O", "Lake").otherwise("Other").alias("ServiceName"),
        F.date_format(F.trunc(F.to_date("o_orderdate"), "month"), "yyyy-MM-dd").alias("BillingPeriodStart"),
        F.col("o_orderdate").alias("ChargePeriodStart"),
        F.col("p_type").alias("ChargeDescription"),
        net_price().alias("EffectiveCost"),
        money("l_extendedprice").alias("ContractedCost"),
        F.upper("p_name").alias("x_SkuMeterName"),
        details.alias("x_SkuDetails"),
    )
    known = part.filter(F.col("p_name").like("red%") | F.col("p_name").like("blue%"))
    meters = known.groupBy(F.lower("p_name").alias("Name_Lower")).agg(F.min("p_partkey").alias("MeterKey"))
    gold = telemetry.billing_gold(focus, meters, "Lake", ["2000-01-01", "2000-02-01"])
    return gold.groupBy("MeterKey", "ChargePeriodStart_DateKey", "BillingType").agg(
        F.count(F.lit(1)).alias("n"), as_double(F.sum("CommitmentSavings")).alias("savings")
    )


@query(
    "Q17_flattening",
    """SELECT 'setting' AS part, 's' || n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'g' || c_custkey END AS who FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0
    UNION ALL SELECT 'setting', 's' || n_nationkey, NULL FROM nation WHERE n_nationkey % 2 = 1
    UNION ALL SELECT 'Admin', CAST(s_suppkey AS VARCHAR), s_name FROM supplier UNION ALL SELECT 'User', CAST(s_suppkey AS VARCHAR), 'n' || s_nationkey FROM supplier""",
)
def flattening(spark: SparkSession, sf: str) -> DataFrame:
    """Settings with their security groups, and the admins and users of capacities."""
    nation = table(spark, sf, "nation")
    member = F.struct(F.concat(F.lit("g"), "c_custkey").alias("graphId"), F.col("c_name").alias("name"))
    even = nation.filter(F.col("n_nationkey") % 2 == 0).join(
        table(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    # One single-group setting row per member: flattening must not depend on one huge array.
    grouped = even.select(
        F.concat(F.lit("s"), "n_nationkey").alias("settingName"), F.array(member).alias("enabledSecurityGroups")
    )
    alone = nation.filter(F.col("n_nationkey") % 2 == 1).select(
        F.concat(F.lit("s"), "n_nationkey").alias("settingName"), F.array().cast(
            "array<struct<graphId:string,name:string>>"
        ).alias("enabledSecurityGroups")
    )
    settings = grouped.unionByName(alone).withColumns({"title": F.lit("t"), "enabled": F.lit(True)})
    capacities = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("Id"), F.array("s_name").alias("admins"), F.array(
            F.concat(F.lit("n"), "s_nationkey")
        ).alias("users")
    )
    flat = telemetry.settings_rows(settings).select(
        F.lit("setting").alias("part"), F.col("settingName").alias("id"), F.col("GroupId").alias("who")
    )
    people = telemetry.capacity_people(capacities).select(
        F.col("Role").alias("part"), F.col("CapacityId").alias("id"), F.col("Principal").alias("who")
    )
    return flat.unionByName(people)

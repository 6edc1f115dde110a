"""Projections, filters and scalar functions (P rows of the inventory) on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import columns as C
from tidegauge.functions import texts as X
from tidegauge.functions import times as M
from tidegauge.registry import query
from tidegauge.session import table

AS_OF = "2024-01-30"
EVENTS_AS_OF = f"DATE '{AS_OF}'"


def iso(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


@query(
    "P1_complex_to_text",
    """SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n, true AS is_text FROM embeddings""",
)
def complex_to_text(spark: SparkSession, sf: str) -> DataFrame:
    flat = C.complex_to_text(table(spark, sf, "embeddings"))
    back = F.from_json("embedding", "array<float>")
    return flat.select(
        "vec_id", "label", F.size(back).alias("n"), (F.typeof("embedding") == "string").alias("is_text")
    )


@query(
    "P2_upper_ids",
    "SELECT conv_id, turn, upper(role) AS role, length(text) AS n FROM conversations",
)
def upper_ids(spark: SparkSession, sf: str) -> DataFrame:
    df = C.upper_ids(table(spark, sf, "conversations"), ["role", "WorkspaceId"])
    return df.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("n"))


@query(
    "P3_date_parts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%Y%m%d') AS k,
        CAST(hour(ts) AS VARCHAR) AS h, strftime(ts, '%M') AS m FROM events""",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = C.date_parts(F.col("iso"))
    return (
        table(spark, sf, "events")
        .withColumn("iso", iso("ts"))
        .select(
            "event_id",
            parts["CreationDate"].cast("string").alias("d"),
            parts["CreationDateKey"].alias("k"),
            parts["CreationHour"].alias("h"),
            parts["CreationMinute"].alias("m"),
        )
    )


def activity_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the shape of activity rows: outcome text, success flag, ids and creation time."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.to_date("ts").alias("CreationDate"),
        F.hour("ts").alias("CreationHour"),
        F.col("user_id").alias("UserId"),
        kind.alias("Activity"),
        F.when(kind == "error", "Failed").when(kind == "view", "InProgress").when(
            kind == "purchase", "Succeeded"
        ).alias(
            "ResultStatus"
        ),
        F.when(kind == "click", 1).otherwise(0).alias("IsSuccess"),
        F.when(kind == "view", F.concat(F.lit("a"), F.col("user_id"))).alias("ArtifactId"),
        F.concat(F.lit("o"), F.get_json_object("props", "$.k")).alias("ObjectId"),
        "value",
        "props",
    )


STATUS = """CASE WHEN event_type = 'error' THEN 'Failed' WHEN event_type = 'view' THEN 'InProgress'
    WHEN event_type IN ('purchase', 'click') THEN 'Succeeded' ELSE 'N/A' END"""


@query("P4_status_ladder", f"SELECT {STATUS} AS status, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def status_ladder(spark: SparkSession, sf: str) -> DataFrame:
    status = C.status_of(F.col("ResultStatus"), F.col("IsSuccess"))
    return (
        activity_rows(spark, sf)
        .groupBy(status.alias("status"), F.col("Activity").alias("event_type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "P5_first_id",
    """SELECT coalesce(upper(CASE WHEN event_type = 'view' THEN 'a' || user_id END),
        upper('o' || json_extract_string(props, '$.k'))) AS item_id, count(*) AS n FROM events GROUP BY 1""",
)
def first_id(spark: SparkSession, sf: str) -> DataFrame:
    item = F.coalesce(F.upper("ArtifactId"), F.upper("ObjectId"))
    return activity_rows(spark, sf).groupBy(item.alias("item_id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "P6_json_attribute",
    """SELECT event_id, json_extract_string(props, '$.k') AS k,
        json_extract_string(props, '$.k') = '42' AS is_answer FROM events""",
)
def json_attribute_(spark: SparkSession, sf: str) -> DataFrame:
    k = X.json_attribute(F.col("props"), "k")
    return table(spark, sf, "events").select("event_id", k.alias("k"), (k == "42").alias("is_answer"))


@query(
    "P7_nested_sources",
    """SELECT event_id, event_type AS kind, 'user/' || user_id AS path FROM events
    UNION ALL SELECT event_id, 'Web', 'k' || json_extract_string(props, '$.k') || ';https' FROM events""",
)
def nested_sources(spark: SparkSession, sf: str) -> DataFrame:
    first = F.to_json(F.struct(F.col("event_type").alias("kind"), F.concat(F.lit("user/"), "user_id").alias("path")))
    k = F.concat(F.lit("k"), F.get_json_object("props", "$.k"))
    second = F.to_json(F.struct(F.lit("Web").alias("ConnectorType"), k.alias("domain"), F.lit("https").alias("scheme")))
    logged = table(spark, sf, "events").select("event_id", F.to_json(F.array(first, second)).alias("DataSource"))
    kind, path = X.source_kind_and_path(F.col("item"))
    return X.expand_json_list(logged, "DataSource", "item").select("event_id", kind.alias("kind"), path.alias("path"))


@query(
    "P8_contexts",
    """SELECT event_id, 'c' || user_id AS context_id, event_type AS trace_id, 'k' AS key,
        json_extract_string(props, '$.k') AS value FROM events
    UNION ALL SELECT event_id, 'c' || user_id, event_type, 'user', CAST(user_id AS VARCHAR) FROM events""",
)
def contexts(spark: SparkSession, sf: str) -> DataFrame:
    def pair(key: str, value):
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    values = F.array(
        pair("k", F.get_json_object("props", "$.k")), pair("user", F.col("user_id")), pair("secret", F.col("value"))
    )
    trace = F.struct(F.col("event_type").alias("id"), values.alias("values"))
    context = F.struct(F.concat(F.lit("c"), "user_id").alias("id"), F.array(trace).alias("traceIds"))
    logged = table(spark, sf, "events").select("event_id", F.to_json(F.array(context)).alias("contexts"))
    return X.expand_contexts(logged, "contexts", without="secret").drop("contexts")


@query(
    "P9_application_context",
    """SELECT event_id, 'd' || user_id AS DatasetId, event_type AS ReportId,
        json_extract_string(props, '$.k') AS VisualId, CAST(NULL AS VARCHAR) AS HostProperties FROM events""",
)
def application_context(spark: SparkSession, sf: str) -> DataFrame:
    source = F.struct(F.col("event_type").alias("ReportId"), F.get_json_object("props", "$.k").alias("VisualId"))
    text = F.to_json(F.struct(F.concat(F.lit("d"), "user_id").alias("DatasetId"), F.array(source).alias("Sources")))
    logged = table(spark, sf, "events").select("event_id", text.alias("value"))
    return X.expand_application_context(logged, "value").drop("value")


@query(
    "P10_decode_text",
    "SELECT doc_id, sha256(replace(text, chr(10), ' ')) AS line_hash FROM documents",
)
def decode_text(spark: SparkSession, sf: str) -> DataFrame:
    encoded = F.base64(F.encode("text", "UTF-8"))
    return table(spark, sf, "documents").select(
        "doc_id", F.sha2(X.decode_query_text(encoded, "UTF-8"), 256).alias("line_hash")
    )


@query(
    "P11_bracket_sum",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + user_id AS total FROM events""",
)
def bracket_sum(spark: SparkSession, sf: str) -> DataFrame:
    text = F.format_string("rows [%s, %s] read", F.get_json_object("props", "$.k"), F.col("user_id").cast("string"))
    return table(spark, sf, "events").select("event_id", X.bracket_sum(text).alias("total"))


@query(
    "P12_xml_json_property",
    "SELECT event_id, event_type AS report_id, 'u' || user_id AS activity_id FROM events",
)
def xml_json_property(spark: SparkSession, sf: str) -> DataFrame:
    source = F.struct(F.col("event_type").alias("ReportId"))
    app = F.to_json(F.struct(F.array(source).alias("Sources")))
    xml = F.concat(
        F.lit("<PropertyList><ActivityID>u"),
        F.col("user_id"),
        F.lit("</ActivityID><ApplicationContext>"),
        app,
        F.lit("</ApplicationContext></PropertyList>"),
    )
    return (
        table(spark, sf, "events")
        .withColumn("xml", xml)
        .select(
            "event_id",
            X.xml_json_property(F.col("xml"), "/PropertyList/ApplicationContext", "$.Sources[0].ReportId").alias(
                "report_id"
            ),
            F.xpath_string("xml", F.lit("/PropertyList/ActivityID")).alias("activity_id"),
        )
    )


@query(
    "P13_all_matches",
    """SELECT link, count(*) AS n, count(DISTINCT page_id) AS pages FROM (
        SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) GROUP BY link""",
)
def all_matches(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "html")
    return (
        X.all_matches(pages, "html", 'href="([^"]*)"', 1, "link")
        .groupBy("link")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))
    )


@query(
    "P14_estimated_size",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN l_linenumber % 3 = 2 THEN 0 ELSE l_partkey END AS est_rows,
        CASE WHEN l_linenumber % 3 = 2 THEN 0 ELSE greatest(1, (l_suppkey * 100) // 1024) END AS est_kb FROM lineitem""",
)
def estimated_size(spark: SparkSession, sf: str) -> DataFrame:
    size = F.format_string(
        "select 1; Estimated size (volume, bytes): %s, %s", F.col("l_partkey"), F.col("l_suppkey") * 100
    )
    rows = F.format_string("rows = %,d Bytes=%,d", F.col("l_partkey"), F.col("l_suppkey") * 100)
    kind = F.col("l_linenumber") % 3
    text = F.when(kind == 0, size).when(kind == 1, rows).otherwise("no estimate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        X.estimated_rows(text).alias("est_rows"),
        X.estimated_kb(text).alias("est_kb"),
    )


@query(
    "P15_running_statement",
    """SELECT conv_id, turn, substr(text, 6, CASE WHEN turn % 2 = 0 THEN length(text) ELSE 11 END) AS statement
    FROM conversations""",
)
def running_statement(spark: SparkSession, sf: str) -> DataFrame:
    start = F.lit(10)
    end = F.when(F.col("turn") % 2 == 0, -1).otherwise(30)
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", X.running_statement(F.col("text"), start, end).alias("statement")
    )


@query(
    "P16_time_bins",
    """SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS five,
        strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS quarter_hour,
        strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start,
        strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS sec, count(*) AS n FROM events GROUP BY ALL""",
)
def time_bins(spark: SparkSession, sf: str) -> DataFrame:
    def text(col):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")

    ts = F.col("ts")
    return (
        table(spark, sf, "events")
        .groupBy(
            text(M.floor_minutes(ts, 5)).alias("five"),
            text(M.floor_minutes(ts, 15)).alias("quarter_hour"),
            text(F.date_trunc("hour", ts)).alias("hour_start"),
            text(F.date_trunc("second", ts)).alias("sec"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


SOURCE_TYPES = ["money", "datetimeoffset", "nvarchar", "tinyint", "decimal", "varchar", "time", "image", "nchar", "int"]


@query(
    "P17_type_mapping",
    """SELECT p_partkey, CASE p_partkey % 10
        WHEN 0 THEN 'decimal(19,' || p_partkey % 8 || ')' WHEN 1 THEN 'datetime2(' || least(p_partkey % 8, 6) || ')'
        WHEN 2 THEN CASE WHEN p_size = 1 THEN 'varchar(8000)' ELSE 'varchar(' || p_size // 2 || ')' END
        WHEN 3 THEN 'smallint' WHEN 4 THEN 'decimal(19,' || p_partkey % 8 || ')'
        WHEN 5 THEN CASE WHEN p_size = 1 THEN 'varchar(8000)' ELSE 'varchar(' || p_size || ')' END
        WHEN 6 THEN 'time(' || least(p_partkey % 8, 6) || ')' WHEN 7 THEN 'varbinary'
        WHEN 8 THEN CASE WHEN p_size = 1 THEN 'char(8000)' ELSE 'char(' || p_size // 2 || ')' END
        ELSE 'int' END AS new_type FROM part""",
)
def type_mapping(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(t) for t in SOURCE_TYPES])
    column_rows = table(spark, sf, "part").select(
        "p_partkey",
        F.element_at(names, (F.col("p_partkey") % 10 + 1).cast("int")).alias("coltype"),
        F.when(F.col("p_size") == 1, -1).otherwise(F.col("p_size")).alias("maxlen"),
        F.lit(19).alias("prec"),
        (F.col("p_partkey") % 8).cast("int").alias("scale"),
    )
    mapped = C.mapped_type(F.col("coltype"), F.col("maxlen"), F.col("prec"), F.col("scale"))
    return column_rows.select("p_partkey", mapped.alias("new_type"))


@query(
    "P18_code_decode",
    """SELECT o_orderstatus AS code, CASE o_orderstatus WHEN 'F' THEN 'FlatMaisonette' WHEN 'O' THEN 'Other' END AS meaning,
        o_orderstatus NOT IN ('D', 'S', 'T', 'F', 'O') AS quarantined, count(*) AS n FROM orders GROUP BY 1""",
)
def code_decode(spark: SparkSession, sf: str) -> DataFrame:
    known, unknown = C.split_known(table(spark, sf, "orders"), "o_orderstatus", list(C.PROPERTY_TYPES))
    code = F.col("o_orderstatus")
    good = known.select(
        code.alias("code"), C.decode_strict(code, C.PROPERTY_TYPES).alias("meaning"), F.lit(False).alias("quarantined")
    )
    bad = unknown.select(
        code.alias("code"), F.lit(None).cast("string").alias("meaning"), F.lit(True).alias("quarantined")
    )
    return good.unionByName(bad).groupBy("code", "meaning", "quarantined").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P19_optional_filters",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
        AND o_totalprice BETWEEN 100000 AND 200000 AND o_orderpriority NOT LIKE '%LOW%'""",
)
def optional_filters(spark: SparkSession, sf: str) -> DataFrame:
    orders = C.optional_filters(
        table(spark, sf, "orders"),
        o_orderstatus="F",
        o_orderpriority=["1-URGENT", "2-HIGH"],
        o_totalprice=(100000, 200000),
        o_custkey=None,
    )
    return C.optional_filters(orders, o_orderpriority="!%LOW%").select("o_orderkey", "o_totalprice")


@query(
    "P20_date_arithmetic",
    f"""SELECT event_type, count(*) FILTER (CAST(ts AS DATE) >= {EVENTS_AS_OF} - 14) AS last14,
        strftime(max(CAST(ts AS DATE)) + INTERVAL 1 MONTH, '%Y-%m-%d') AS due,
        strftime(min(ts) + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS first_check FROM events GROUP BY 1""",
)
def date_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    now = F.to_date(F.lit(AS_OF))
    return (
        table(spark, sf, "events")
        .groupBy("event_type")
        .agg(
            F.count_if(F.to_date("ts") >= F.date_sub(now, 14)).alias("last14"),
            F.add_months(F.max(F.to_date("ts")), 1).cast("string").alias("due"),
            F.date_format(F.min("ts") + F.make_dt_interval(mins=F.lit(90)), "yyyy-MM-dd HH:mm:ss").alias("first_check"),
        )
    )


@query(
    "P21_durations",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('second', o_orderdate, l_shipdate) AS BIGINT) AS secs,
        date_diff('second', o_orderdate, l_shipdate) / 3600.0 AS hours
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'""",
)
def durations(spark: SparkSession, sf: str) -> DataFrame:
    # Open lines get the year-1 end date the source uses for "not ended", and are dropped again.
    ended = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).otherwise(F.expr("timestamp_ntz '0001-01-01'"))
    secs = C.seconds_between(F.col("o_orderdate"), ended)
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", secs.alias("secs"), (secs / F.lit(3600.0)).alias("hours"))
        .filter(F.col("secs").isNotNull())
    )


@query(
    "P22_name_match",
    """SELECT lower(regexp_replace(p_brand || ' ' || p_name, '[^A-Za-z0-9]', '', 'g')) AS "matchName", p_size AS "pSize",
        count(*) AS n FROM part GROUP BY 1, 2""",
)
def name_match(spark: SparkSession, sf: str) -> DataFrame:
    name = C.match_name(F.concat_ws(" ", "p_brand", "p_name"))
    parts = table(spark, sf, "part").select(name.alias("match name"), "p_size")
    return C.rename_all(parts, C.camel_case).groupBy("matchName", "pSize").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P23_masking",
    f"""SELECT CAST(ts AS DATE) >= {EVENTS_AS_OF} - 7 AS recent, CASE WHEN CAST(ts AS DATE) < {EVENTS_AS_OF} - 7
        THEN 'Masked' ELSE sha256('s' || 'user' || user_id) END AS user_name, count(*) AS n FROM events GROUP BY 1, 2""",
)
def masking(spark: SparkSession, sf: str) -> DataFrame:
    spelled = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" User"), "user_id")).otherwise(
        F.concat(F.lit("USER"), F.col("user_id"), F.lit(" "))
    )
    day = F.to_date("ts")
    cutoff = F.date_sub(F.to_date(F.lit(AS_OF)), 7)
    named = table(spark, sf, "events").withColumn("user_name", C.pseudonym(spelled, "s"))
    return (
        C.mask_older(named, "user_name", day, cutoff)
        .groupBy((day >= cutoff).alias("recent"), "user_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "P24_user_groups",
    """SELECT CASE WHEN user_id % 10 < 3 THEN 'zeta' || user_id % 10 WHEN user_id % 4 = 0 THEN 'alpha' ELSE 'Others' END
        AS user_group, count(*) AS n FROM events GROUP BY 1""",
)
def user_groups(spark: SparkSession, sf: str) -> DataFrame:
    from tidegauge.operators.joins import with_user_group

    events = table(spark, sf, "events")
    users = events.select("user_id").distinct()
    zeta = users.filter(F.col("user_id") % 10 < 3).select(
        F.concat(F.lit("zeta"), F.col("user_id") % 10).alias("user_group"), "user_id", F.lit(1).alias("position")
    )
    alpha = users.filter(F.col("user_id") % 4 == 0).select(
        F.lit("alpha").alias("user_group"), "user_id", F.lit(2).alias("position")
    )
    members = zeta.unionByName(alpha)
    return with_user_group(events, members, "user_id", "Others").groupBy("user_group").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P25_name_variants",
    """SELECT p_partkey, unnest(['''' || p_type || '''[' || p_name || ']', p_type || '[' || p_name || ']',
        '[' || p_name || ']']) AS variant FROM part""",
)
def name_variants(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", C.name_variants(F.col("p_name"), F.col("p_type")).alias("variant")
    )


@query(
    "P26_hash_key",
    """SELECT p_partkey, CAST(CASE WHEN u >= 9223372036854775808 THEN CAST(u AS HUGEINT) - 18446744073709551616
        ELSE u END AS BIGINT) AS key FROM (SELECT p_partkey, CAST('0x' || right(md5(p_brand || p_name || p_size), 16)
        AS UBIGINT) AS u FROM part)""",
)
def hash_key(spark: SparkSession, sf: str) -> DataFrame:
    key = C.hash_key(F.col("p_brand"), F.col("p_name"), F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", key.alias("key"))


@query("P27_content_hash", "SELECT page_id, sha256(html) AS content_hash FROM pages")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", C.content_hash(F.col("html")).alias("content_hash"))


@query(
    "P28_display_category",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'Success' WHEN 'N' THEN 'Error' ELSE 'N/A' END AS category,
        CASE l_linestatus WHEN 'O' THEN 'Many to One' ELSE 'One to One' END AS cardinality, count(*) AS n
    FROM lineitem GROUP BY 1, 2""",
)
def display_category(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N")
    side = F.when(F.col("l_linestatus") == "O", "many").otherwise("one")
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            C.display_success(flag).alias("category"), C.cardinality_text(side, F.lit("one")).alias("cardinality")
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "P29_calendar",
    f"""WITH d AS (SELECT CAST(generate_series AS DATE) AS day FROM generate_series(DATE '2023-12-01', DATE '2024-02-28', INTERVAL 1 DAY)),
    n AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
    SELECT strftime(d.day, '%Y%m%d') AS "DateKey", CAST(year(d.day) AS INTEGER) AS "Year", CAST(month(d.day) AS INTEGER) AS "Month",
        CAST(day(d.day) AS INTEGER) AS "Day", CAST(weekofyear(d.day) AS INTEGER) AS "WeekOfYear",
        strftime(d.day, '%Y-%m') AS "YearMonth", strftime(d.day, '%a') AS "DayOfWeek", CAST(dayofweek(d.day) + 1 AS INTEGER) AS "DayOfWeekNum",
        CAST(year(d.day) = 2024 AS INTEGER) AS "IsCurrentYear", CAST(year(d.day) = 2023 AS INTEGER) AS "IsPreviousYear",
        CAST(year(d.day) = 2024 AND month(d.day) <= 3 AS INTEGER) AS "IsCurrentQuarter",
        CAST(year(d.day) = 2024 AND month(d.day) = 1 AS INTEGER) AS "IsCurrentMonth",
        CAST(year(d.day) = 2023 AND month(d.day) = 12 AS INTEGER) AS "IsPreviousMonth",
        CAST(d.day BETWEEN {EVENTS_AS_OF} - 14 AND {EVENTS_AS_OF} AS INTEGER) AS "IsInLast14Days",
        CAST(d.day BETWEEN {EVENTS_AS_OF} - 30 AND {EVENTS_AS_OF} AS INTEGER) AS "IsInLast30Days",
        coalesce(n.n, 0) AS n FROM d LEFT JOIN n ON d.day = n.day""",
)
def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    days = M.calendar(spark, "2023-12-01", "2024-02-28", AS_OF)
    n = table(spark, sf, "events").groupBy(F.to_date("ts").alias("Date2Key")).agg(F.count(F.lit(1)).alias("n"))
    unused = ["Date", "Date2Key", "IsInLast7Days", "IsInLast60Days", "IsInLast90Days"]
    return days.join(n, "Date2Key", "left").withColumn("n", F.coalesce("n", F.lit(0))).drop(*unused)


@query(
    "P30_number_series",
    """SELECT CAST(s.generate_series AS INTEGER) AS "Value", coalesce(n, 0) AS n FROM generate_series(0, 63) s
    LEFT JOIN (SELECT p_size, count(*) AS n FROM part GROUP BY 1) ON p_size = s.generate_series""",
)
def number_series(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "part").groupBy("p_size").agg(F.count(F.lit(1)).alias("n"))
    return (
        M.series(spark, 0, 63)
        .join(n, F.col("Value") == F.col("p_size"), "left")
        .select("Value", F.coalesce("n", F.lit(0)).alias("n"))
    )


@query(
    "P31_report_measures",
    "SELECT DISTINCT p_type AS table_name, p_name AS measure_name FROM part",
)
def report_measures(spark: SparkSession, sf: str) -> DataFrame:
    quoted = F.format_string("MEASURE '%s'[%s] = SUM([x]) /* END */ rest [y]", "p_type", "p_name")
    bare = F.format_string("MEASURE %s[%s] = 1 /* END */", "p_type", "p_name")
    text = F.when(F.col("p_partkey") % 2 == 0, quoted).otherwise(bare)
    found = table(spark, sf, "part").select(text.alias("text")).distinct()
    table_name, measure = X.report_measure_parts(F.col("text"), "/* END */")
    return found.select(table_name.alias("table_name"), measure.alias("measure_name")).distinct()

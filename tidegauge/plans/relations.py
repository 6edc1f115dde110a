"""Joins, windows, sorts and set operations (J, W, L and U- rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.money import as_double, money, net_price
from tidegauge.operators import digest as D
from tidegauge.operators import intervals as I
from tidegauge.operators import joins as J
from tidegauge.operators import ordered as O
from tidegauge.operators import sets as S
from tidegauge.plans.tpch import NET, nations
from tidegauge.registry import query
from tidegauge.session import table

MICROS = "CAST(CAST(value AS DECIMAL(12,2)) * 1000000 AS BIGINT)"


def event_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Events as intervals of microseconds: start, and end = start + value seconds."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return (
        table(spark, sf, "events")
        .withColumn("start_us", start)
        .withColumn("end_us", F.col("start_us") + (money("value") * 1000000).cast("bigint"))
    )


@query(
    "J1_dimension_lookup",
    """SELECT p_type AS kind, coalesce(seg, 'none') AS seg, count(*) AS n FROM (SELECT DISTINCT p_partkey, p_type, upper(p_type) AS u FROM part)
    LEFT JOIN (SELECT k, arg_min(seg, (name, seg)) AS seg FROM (SELECT lower(p_type) AS k, CASE WHEN p_size % 2 = 0 THEN lower(p_type) ELSE p_type END AS name, p_brand AS seg
        FROM part WHERE p_type <> 'PROMO') GROUP BY 1) ON lower(u) = k GROUP BY 1, 2""",
)
def dimension_lookup(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    spelled = F.when(F.col("p_size") % 2 == 0, F.lower("p_type")).otherwise(F.col("p_type"))
    dim = part.filter(F.col("p_type") != "PROMO").select(spelled.alias("name"), F.col("p_brand").alias("seg"))
    found = J.lookup(part, dim, F.upper("p_type"), "name", "seg")
    return found.groupBy(F.col("p_type").alias("kind"), F.coalesce("seg", F.lit("none")).alias("seg")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "J2_star_join",
    """SELECT r_name, n_name, c_mktsegment, strftime(o_orderdate, '%Y-%m') AS mon, count(*) AS n,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    fact = J.star(
        table(spark, sf, "orders"),
        (table(spark, sf, "customer"), "o_custkey", "c_custkey"),
        (F.broadcast(table(spark, sf, "nation")), "c_nationkey", "n_nationkey"),
        (F.broadcast(table(spark, sf, "region")), "n_regionkey", "r_regionkey"),
    )
    return fact.groupBy("r_name", "n_name", "c_mktsegment", F.date_format("o_orderdate", "yyyy-MM").alias("mon")).agg(
        F.count(F.lit(1)).alias("n"), as_double(F.sum(money("o_totalprice"))).alias("total")
    )


@query(
    "J3_latest_with_ties",
    """SELECT o_custkey, o_orderkey FROM orders JOIN (SELECT o_custkey AS k, max(o_orderdate) AS d FROM orders GROUP BY 1)
    ON o_custkey = k AND o_orderdate = d""",
)
def latest_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    return J.latest_rows(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query(
    "J4_suffix_join",
    "SELECT s_suppkey AS old_key, s_suppkey + 1000000 AS new_key FROM supplier WHERE s_suppkey % 3 <> 0",
)
def suffix_join(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "supplier").select(
        "s_name", F.col("s_suppkey").alias("old_key"), F.lit("Lake").alias("kind")
    )
    new = table(spark, sf, "supplier").select(
        F.concat("s_name", F.lit("_recovered")).alias("copy_name"),
        (F.col("s_suppkey") + 1000000).alias("new_key"),
        F.when(F.col("s_suppkey") % 3 == 0, "Other").otherwise("Lake").alias("copy_kind"),
    )
    found = J.match_without_suffix(old, new, "s_name", "copy_name", "_recovered", {"kind": "copy_kind"})
    return found.select("old_key", "new_key")


@query(
    "J5_rewrite_references",
    """SELECT o_orderkey, o_orderstatus, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE
        CAST(CASE WHEN o_custkey % 2 = 0 THEN o_custkey + 500000 ELSE o_custkey END AS VARCHAR) || ',x' || o_orderkey END AS refs FROM orders""",
)
def rewrite_references(spark: SparkSession, sf: str) -> DataFrame:
    refs = F.array(F.col("o_custkey").cast("string"), F.concat(F.lit("x"), "o_orderkey"))
    kind = F.col("o_orderkey") % 5
    some = F.when(kind == 0, F.array().cast("array<string>")).when(kind != 1, refs)
    items = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", some.alias("refs"))
    mapping = (
        table(spark, sf, "customer")
        .filter(F.col("c_custkey") % 2 == 0)
        .select(
            F.col("c_custkey").cast("string").alias("old_id"),
            (F.col("c_custkey") + 500000).cast("string").alias("new_id"),
        )
    )
    out = J.rewrite_references(items, "refs", mapping, "old_id", "new_id", "o_orderkey")
    return out.withColumn("refs", F.array_join("refs", ","))


@query(
    "J6_right_outer",
    """SELECT c_custkey, count(o_orderkey) AS n FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY 1""",
)
def right_outer(spark: SparkSession, sf: str) -> DataFrame:
    changed = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n")
    )
    return changed.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "right").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("n")
    )


@query(
    "J7_semi_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    chosen = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(chosen, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query(
    "J8_placeholders",
    """SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT DISTINCT o_custkey, 'Unknown' FROM orders WHERE o_custkey % 2 <> 0""",
)
def placeholder_rows(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "customer").filter(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    wanted = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return J.placeholders(wanted, known, "id", name=F.lit("Unknown"))


@query(
    "J8_not_in",
    "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50)",
)
def not_in(spark: SparkSession, sf: str) -> DataFrame:
    returned = table(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50))
    returned = returned.select("l_partkey")
    return J.not_in(table(spark, sf, "part").select("p_partkey"), "p_partkey", returned, "l_partkey")


@query(
    "J9_unused_columns",
    """SELECT DISTINCT p_brand, p_name FROM part EXCEPT SELECT p_brand, p_name FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_quantity > 49""",
)
def unused_columns(spark: SparkSession, sf: str) -> DataFrame:
    declared = table(spark, sf, "part").select("p_brand", "p_name").distinct()
    used_lines = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 49).select("l_partkey")
    used = table(spark, sf, "part").join(used_lines, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    return J.unused_columns(declared, used, ["p_brand", "p_name"])


WORDS = "SELECT DISTINCT w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE w <> ''"


@query(
    "J10_substring_join",
    f"SELECT doc_id, w FROM documents JOIN ({WORDS}) ON contains(text, w)",
)
def substring_join(spark: SparkSession, sf: str) -> DataFrame:
    words = (
        table(spark, sf, "benchmark")
        .select(F.explode(F.split("text", " ")).alias("w"))
        .distinct()
    )
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return J.texts_containing(docs, "doc_id", "text", words, "w").select("doc_id", "w")


@query(
    "J11_points_in_intervals",
    f"""SELECT strftime(h, '%Y-%m-%d %H') AS at, event_id FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)
    JOIN events ON ts <= h AND h <= ts + to_microseconds({MICROS})""",
)
def points_in_intervals(spark: SparkSession, sf: str) -> DataFrame:
    end = F.col("ts") + F.make_dt_interval(secs=money("value").cast("decimal(18,6)"))
    spans = table(spark, sf, "events").select("event_id", F.col("ts").alias("start_at"), end.alias("end_at"))
    hours = table(spark, sf, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).distinct()
    found = J.points_in_intervals(hours, "h", spans, "start_at", "end_at")
    return found.select(F.date_format("h", "yyyy-MM-dd HH").alias("at"), "event_id")


@query(
    "J12_begin_end",
    """SELECT e.event_id, b.event_id AS begin_id FROM (SELECT * FROM events WHERE event_type IN ('error', 'purchase')) e
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') b ON e.user_id = b.user_id AND e.props = b.props""",
)
def begin_end(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    ends = events.filter(F.col("event_type").isin("error", "purchase")).select("event_id", "user_id", "props", "ts")
    begins = events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("begin_id"), "user_id", "props", F.col("ts").alias("begin_ts")
    )
    return J.pair_begin_end(ends, begins, ["user_id", "props"], "begin_ts").select("event_id", "begin_id")


@query(
    "J13_series_product",
    "SELECT p_partkey, CAST(s AS INTEGER) AS s, p_size * s AS scaled FROM part, (SELECT unnest(range(1, 9)) AS s)",
)
def series_product(spark: SparkSession, sf: str) -> DataFrame:
    out = J.expand_series(table(spark, sf, "part").select("p_partkey", "p_size"), F.lit(1), F.lit(8), "s")
    return out.select("p_partkey", "s", (F.col("p_size") * F.col("s")).cast("bigint").alias("scaled"))


@query(
    "J14_schedule",
    """SELECT p_type, day, tm AS time, count(*) AS n FROM part, (SELECT unnest(['Mon', 'Wed', 'Fri']) AS day), (SELECT unnest([0, 1]) AS i),
        LATERAL (SELECT CASE WHEN i = 0 THEN '06:00' ELSE '18:00' END AS tm)
    WHERE (p_size % 2 = 0 OR day <> 'Wed') AND (p_size % 3 = 0 OR i = 0) GROUP BY 1, 2, 3""",
)
def schedule(spark: SparkSession, sf: str) -> DataFrame:
    days = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("Mon"), F.lit("Wed"), F.lit("Fri"))).otherwise(
        F.array(F.lit("Mon"), F.lit("Fri"))
    )
    hours = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("06:00"), F.lit("18:00"))).otherwise(F.array(F.lit("06:00")))
    items = table(spark, sf, "part").select("p_type", days.alias("days"), hours.alias("times"))
    return J.expand_schedule(items, "days", "times").groupBy("p_type", "day", "time").agg(F.count(F.lit(1)).alias("n"))


@query(
    "J15_alternate_key",
    """SELECT strftime(l_shipdate, '%Y') AS yr, count(*) AS shipped, count(*) FILTER (year(o_orderdate) = year(l_shipdate)) AS same_year
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def alternate_key(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    same = F.year("o_orderdate") == F.year("l_shipdate")
    return lines.groupBy(F.date_format("l_shipdate", "yyyy").alias("yr")).agg(
        F.count(F.lit(1)).alias("shipped"), F.count_if(same).alias("same_year")
    )


@query(
    "J16_credited_usage",
    """WITH u AS (SELECT l_partkey AS obj, count(*) AS n FROM lineitem GROUP BY 1), d AS (SELECT DISTINCT p_partkey AS obj, p_partkey // 2 AS ref FROM part WHERE p_partkey > 0)
    SELECT obj, is_direct, CAST(sum(n) AS BIGINT) AS n FROM (SELECT obj, true AS is_direct, n FROM u UNION ALL SELECT ref, false, n FROM u JOIN d USING (obj)) GROUP BY 1, 2""",
)
def credited_usage(spark: SparkSession, sf: str) -> DataFrame:
    usage = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("obj")).agg(F.count(F.lit(1)).alias("n"))
    refs = table(spark, sf, "part").filter(F.col("p_partkey") > 0).select(
        F.col("p_partkey").alias("obj"), F.shiftright("p_partkey", 1).alias("ref")
    )
    return J.credit_usage(usage, refs, "obj", "ref").groupBy("obj", "is_direct").agg(F.sum("n").alias("n"))


@query(
    "J17_request_view",
    """SELECT c_custkey AS session, o_orderkey AS request, s_name AS db, word FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey, LATERAL (SELECT unnest(string_split(o_orderpriority, '-')) AS word)
    WHERE o_orderstatus = 'O'""",
)
def request_view(spark: SparkSession, sf: str) -> DataFrame:
    requests = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    return (
        table(spark, sf, "customer")
        .join(requests, F.col("c_custkey") == F.col("o_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("c_custkey").alias("session"),
            F.col("o_orderkey").alias("request"),
            F.col("s_name").alias("db"),
            F.explode(F.split("o_orderpriority", "-")).alias("word"),
        )
    )


@query(
    "J18_object_statistics",
    f"""WITH combos AS (SELECT DISTINCT p_type, p_brand FROM part),
    res AS (SELECT p_type, p_brand, count(*) AS measured, count(*) FILTER (p_size > 25) AS resident FROM part GROUP BY 1, 2),
    sizes AS (SELECT p_type, p_brand, CAST(sum(p_size) AS DOUBLE) / count(*) AS avg_size FROM part GROUP BY 1, 2),
    cold AS (SELECT p_type, p_brand, CAST(sum({NET}) AS DOUBLE) / count(*) AS avg_cpu FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'A' GROUP BY 1, 2)
    SELECT * FROM combos LEFT JOIN res USING (p_type, p_brand) LEFT JOIN sizes USING (p_type, p_brand) LEFT JOIN cold USING (p_type, p_brand)""",
)
def object_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Each measurement is averaged on its own before the joins, so that fan-out cannot inflate counts."""
    part = table(spark, sf, "part")
    keys = ["p_type", "p_brand"]
    resident = part.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("measured"),
        F.count_if(F.col("p_size") > 25).alias("resident"),
        (F.sum("p_size").cast("double") / F.count(F.lit(1))).alias("avg_size"),
    )
    cold = (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "A")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(*keys)
        .agg((as_double(F.sum(net_price())) / F.count(F.lit(1))).alias("avg_cpu"))
    )
    return resident.join(cold, keys, "left")


@query(
    "J19_lineage_links",
    """SELECT l_orderkey, l_linenumber, p_name AS source_name, s_name AS sink_name FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = p_size % 25""",
)
def lineage_links(spark: SparkSession, sf: str) -> DataFrame:
    flows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sources = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("source_name"), (F.col("p_size") % 25).alias("container")
    )
    sinks = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("sink_name"), "s_nationkey")
    return (
        flows.join(sources, F.col("l_partkey") == F.col("p_partkey"))
        .join(sinks, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("container") == F.col("s_nationkey")))
        .select("l_orderkey", "l_linenumber", "source_name", "sink_name")
    )


@query(
    "J20_enrichment",
    "SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON r_regionkey = n_regionkey",
)
def enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return J.star(
        table(spark, sf, "supplier"),
        (nations(spark, sf), "s_nationkey", "n_nationkey"),
        (F.broadcast(table(spark, sf, "region")), "n_regionkey", "r_regionkey"),
    ).select("s_suppkey", "s_name", "n_name", "r_name")


# Windows ----------------------------------------------------------------------------------------


@query(
    "W1_surrogate_keys",
    """WITH m AS (SELECT max(c_custkey) AS k FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT lower(c_name) AS name_lower, c_custkey AS key FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT lower(c_name), row_number() OVER (ORDER BY lower(c_name)) + (SELECT k FROM m) FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    from tidegauge.operators.merge import continue_keys

    customers = table(spark, sf, "customer")
    existing = customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.lower("c_name").alias("name_lower"), F.col("c_custkey").alias("key")
    )
    return continue_keys(existing, customers.select(F.lower("c_name").alias("name_lower")), "name_lower", "key")


@query(
    "W2_row_sequence",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders",
)
def row_sequence(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return O.row_numbers(orders, [], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query(
    "W2_row_sequence_per_group",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events",
)
def row_sequence_per_group(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return O.row_numbers(events, ["event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "rn")


@query(
    "W3_deleted_flag",
    """SELECT o_custkey, CASE WHEN max(max(o_orderdate)) OVER () = max(o_orderdate) THEN 'False' ELSE 'True' END AS deleted FROM orders GROUP BY 1""",
)
def deleted_flag(spark: SparkSession, sf: str) -> DataFrame:
    newest = table(spark, sf, "orders").agg(F.max("o_orderdate").alias("d"))
    per_key = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
    return per_key.select(
        "o_custkey", F.when(F.col("d") == newest.scalar(), "False").otherwise("True").alias("deleted")
    )


@query(
    "W4_latest_record",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_record(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return O.latest(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "W5_rank_in_parent",
    "SELECT o_orderkey, o_orderstatus, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC) AS rank FROM orders",
)
def rank_in_parent(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return O.ranks(orders, ["o_orderstatus"], F.col("o_orderdate")).drop("o_orderdate")


@query(
    "W7_missing_hours",
    """WITH seen AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h FROM events),
    grid AS (SELECT user_id, d, CAST(hh AS INTEGER) AS h FROM (SELECT DISTINCT user_id, d FROM seen), (SELECT unnest(range(0, 24)) AS hh)),
    absent AS (SELECT g.* FROM grid g LEFT JOIN seen s ON s.user_id = g.user_id AND s.d = g.d AND s.h = g.h WHERE s.h IS NULL)
    SELECT user_id, strftime(d, '%Y-%m-%d') AS day, CAST(min(h) AS INTEGER) AS start_hour, CAST(max(h) + 1 AS INTEGER) AS end_hour
    FROM (SELECT *, h - row_number() OVER (PARTITION BY user_id, d ORDER BY h) AS island FROM absent) GROUP BY user_id, d, island""",
)
def missing_hours(spark: SparkSession, sf: str) -> DataFrame:
    hours = table(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").alias("h")
    )
    return I.missing_hours(hours, ["user_id", "day"], "h")


UNION_SQL = f"""WITH i AS (SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + {MICROS} AS e, value FROM events),
    r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i)"""


@query(
    "W8_interval_union",
    f"""{UNION_SQL} SELECT user_id, storage, total, cpu, greatest(0, total - storage) AS formula, CASE WHEN storage > 0 THEN cpu / storage ELSE 0 END AS parallelism FROM (
        SELECT user_id, CAST(sum(greatest(0, e - greatest(s, coalesce(reach, s)))) AS BIGINT) AS storage, max(e) - min(s) AS total,
            CAST(sum(e - s) AS BIGINT) AS cpu FROM r GROUP BY 1)""",
)
def interval_union(spark: SparkSession, sf: str) -> DataFrame:
    spans = event_intervals(spark, sf).select("user_id", "event_id", "start_us", "end_us")
    total = F.max("end_us") - F.min("start_us")
    return I.engine_split(
        spans, ["user_id"], "start_us", "end_us", ["event_id"], total, F.sum(F.col("end_us") - F.col("start_us"))
    )


@query(
    "W9_timeline",
    f"""WITH i AS (SELECT user_id, event_id, strftime(ts, '%Y-%m-%d') AS day, epoch_us(date_trunc('day', ts)) AS f, epoch_us(date_trunc('day', ts)) + 86400000000 AS l,
        epoch_us(ts) AS s, epoch_us(ts) + {MICROS} AS e FROM events),
    r AS (SELECT *, greatest(f, coalesce(max(e) OVER (PARTITION BY user_id, day ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f)) AS since FROM i),
    p AS (SELECT user_id, day, f, l, 'event' AS kind, s AS from_at, e AS to_at FROM r UNION ALL SELECT user_id, day, f, l, 'gap', since, s FROM r WHERE s - since > 1000
        UNION ALL SELECT user_id, day, f, l, 'gap', max(e), l FROM i GROUP BY user_id, day, f, l HAVING l - max(e) > 1000)
    SELECT user_id, day, kind, from_at, to_at, from_at - f AS start_offset, to_at - f AS end_offset,
        (from_at - f) * 100 / (l - f) AS relative_start, (to_at - f) * 100 / (l - f) AS relative_end FROM p""",
)
def timeline(spark: SparkSession, sf: str) -> DataFrame:
    spans = event_intervals(spark, sf).select(
        "user_id",
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.unix_micros(F.date_trunc("day", F.col("ts")).cast("timestamp")).alias("day_us"),
        "start_us",
        "end_us",
    )
    last = F.col("day_us") + F.lit(86400000000)
    return I.timeline(spans, ["user_id", "day"], "start_us", "end_us", ["event_id"], F.col("day_us"), last, 1000)


@query(
    "W11_latest_name",
    """SELECT event_id, event_type AS name, arg_max(event_type, (ts, event_id)) OVER (PARTITION BY user_id) AS current_name FROM events""",
)
def latest_name(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", F.col("event_type").alias("name"))
    return I.label_with_latest(events, "user_id", "name", ["ts", "event_id"], "current_name").select(
        "event_id", "name", "current_name"
    )


# Sorts and limits -------------------------------------------------------------------------------


@query("L1_sort", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_name")
def sort(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_acctbal"
    ).orderBy(F.desc("s_acctbal"), "s_name")


@query("L2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "L3_watermark",
    "SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders",
)
def watermark(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_day"),
    )


@query(
    "L4_fastest_run",
    """SELECT o_custkey AS query, o_orderkey AS run, o_totalprice AS total FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def fastest_run(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("query"), F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("total")
    )
    return O.earliest(runs, ["query"], [F.col("total"), F.col("run")])


@query(
    "L5_largest_contributor",
    """WITH n AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT (SELECT user_id FROM u ORDER BY n DESC, user_id LIMIT 1) AS top_user, (SELECT max(n) FROM u) AS top_count,
        (SELECT event_type FROM n ORDER BY n DESC, event_type LIMIT 1) AS dominant_type,
        (SELECT max(n) FROM n) * 100.0 / (SELECT sum(n) FROM n) AS dominant_percent""",
)
def largest_contributor(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    per_type = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    top = per_user.agg(
        F.max_by("user_id", F.struct("n", -F.col("user_id"))).alias("top_user"), F.max("n").alias("top_count")
    )
    dominant = per_type.orderBy(F.desc("n"), "event_type").limit(1).select(F.col("event_type"))
    share = per_type.agg((F.max("n") * F.lit(100.0) / F.sum("n")).alias("p"))
    return top.withColumns({"dominant_type": dominant.scalar(), "dominant_percent": share.scalar()})


# Sets -------------------------------------------------------------------------------------------


@query(
    "UA_tagged_union",
    """SELECT s_name AS name, s_nationkey AS nation, 'supplier' AS role FROM supplier UNION ALL SELECT c_name, c_nationkey, 'customer' FROM customer""",
)
def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    def people(name: str, p: str) -> DataFrame:
        return table(spark, sf, name).select(F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"))

    return S.tagged_union("role", supplier=people("supplier", "s"), customer=people("customer", "c"))


@query(
    "UB_union_distinct",
    """SELECT s_nationkey AS id, 'nation' AS kind FROM supplier UNION SELECT c_nationkey, 'nation' FROM customer UNION SELECT n_nationkey, 'nation' FROM nation
    UNION SELECT r_regionkey, 'region' FROM region""",
)
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    def ids(name: str, col: str, kind: str) -> DataFrame:
        return table(spark, sf, name).select(F.col(col).alias("id"), F.lit(kind).alias("kind"))

    return S.union_distinct(
        ids("supplier", "s_nationkey", "nation"),
        ids("customer", "c_nationkey", "nation"),
        ids("nation", "n_nationkey", "nation"),
        ids("region", "r_regionkey", "region"),
    )


@query(
    "UC_difference",
    """SELECT p_partkey AS id, 'unsold' AS part FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')
    UNION ALL SELECT p_partkey, 'both' FROM (SELECT p_partkey FROM part INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')""",
)
def difference(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    sold = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "A").select(F.col("l_partkey").alias("id"))
    return S.tagged_union("part", unsold=parts.subtract(sold), both=parts.intersect(sold))


@query(
    "UD_result_equivalence",
    """SELECT 'same' AS pair, true AS same_columns, true AS same_count, 0 AS different_rows, true AS equal
    UNION ALL SELECT 'changed', true, true, 2 * count(*) FILTER (o_orderstatus = 'P'), false FROM orders""",
)
def result_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    shuffled = orders.repartition("o_custkey")
    status = F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus"))
    changed = orders.withColumn("o_orderstatus", status)
    return S.tagged_union("pair", same=S.equivalence(orders, shuffled), changed=S.equivalence(orders, changed))


@query(
    "UE_content_signature", "SELECT count(*) AS row_count, true AS unchanged, false AS same_after_edit FROM customer"
)
def content_signature(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    edited = customers.withColumn("c_acctbal", F.when(F.col("c_custkey") == 0, 0.0).otherwise(F.col("c_acctbal")))
    first = S.content_signature(customers)
    again = S.content_signature(customers.repartition("c_nationkey").select(*reversed(customers.columns)))
    other = S.content_signature(edited)
    return first.select(
        "row_count",
        (F.col("content_hash") == again.select("content_hash").scalar()).alias("unchanged"),
        (F.col("content_hash") == other.select("content_hash").scalar()).alias("same_after_edit"),
    )


@query(
    "UE_difference_digest",
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 103 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_custkey
        FROM orders WHERE o_orderkey % 101 <> 0 UNION ALL SELECT -o_orderkey - 1, o_totalprice, o_custkey FROM orders WHERE o_orderkey % 107 = 0)
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
        CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'changed' END AS difference
    FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_custkey IS DISTINCT FROM b.o_custkey""",
)
def difference_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders before and after some were deleted, some changed and some added: the keys that differ, told from digests."""
    before = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    price = F.when(F.col("o_orderkey") % 103 == 0, 0.0).otherwise(F.col("o_totalprice"))
    kept = before.filter(F.col("o_orderkey") % 101 != 0).withColumn("o_totalprice", price)
    added = before.filter(F.col("o_orderkey") % 107 == 0).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return D.differing(before, kept.unionByName(added), ["o_orderkey"])

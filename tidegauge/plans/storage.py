"""Sources and sinks (S and K rows of the inventory).

Each query derives its files from the test tables, reads them back through the library and returns
what was read. Files go to fresh folders below the shared working folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.money import as_double, money
from tidegauge.operators.merge import changes_since
from tidegauge.registry import query
from tidegauge.session import stored, table, work_path
from tidegauge.sources import billing, databases, delimited, files, json_drop, metadata
from tidegauge.tables import maintenance as K
from tidegauge.tables import versioned as V

PAGE = 200  # records per JSON document, as an API page would hold


def write_pages(spark: SparkSession, records: DataFrame, key: str, record, field: str, name: str) -> str:
    """JSON documents with up to PAGE records each, one document per line."""
    path = work_path(spark, name)
    docs = records.groupBy(F.floor(F.col(key) / PAGE)).agg(F.collect_list(record).alias(field))
    docs.select(F.to_json(F.struct(field)).alias("value")).write.text(path)
    return path


@query(
    "S1_json_drop",
    """SELECT event_type AS "Activity", count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, min(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS first_at FROM events GROUP BY 1""",
)
def json_drop_(spark: SparkSession, sf: str) -> DataFrame:
    record = F.struct(
        F.col("event_id").alias("Id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("CreationTime"),
        F.col("user_id").alias("UserId"),
        F.col("event_type").alias("Activity"),
    )
    path = write_pages(spark, table(spark, sf, "events"), "event_id", record, "activityEventEntities", "activities")
    schema = "activityEventEntities array<struct<Id:bigint,CreationTime:string,UserId:bigint,Activity:string>>"
    rows = json_drop.read_json_drop(spark, path, "activityEventEntities", schema=schema, multi_line=False)
    return rows.groupBy("Activity").agg(
        F.count("Id").alias("n"), F.sum("UserId").alias("users"), F.min("CreationTime").alias("first_at")
    )


@query("S2_fallback_field", "SELECT c_custkey AS id, c_mktsegment AS name FROM customer")
def fallback_field(spark: SparkSession, sf: str) -> DataFrame:
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"))
    path = write_pages(spark, table(spark, sf, "customer"), "c_custkey", record, "value", "overrides")
    schema = "value array<struct<id:bigint,name:string>>"
    return json_drop.read_json_drop(
        spark, path, "Overrides", "tenantSettings", "value", schema=schema, multi_line=False
    )


@query(
    "S3_optional_fields",
    "SELECT s_suppkey AS id, s_name AS name, '' AS description FROM supplier",
)
def optional_fields(spark: SparkSession, sf: str) -> DataFrame:
    record = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("extra"))
    path = write_pages(spark, table(spark, sf, "supplier"), "s_suppkey", record, "value", "workspaces")
    rows = json_drop.read_json_drop(spark, path, "value", multi_line=False)  # inferred schema
    return json_drop.with_defaults(rows, drop=["extra", "capacityMigrationStatus"], description=F.lit(""))


@query(
    "S4_billing_period",
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period, count(*) AS n,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS cost FROM orders
    WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2000-05-01' GROUP BY 1""",
)
def billing_period(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "billing")
    start = F.trunc(F.to_date("o_orderdate"), "month")
    folder = F.concat_ws("-", F.date_format(start, "yyyyMMdd"), F.date_format(F.last_day(start), "yyyyMMdd"))
    exported = table(spark, sf, "orders").select(
        start.alias(
            "BillingPeriodStart"
        ), F.col("o_totalprice").alias("EffectiveCost"), folder.alias("period"), F.lit("run").alias("export")
    )
    exported.write.partitionBy("period", "export").parquet(root)
    rows = billing.read_billing_period(spark, root, dt.date(2000, 5, 1), -3, 0, layout="period={period}/*/*.parquet")
    return rows.groupBy(F.col("BillingPeriodStart").cast("string").alias("period")).agg(
        F.count(F.lit(1)).alias("n"), as_double(F.sum(money("EffectiveCost"))).alias("cost")
    )


@query(
    "S5_keyed_csv",
    """SELECT lower(p_name) AS name_lower, p_type AS category, p_size AS size FROM (SELECT *, row_number() OVER (PARTITION BY lower(p_name)
        ORDER BY p_name, p_type, p_size) AS rn FROM (SELECT DISTINCT p_name, p_type, p_size FROM part)) WHERE rn = 1""",
)
def keyed_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "meters")
    table(spark, sf, "part").select("p_name", "p_type", "p_size").write.option("header", True).csv(path)
    rows = delimited.read_keyed_csv(spark, path, "p_name", "name_lower", "p_name string, p_type string, p_size int")
    return rows.select("name_lower", F.col("p_type").alias("category"), F.col("p_size").alias("size"))


@query(
    "S6_load_with_rejects",
    """SELECT 'good' AS part, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_tax = 0)
    UNION ALL SELECT 'bad', count(*), NULL FROM lineitem WHERE l_returnflag = 'R' AND l_tax = 0""",
)
def load_with_rejects(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "load")
    broken = (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)
    quantity = F.when(broken, F.lit("many")).otherwise(F.col("l_quantity").cast("string"))
    table(spark, sf, "lineitem").select(
        "l_orderkey", quantity.alias("q"), "l_returnflag"
    ).write.option("sep", "|").csv(path)
    schema = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("q", T.DoubleType()),
            T.StructField("flag", T.StringType()),
        ]
    )
    good, bad = delimited.load_with_rejects(spark, path, schema, work_path(spark, "loaded"))
    counts = good.select(F.lit("good").alias("part"), F.col("l_orderkey").alias("k")).unionByName(
        bad.filter(F.col("line").isNotNull()).select(F.lit("bad").alias("part"), F.lit(None).cast("bigint").alias("k"))
    )
    return counts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))


@query(
    "S7_price_paid",
    """SELECT '{' || o_orderkey || '}' AS id, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS day,
        CASE o_orderstatus WHEN 'F' THEN 'FlatMaisonette' WHEN 'O' THEN 'Other' ELSE 'Terraced' END AS kind,
        o_orderpriority = '1-URGENT' AS is_new, 'Commonhold' AS duration FROM orders""",
)
def price_paid(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "price-paid")
    code = F.when(F.col("o_orderstatus") == "P", "T").otherwise(F.col("o_orderstatus"))
    blank = F.lit("")
    lines = table(spark, sf, "orders").select(
        F.concat(F.lit("{"), "o_orderkey", F.lit("}")).alias("id"),
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("day"),
        F.lit("SW13 0NP").alias("postcode"),
        code.alias("kind"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Y").otherwise("N").alias("new"),
        F.lit("C").alias("duration"),
        *[blank.alias(f"address{i}") for i in range(7)],
        F.lit("A").alias("category"),
        F.lit("A").alias("status"),
    )
    lines.write.option("quoteAll", True).csv(path)
    rows = delimited.read_price_paid(spark, path)
    return rows.select(
        F.col("TransactionId").alias("id"),
        F.col("Price").alias("price"),
        F.date_format("DateOfTransfer", "yyyy-MM-dd").alias("day"),
        F.col("PropertyType").alias("kind"),
        F.col("IsNew").alias("is_new"),
        F.col("DurationType").alias("duration"),
    )


def write_logs(spark: SparkSession, sf: str) -> str:
    """Events as header CSV log files whose JSON column is broken on error rows."""
    path = work_path(spark, "logs")
    bad = F.col("event_type") == "error"
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("RequestId"),
        F.when(bad, F.concat(F.lit("{broken"), "props")).otherwise(F.col("props")).alias("DataSource"),
        F.when(bad, "N").otherwise("Y").alias("Success"),
    )
    rows.write.options(header=True, extension="log", quote='"', escape='"', maxRecordsPerFile=4000).csv(path)
    return path


LOG_SCHEMA = "RequestId bigint, DataSource string, Success string"


@query(
    "S8_log_folder",
    """SELECT CASE WHEN event_type = 'error' THEN 'N' ELSE 'Y' END AS "Success", count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""",
)
def log_folder(spark: SparkSession, sf: str) -> DataFrame:
    rows = delimited.read_logs(spark, write_logs(spark, sf), "part", LOG_SCHEMA, ["RequestId", "Success"])
    return rows.groupBy("Success").agg(F.count(F.lit(1)).alias("n"), F.sum("RequestId").alias("ids"))


@query(
    "S9_bad_records",
    """SELECT '{broken' || props AS "DataSource", count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1""",
)
def bad_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = (
        spark.read.schema(LOG_SCHEMA)
        .options(header=True, quote='"', escape='"', pathGlobFilter="*.log")
        .csv(write_logs(spark, sf))
    )
    found = delimited.unparsable(rows, "DataSource")
    return found.filter(F.col("line") > 1).groupBy("DataSource").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S10_snapshot",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 0 AS marker FROM customer",
)
def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A whole source table as a first change set, every row an insert.

    The source is read from files here; ``databases.read_snapshot`` reads the same rows from a
    database in parallel ranges.
    """
    folder = K.create_landing_table(spark, work_path(spark, "landing"), "crm", "customer", ["c_custkey"])
    source = table(spark, sf, "customer")
    K.write_change_files(changes_since(source, "c_custkey", None), folder)
    rows = K.read_change_files(spark, folder)
    return rows.select(*source.columns, F.col(K.MARKER).alias("marker"))


@query(
    "S11_incremental_read",
    """SELECT 'batch' AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    UNION ALL SELECT 'moved', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders""",
)
def incremental_read(spark: SparkSession, sf: str) -> DataFrame:
    """Orders before 2000 are recorded as moved; the batch is the rest, and the ledger grows by it."""
    changes = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    cut = F.expr("timestamp_ntz '2000-01-01'")
    moved = changes.filter(F.col("o_orderdate") < cut)
    path = work_path(spark, "moved-ledger")
    databases.record_moved(moved, "o_orderkey", path)
    batch = stored(databases.unmoved(changes, spark.read.parquet(path), "o_orderkey"), "batch")
    databases.record_moved(batch, "o_orderkey", path)
    ledger = spark.read.parquet(path)
    both = batch.select(F.lit("batch").alias("part"), "o_orderkey").unionByName(
        ledger.select(F.lit("moved").alias("part"), "o_orderkey")
    )
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "S13_units",
    """SELECT source, u.unit, sum(n_chars) / u.v AS size FROM documents, (VALUES ('bytes', 1), ('kilobytes', 1024), ('megabytes', 1048576), ('gigabytes', 1073741824)) u(unit, v) GROUP BY source, u.unit, u.v""",
)
def units(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes in every unit of the static unit table, attached without a join."""
    totals = table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("n"))
    return metadata.with_units(totals, "size").select(
        "source", "unit", (F.col("n") / F.col("unit_value")).alias("size")
    )


def _static_sql(rows: list[tuple]) -> str:
    """A static table as VALUES."""

    def value(v) -> str:
        return "'" + v + "'" if isinstance(v, str) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(map(value, row)) + ")" for row in rows) + ")"


REGION_NAMES = [*(r[1] for r in metadata.REGIONS), "Nowhere"]


@query(
    "S13_regions",
    f"""WITH c AS (SELECT c_acctbal, list_extract([{", ".join(f"'{n}'" for n in REGION_NAMES)}], 1 + CAST(c_custkey % {len(REGION_NAMES)} AS INTEGER)) AS region FROM customer)
    SELECT g.continent, c.region, CAST(g.latitude AS DOUBLE) AS latitude, CAST(g.longitude AS DOUBLE) AS longitude, g.location, count(*) AS capacities FROM c
    LEFT JOIN {_static_sql(metadata.REGIONS)} g(continent, region, latitude, longitude, location) ON g.region = c.region GROUP BY 1, 2, 3, 4, 5""",
)
def capacity_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stand for capacities, dealt over the region names and an unknown one."""
    names = F.array(*[F.lit(n) for n in REGION_NAMES])
    capacities = table(spark, sf, "customer").select(
        F.element_at(names, (F.col("c_custkey") % len(REGION_NAMES)).cast("int") + 1).alias("region")
    )
    counted = capacities.groupBy("region").agg(F.count(F.lit(1)).alias("capacities"))
    return metadata.with_static(counted, metadata.regions(spark), "region", "region").select(
        "continent", "region", "latitude", "longitude", "location", "capacities"
    )


TYPE_NAMES = [*(r[0] for r in metadata.CONTENT_TYPES), "NewMode"]


@query(
    "S13_content_types",
    f"""WITH p AS (SELECT p_size, list_extract([{", ".join(f"'{n}'" for n in TYPE_NAMES)}], 1 + CAST(p_partkey % {len(TYPE_NAMES)} AS INTEGER)) AS content_type FROM part)
    SELECT coalesce(t.mapped_name, p.content_type) AS mapped_name, count(*) AS models, CAST(count(*) FILTER (t.in_optimization) AS BIGINT) AS in_optimization,
        CAST(count(*) FILTER (t.is_default) AS BIGINT) AS defaults, CAST(sum(p_size) AS BIGINT) AS size FROM p
    LEFT JOIN {_static_sql(metadata.CONTENT_TYPES)} t(content_type, mapped_name, in_optimization, is_default) ON t.content_type = p.content_type GROUP BY 1""",
)
def semantic_model_types(spark: SparkSession, sf: str) -> DataFrame:
    """Parts stand for semantic models, dealt over the content types and an unknown one, which keeps its name."""
    names = F.array(*[F.lit(n) for n in TYPE_NAMES])
    models = table(spark, sf, "part").select(
        "p_size", F.element_at(names, (F.col("p_partkey") % len(TYPE_NAMES)).cast("int") + 1).alias("provider")
    )
    typed = metadata.with_static(models, metadata.content_types(spark), "provider", "content_type")
    return typed.groupBy(F.coalesce("mapped_name", "provider").alias("mapped_name")).agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if("in_optimization").alias("in_optimization"),
        F.count_if("is_default").alias("defaults"),
        F.sum("p_size").alias("size"),
    )


@query(
    "S14_list_records",
    """SELECT CAST(c_custkey AS VARCHAR) AS "Key", c_mktsegment AS "Segment" FROM customer""",
)
def list_records(spark: SparkSession, sf: str) -> DataFrame:
    fields = F.struct(
        F.col("c_custkey").alias("Key"), F.col("c_mktsegment").alias("Segment"), F.col("c_acctbal").alias("Balance")
    )
    path = write_pages(
        spark, table(spark, sf, "customer"), "c_custkey", F.struct(fields.alias("fields")), "value", "lists"
    )
    docs = json_drop.read_documents(spark, path, multi_line=False)
    return json_drop.list_records(docs, columns=["Key", "Segment"])


@query(
    "S15_storage_summary",
    """SELECT 'data' AS kind, count(DISTINCT o_orderstatus) AS files, true AS filled FROM orders
    UNION ALL SELECT 'log', count(DISTINCT n_regionkey), min(n_regionkey) IS NOT NULL FROM nation""",
)
def storage_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Files by kind in a tree of one data file per order status and one log per region."""
    root = work_path(spark, "tree")
    files.write_one_each(table(spark, sf, "orders"), "o_orderstatus", f"{root}/data")
    table(spark, sf, "nation").coalesce(1).write.partitionBy("n_regionkey").json(f"{root}/logs")
    found = files.storage_summary(spark, root)
    return found.select("kind", "files", (F.col("bytes") > 0).alias("filled"))


NAMES = """region nation customer supplier part orders lineitem events
    documents embeddings pages benchmark labels conversations""".split()


def _fill_sql(name: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, {i + 1} AS position, count({c}) AS filled, count(*) AS rows FROM {name}"
        for i, c in enumerate(columns.split())
    )


COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


@query("S16_column_metadata", " UNION ALL ".join(_fill_sql(n, c) for n, c in COLUMNS.items()))
def column_metadata(spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: table(spark, sf, n) for n in NAMES}
    fill = None
    for name, df in tables.items():
        part = metadata.column_fill(name, df)
        fill = part if fill is None else fill.unionByName(part)
    meta = metadata.column_metadata(spark, tables).select("table_name", "column_name", "position")
    return fill.join(meta, ["table_name", "column_name"])


# Sinks ------------------------------------------------------------------------------------------


@query(
    "K1_append_evolving",
    """SELECT o_orderstatus IS NOT NULL AS has_status, count(*) AS n FROM (
        SELECT CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END AS o_orderstatus FROM orders) GROUP BY 1""",
)
def append_evolving(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "evolving")
    orders = table(spark, sf, "orders")
    V.append(orders.filter(F.year("o_orderdate") < 1998).select("o_orderkey"), path)
    V.append(orders.filter(F.year("o_orderdate") >= 1998).select("o_orderkey", "o_orderstatus"), path)
    return V.read_evolving(spark, path).groupBy(F.col("o_orderstatus").isNotNull().alias("has_status")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("K2_replace_table", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "replaced")
    V.write_version(table(spark, sf, "customer").select("c_custkey"), root)
    V.write_version(table(spark, sf, "customer"), root)
    return V.read_current(spark, root).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "K3_clean_names",
    """SELECT s_suppkey AS supp_key, s_name AS "name_v2", '2024-01-30 00:00:00' AS load_timestamp FROM supplier""",
)
def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "clean")
    at = F.to_timestamp(F.lit("2024-01-30 00:00:00"))
    messy = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("supp key"), F.col("s_name").alias("{name}.v2;")
    )
    V.save_sanitised(messy, path, at)
    V.save_sanitised(messy.limit(0), path, at)
    out = spark.read.parquet(path)
    return out.withColumn("load_timestamp", F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("K4_ensure_table", "SELECT count(*) AS orders_seen, 0 AS rows_in_new FROM orders")
def ensure_table(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    created = V.ensure_table(spark, work_path(spark, "ensured"), orders.schema)
    return orders.agg(F.count(F.lit(1)).alias("orders_seen")).withColumn(
        "rows_in_new", created.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    )


@query(
    "K5_schema_sync",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS BIGINT) AS s_rating, CAST(NULL AS VARCHAR) AS s_note FROM supplier",
)
def schema_sync(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    rows = [
        ("supplier", "s_name", "string"),
        ("supplier", "s_rating", "bigint"),
        ("supplier", "s_note", "string"),
        ("supplier", "s_more", "struct<a:int>"),
    ]
    definition = spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
    existing = metadata.column_metadata(spark, {"supplier": supplier})
    added = {
        r["column_name"]: r["data_type"] for r in V.missing_columns(definition, existing).collect()
    }  # a few column names
    root = work_path(spark, "synced")
    V.write_version(V.with_columns(supplier, added), root)
    return V.read_current(spark, root)


@query(
    "K6_schema_drift",
    """SELECT 'part' AS table_name, 'added' AS change, 'p_note' AS columns, count(*) AS n FROM part
    UNION ALL SELECT 'part', 'dropped', 'p_brand, p_name', count(*) FROM part UNION ALL SELECT 'part', 'retyped', 'p_size', count(*) FROM part""",
)
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    changed = V.retyped(part.drop("p_brand", "p_name"), p_size="bigint").withColumn("p_note", F.lit("x"))
    root = work_path(spark, "drifted")
    V.write_version(changed, root)
    now = V.read_current(spark, root)
    report = metadata.drift_report(
        metadata.drift(metadata.column_metadata(spark, {"part": part}), metadata.column_metadata(spark, {"part": now}))
    )
    return report.withColumn("n", now.agg(F.count(F.lit(1)).alias("n")).scalar())


@query(
    "K7_change_type",
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part",
)
def change_type(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "retyped")
    V.write_version(table(spark, sf, "part"), root)
    V.write_version(V.retyped(V.read_current(spark, root), p_size="string"), root)
    return V.read_current(spark, root)


@query(
    "K8_change_files",
    "SELECT o_orderstatus, count(*) AS n, count(*) AS gapless, count(*) AS in_sequence FROM orders GROUP BY 1",
)
def change_files(spark: SparkSession, sf: str) -> DataFrame:
    """Three change sets: their rows, those in files that follow the file before, and those in files of their set."""
    folder = K.create_landing_table(spark, work_path(spark, "landing"), "sales", "orders", ["o_orderkey"])
    orders = table(spark, sf, "orders").withColumn(K.MARKER, F.lit(0))
    numbers = {}
    for status in ("F", "O", "P"):
        numbers[status] = K.write_change_files(orders.filter(F.col("o_orderstatus") == status), folder)
    rows = K.read_change_files(spark, folder)
    first = F.create_map(*[x for s, n in numbers.items() for x in (F.lit(s), F.lit(n[0]))])
    last = F.create_map(*[x for s, n in numbers.items() for x in (F.lit(s), F.lit(n[-1]))])
    own = F.col("_file").between(first[F.col("o_orderstatus")], last[F.col("o_orderstatus")])
    before = rows.select((F.col("_file") + 1).alias("_next")).distinct()
    followed = rows.join(before, F.col("_file") == F.col("_next"), "left")
    return followed.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_next").isNotNull() | (F.col("_file") == 1)).alias("gapless"),
        F.count_if(own).alias("in_sequence"),
    )


@query(
    "K10_archive",
    """SELECT CAST(year(ts) AS VARCHAR) AS y, strftime(ts, '%m') AS m, strftime(ts, '%d') AS d, count(*) AS n FROM events GROUP BY ALL""",
)
def archive(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "history")
    K.archive(table(spark, sf, "events"), path, F.col("ts"))
    rows = spark.read.schema("event_id bigint, y string, m string, d string").parquet(path)
    return rows.groupBy("y", "m", "d").agg(F.count(F.lit(1)).alias("n"))


@query(
    "K11_backups",
    """SELECT d AS backup_date, count(*) AS n FROM supplier, (VALUES ('2024-01-20'), ('2024-01-29')) v(d) GROUP BY 1""",
)
def backups(spark: SparkSession, sf: str) -> DataFrame:
    path, kept = work_path(spark, "backups"), work_path(spark, "kept")
    for day in ("2024-01-05", "2024-01-20", "2024-01-29", "2024-01-29"):
        K.back_up(table(spark, sf, "supplier"), path, day)
    K.kept_backups(spark.read.parquet(path), "2024-01-30", 10).write.partitionBy("backup_date").parquet(kept)
    rows = spark.read.parquet(kept)
    return rows.groupBy(F.col("backup_date").cast("string").alias("backup_date")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "K12_compaction", "SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, true AS fewer_files FROM lineitem"
)
def compaction(spark: SparkSession, sf: str) -> DataFrame:
    loose, tight = work_path(spark, "loose"), work_path(spark, "tight")
    table(spark, sf, "lineitem").repartition(24).write.parquet(loose)
    size = files.sizes(spark, loose).agg(F.sum("length").alias("b"), F.count(F.lit(1)).alias("n")).first()
    V.compacted(spark.read.parquet(loose), size["b"], 128 << 20).write.parquet(tight)
    rows = spark.read.parquet(tight).agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))
    count = files.sizes(spark, tight).agg(F.count_if(F.col("path").endswith(".parquet")).alias("n"))
    return rows.withColumn("fewer_files", count.scalar() < F.lit(size["n"]))


@query(
    "K13_copy_tables",
    """SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS matches, true AS logged FROM customer
    UNION ALL SELECT 'orders', count(*), count(*), true, true FROM orders""",
)
def copy_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables copied, the rows on both sides, and whether the log has their paths and an end after the start."""
    target = work_path(spark, "copies")
    pairs = {n: (f"{sf}/{n}.parquet", f"{target}/{n}") for n in ("customer", "orders")}
    log = K.copy_tables(spark, pairs)
    counts = K.reconcile(
        {
            n: spark.read.parquet(s) for n, (s, _) in pairs.items()
        }, {n: spark.read.parquet(t) for n, (_, t) in pairs.items()}
    )
    paths = (F.col("source") == F.concat(F.lit(f"{sf}/"), "table_name", F.lit(".parquet"))) & (
        F.col("target") == F.concat(F.lit(f"{target}/"), "table_name")
    )
    timed = (F.col("ended") >= F.col("started")) & (F.col("seconds") >= 0)
    return counts.join(F.broadcast(log), "table_name").select(*counts.columns, (paths & timed).alias("logged"))


@query(
    "K13_moved_paths",
    """WITH t AS (SELECT p_partkey AS k, 'abfss://' || CASE WHEN p_size % 3 = 0 THEN 'sales' WHEN p_size % 3 = 1 THEN 'sales2' ELSE 'audit' END || '@' AS w,
        CASE WHEN p_size % 2 = 0 THEN 'raw' ELSE 'raw_old' END AS l, '/Tables/t' || p_partkey AS r, p_size FROM part)
    SELECT k, CASE WHEN p_size % 3 = 0 THEN 'abfss://dr@' ELSE w END || 'host/' || CASE WHEN l = 'raw' THEN 'copy' ELSE l END || '.Lakehouse' || r || '_recovered' AS by_name,
        CASE WHEN p_size % 3 = 0 THEN 'abfss://dr@' ELSE w END || 'host/' || CASE WHEN l = 'raw' THEN 'copy' ELSE l END || r AS by_id FROM t""",
)
def moved_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Parts stand for tables of three workspaces and two lakehouses with similar names; those of one of each move."""
    size = F.col("p_size")
    workspace = F.when(size % 3 == 0, "sales").when(size % 3 == 1, "sales2").otherwise("audit")
    lakehouse = F.when(size % 2 == 0, "raw").otherwise("raw_old")

    def path(kind: str):
        parts = [F.lit("abfss://"), workspace, F.lit("@host/"), lakehouse, F.lit(f"{kind}/Tables/t"), F.col("p_partkey")]
        return F.concat(*parts)

    tables = table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), path(".Lakehouse").alias("named"), path("").alias("numbered")
    )
    moves = ("sales", "dr"), ("raw", "copy")
    return tables.select(
        "k",
        K.moved_path(F.col("named"), *moves, suffix="_recovered").alias("by_name"),
        K.moved_path(F.col("numbered"), *moves, by_id=True, suffix="_recovered").alias("by_id"),
    )


@query(
    "K14_split_names",
    "SELECT 'dbo' AS schema_name, 'nation' AS table_name, count(*) AS n FROM nation UNION ALL SELECT 'sales', 'orders', count(*) FROM orders",
)
def split_names(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "reingest")
    out = None
    for full in ("dbo__nation", "sales__orders"):
        schema, name = V.split_name(full)
        V.write_version(table(spark, sf, name), f"{root}/{schema}/{name}")
        rows = V.read_current(spark, f"{root}/{schema}/{name}").agg(F.count(F.lit(1)).alias("n"))
        row = rows.select(F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "K15_batched_copy",
    "SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS matches FROM orders",
)
def batched_copy(spark: SparkSession, sf: str) -> DataFrame:
    orders, path = table(spark, sf, "orders"), work_path(spark, "batched")
    # Range cuts from a sketch: a handful of numbers reach the driver, never rows.
    cuts = orders.agg(F.percentile_approx("o_orderkey", [0.25, 0.5, 0.75], 1000)).first()[0]
    K.copy_in_batches(orders, path, "o_orderkey", cuts)
    K.copy_in_batches(orders, path, "o_orderkey", cuts)  # a restart copies nothing twice
    return K.reconcile({"orders": orders}, {"orders": spark.read.parquet(path)})


@query(
    "K17_insensitive_view",
    "SELECT lower(c_mktsegment) AS segment, count(*) AS n FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery') GROUP BY 1",
)
def insensitive_view(spark: SparkSession, sf: str) -> DataFrame:
    spelled = F.when(
        F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")
    ).otherwise(F.regexp_replace("c_mktsegment", "I", "Í"))
    view = V.insensitive(table(spark, sf, "customer").select("c_custkey", spelled.alias("c_mktsegment")))
    chosen = view.filter(F.col("c_mktsegment").isin("Building", "Machinery"))
    per = chosen.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    plain = F.translate(F.lower(F.collate("c_mktsegment", "UTF8_BINARY")), "í", "i")
    return per.select(plain.alias("segment"), "n")


@query(
    "K19_run_ledger",
    """SELECT CAST(o_custkey % 50 AS VARCHAR) AS run_id, count(*) AS n FROM orders WHERE o_custkey % 50 NOT IN (7, 9) GROUP BY 1""",
)
def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer residue is a load run; two runs never completed and their rows are purged."""
    rows = table(spark, sf, "orders").withColumn("run_id", (F.col("o_custkey") % 50).cast("string"))
    at = F.to_timestamp(F.lit("2024-01-30"))
    ledger = rows.select("run_id").distinct().select("run_id", F.lit("completed").alias("status"), at.alias("at"))
    ledger = K.finish_run(K.finish_run(ledger, "7", "failed", at), "9", "started", at)
    root = work_path(spark, "runs")
    V.write_version(rows, root)
    V.write_version(K.purge_incomplete(V.read_current(spark, root), ledger), root)
    return V.read_current(spark, root).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "K19_purge_every_table",
    """SELECT table_name, run_id, CASE WHEN run_id IN ('7', '9') THEN 'removed' ELSE 'completed' END AS status,
        CASE WHEN run_id IN ('7', '9') THEN 0 ELSE count(*) END AS n
    FROM (SELECT 'orders' AS table_name, CAST(o_custkey % 10 AS VARCHAR) AS run_id FROM orders
        UNION ALL SELECT 'customer', CAST(c_custkey % 10 AS VARCHAR) FROM customer) GROUP BY 1, 2""",
)
def purge_every_table(spark: SparkSession, sf: str) -> DataFrame:
    """Ten load runs over two tables: all started, one failed, one never completed; both are purged and marked."""
    keys = {"orders": "o_custkey", "customer": "c_custkey"}
    roots = {n: work_path(spark, f"runs-{n}") for n in keys}
    for name, key in keys.items():
        V.write_version(table(spark, sf, name).withColumn("run_id", (F.col(key) % 10).cast("string")), roots[name])
    at = F.to_timestamp(F.lit("2024-01-30"))
    ledger = spark.createDataFrame([], "run_id string, status string, at timestamp")
    for run in map(str, range(10)):
        ledger = K.start_run(ledger, run, at)
        if run != "9":
            ledger = K.finish_run(ledger, run, "failed" if run == "7" else "completed", at)
    ledger = K.purge_tables(spark, list(roots.values()), stored(ledger, "run-ledger"))
    out = None
    for name, root in roots.items():
        counts = V.read_current(spark, root).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
        part = ledger.join(counts, "run_id", "left").select(
            F.lit(name).alias("table_name"), "run_id", "status", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
        )
        out = part if out is None else out.unionByName(part)
    return out

"""Graphs and recursion (R rows of the inventory) on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import graph as G
from tidegauge.registry import query
from tidegauge.session import spread, table


@query(
    "R1_dependency_closure",
    """WITH RECURSIVE e AS (SELECT o_orderkey AS src, o_orderkey // 2 AS dst FROM orders WHERE o_orderkey > 0),
    c(root, node, level) AS (SELECT src, dst, 1 FROM e UNION SELECT c.root, e.dst, c.level + 1 FROM c JOIN e ON e.src = c.node)
    SELECT root, node, CAST(min(level) AS INTEGER) AS level FROM c GROUP BY 1, 2""",
)
def dependency_closure(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "orders").filter(F.col("o_orderkey") > 0).select(
        F.col("o_orderkey").alias("src"), F.shiftright("o_orderkey", 1).alias("dst")
    )
    return G.closure(edges, "src", "dst")


@query(
    "R2_reachable_definitions",
    """WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0 UNION SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey > 0),
    r(node, level) AS (SELECT p_partkey, 0 FROM part WHERE p_size = 50 UNION SELECT e.dst, r.level + 1 FROM r JOIN e ON e.src = r.node)
    SELECT 'm' || node AS node, CAST(min(level) AS INTEGER) AS level FROM r GROUP BY 1""",
)
def reachable_definitions(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    text = F.when(
        key > 0, F.format_string("SUM([m%d]) + [m%d] / [missing]", F.floor(key / 2), F.floor(key / 3))
    ).otherwise("1")
    parts = table(spark, sf, "part").select(F.concat(F.lit("m"), key).alias("name"), text.alias("body"), "p_size")
    roots = parts.filter(F.col("p_size") == 50).select("name")
    return G.reachable(G.token_edges(parts, "name", "body"), roots, "src", "dst")


@query(
    "R3_upstream_edges",
    """WITH f AS (SELECT DISTINCT 'p' || l_partkey AS i, 's' || l_suppkey AS u, p_brand AS c, n_name AS uc FROM lineitem JOIN part ON p_partkey = l_partkey
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
    SELECT 'item' AS kind, i AS src, u AS dst FROM f UNION SELECT 'container', c, uc FROM f UNION SELECT 'contains', c, i FROM f UNION SELECT 'contains', uc, u FROM f""",
)
def upstream_edges(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    flows = (
        spread(lines.distinct(), lines.count(), "l_partkey")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("p"), "l_partkey").alias("i"),
            F.concat(F.lit("s"), "l_suppkey").alias("u"),
            "p_brand",
            "n_name",
        )
    )
    return G.upstream_edges(flows, "i", "u", "p_brand", "n_name")


GRAPH_SQL = """WITH uses AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag = 'A'),
    reads AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag = 'R'),
    n AS (SELECT 'trigger' AS kind, n_name AS name, CAST(1 AS BIGINT) AS usage FROM nation
        UNION ALL SELECT 'pipeline', CAST(s_suppkey AS VARCHAR), s_nationkey % 4 FROM supplier WHERE s_suppkey % 9 <> 0
        UNION ALL SELECT 'dataset', CAST(p_partkey AS VARCHAR), (SELECT count(*) FROM uses WHERE p = p_partkey) FROM part
        UNION ALL SELECT DISTINCT 'linkedService', p_brand, 7 FROM part),
    e AS (SELECT 'trigger_' || n_name AS source, 'pipeline_' || s_suppkey AS target, 'triggers' AS kind, 1 AS o FROM supplier JOIN nation ON n_nationkey = s_nationkey
        UNION ALL SELECT 'pipeline_' || s, 'dataset_' || p, 'uses', 2 FROM uses UNION ALL SELECT 'dataset_' || p_partkey, 'linkedService_' || p_brand, 'references', 3 FROM part
        UNION ALL SELECT 'pipeline_' || s, 'dataset_' || p, 'dependsOn', 5 FROM reads)"""

KINDS = ["triggers", "uses", "references", "executes", "dependsOn"]


def factory(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as pipelines, parts as datasets, brands as services, nations as triggers."""
    lines = table(spark, sf, "lineitem")
    uses = lines.filter(F.col("l_returnflag") == "A").select("l_suppkey", "l_partkey").distinct()
    reads = lines.filter(F.col("l_returnflag") == "R").select("l_suppkey", "l_partkey").distinct()
    part, supplier, nation = (table(spark, sf, n) for n in ("part", "supplier", "nation"))
    usage = uses.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("usage"))

    def node(df: DataFrame, kind: str, name, usage_col) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), name.cast("string").alias("name"), usage_col.cast("bigint").alias("usage")
        )

    nodes = (
        node(nation, "trigger", F.col("n_name"), F.lit(1))
        .unionByName(
            node(supplier.filter(F.col("s_suppkey") % 9 != 0), "pipeline", F.col("s_suppkey"), F.col("s_nationkey") % 4)
        )
        .unionByName(
            node(
                part.join(usage, F.col("p_partkey") == F.col("l_partkey"), "left"),
                "dataset",
                F.col("p_partkey"),
                F.coalesce("usage", F.lit(0)),
            )
        )
        .unionByName(node(part.select("p_brand").distinct(), "linkedService", F.col("p_brand"), F.lit(7)))
    )

    def edge(df: DataFrame, sk: str, s, tk: str, t, kind: str) -> DataFrame:
        return df.select(
            F.lit(sk).alias("source_kind"), s.cast("string").alias("source"), F.lit(tk).alias("target_kind"), t.cast("string").alias("target"), F.lit(kind).alias("kind")
        )

    fired = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    edges = (
        edge(fired, "trigger", F.col("n_name"), "pipeline", F.col("s_suppkey"), "triggers")
        .unionByName(edge(uses, "pipeline", F.col("l_suppkey"), "dataset", F.col("l_partkey"), "uses"))
        .unionByName(edge(part, "dataset", F.col("p_partkey"), "linkedService", F.col("p_brand"), "references"))
        .unionByName(edge(reads, "pipeline", F.col("l_suppkey"), "dataset", F.col("l_partkey"), "dependsOn"))
    )
    return nodes, edges


@query(
    "R4_graph_nodes",
    f"""{GRAPH_SQL} SELECT kind || '_' || name AS id, kind, name AS label, CASE
        WHEN kind = 'trigger' AND usage > 2 THEN 'high' WHEN kind = 'trigger' THEN 'medium' WHEN kind = 'dataset' AND usage > 5 THEN 'high' WHEN kind = 'dataset' AND usage > 2 THEN 'medium'
        WHEN kind = 'linkedService' AND usage > 10 THEN 'high' WHEN kind = 'linkedService' AND usage > 5 THEN 'medium' WHEN kind = 'pipeline' AND usage > 2 THEN 'high'
        WHEN kind = 'pipeline' AND usage > 0 THEN 'medium' ELSE 'low' END AS criticality FROM n
    UNION ALL SELECT 'pipeline_' || s_suppkey, 'pipeline', s_suppkey || ' (referenced)', 'low' FROM supplier WHERE s_suppkey % 9 = 0""",
)
def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return G.dependency_graph(*factory(spark, sf), KINDS)[0]


@query(
    "R4_graph_edges",
    f"{GRAPH_SQL} SELECT source, target, arg_min(kind, o) AS kind FROM e GROUP BY 1, 2",
)
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.dependency_graph(*factory(spark, sf), KINDS)[1]


@query(
    "R5_copy_lineage",
    """SELECT p_partkey, 'copy' || p_size AS activity, 'SqlSource' AS source_type, p_brand AS source_container, p_name AS source_table, 'LakeSink' AS sink_type,
        'lake' AS sink_container, p_type AS sink_table, c || ' (String varchar)' AS source_column, c || '_out (string)' AS sink_column FROM part, (VALUES ('a'), ('b')) v(c)""",
)
def copy_lineage(spark: SparkSession, sf: str) -> DataFrame:
    def end(kind: str, container, tbl):
        settings = F.struct(
            F.struct(
                container.alias("name")
            ).alias("linkedService"), F.struct(tbl.alias("table")).alias("typeProperties")
        )
        return F.struct(F.lit(kind).alias("type"), settings.alias("datasetSettings"))

    def mapping(c: str):
        source = F.struct(F.lit(c).alias("name"), F.lit("String").alias("type"), F.lit("varchar").alias("physicalType"))
        sink = F.struct(F.lit(f"{c}_out").alias("name"), F.lit("string").alias("physicalType"))
        return F.struct(source.alias("source"), sink.alias("sink"))

    def activity(kind: str):
        properties = F.struct(
            end("SqlSource", F.col("p_brand"), F.col("p_name")).alias("source"),
            end("LakeSink", F.lit("lake"), F.col("p_type")).alias("sink"),
            F.struct(F.array(mapping("a"), mapping("b")).alias("mappings")).alias("translator"),
        )
        return F.struct(
            F.concat(F.lit("copy"), "p_size").alias("name"),
            F.lit(kind).alias("type"),
            properties.alias("typeProperties"),
        )

    body = F.struct(F.struct(F.array(activity("Lookup"), activity("Copy")).alias("activities")).alias("properties"))
    pipelines = table(spark, sf, "part").select("p_partkey", F.to_json(body).alias("definition"))
    return G.copy_lineage(pipelines, "definition")


@query(
    "R6_effective_reads",
    """WITH cols AS (SELECT DISTINCT p_type AS tab, p_brand AS col FROM part)
    SELECT 'u' || c_custkey AS principal, tab, col FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN cols
        ON (n_regionkey = 0 AND tab = 'ECONOMY') OR (n_regionkey = 1 AND tab = 'PROMO') OR (n_regionkey = 2 AND tab = 'SMALL')
    WHERE NOT (n_regionkey = 0 AND col = 'Brand#1') AND NOT (n_nationkey % 2 = 1 AND col IN ('Brand#2', 'Brand#3')) AND n_regionkey <> 2""",
)
def effective_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Customers are users, nations groups, regions roles; region 2 is denied every column."""
    nation = table(spark, sf, "nation")
    group, role = F.concat(F.lit("g"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey")
    users = table(spark, sf, "customer").select(
        F.concat(F.lit("u"), "c_custkey").alias("member"), F.concat(F.lit("g"), "c_nationkey").alias("parent")
    )
    members = users.unionByName(nation.select(group.alias("member"), role.alias("parent")))
    columns = table(spark, sf, "part").select(
        F.col("p_type").alias("table"), F.col("p_brand").alias("column")
    ).distinct()
    role_table = F.when(
        F.col("n_regionkey") == 0, "ECONOMY"
    ).when(F.col("n_regionkey") == 1, "PROMO").when(F.col("n_regionkey") == 2, "SMALL")
    grants = nation.select(
        role.alias("principal"), role_table.alias("table")
    ).filter(F.col("table").isNotNull()).distinct()
    odd = nation.filter(F.col("n_nationkey") % 2 == 1).select(
        group.alias("principal"), F.explode(F.array(F.lit("Brand#2"), F.lit("Brand#3"))).alias("column")
    )
    denies = (
        odd.join(columns, "column")
        .select("principal", "table", "column")
        .unionByName(
            columns.filter(F.col("column") == "Brand#1").select(F.lit("r0").alias("principal"), "table", "column")
        )
        .unionByName(columns.select(F.lit("r2").alias("principal"), "table", "column"))
    )
    out = G.effective_reads(members, grants, denies, columns).filter(F.col("principal").startswith("u"))
    return out.select("principal", F.col("table").alias("tab"), F.col("column").alias("col"))


@query(
    "R7_usage_counts",
    """SELECT name, count(*) AS usage FROM (SELECT 'p' || l_partkey AS name FROM lineitem UNION ALL SELECT 's' || l_suppkey FROM lineitem WHERE l_returnflag <> 'N') GROUP BY 1""",
)
def usage_counts(spark: SparkSession, sf: str) -> DataFrame:
    inputs = F.array(F.concat(F.lit("p"), "l_partkey"))
    outputs = F.when(F.col("l_returnflag") != "N", F.array(F.concat(F.lit("s"), "l_suppkey")))
    refs = table(spark, sf, "lineitem").select(inputs.alias("inputs"), outputs.alias("outputs"))
    return G.usage_counts(refs, "name", "inputs", "outputs")

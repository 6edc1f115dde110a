"""Dependency graphs: closure, reachability, typed graphs, privileges, usage counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.ordered import row_numbers
from tidegauge.session import cut_lineage, settings, stored, tasks_for, work_path

PAIRS_PER_EDGE = 4  # what a closure's buckets are made for; paths are a few steps long at least
# Buckets are read as they lie below a union too; a task writes its one bucket without sorting it first.
BUCKETED = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.maxConcurrentOutputFileWriters": "8"}


def closure(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """All (root, node) pairs reachable over edges, with the smallest number of steps as ``level``.

    Path lengths double per round: pairs exactly k steps apart meet all pairs up to k steps, so a
    chain of a thousand references takes ten joins. Only the shortest path is kept, which also
    ends cycles. Pairs stay in files bucketed by root: a round shuffles its frontier and the pairs it
    finds, meets those of earlier rounds where they lie, and appends only what is new.
    """
    spark = edges.sparkSession
    buckets = tasks_for(PAIRS_PER_EDGE * edges.count())
    path = work_path(spark, "closure")
    name = path.rpartition("/")[2].replace("-", "_")

    def append(pairs: DataFrame) -> DataFrame:
        pairs.write.mode("append").bucketBy(buckets, "root").option("path", path).saveAsTable(name)
        return spark.table(name)

    with settings(spark, BUCKETED):
        first = edges.select(F.col(src).alias("root"), F.col(dst).alias("node")).repartition(buckets, "root")
        known = append(first.distinct().withColumn("level", F.lit(1)))
        reach = 1
        while True:
            frontier = known.filter(F.col("level") == reach)
            if frontier.limit(1).count() == 0:
                break
            step = frontier.select("root", F.col("node").alias("via")).join(
                known.select(F.col("root").alias("via"), "node", F.col("level").alias("more")), "via"
            )
            longer = step.select("root", "node", (F.col("more") + reach).alias("level")).repartition(buckets, "root")
            shortest = known.unionByName(longer).groupBy("root", "node").agg(F.min("level").alias("level"))
            known = append(shortest.filter(F.col("level") > reach))
            reach *= 2
    spark.sql(f"DROP TABLE {name}")  # from the catalog; the files stay
    return spark.read.schema(known.schema).parquet(path)


def token_edges(definitions: DataFrame, name: str, text: str, pattern: str = r"\[([^\]]+)\]") -> DataFrame:
    """(definition, referenced definition) pairs found in definition texts."""
    tokens = definitions.select(
        F.col(name).alias("src"), F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias("dst")
    )
    names = definitions.select(F.col(name).alias("dst")).distinct()
    return tokens.distinct().join(names, "dst", "left_semi").select("src", "dst")


def reachable(edges: DataFrame, roots: DataFrame, src: str, dst: str, node: str = "node") -> DataFrame:
    """Nodes reached from any root, breadth first, with their level (roots are level 0)."""
    seen = cut_lineage(roots.select(F.col(roots.columns[0]).alias(node)).distinct().withColumn("level", F.lit(0)))
    frontier, level = seen, 0
    links = edges.select(F.col(src).alias("_src"), F.col(dst).alias("_dst")).distinct()
    while not frontier.isEmpty():
        level += 1
        found = frontier.join(links, F.col(node) == F.col("_src")).select(F.col("_dst").alias(node)).distinct()
        frontier = cut_lineage(found.join(seen.select(node), node, "left_anti").withColumn("level", F.lit(level)))
        seen = seen.unionByName(frontier)
    return seen


def upstream_edges(
    df: DataFrame, item: str, upstream_item: str, container: str, upstream_container: str
) -> DataFrame:
    """Distinct edges: item → upstream item, container → upstream container, and both containments."""

    def edge(kind: str, a: str, b: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst")
        )

    edges = F.array(
        edge("item", item, upstream_item),
        edge("container", container, upstream_container),
        edge("contains", container, item),
        edge("contains", upstream_container, upstream_item),
    )
    return df.select(F.explode(edges).alias("e")).select("e.*").distinct()


# Usage above which an artifact is highly / fairly critical.
CRITICAL = {"dataset": (5, 2), "linkedService": (10, 5), "pipeline": (2, 0)}


def criticality(kind: Column, usage: Column) -> Column:
    out = F.when((kind == "trigger") & (usage > 2), "high").when(kind.isin("trigger", "dataflow"), "medium")
    for name, (high, medium) in CRITICAL.items():
        out = out.when((kind == name) & (usage > high), "high").when((kind == name) & (usage > medium), "medium")
    return out.otherwise("low")


def dependency_graph(nodes: DataFrame, edges: DataFrame, kinds: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Typed nodes with criticality, and one edge per (source, target).

    ``nodes`` hold ``kind``, ``name`` and ``usage``; ``edges`` hold ``source_kind``, ``source``,
    ``target_kind``, ``target`` and ``kind``. Of several edges between two nodes the kind that
    comes first in ``kinds`` stays. Missing targets become placeholder nodes.
    """

    def node_id(kind: str, name: str) -> Column:
        return F.concat_ws("_", F.col(kind), F.col(name))

    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    ids = edges.select(
        node_id("source_kind", "source").alias("source"),
        node_id("target_kind", "target").alias("target"),
        F.struct(order.alias("place"), F.col("kind")).alias("_kind"),
        F.struct("target_kind", F.col("target").alias("name")).alias("_target"),
    )
    kept = ids.groupBy("source", "target").agg(F.min("_kind").alias("_kind"), F.min("_target").alias("_target"))
    own = nodes.select(
        node_id("kind", "name").alias("id"), "kind", F.col("name").alias("label"), criticality(
            F.col("kind"), F.col("usage")
        ).alias("criticality")
    )
    missing = (
        kept.select(
            F.col("target").alias("id"), F.col("_target.target_kind").alias("kind"), F.col("_target.name").alias("name")
        )
        .distinct()
        .join(own.select("id"), "id", "left_anti")
        .select(
            "id", "kind", F.concat("name", F.lit(" (referenced)")).alias("label"), F.lit("low").alias("criticality")
        )
    )
    return own.unionByName(missing), kept.select("source", "target", F.col("_kind.kind").alias("kind"))


COPY_ACTIVITIES = (
    "properties struct<activities:array<struct<name:string,type:string,typeProperties:struct<"
    "source:struct<type:string,datasetSettings:struct<linkedService:struct<name:string>,typeProperties:struct<table:string>>>,"
    "sink:struct<type:string,datasetSettings:struct<linkedService:struct<name:string>,typeProperties:struct<table:string>>>,"
    "translator:struct<mappings:array<struct<source:struct<name:string,type:string,physicalType:string>,"
    "sink:struct<name:string,physicalType:string>>>>>>>>"
)


def copy_lineage(pipelines: DataFrame, definition: str) -> DataFrame:
    """One row per copy activity and column mapping of pipeline definitions held as JSON text."""
    parsed = pipelines.withColumn("_d", F.from_json(definition, COPY_ACTIVITIES))
    acts = parsed.withColumn("_a", F.explode("_d.properties.activities")).filter(F.col("_a.type") == "Copy")
    tp = "_a.typeProperties"
    rows = acts.withColumn("_m", F.explode_outer(f"{tp}.translator.mappings"))
    keep = [c for c in pipelines.columns if c != definition]
    return rows.select(
        *keep,
        F.col("_a.name").alias("activity"),
        F.col(f"{tp}.source.type").alias("source_type"),
        F.col(f"{tp}.source.datasetSettings.linkedService.name").alias("source_container"),
        F.col(f"{tp}.source.datasetSettings.typeProperties.table").alias("source_table"),
        F.col(f"{tp}.sink.type").alias("sink_type"),
        F.col(f"{tp}.sink.datasetSettings.linkedService.name").alias("sink_container"),
        F.col(f"{tp}.sink.datasetSettings.typeProperties.table").alias("sink_table"),
        F.format_string(
            "%s (%s %s)", "_m.source.name", "_m.source.type", "_m.source.physicalType"
        ).alias("source_column"),
        F.format_string("%s (%s)", "_m.sink.name", "_m.sink.physicalType").alias("sink_column"),
    )


WORD = 64  # columns of a table per bitmap word


def column_words(columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns as bits: (table, column, word, bit), and per (table, word) all bits with at most 64 column names."""
    known = columns.select("table", "column").dropna().distinct()
    place = F.col("_nth") - 1
    placed = row_numbers(known, ["table"], [F.col("column")], "_nth").select(
        "table",
        "column",
        F.floor(place / WORD).alias("word"),
        F.expr(f"shiftleft(1L, CAST((_nth - 1) % {WORD} AS INT))").alias("bit"),
    )
    names = F.collect_list(F.struct("bit", "column")).alias("names")
    return placed, placed.groupBy("table", "word").agg(F.bit_or("bit").alias("all"), names)


def effective_reads(members: DataFrame, grants: DataFrame, denies: DataFrame, columns: DataFrame) -> DataFrame:
    """Readable (principal, table, column) rows of every member.

    ``members``: member, parent (users in groups, groups in groups or roles); ``grants``: principal,
    table; ``denies``: principal, table, column; ``columns``: table, column. A principal has what it
    and all its parents are granted, minus the columns any of them is denied. A table whose columns
    are all denied has no rows left, which denies the table. Nulls match nothing.

    A table's columns are words of 64 bits. Memberships are closed over groups only, and denied words
    are united per group. Members with the same direct parents (told by two hashes and a count) share
    one profile, for which granted words lose the denied ones; members meet their profile's words last.
    No member is paired with a column before the denies are applied.
    """
    placed, words = column_words(columns)
    denied = (
        denies.join(placed, ["table", "column"]).groupBy("principal", "table", "word").agg(F.bit_or("bit").alias("off"))
    )
    people = members.select("member").dropna().distinct()
    links = members.select("member", F.col("parent").alias("via")).dropna().distinct()
    groups = links.select("via").distinct()
    holders = grants.select("principal").unionByName(denies.select("principal")).dropna().distinct()
    own = people.join(holders, F.col("member") == F.col("principal"), "left_semi")
    nodes = groups.unionByName(own.select(F.col("member").alias("via"))).distinct()
    between = links.join(groups.withColumnRenamed("via", "member"), "member", "left_semi")
    up = (
        closure(between, "member", "via")
        .select(F.col("root").alias("via"), F.col("node").alias("principal"))
        .unionByName(nodes.select("via", F.col("via").alias("principal")))
        .distinct()
    )
    can = up.join(grants.select("principal", "table"), "principal").select("via", "table").distinct()
    cannot = up.join(denied, "principal").groupBy("via", "table", "word").agg(F.bit_or("off").alias("off"))

    direct = stored(
        links.unionByName(own.select("member", F.col("member").alias("via"))).distinct(), "direct-memberships"
    )
    marks = ["_sum", "_xor", "_n"]
    profiles = direct.groupBy("member").agg(
        F.sum(F.xxhash64("via").cast("decimal(20,0)")).alias("_sum"),
        F.bit_xor(F.xxhash64("via", F.lit("profile"))).alias("_xor"),
        F.count(F.lit(1)).alias("_n"),
    )
    first = profiles.groupBy(*marks).agg(F.min("member").alias("profile"))
    shown = direct.join(first.select(F.col("profile").alias("member")), "member", "left_semi").select(
        F.col("member").alias("profile"), "via"
    )
    granted = shown.join(can, "via").select("profile", "table").distinct().join(words, "table")
    taken = shown.join(cannot, "via").groupBy("profile", "table", "word").agg(F.bit_or("off").alias("off"))
    left = granted.join(taken, ["profile", "table", "word"], "left").withColumn(
        "on", F.col("all").bitwiseAND(F.bitwise_not(F.coalesce("off", F.lit(0).cast("bigint"))))
    )
    readable = left.filter(F.col("on") != 0).select(
        "profile",
        "table",
        F.filter("names", lambda c: c["bit"].bitwiseAND(F.col("on")) != 0).alias("names"),
    )
    of = profiles.join(first, marks).select(F.col("member").alias("principal"), "profile")
    return (
        of.join(readable, "profile")
        .select("principal", "table", F.explode("names.column").alias("column"))
    )


def usage_counts(refs: DataFrame, name: str, inputs: str, outputs: str) -> DataFrame:
    """How often each artifact is referenced, inputs and outputs together."""
    both = refs.select(
        F.explode(
            F.concat(
                F.coalesce(inputs, F.array().cast("array<string>")),
                F.coalesce(outputs, F.array().cast("array<string>")),
            )
        ).alias(name)
    )
    return both.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("usage"))

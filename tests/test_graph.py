import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidegauge.operators import graph as G


def brute_closure(edges):
    out = {}
    for root in {a for a, _ in edges}:
        level, frontier = 0, {root}
        while frontier:
            level += 1
            frontier = {b for a, b in edges if a in frontier and (root, b) not in out}
            for b in frontier:
                out[root, b] = level
    return out


def test_closure_of_random_graphs_with_cycles(spark):
    for seed in (1, 2):
        rnd = random.Random(seed)
        edges = {(rnd.randrange(25), rnd.randrange(25)) for _ in range(40)}
        df = spark.createDataFrame(sorted(edges), "s int, d int")
        got = {(r["root"], r["node"]): r["level"] for r in G.closure(df, "s", "d").collect()}
        assert got == brute_closure(edges)


def test_closure_of_a_long_chain(spark):
    df = spark.range(70).select(F.col("id").alias("s"), (F.col("id") + 1).alias("d"))
    out = G.closure(df, "s", "d")
    assert out.count() == 70 * 71 // 2
    assert out.agg(F.max("level")).first()[0] == 70


def test_reachable_definitions(spark):
    defs = spark.createDataFrame(
        [("a", "[b] + [c]"), ("b", "[a]"), ("c", "1"), ("d", "[c]")], "name string, body string"
    )
    edges = G.token_edges(defs, "name", "body")
    roots = defs.filter("name = 'a'").select("name")
    assert rows(G.reachable(edges, roots, "src", "dst")) == [("a", 0), ("b", 1), ("c", 1)]


def test_dependency_graph_bands_and_placeholders(spark):
    nodes = spark.createDataFrame(
        [
            ("dataset", "d1", 6),
            ("dataset", "d2", 3),
            ("dataset", "d3", 2),
            ("pipeline", "p", 1),
            ("trigger", "t", 3),
            ("linkedService", "l", 11),
        ],
        "kind string, name string, usage bigint",
    )
    edges = spark.createDataFrame(
        [
            ("trigger", "t", "pipeline", "gone", "triggers"),
            ("pipeline", "p", "dataset", "d1", "dependsOn"),
            ("pipeline", "p", "dataset", "d1", "uses"),
        ],
        "source_kind string, source string, target_kind string, target string, kind string",
    )
    n, e = G.dependency_graph(nodes, edges, ["triggers", "uses", "references", "executes", "dependsOn"])
    bands = {r["id"]: (r["label"], r["criticality"]) for r in n.collect()}
    assert bands == {
        "dataset_d1": ("d1", "high"),
        "dataset_d2": ("d2", "medium"),
        "dataset_d3": ("d3", "low"),
        "pipeline_p": ("p", "medium"),
        "trigger_t": ("t", "high"),
        "linkedService_l": ("l", "high"),
        "pipeline_gone": ("gone (referenced)", "low"),
    }
    assert rows(e) == [("pipeline_p", "dataset_d1", "uses"), ("trigger_t", "pipeline_gone", "triggers")]


def test_effective_reads_through_nested_groups(spark):
    members = spark.createDataFrame(
        [("ann", "g1"), ("g1", "g2"), ("g2", "g1"), ("bob", "g3")], "member string, parent string"
    )
    grants = spark.createDataFrame([("g2", "t"), ("bob", "t"), ("bob", "u")], "principal string, table string")
    denies = spark.createDataFrame(
        [("g1", "t", "x"), ("g3", "u", "y")], "principal string, table string, column string"
    )
    columns = spark.createDataFrame([("t", "x"), ("t", "z"), ("u", "y")], "table string, column string")
    out = G.effective_reads(members, grants, denies, columns).filter("principal IN ('ann', 'bob')")
    assert rows(out) == [("ann", "t", "z"), ("bob", "t", "x"), ("bob", "t", "z")]


def brute_reads(members, grants, denies, columns):
    out = set()
    for principal in {m for m, _ in members}:
        holders, todo = {principal}, [principal]
        while todo:
            at = todo.pop()
            for m, p in members:
                if m == at and p not in holders:
                    holders.add(p)
                    todo.append(p)
        tables = {t for p, t in grants if p in holders}
        off = {(t, c) for p, t, c in denies if p in holders}
        out |= {(principal, t, c) for t, c in columns if t in tables and (t, c) not in off}
    return out


def test_effective_reads_of_random_memberships_and_wide_tables(spark):
    for seed in (3, 4):
        rnd = random.Random(seed)
        columns = [("wide", f"c{i}") for i in range(150)] + [("one", "c"), ("all", "c0"), ("all", "c1")]
        groups = [f"g{i}" for i in range(9)]
        members = [(f"u{i}", rnd.choice(groups)) for i in range(40) for _ in range(rnd.randrange(1, 4))]
        members += [(rnd.choice(groups), rnd.choice(groups)) for _ in range(8)]  # cycles among them
        anyone = [*groups, "u1", "u2", "u3", "nobody"]
        grants = [(rnd.choice(anyone), rnd.choice(["wide", "one", "all"])) for _ in range(9)]
        denies = [(rnd.choice(anyone), *rnd.choice(columns)) for _ in range(60)]
        denies += [(groups[0], "all", "c0"), (groups[0], "all", "c1"), ("u1", "wide", "c63"), ("u1", "wide", "c127")]
        out = G.effective_reads(
            spark.createDataFrame([*members, (None, "g1"), ("u0", None)], "member string, parent string"),
            spark.createDataFrame([*grants, (None, "one")], "principal string, table string"),
            spark.createDataFrame([*denies, ("g1", None, "c1"), ("g1", "gone", "c")], "principal string, table string, column string"),
            spark.createDataFrame([*columns, (None, "x")], "table string, column string"),
        )
        found = [tuple(r) for r in out.select("principal", "table", "column").collect()]
        assert len(found) == len(set(found))
        assert set(found) == brute_reads(members, grants, denies, columns)


def test_effective_reads_without_rows(spark):
    none = spark.createDataFrame([], "member string, parent string")
    out = G.effective_reads(
        none,
        spark.createDataFrame([], "principal string, table string"),
        spark.createDataFrame([], "principal string, table string, column string"),
        spark.createDataFrame([], "table string, column string"),
    )
    assert out.count() == 0

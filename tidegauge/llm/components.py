"""Connected components by contraction: joins and aggregates only, a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``links``; a component's name is its smallest node.

    Each round every node points to the smallest node among itself and its neighbours, and links are drawn anew between
    what their ends point to, which keeps components connected and merges every node with a smaller neighbour. A
    star of any size is one round. Pre-aggregated minima make a hot node cheap; rounds are written to the shared folder.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    known: DataFrame | None = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "component-points")
        if points.limit(1).count() == 0:
            break
        to = points.select(F.col("a").alias("node"), F.col("to"))
        if known is None:
            known = to
        else:
            step = to.select(F.col("node").alias("component"), "to")
            moved = known.withColumnRenamed("to", "component").join(step, "component", "left")
            known = stored(moved.select("node", F.coalesce("to", "component").alias("to")), "component-names")
        ends_a = points.select("a", F.col("to").alias("new_a"))
        ends_b = points.select(F.col("a").alias("b"), F.col("to").alias("new_b"))
        drawn = edges.join(ends_a, "a").join(ends_b, "b").filter("new_a <> new_b")
        edges = stored(
            drawn.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(),
            "component-links",
        )
    if known is None:
        known = points.select(F.col("a").alias("node"), F.col("to"))
    return known.select("node", F.col("to").alias("component"))

"""Mixing sources to target weights: whole copies first, then a Pareto sample for the rest.

A source with target T and size S (in words) takes every document floor(T/S) times for certain. What is left, R, is
drawn by Pareto order sampling: a document's inclusion odds are R/(S - R) times its size over the source's mean size, so that
long documents are likelier than short ones, and documents rank by the odds of a random number over their inclusion odds.
The sample has a fixed size in words: documents are taken in this order as long as they fit into R, and one more,
the one whose size fits the remaining gap best, closes it. The random numbers are digests of id and text, so that reruns
agree.

A hot source is ranked in cells of the ranking value: words per cell are added up first, and only the one cell in which R
runs out has its rows ranked. What comes out is one row per source, from which the times of a document follow by a
column expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: No source and no document is repeated more often.
MOST_COPIES = 3
SEED = "mixture"


def size_of(text: Column) -> Column:
    """Words of a text, none if null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_of(doc_id: Column, text: Column) -> Column:
    """A random number in (0, 1) from id and text."""
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")), F.lit(SEED))
    digits = F.substring(F.md5(name.cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, u) of every row."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        random_of(F.col(doc_id), F.col(text)).alias("u"),
    )


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """One row per source: (source, source_size, target, copies, rest, odds), the odds for a document of one word.

    Sources in code point order, null last, have ``weights`` in turn and share all words by weight. A target stops at
    ``MOST_COPIES`` times its source's size; the excess is shared again by weight. Sources that stop are a prefix in the
    order of size per weight, so one pass over the sources (a small table) finds them, in whole numbers.
    """
    scale = math.lcm(*weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    sources = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int")))
    )
    fullest = Window.orderBy(F.expr(f"source_size * ({scale} div weight)"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    rest = fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    most = MOST_COPIES * F.col("source_size")
    shared = (
        sources.withColumn("words", F.sum("source_size").over(every))
        .withColumn("left", F.col("words") - F.coalesce(F.sum(most).over(before), F.lit(0)))
        .withColumn("stops", most * F.sum("weight").over(rest) <= F.col("weight") * F.col("left"))
        .withColumn("free_words", F.col("words") - F.sum(F.when(F.col("stops"), most).otherwise(0)).over(every))
        .withColumn("free_weight", F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(every))
        .withColumn(
            "target",
            F.when(F.col("stops"), most.cast("double")).otherwise(
                (F.col("free_words") * F.col("weight")).cast("double") / F.col("free_weight").cast("double")
            ),
        )
    )
    size = F.col("source_size").cast("double")
    return (
        shared.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / size)).otherwise(0))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * size))
        .withColumn("p", F.when(F.col("source_size") > 0, F.col("rest") / size).otherwise(0.0))
        .withColumn("odds", F.when((F.col("p") > 0) & (F.col("p") < 1), F.col("p") / (1 - F.col("p"))))
        .select("source", "source_size", "n", "target", F.col("copies").cast("long").alias("copies"), "rest", "odds")
    )


def rank_of(size: Column, u: Column) -> Column:
    """The ranking value of a document, given its source's columns; null if nothing is drawn."""
    relative = size.cast("double") * F.col("n").cast("double") / F.col("source_size").cast("double")
    return F.when((size > 0) & F.col("odds").isNotNull(), (u / (1 - u)) / (F.col("odds") * relative))


def planned(rows: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """One row per source: its target, certain copies, the place in the ranking up to which documents are drawn, and the
    one that closes the gap. ``rows`` are (source, size, u). ``times`` reads it; stored, so that the planner knows its size.
    """
    cells = max(1, math.isqrt(rows.count()))
    goal = stored(targets(rows, weights), "mixture-targets").withColumnRenamed("source", "of")
    known = rows.join(goal, F.col("source").eqNullSafe(F.col("of"))).withColumn("q", rank_of(F.col("size"), F.col("u")))
    share = F.col("q") / (1 + F.col("q"))
    drawn = stored(
        known.filter(F.col("q").isNotNull()).select(
            "of", "size", "u", "q", "rest", F.least(F.lit(cells - 1), F.floor(share * cells)).cast("long").alias("cell")
        ),
        "mixture-ranks",
    )

    # Per source, the cell in which the rest runs out and the words before it.
    upto = Window.partitionBy("of").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = drawn.groupBy("of", "cell").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    runs_out = (F.col("before") + F.col("words") > F.col("rest")) & (F.col("before") <= F.col("rest"))
    found = sums.filter(runs_out).groupBy("of").agg(F.min(F.struct("cell", "before")).alias("cut"))
    cuts = stored(found.select(F.col("of").alias("cut_of"), F.col("cut.cell").alias("cut_cell"), F.col("cut.before").alias("before")), "mixture-cells")
    here = F.col("of").eqNullSafe(F.col("cut_of"))

    # In that cell, the last place that fits. Rows of one place are equal and go together.
    units = drawn.join(cuts, here & (F.col("cell") == F.col("cut_cell"))).groupBy("of", "q", "u").agg(
        F.sum("size").alias("words"), F.max("rest").alias("rest"), F.max("before").alias("before")
    )
    order = Window.partitionBy("of").orderBy("q", "u").rowsBetween(Window.unboundedPreceding, 0)
    units = units.withColumn("upto", F.col("before") + F.sum("words").over(order)).filter(F.col("upto") <= F.col("rest"))
    fit = units.groupBy("of").agg(F.max(F.struct("q", "u")).alias("last"), F.max("upto").alias("words"))
    fit = fit.select(F.col("of").alias("fit_of"), "last", "words")
    cuts = cuts.join(fit, F.col("cut_of").eqNullSafe(F.col("fit_of")), "left").drop("fit_of")
    cuts = stored(cuts.withColumn("words", F.coalesce("words", "before")).drop("before"), "mixture-cuts")

    # The place that closes the gap best, if taking it brings the source nearer to its target.
    gap = F.col("rest") - F.col("words")
    open_rows = drawn.join(cuts, here).filter(~_before_cut() & (F.col("size") < 2 * gap))
    units = open_rows.groupBy("of", "q", "u").agg(F.sum("size").alias("size"), F.max(gap).alias("gap"))
    miss = F.abs(F.col("size") - F.col("gap"))
    best = (
        units.filter(miss < F.col("gap"))
        .groupBy("of")
        .agg(F.min(F.struct(miss.alias("miss"), "q", "u")).alias("best"))
        .select(F.col("of").alias("best_of"), F.struct("best.q", "best.u").alias("extra"))
    )
    plan = goal.join(cuts.drop("words"), here, "left").drop("cut_of")
    plan = plan.join(best, F.col("of").eqNullSafe(F.col("best_of")), "left").drop("best_of")
    return stored(plan.withColumn("cells", F.lit(cells)), "mixture-plan")


def _before_cut() -> Column:
    at = F.struct("q", "u")
    inside = F.coalesce((F.col("cell") == F.col("cut_cell")) & (at <= F.col("last")), F.lit(False))
    return (F.col("cell") < F.col("cut_cell")) | inside


def times(size: Column, u: Column) -> Column:
    """How often a document is taken, given the columns of its source's plan."""
    q = rank_of(size, u)
    at = F.struct(q.alias("q"), u.alias("u"))
    cell = F.least(F.col("cells") - 1, F.floor(q / (1 + q) * F.col("cells"))).cast("long")
    before = (cell < F.col("cut_cell")) | ((cell == F.col("cut_cell")) & (at <= F.col("last")))
    once = q.isNotNull() & (F.coalesce(before, F.lit(False)) | F.coalesce(at == F.col("extra"), F.lit(False)))
    return F.col("copies") + once.cast("long")


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often the mixture takes every document: (doc_id, source, size, source_size, target, times, taken).

    One row per input row; ``taken`` is the words taken, size times ``times``. Null texts have no words; a null source
    is a source. Rows with equal id and text share a place in the ranking and are taken as often as each other. Sources without words have target 0. An empty table gives an empty result.
    """
    rows = stored(measured(docs, doc_id, text, source), "mixture-sizes")
    plan = planned(rows, weights)
    known = rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("times", times(F.col("size"), F.col("u")))
    return known.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')) || ':{SEED}'), 1, 12))::BIGINT + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS n,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sizes GROUP BY source),
filled AS (
  SELECT *, sum(source_size) OVER () AS words,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size * (10 // weight), source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
    sum(weight) OVER (ORDER BY source_size * (10 // weight), source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM sources),
stopped AS (SELECT *, 3 * source_size * left_weight <= weight * left_words AS stops FROM filled),
free AS (
  SELECT *, words - sum(CASE WHEN stops THEN 3 * source_size ELSE 0 END) OVER () AS free_words,
    sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () AS free_weight
  FROM stopped),
targets AS (
  SELECT source, source_size, n, CASE WHEN stops THEN (3 * source_size)::DOUBLE
    ELSE (free_words * weight)::DOUBLE / free_weight::DOUBLE END AS target
  FROM free),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END AS copies FROM targets),
rests AS (SELECT *, greatest(0.0::DOUBLE, target - copies * source_size::DOUBLE) AS rest FROM parts),
chances AS (SELECT *, CASE WHEN source_size > 0 THEN rest / source_size::DOUBLE ELSE 0 END AS p FROM rests),
odds AS (
  SELECT s.doc_id, s.source, s.size, s.u, c.source_size, c.target, c.copies, c.rest,
    CASE WHEN size > 0 AND p > 0 AND p < 1
      THEN (u / (1 - u)) / ((p / (1 - p)) * (size::DOUBLE * n::DOUBLE / source_size::DOUBLE)) END AS q
  FROM sizes s JOIN chances c ON s.source IS NOT DISTINCT FROM c.source),
units AS (
  SELECT source, rest, q, u, sum(size)::BIGINT AS words FROM odds WHERE q IS NOT NULL GROUP BY ALL),
draws AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY q, u ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest AS chosen
  FROM units),
gaps AS (
  SELECT *, rest - sum(CASE WHEN chosen THEN words ELSE 0 END) OVER (PARTITION BY source) AS gap FROM draws),
fits AS (
  SELECT *, NOT chosen AND abs(words - gap) < gap AS may FROM gaps),
lasts AS (
  SELECT *, may AND row_number() OVER (PARTITION BY source, may ORDER BY abs(words - gap), q, u) = 1 AS last FROM fits)
SELECT doc_id, size, source_size, target,
  (size * (copies::BIGINT + coalesce(chosen::BIGINT + last::BIGINT, 0)))::BIGINT AS taken
FROM odds LEFT JOIN lasts ON odds.source IS NOT DISTINCT FROM lasts.source AND odds.q = lasts.q AND odds.u = lasts.u
"""

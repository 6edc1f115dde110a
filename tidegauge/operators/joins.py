"""Joins of the telemetry, cost and audit jobs."""

from __future__ import annotations

import operator
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import stored

#: Characters of names that every task may hold as an automaton, at about a hundred bytes each.
AUTOMATON_CHARS = 1 << 20


def with_user_group(
    df: DataFrame, members: DataFrame, user: str, default: str, group: str = "user_group", order: str = "position"
) -> DataFrame:
    """Group of each user by member lists; of several lists the first (smallest ``order``) wins, and users in no
    list get the default group."""
    listed = members.groupBy(user).agg(F.min_by(F.col(group), F.struct(order, group)).alias(group))
    return df.join(listed, user, "left").withColumn(group, F.coalesce(group, F.lit(default)))


def lookup(facts: DataFrame, dim: DataFrame, key: Column, dim_key: str, *columns: str) -> DataFrame:
    """Left-outer lookup of dimension columns by a derived lower-case key.

    Of dimension rows whose keys differ in case only, the smallest by spelling and columns is taken.
    """
    right = (
        dim.groupBy(F.lower(dim_key).alias("_lookup"))
        .agg(F.min(F.struct(F.col(dim_key).alias("_spelling"), *columns)).alias("_row"))
        .select("_lookup", *[F.col(f"_row.{c}").alias(c) for c in columns])
    )
    return facts.join(right, F.lower(key) == F.col("_lookup"), "left").drop("_lookup")


def star(fact: DataFrame, *links: tuple[DataFrame, str, str]) -> DataFrame:
    """Left joins along declared many-to-one relationships ``(dimension, fact key, dimension key)``."""
    for dim, key, dim_key in links:
        fact = fact.join(dim, F.col(key) == F.col(dim_key), "left")
    return fact


def latest_rows(df: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    """All rows that carry the latest timestamp of their key (ties are kept)."""
    newest = df.groupBy(*by).agg(F.max(ts).alias(ts))
    return df.join(newest, [*by, ts], "left_semi")


def match_without_suffix(
    old: DataFrame, new: DataFrame, name: str, new_name: str, suffix: str, on: Mapping[str, str]
) -> DataFrame:
    """Rows of a copy matched to their originals, whose names lack the copy's suffix."""
    base = F.regexp_replace(F.col(new_name), F.lit(suffix), F.lit(""))
    cond = F.col(name) == base
    for left, right in on.items():
        cond = cond & (F.col(left) == F.col(right))
    return old.join(new, cond)


def rewrite_references(df: DataFrame, refs: str, mapping: DataFrame, old: str, new: str, key: str) -> DataFrame:
    """Replace old ids by new ones in an array column; ids without a mapping stay.

    Every row stays with all its columns; empty and null lists stay as they are. Rows with the same key and list share
    the rewritten list.
    """
    lists = df.select(F.col(key).alias("_key"), F.col(refs).alias("_refs")).filter(F.size("_refs") > 0).distinct()
    position = lists.select("_key", "_refs", F.posexplode("_refs").alias("_pos", "_ref"))
    mapped = position.join(mapping.select(old, new), F.col("_ref") == F.col(old), "left")
    pair = F.struct(F.col("_pos"), F.coalesce(new, "_ref").alias("_ref"))
    rewritten = mapped.groupBy("_key", "_refs").agg(
        F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["_ref"]).alias("_new")
    )
    own = F.col(key).eqNullSafe(F.col("_key")) & (F.col(refs) == F.col("_refs"))
    joined = df.join(rewritten, own, "left")
    return joined.withColumn(refs, F.coalesce("_new", refs)).select(*df.columns)


def placeholders(wanted: DataFrame, known: DataFrame, key: str, **fill: Column) -> DataFrame:
    """Known rows plus one placeholder row per wanted key that is missing."""
    missing = wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")
    return known.unionByName(missing.withColumns(dict(fill)), allowMissingColumns=True)


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """SQL NOT IN on keys that hold no null."""
    return df.join(other.filter(F.col(other_col).isNotNull()), F.col(col) == F.col(other_col), "left_anti")


def unused_columns(declared: DataFrame, used: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Declared (table, column) rows that no use mentions."""
    return declared.join(used.select(*keys).distinct(), list(keys), "left_anti")


def texts_containing(
    texts: DataFrame, key: str, text: str, objects: DataFrame, name: str, automaton_chars: int = AUTOMATON_CHARS
) -> DataFrame:
    """Text rows with each object whose name occurs in the text, case-sensitively; rows without a key are left out.

    No text is compared with every object and none is repeated for a candidate. Names of up to ``automaton_chars``
    characters in all go to the tasks as one Aho-Corasick automaton, which finds all of them in one pass over a text;
    more names are met in a join of character grams. Whole texts are read in both ways.
    """
    names = stored(objects.filter(F.length(name) > 0).select(name).distinct(), "names")
    texts = texts.filter(F.col(key).isNotNull())
    if (names.agg(F.sum(F.length(name))).first()[0] or 0) <= automaton_chars:
        return _found_by_automaton(texts, text, names, name)
    return _found_by_grams(texts, key, text, names, name)


def _found_by_automaton(texts: DataFrame, text: str, names: DataFrame, name: str) -> DataFrame:
    context = texts.sparkSession.sparkContext
    given = context.broadcast([r[0] for r in names.collect()])  # bounded by the caller

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for word in given.value:
            automaton.add_word(word, word)
        automaton.make_automaton()
        value = operator.itemgetter(1)
        for batch in batches:
            yield pd.Series([list(set(map(value, automaton.iter(t)))) if given.value and t else [] for t in batch], dtype=object)

    if texts.rdd.getNumPartitions() < context.defaultParallelism:  # a single small file is one split
        texts = texts.repartition(context.defaultParallelism)
    return texts.select("*", F.explode(found(text)).alias(name))


def _found_by_grams(texts: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """Of the text only the character grams at every k-th position are kept, and each name offers its first k grams:
    wherever the name occurs, one of its grams falls on a kept position. Grams meet in an equi-join; the candidates of
    a text come together as one array and are verified in one go, so no pair is missed.
    Names are classed by length (1, 2, 4, or 8 and more); a class steps by about a quarter of its shortest name.
    """
    classes = F.when(F.length(name) >= 8, 8)
    for least in (4, 2):
        classes = classes.when(F.length(name) >= least, least)
    named = names.withColumn("_class", classes.otherwise(1))
    present = named.groupBy("_class").agg(F.min(F.length(name)).alias("shortest")).collect()  # at most 4 rows
    grams, anchors = [F.array().cast("array<string>")], F.array().cast("array<string>")
    for size, shortest in sorted((r["_class"], r["shortest"]) for r in present):
        step = max(1, (shortest + 2) // 4)
        width = shortest - step + 1
        # The lookahead takes the gram, then the match moves on by one step.
        grams.append(F.regexp_extract_all(F.col(text), F.lit(f"(?s)(?=(.{{{width}}})).{{{step}}}"), F.lit(1)))
        first = [F.substring(F.col(name), at + 1, width) for at in range(step)]
        anchors = F.when(F.col("_class") == size, F.array(*first)).otherwise(anchors)
    index = named.select(F.explode(anchors).alias("_gram"), name)
    dealt = texts.repartition(F.col(key))
    probes = dealt.select(key, F.explode(F.array_distinct(F.concat(*grams))).alias("_gram"))
    candidates = probes.join(index, "_gram").groupBy(key).agg(F.collect_set(name).alias("_names"))
    held = F.filter("_names", lambda n: F.contains(F.col(text), n))
    return dealt.join(candidates, key).select(*texts.columns, F.explode(held).alias(name))


def points_in_intervals(
    points: DataFrame, at: str, intervals: DataFrame, start: str, end: str, base_seconds: int = 60, levels: int = 28
) -> DataFrame:
    """Pairs with start <= point <= end, by an equi-join on time cells.

    An interval is filed at the level whose cells are at least as long as itself, so it touches at
    most two cells however long it is; a point looks into one cell per level that occurs.
    """
    length = F.greatest(F.lit(0), F.unix_timestamp(end) - F.unix_timestamp(start)) + 1
    level = F.greatest(F.lit(0), F.ceil(F.log2(length / F.lit(base_seconds)))).cast("int")
    filed = intervals.filter(F.col(start) <= F.col(end)).withColumn("_level", F.least(level, F.lit(levels)))
    width = F.lit(base_seconds) * F.pow(F.lit(2), F.col("_level"))

    def cell(ts: Column) -> Column:
        return F.floor(F.unix_timestamp(ts) / width).cast("bigint")

    filed = filed.withColumn("_cell", F.explode(F.sequence(cell(F.col(start)), cell(F.col(end)))))
    used = filed.select("_level").distinct()
    occurring = [r["_level"] for r in used.collect()]  # at most levels + 1 values
    if not occurring:
        return points.join(intervals, F.lit(False))
    probes = points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in sorted(occurring)])))
    probes = probes.withColumn("_cell", cell(F.col(at)))
    inside = F.col(at).between(F.col(start), F.col(end))
    return probes.join(filed, ["_level", "_cell"]).filter(inside).drop("_level", "_cell")


def pair_begin_end(
    ends: DataFrame,
    begins: DataFrame,
    keys: Sequence[str],
    begin_ts: str,
    since: Column | None = None,
    lookback_seconds: int = 86400,
) -> DataFrame:
    """Each end with all begins on the same keys; unmatched ends are kept.

    A batch of ends that starts at ``since`` is met by begins from ``lookback_seconds`` before it on, as an operation may
    have begun in the batch before; without ``since`` every begin counts. Keys tell operations apart, so no time is
    compared. A key with very many rows is left to the planner's skew handling.
    """
    b = begins.select(*[F.col(c).alias(f"_b_{c}") if c in keys else F.col(c) for c in begins.columns])
    if since is not None:
        b = b.filter(F.col(begin_ts) >= since - F.make_dt_interval(secs=F.lit(lookback_seconds)))
    cond = F.lit(True)
    for key in keys:
        cond = cond & (F.col(key) == F.col(f"_b_{key}"))
    return ends.join(b, cond, "left").drop(*[f"_b_{c}" for c in keys])


def expand_series(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Each row once per number of a series: the product of a table with a series, without a join."""
    return df.withColumn(name, F.explode(F.sequence(first, last)))


def expand_schedule(items: DataFrame, days: str, times: str) -> DataFrame:
    """One row per item, scheduled day and scheduled time."""
    return items.withColumn("day", F.explode(days)).withColumn("time", F.explode(times))


def credit_usage(usage: DataFrame, closure: DataFrame, obj: str, ref: str) -> DataFrame:
    """Usage of each object, plus the same usage credited to everything it depends on."""
    direct = usage.withColumn("is_direct", F.lit(True))
    through = usage.join(
        closure.select(F.col(obj).alias("_root"), F.col(ref).alias("_ref")), F.col(obj) == F.col("_root")
    )
    indirect = through.withColumn(obj, F.col("_ref")).drop("_root", "_ref").withColumn("is_direct", F.lit(False))
    return direct.unionByName(indirect)

"""N-gram Jaccard join by token-combination prefixes.

Documents are sets of word 5-grams (tokens). Two sets of sizes x and y link if their Jaccard similarity is at least 3/4,
that is if they share at least 3/7 (x + y) tokens. With all tokens in one global order, rarest first, a set has a
token in common with any partner among its first m + 1, where m is how many of its tokens a partner may lack. Rare
tokens are indexed one by one in this prefix. A frequent token has a long list, so frequent tokens are indexed in
combinations of two over an extended prefix: if the first shared token is frequent, so are all shared ones. The tokens
of only one side are at most (x + y) / 7, so among two more shared tokens than that, two are next to each other in
both sets. It is therefore enough to index pairs of neighbours, one per token, over the first m + (x + y) / 7 + 2.

The index is made twice. The first one assumes the widest partner sizes, from 3/4 to 4/3; its lists tell which sizes
a set's partners can have at all, and for these m and the extension are smaller, so that the second index is shorter
and its lists hold few sets that do not link. Candidates are verified on the whole sets, so the result is exact.

How often a token occurs is counted exactly over all documents. Tokens are 64-bit hashes, compared in full everywhere, and
travel packed: blocks of documents send theirs to buckets of a hash range; a bucket returns those that occur in more than one set to the
sets' homes, where a set's frequent and rare tokens meet and its index entries are made. Equal sets are one class and
take part once. Tokens in over 1/100 of a bounded sample of sets are spread over buckets of their own and ordered by
their count in the sample, as the order only has to be the same everywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import words
from tidegauge.llm.components import components
from tidegauge.session import stored

WORDS = 5
#: Similarity from which two sets link, as a fraction; linked sets share at least 3 of 7 parts of their sizes' sum.
LINK = (3, 4)
SHARES = sum(LINK)
#: A token in more sets than this is frequent.
RARE = 48
#: Sets with fewer tokens index single tokens only; from ``COMBINE`` on frequent tokens are combined as well.
SINGLE, COMBINE = 16, 12
#: Tokens of one bucket and sets of one home, on average.
BUCKET_TOKENS = 1_000_000
HOME_SETS = 1_000
#: Sets sampled to find the tokens that get buckets of their own, and the share of sets that makes them so.
SAMPLE_SETS, HOT_SHARE = 10_000, 0.01
#: Classes a task remembers to have sent.
REMEMBERED = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Odd 64-bit multipliers for mixing hashes.
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words, A-Z lower-cased."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    return words.word_hashes(raw, *words.word_places(raw))


def shingles(text: str | None, length: int = WORDS) -> np.ndarray:
    """The sorted distinct tokens of a text: its runs of ``length`` words, or all its words if it has fewer."""
    hashes = word_hashes(text or "")
    n = len(hashes)
    if n == 0:
        return hashes
    length = min(n, length)
    found = np.full(n - length + 1, length, np.uint64)
    for i in range(length):
        found = mix(found * _MIX[0] + hashes[i : n - length + 1 + i])
    return np.unique(found)


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set, from two sums over its tokens."""
    sums = np.array([len(tokens), tokens.sum(dtype=np.uint64), mix(tokens ^ _MIX[0]).sum(dtype=np.uint64)], np.uint64)
    return int(mix(mix(mix(sums[:1]) + sums[1:2]) + sums[2:3])[0].astype(np.int64))


def classes(docs: DataFrame, doc_id: str, text: str, sample_rate: float) -> DataFrame:
    """(doc_id, n, class, sample): token count and class of every row, and the tokens of sampled classes."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    chosen = int(sample_rate * (1 << 32))

    @F.pandas_udf("n long, class long, sample binary")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for body in batch:
                tokens = shingles(body)
                name = class_of(tokens)
                sampled = len(tokens) and (name & 0xFFFFFFFF) < chosen
                found.append((len(tokens), name, tokens.tobytes() if sampled else None))
            yield pd.DataFrame(found, columns=["n", "class", "sample"])

    return rows.select("doc_id", measure("text").alias("r")).select("doc_id", "r.*")


def hot_tokens(sampled: DataFrame) -> dict[int, int]:
    """Tokens in over ``HOT_SHARE`` of the sampled classes, with their counts; at most tokens per set / HOT_SHARE."""
    single = sampled.groupBy("class").agg(F.min("sample").alias("sample"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                tokens, counts = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in batch["sample"]]), return_counts=True)
                yield pd.DataFrame({"token": tokens.view(np.int64), "n": counts.astype(np.int64)})

    found = (
        single.select("sample")
        .mapInPandas(count, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= max(100, int(HOT_SHARE * single.count())))
        .collect()
    )
    return {r["token"]: r["n"] for r in found}


def spread(docs: DataFrame, text: str, buckets: int, hot) -> DataFrame:
    """Tokens of all sets by bucket: (bucket, sets binary, sizes binary, held binary, tokens binary) per block of rows.

    ``sets`` are class names, ``sizes`` their numbers of tokens, ``held`` how many tokens of each the row carries. Buckets
    from ``buckets`` on hold hot tokens, dealt by set. A class is sent once per task at most.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot_sorted = hot.value[0]
        seen: set[int] = set()
        for batch in batches:
            names, sizes, parts = [], [], []
            for body in batch["text"]:
                tokens = shingles(body if isinstance(body, str) else None)
                name = class_of(tokens)
                if len(tokens) and name not in seen:
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    sizes.append(len(tokens))
                    parts.append(tokens)
            if not parts:
                continue
            tokens, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
            names, sizes = np.array(names, np.int64), np.array(sizes, "<u4")
            bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            if len(hot_sorted):
                place = np.minimum(np.searchsorted(hot_sorted, tokens), len(hot_sorted) - 1)
                is_hot = hot_sorted[place] == tokens
                bucket[is_hot] = buckets + names[owner[is_hot]] % buckets
            order = np.argsort(bucket, kind="stable")
            bucket, carried, owner = bucket[order], tokens[order], owner[order]
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            out = []
            for a, b in zip(starts, np.append(starts[1:], len(bucket))):
                sets, held = np.unique(owner[a:b], return_counts=True)
                out.append(
                    (bucket[a], names[sets].tobytes(), sizes[sets].tobytes(), held.astype("<u4").tobytes(), carried[a:b].astype("<u8").tobytes())
                )
            yield pd.DataFrame(out, columns=["bucket", "sets", "sizes", "held", "tokens"])

    schema = "bucket long, sets binary, sizes binary, held binary, tokens binary"
    return docs.select(F.col(text).alias("text")).mapInPandas(pack, schema)


def shared_tokens(spread_out: DataFrame, buckets: int, homes: int, hot) -> DataFrame:
    """Per bucket and home, the tokens that occur in more than one set: (home, sets, sizes, held, tokens, counts)."""

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        names = np.concatenate([np.frombuffer(x, np.int64) for x in rows["sets"]])
        sizes = np.concatenate([np.frombuffer(x, "<u4") for x in rows["sizes"]])
        held = np.concatenate([np.frombuffer(x, "<u4") for x in rows["held"]])
        tokens = np.frombuffer(b"".join(rows["tokens"]), "<u8")
        # The same class can come from several tasks; number the classes so that it counts once.
        known, first = np.unique(names, return_index=True)
        owner = np.repeat(np.searchsorted(known, names), held).astype(np.int64)
        order = np.lexsort((owner, tokens))
        tokens, owner = tokens[order], owner[order]
        once = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])])
        tokens, owner = tokens[once], owner[once]
        if bucket < buckets:
            starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            counts = np.diff(np.append(starts, len(tokens)))
            counts = np.repeat(counts, counts)
            shared = counts > 1
            tokens, owner, counts = tokens[shared], owner[shared], counts[shared]
        else:  # a part of the sets only: counts come from the sample
            counts = hot.value[1][np.searchsorted(hot.value[0], tokens)]
        if not len(tokens):
            return pd.DataFrame([], columns=columns)
        home = known[owner] % homes
        order = np.lexsort((owner, home))
        tokens, owner, counts, home = tokens[order], owner[order], counts[order], home[order]
        cuts = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]]))
        out = []
        for a, b in zip(cuts, np.append(cuts[1:], len(home))):
            sets, held = np.unique(owner[a:b], return_counts=True)
            out.append(
                (
                    home[a],
                    known[sets].tobytes(),
                    sizes[first[sets]].tobytes(),
                    held.astype("<u4").tobytes(),
                    tokens[a:b].astype("<u8").tobytes(),
                    counts[a:b].astype("<u4").tobytes(),
                )
            )
        return pd.DataFrame(out, columns=columns)

    columns = ["home", "sets", "sizes", "held", "tokens", "counts"]
    schema = "home long, sets binary, sizes binary, held binary, tokens binary, counts binary"
    return spread_out.repartition(2 * buckets, "bucket").groupBy("bucket").applyInPandas(count, schema)


def indexed(shared: DataFrame, homes: int) -> DataFrame:
    """(class, n, tokens, rare) of the sets that can have a partner: enough of their tokens are shared.

    ``tokens`` are the shared ones in the global order; the first ``rare`` of them are rare.
    """

    def assemble(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = np.concatenate([np.frombuffer(x, np.int64) for x in rows["sets"]])
        sizes = np.concatenate([np.frombuffer(x, "<u4") for x in rows["sizes"]])
        held = np.concatenate([np.frombuffer(x, "<u4") for x in rows["held"]])
        tokens = np.frombuffer(b"".join(rows["tokens"]), "<u8")
        counts = np.frombuffer(b"".join(rows["counts"]), "<u4")
        known, first = np.unique(names, return_index=True)
        owner = np.repeat(np.searchsorted(known, names), held)
        order = np.lexsort((tokens, counts, owner))
        tokens, counts, owner = tokens[order], counts[order], owner[order]
        ends = np.cumsum(np.bincount(owner, minlength=len(known)))
        out, start = [], 0
        for i, end in enumerate(ends):
            n = int(sizes[first[i]])
            if LINK[1] * (end - start) >= LINK[0] * n:
                rare = int(np.searchsorted(counts[start:end], RARE, "right"))
                out.append((known[i], n, tokens[start:end].view(np.int64), rare))
            start = end
        return pd.DataFrame(out, columns=["class", "n", "tokens", "rare"])

    return shared.repartition(homes, "home").groupBy("home").applyInPandas(assemble, "class long, n int, tokens array<long>, rare int")


def postings(sets: DataFrame, combined: bool = True) -> DataFrame:
    """(signature, class, n, shared): index entries of ``sets`` (class, n, tokens, rare, low, high).

    ``low`` and ``high`` bound the sizes of a set's partners, ``shared`` is the number of its tokens that are in other sets.
    Without ``combined`` frequent tokens of the prefix are indexed one by one as well.
    """
    alone = F.col("n") - F.size("tokens")  # tokens of this set only come first in the order
    lacking = F.col("n") - F.ceil(LINK[0] * (F.col("n") + F.col("low")) / SHARES)
    sized = sets.select(
        "class",
        "n",
        "tokens",
        "rare",
        F.size("tokens").alias("shared"),
        F.greatest(F.lit(0), lacking + 1 - alone).cast("int").alias("prefix"),
        (lacking - alone + F.floor((F.col("n") + F.col("high")) / SHARES) + 2).cast("int").alias("end"),
    )
    alone_only = (F.col("n") < SINGLE) | F.lit(not combined)
    singles = F.when(alone_only, F.col("prefix")).otherwise(F.least("prefix", "rare"))
    frequent = (F.col("n") >= COMBINE) & (F.col("prefix") > F.col("rare")) & F.lit(combined)
    run = F.slice("tokens", F.col("rare") + 1, F.greatest(F.lit(0), F.col("end") - F.col("rare")))
    cut = sized.select(
        "class",
        "n",
        "shared",
        F.slice("tokens", F.lit(1), singles).alias("singles"),
        F.when(frequent, run).otherwise(F.array().cast("array<long>")).alias("run"),
    )
    pairs = F.zip_with(
        F.slice("run", F.lit(1), F.greatest(F.lit(0), F.size("run") - 1)),
        F.slice("run", F.lit(2), F.greatest(F.lit(0), F.size("run") - 1)),
        lambda a, b: F.xxhash64(a, b),
    )
    entries = F.array_distinct(F.concat("singles", pairs))
    return cut.select(F.explode(entries).alias("signature"), "class", "n", "shared")


def narrowed(index: DataFrame) -> DataFrame:
    """``index`` with ``low`` and ``high``, the sizes that partners can have; sets without a possible partner go."""
    least = F.ceil(LINK[0] * F.col("n") / LINK[1])
    most = F.floor(LINK[1] * F.col("n") / LINK[0])
    entries = stored(postings(index.withColumns({"low": least, "high": most})), "join-wide")
    lists = (
        entries.groupBy("signature")
        .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )
    sizes = stored(
        entries.join(lists, "signature")
        .groupBy("class")
        .agg(
            F.min(F.greatest(F.col("least"), least)).alias("low"),
            F.max(F.least(F.col("most"), most)).alias("high"),
        ),
        "join-sizes",
    )
    enough = SHARES * F.size("tokens") >= LINK[0] * (F.col("n") + F.col("low"))
    return index.join(sizes, "class").filter(enough)


def alike(n_a: str, n_b: str, s_a: str, s_b: str):
    """Size filter: sets of too different sizes, or with too few tokens that are in other sets, cannot link."""
    near = LINK[1] * F.least(n_a, n_b) >= LINK[0] * F.greatest(n_a, n_b)
    return near & (SHARES * F.least(s_a, s_b) >= LINK[0] * (F.col(n_a) + F.col(n_b)))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link, checked on all their tokens."""
    left = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return joined.filter(LINK[1] * F.col("both") >= LINK[0] * union).select("a", "b", "both", union.alias("either"))


def prepared(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, stored; index of the classes that can have a partner, stored)."""
    rate = min(1.0, SAMPLE_SETS / max(1, docs.count()))
    rows = stored(classes(docs, doc_id, text, rate), "join-rows")
    total = rows.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows")).first()
    buckets = min(1 << 22, max(1, math.ceil((total["tokens"] or 0) / BUCKET_TOKENS)))
    homes = max(1, math.ceil(total["rows"] / HOME_SETS))
    found = hot_tokens(rows.filter("sample is not null").select("class", "sample"))
    keys = np.array(sorted(np.uint64(k & (1 << 64) - 1) for k in found), np.uint64)
    counts = np.array([found[int(k.astype(np.int64))] for k in keys], np.int64) * math.ceil(1 / rate) + RARE + 1
    hot = docs.sparkSession.sparkContext.broadcast((keys, counts))
    index = indexed(shared_tokens(spread(docs, text, buckets, hot), buckets, homes, hot), homes)
    return rows.drop("sample"), stored(index, "join-index")


def links(index: DataFrame) -> DataFrame:
    """All links (a, b, both, either) between different sets, a < b: sizes of intersection and union.

    Their number is what the data has, which within a group of near copies is its square; ``grouped`` needs fewer.
    """
    entries = postings(narrowed(index))
    left, right = _side(entries, "a"), _side(entries, "b")
    pairs = left.join(right, "signature").filter((F.col("a") < F.col("b")) & alike("n_a", "n_b", "s_a", "s_b"))
    return verified(pairs.select("a", "b").distinct(), index)


def _side(entries: DataFrame, name: str, *more: str) -> DataFrame:
    return entries.select(
        "signature",
        F.col("class").alias(name),
        F.col("n").alias(f"n_{name}"),
        F.col("shared").alias(f"s_{name}"),
        *[F.col(c).alias(f"{c}_{name}") for c in more],
    )


def grouped(index: DataFrame) -> DataFrame:
    """(node, component) of the classes that have a link.

    First every set of a signature's list is verified against one of the list only, the one with the fewest tokens of
    its own, which in a group of near copies is nearest to what they were copied from; the links found are followed.
    Only sets that are in different components by then are verified among themselves, so a group of near copies costs
    about one check per member, and no link between components is lost. For these the single tokens of the narrow
    prefix do: near copies have most combinations in common, and would meet once for each of them.
    """
    sized = narrowed(index)
    entries = stored(postings(sized), "join-postings")
    own = F.struct(F.col("n") - F.col("shared"), F.col("class"))
    lists = (
        entries.groupBy("signature")
        .agg(F.min_by(F.struct("class", "n", "shared"), own).alias("hub"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
        .select("signature", F.col("hub.class").alias("hub"), F.col("hub.n").alias("n_hub"), F.col("hub.shared").alias("s_hub"))
    )
    stars = (
        entries.join(lists, "signature")
        .filter((F.col("class") != F.col("hub")) & alike("n", "n_hub", "shared", "s_hub"))
        .select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
        .distinct()
    )
    checked = stored(stars, "join-stars")
    found = stored(verified(checked, index).select("a", "b"), "join-star-links")
    names = components(found, "a", "b")
    single = postings(sized, combined=False)
    named = single.join(names.withColumnRenamed("node", "class"), "class", "left").select(
        "signature", "class", "n", "shared", F.coalesce("component", "class").alias("of")
    )
    named = stored(named, "join-singles")
    split = named.groupBy("signature").agg(F.min("of").alias("low"), F.max("of").alias("high"))
    rest = stored(named.join(split.filter("low <> high").select("signature"), "signature"), "join-open")
    pairs = (
        _side(rest, "a", "of")
        .join(_side(rest, "b", "of"), "signature")
        .filter((F.col("a") < F.col("b")) & (F.col("of_a") != F.col("of_b")) & alike("n_a", "n_b", "s_a", "s_b"))
        .select("a", "b")
        .distinct()
        .join(checked, ["a", "b"], "left_anti")
    )
    more = stored(verified(pairs, index).select("a", "b"), "join-more-links")
    if more.limit(1).count() == 0:
        return names
    return components(stored(found.unionByName(more), "join-links"), "a", "b")


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of documents connected by links: (doc_id, n_shingles, component_id), one row per input row.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included (null ids are never the
    smallest, and name a group only if all its ids are null). Null, empty and blank texts have no shingles and link
    with nothing. Rows with equal sets are one class, however many they are; rows repeated under one id count as rows of
    their own. An empty table gives an empty result. Tokens are 64-bit hashes.
    """
    rows, index = prepared(docs, doc_id, text)
    names = grouped(index).select(F.col("node").alias("class"), "component")
    # Ids are reduced to one per class before classes meet their components.
    smallest = stored(
        rows.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("low")).join(names, "class", "left"), "join-classes"
    )
    of_component = smallest.filter("component is not null").groupBy("component").agg(F.min("low").alias("lowest"))
    of_class = smallest.join(of_component, "component", "left").select("class", F.coalesce("lowest", "low").alias("component_id"))
    with_words = rows.filter("n > 0").join(of_class, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    without = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return with_words.unionByName(without)

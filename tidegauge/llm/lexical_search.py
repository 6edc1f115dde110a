"""Ranked lexical search: the best documents of every item of a query set, found by presence-mask grouping.

Documents lie in blocks. For a block every asked term has a bitmap of the documents that hold it. An item's bitmaps,
stacked, give each document a mask of the item's terms that it has. Documents with one mask share a bound on their score:
the sum, over the terms present, of the term's weight times its greatest share in the block. Distinct masks are evaluated
by descending bound, and as soon as the bound of the next mask is below the k-th best score found so far, the rest of the
block cannot enter the result. A task carries the best scores from block to block, so later blocks are mostly skipped.

Scores are whole numbers: a term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), and its share in a document is
10^9 tf div (1000 tf + 8 m), where m = 25 + 75 n N div L. N counts the documents with a term, L all their terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidegauge.session import stored

BEST = 10
#: Items that one pass over the documents serves, which bounds the driver's memory and the broadcast query terms.
ITEMS = 2_000
#: Documents of a block, and entries of its matrix of terms and documents.
BLOCK_DOCS, BLOCK_ENTRIES = 4_096, 8 << 20
#: Bytes of a text that are split at a time.
PIECE = 4 << 20
#: Documents that are evaluated before the bound is looked at again; doubled from step to step.
FIRST_STEP = 32
#: Parts in which the best rows of an item's tasks are reduced first.
PARTS = 64

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, piece by piece: runs of ASCII letters, digits and other characters; A-Z lower-cased."""
    raw = (text or "").encode().translate(_FOLD)
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= PIECE else raw.rfind(b" ", at, at + PIECE)
        if end < 0:  # no border in a whole piece
            end = raw.find(b" ", at + PIECE)
            end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end + 1


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def postings(docs: DataFrame, doc_id: str, text: str, vocabulary) -> DataFrame:
    """Blocks of documents: (named, ids, lengths, held, terms, times) as packed arrays.

    ``lengths`` are numbers of terms; ``held`` says how many of the asked terms each document has, ``terms`` and ``times``
    which and how often. Documents without a term are left out.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary.value
        size = max(1, min(BLOCK_DOCS, BLOCK_ENTRIES // max(1, len(known))))
        ids: list[int | None] = []
        lengths: list[int] = []
        found: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def packed() -> pd.DataFrame:
            row = {
                "named": np.array([i is not None for i in ids], "?").tobytes(),
                "ids": np.array([i or 0 for i in ids], "<i8").tobytes(),
                "lengths": np.array(lengths, "<i8").tobytes(),
                "held": np.array([len(x) for x in found], "<u4").tobytes(),
                "terms": np.concatenate(found).astype("<u4").tobytes(),
                "times": np.concatenate(times).astype("<u4").tobytes(),
            }
            for part in (ids, lengths, found, times):
                part.clear()
            return pd.DataFrame([row])

        for batch in batches:
            for name, body in zip(batch["doc_id"].array, batch["text"]):
                length, counts = 0, Counter()
                for words in terms(body if isinstance(body, str) else None):
                    length += len(words)
                    counts.update(filter(None, map(known.get, words)))
                if length:
                    ids.append(None if pd.isna(name) else int(name))
                    lengths.append(length)
                    found.append(np.fromiter(counts.keys(), np.int64, len(counts)) - 1)
                    times.append(np.fromiter(counts.values(), np.int64, len(counts)))
                    if len(ids) == size:
                        yield packed()
        if ids:
            yield packed()

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(pack, "named binary, ids binary, lengths binary, held binary, terms binary, times binary")


def statistics(blocks: DataFrame) -> dict[int, int]:
    """Documents that hold each asked term; -1: number of documents, -2: number of terms in them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        holding: Counter = Counter()
        for batch in batches:
            for row in batch.itertuples():
                lengths = np.frombuffer(row.lengths, "<i8")
                holding.update({-1: len(lengths), -2: int(lengths.sum())})
                which, n = np.unique(np.frombuffer(row.terms, "<u4"), return_counts=True)
                holding.update(dict(zip(which.tolist(), n.tolist())))
        yield pd.DataFrame({"term": list(holding.keys()), "n": list(holding.values())}, dtype=np.int64)

    counted = blocks.mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in counted.collect()}


class Best:
    """The best (score, document) of an item so far: the highest scores, ties to the smaller id, no id last."""

    def __init__(self, size: int):
        self.size = size
        self.score = np.empty(0, np.int64)
        self.named = np.empty(0, bool)
        self.ids = np.empty(0, np.int64)

    def least(self) -> int:
        """Scores below this cannot enter any more."""
        return int(self.score[-1]) if len(self.score) == self.size else 1

    def add(self, score: np.ndarray, named: np.ndarray, ids: np.ndarray) -> None:
        score, named, ids = (np.concatenate(x) for x in ((self.score, score), (self.named, named), (self.ids, ids)))
        order = np.lexsort((ids, ~named, -score))[: self.size]
        self.score, self.named, self.ids = score[order], named[order], ids[order]


class Block:
    """The documents of a block: ids, bitmaps of the asked terms, and the terms' shares in each document."""

    def __init__(self, row, documents: int, words: int, weighty: np.ndarray):
        self.ids, self.named = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.named, "?")
        lengths = np.frombuffer(row.lengths, "<i8")
        distinct, at = np.unique(lengths, return_inverse=True)
        m = np.array([25 + 75 * int(n) * documents // words for n in distinct], np.int64)[at]
        held = np.frombuffer(row.held, "<u4")
        doc = np.repeat(np.arange(len(held)), held)
        found, times = np.frombuffer(row.terms, "<u4").astype(np.int64), np.frombuffer(row.times, "<u4").astype(np.int64)
        keep = weighty[found]
        doc, found, times = doc[keep], found[keep], times[keep]
        present = np.unique(found)
        #: Line of each term in the matrix, -1 if no document of the block holds it.
        self.line = np.full(len(weighty), -1)
        self.line[present] = np.arange(len(present))
        self.shares = np.zeros((len(present), len(held)), np.int32)
        self.shares[self.line[found], doc] = 1_000_000_000 * times // (1000 * times + 8 * m[doc])
        self.greatest = self.shares.max(axis=1, initial=0).astype(np.int64)
        self.bitmaps = self.shares > 0

    def search(self, asked: np.ndarray, factors: np.ndarray, best: Best) -> None:
        """Enter the block's documents into ``best``: ``asked`` terms, with ``factors`` of their shares."""
        lines = self.line[asked]
        lines, factors = lines[lines >= 0], factors[lines >= 0]
        bounds = factors * self.greatest[lines]
        if not len(lines) or bounds.sum() < best.least():
            return
        masks = np.packbits(self.bitmaps[lines], axis=0)  # a column of bytes per document
        if len(masks) <= 8:
            wide = np.zeros((masks.shape[1], 8), np.uint8)
            wide[:, : len(masks)] = masks.T
            _, first, group = np.unique(wide.view(np.uint64)[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, group = np.unique(masks, axis=1, return_index=True, return_inverse=True)
        bound = bounds @ self.bitmaps[np.ix_(lines, first)]  # of every distinct mask
        reachable = bound >= best.least()
        docs = np.flatnonzero(reachable[group.reshape(-1)])
        bound = bound[group.reshape(-1)[docs]]
        order = np.argsort(-bound, kind="stable")
        docs, bound = docs[order], bound[order]
        at, step = 0, FIRST_STEP
        while at < len(docs) and bound[at] >= best.least():
            some = docs[at : at + step]
            score = factors @ self.shares[np.ix_(lines, some)].astype(np.int64)
            good = score >= best.least()
            if good.any():
                best.add(score[good], self.named[some[good]], self.ids[some[good]])
            at, step = at + step, step * 2


def _block_of_items(blocks: DataFrame, items: list[Counter], names: DataFrame, vocabulary: dict[bytes, int], k: int) -> DataFrame:
    counted = statistics(blocks)
    documents, words = counted.get(-1, 0), counted.get(-2, 0)
    weights = np.array([weight(documents, counted.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    asked = [np.array([vocabulary[t] - 1 for t in item], np.int64) for item in items]
    factors = [np.array(list(item.values()), np.int64) * weights[a] for item, a in zip(items, asked)]
    given = blocks.sparkSession.sparkContext.broadcast((asked, factors, weights > 0))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, factors, weighty = given.value
        bests = [Best(k) for _ in asked]
        for batch in batches:
            for row in batch.itertuples():
                block = Block(row, documents, words, weighty)
                for a, f, best in zip(asked, factors, bests):
                    block.search(a, f, best)
        part = TaskContext.get().partitionId() % PARTS
        for i, best in enumerate(bests):
            if len(best.score):
                ids = pd.array([int(d) if n else None for d, n in zip(best.ids, best.named)], "Int64")
                yield pd.DataFrame({"item": i, "part": part, "doc_id": ids, "score": best.score})

    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = blocks.mapInPandas(search, "item long, part int, doc_id long, score long")
    for keys in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked(
    items: DataFrame,
    docs: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    doc_id: str = "doc_id",
    text: str = "text",
    k: int = BEST,
) -> DataFrame:
    """The ``k`` best documents of every item: (item_id, rank, doc_id, score), rank from 1, only scores above 0.

    An item's score in a document sums its terms, repeats included. Equal scores are ranked by ascending doc_id, rows without
    an id last; ids of documents are integers. Items and documents that are null, empty or without a term find nothing
    and are not found. Repeated rows are documents (or items) of their own. Other columns are not read. An empty table
    on either side gives an empty result.

    The items are the query set: they are read in blocks of ``ITEMS``, and each block meets all documents.
    """
    spark = docs.sparkSession
    names = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    schema = f"item long, item_id {dict(names.dtypes)['item_id']}"
    result = spark.createDataFrame([], f"item_id {dict(names.dtypes)['item_id']}, rank int, doc_id long, score long")
    rows: Iterator[Row] = names.toLocalIterator()
    while some := list(islice(rows, ITEMS)):
        asked = [Counter(t for words in terms(r["text"]) for t in words) for r in some]
        vocabulary = {t: i + 1 for i, t in enumerate(sorted(set().union(*asked)))}
        blocks = stored(postings(docs, doc_id, text, spark.sparkContext.broadcast(vocabulary)), "search-blocks")
        names_of = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(some)], schema)
        result = result.unionByName(_block_of_items(blocks, asked, names_of, vocabulary, k))
    return result


#: The same ranking in SQL, every matching document scored.
SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), sizes AS (
  SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term
), df AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN df ON asked.term = df.term JOIN tf ON asked.term = tf.term JOIN sizes ON tf.doc_id = sizes.doc_id, total
  GROUP BY item_id, tf.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

"""Removal of word sequences that occur earlier in the corpus, found by difference-cover anchors.

A window is a run of ``window`` words. A difference cover modulo a period is a set of residues in which every difference
occurs. Anchors, runs of ``window - period + 1`` words, are hashed only where their place in the text falls on a
residue of the cover. Two equal windows at places i and j then have some offset d below the period for which i + d and
j + d are both on the cover: the anchors there lie inside the windows and are equal. So a text without a repeated
anchor has no repeated window, and only around repeated anchors are windows looked at: every anchor extends to the
windows that hold it, and these are compared whole.

Texts travel in compressed blocks. A block sends its distinct anchors to buckets of a hash range, and a bucket returns
those that several blocks have. Then the block sends its distinct windows around repeated anchors, each with its first
place, and a bucket returns those that start earlier in another block. No pairs are made: a passage in a third of all
documents costs one entry per block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.words import WHITE, Powers, run_hashes, word_hashes, word_places
from tidegauge.session import stored

WINDOW = 20
#: Shortest anchor, if the window allows it.
LEAST_ANCHOR = 7
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK = 4 << 20
#: Anchors or windows of one bucket, on average and at most.
BUCKET = 1_000_000

# Perfect difference covers by period, and odd multipliers of the two hashes of a window.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
WORD, CHECK = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F

_WORDS, _CHECKS = Powers(WORD), Powers(CHECK)


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least ``LEAST_ANCHOR`` words, and its cover."""
    period = max((p for p in COVERS if p <= window - LEAST_ANCHOR + 1), default=1)
    return period, COVERS[period]


class Block:
    """The texts of a block, its words and their hashes. Rows are in the order of their ids, those without one last."""

    def __init__(self, row, window: int):
        self.window = window
        self.ids = np.frombuffer(row.ids, "<i8")
        self.named = np.frombuffer(row.named, "?")
        lengths = np.frombuffer(row.lengths, "<i8")
        self.raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.texts, max_output_size=int(lengths.sum()) + 1), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.starts, self.ends = word_places(self.raw)
        #: Number of the first word of every row, and of the row after the last.
        self.first = np.searchsorted(self.starts, self.offsets)
        self.row = np.repeat(np.arange(len(lengths)), np.diff(self.first))
        self.place = np.arange(len(self.starts)) - self.first[self.row]

    def hashes(self) -> np.ndarray:
        return word_hashes(self.raw, self.starts, self.ends)

    def inside(self, length: int) -> np.ndarray:
        """Whether the run of ``length`` words from each word on stays in its text."""
        n = max(0, len(self.row) - length + 1)
        return self.row[:n] == self.row[len(self.row) - n :]

    def order(self) -> np.ndarray:
        """(id, place) of every word as one number; rows of one id share it, as do those without an id."""
        new = np.ones(len(self.ids), bool)
        new[1:] = (self.ids[1:] != self.ids[:-1]) | (self.named[1:] != self.named[:-1])
        return (np.cumsum(new)[self.row] << 32) | self.place

    def anchors(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors and the words they start at."""
        period, cover = cover_for(self.window)
        length = self.window - period + 1
        on = np.zeros(period, bool)
        on[list(cover)] = True
        keep = self.inside(length) & on[self.place[: max(0, len(self.place) - length + 1)] % period]
        return run_hashes(hashes, length, _WORDS)[keep], np.flatnonzero(keep)

    def windows_around(self, words: np.ndarray) -> np.ndarray:
        """The words at which windows start that hold an anchor from ``words``."""
        period, _ = cover_for(self.window)
        valid = self.inside(self.window)
        change = np.zeros(len(self.row) + 1, np.int64)
        np.add.at(change, np.maximum(words - period + 1, self.first[self.row[words]]), 1)
        np.add.at(change, words + 1, -1)
        return np.flatnonzero((np.cumsum(change)[: len(valid)] > 0) & valid)


def blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(block, words, ids, named, lengths, texts): the rows in compressed blocks, a null text as an empty one."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def packed() -> pd.DataFrame:
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            raw = b"".join(texts[i] for i in order)
            row = {
                "block": number,
                "words": len(word_places(np.frombuffer(raw, np.uint8))[0]),
                "ids": np.array([ids[i] or 0 for i in order], "<i8").tobytes(),
                "named": np.array([ids[i] is not None for i in order], "?").tobytes(),
                "lengths": np.array([len(texts[i]) for i in order], "<i8").tobytes(),
                "texts": zstandard.ZstdCompressor().compress(raw),
            }
            return pd.DataFrame([row])

        for batch in batches:
            for name, body in zip(batch["doc_id"].array, batch["text"]):
                # One white byte after every text keeps words of neighbouring texts apart.
                body = (body if isinstance(body, str) else "").encode() + b" "
                if ids and held + len(body) > BLOCK:
                    yield packed()
                    number, held = number + 1, 0
                    ids.clear()
                    texts.clear()
                ids.append(None if pd.isna(name) else int(name))
                texts.append(body)
                held += len(body) + 64
        if ids:
            yield packed()

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(pack, "block long, words long, ids binary, named binary, lengths binary, texts binary")


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, where each bucket begins, the buckets): hashes by range."""
    bucket = (hashes >> np.uint64(32)).astype(np.int64) * buckets >> 32
    order = np.argsort(bucket, kind="stable")
    present, begins = np.unique(bucket[order], return_index=True)
    return order, np.append(begins, len(order)), present


def _each(make: Callable[[object], Iterator[tuple]], columns: list[str]):
    """A mapInPandas function that makes rows from every row."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                if out := list(make(row)):
                    yield pd.DataFrame(out, columns=columns)

    return apply


def repeated_anchors(packed: DataFrame, buckets: int, window: int) -> DataFrame:
    """(block, anchors): the anchors of a block that other blocks have as well."""

    def send(row) -> Iterator[tuple]:
        block = Block(row, window)
        found = np.unique(block.anchors(block.hashes())[0])
        order, begins, present = _dealt(found, buckets)
        for i, bucket in enumerate(present):
            # The bucket stands for the upper bits; six bytes are enough to find what is worth comparing.
            low = found[order[begins[i] : begins[i + 1]]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            yield int(bucket), row.block, low.tobytes()

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        wide = np.zeros((sum(map(len, rows["anchors"])) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(rows["anchors"]), np.uint8).reshape(-1, 6)
        anchors = wide.reshape(-1).view("<u8")
        owner = np.repeat(np.arange(len(rows)), [len(x) // 6 for x in rows["anchors"]])
        order = np.argsort(anchors, kind="stable")
        same = anchors[order][1:] == anchors[order][:-1]
        shared = np.zeros(len(order), bool)
        shared[order[1:]] |= same
        shared[order[:-1]] |= same
        names = rows["block"].to_numpy()
        out = []
        for i in np.unique(owner[shared]):
            mine = _slice(owner, i)
            out.append((names[i], int(key[0]), anchors[mine][shared[mine]].tobytes()))
        return pd.DataFrame(out, columns=["block", "bucket", "anchors"])

    sent = packed.mapInPandas(_each(send, ["bucket", "block", "anchors"]), "bucket long, block long, anchors binary")
    met = sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(meet, "block long, bucket long, anchors binary")
    return met.groupBy("block").agg(F.collect_list(F.struct("bucket", "anchors")).alias("answers"))


def _slice(owner: np.ndarray, i: int) -> slice:
    """Where the sorted ``owner`` is ``i``."""
    return slice(int(np.searchsorted(owner, i)), int(np.searchsorted(owner, i, "right")))


def earlier_windows(known: DataFrame, anchor_buckets: int, buckets: int, window: int) -> DataFrame:
    """(block, places): the first places in a block of windows that start earlier in another block.

    ``known`` has the blocks and the anchors they share with others (``answers``).
    """

    def send(row) -> Iterator[tuple]:
        block = Block(row, window)
        hashes = block.hashes()
        anchors, at = block.anchors(hashes)
        _, group, counts = np.unique(anchors, return_inverse=True, return_counts=True)
        repeated = counts[group] > 1
        if row.answers is not None:
            low = anchors & np.uint64((1 << 48) - 1)
            bucket = (anchors >> np.uint64(32)).astype(np.int64) * anchor_buckets >> 32
            for answer in row.answers:
                mine = np.flatnonzero(bucket == answer["bucket"])
                repeated[mine[np.isin(low[mine], np.frombuffer(answer["anchors"], "<u8"))]] = True
        starts = block.windows_around(at[repeated])
        if not len(starts):
            return
        found = run_hashes(hashes, window, _WORDS)[starts]
        check = (run_hashes(hashes, window, _CHECKS)[starts] >> np.uint64(32)).astype("<u4")
        order = np.lexsort((block.order()[starts], found))
        first = order[np.concatenate([[True], found[order][1:] != found[order][:-1]])]
        first.sort()
        found, check, starts = found[first], check[first], starts[first]
        order, begins, present = _dealt(found, buckets)
        for i, name in enumerate(present):
            mine = order[begins[i] : begins[i + 1]]
            rows, held = np.unique(block.row[starts[mine]], return_counts=True)
            yield (
                int(name),
                row.block,
                found[mine].astype("<u8").tobytes(),
                check[mine].tobytes(),
                starts[mine].astype("<u4").tobytes(),
                block.ids[rows].tobytes(),
                block.named[rows].tobytes(),
                block.first[rows].astype("<u4").tobytes(),
                held.astype("<u4").tobytes(),
            )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        def joined(column: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(rows[column]), kind)

        found, check, starts, held = joined("windows", "<u8"), joined("checks", "<u4"), joined("starts", "<u4"), joined("held", "<u4")
        owner = np.repeat(np.arange(len(rows)), [len(x) // 8 for x in rows["windows"]])
        ids, unnamed = np.repeat(joined("ids", "<i8"), held), ~np.repeat(joined("named", "?"), held)
        place = starts - np.repeat(joined("first", "<u4"), held)
        order = np.lexsort((place, ids, unnamed, check, found))
        new = np.ones(len(order), bool)
        new[1:] = (found[order][1:] != found[order][:-1]) | (check[order][1:] != check[order][:-1])
        leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = (unnamed[order] != unnamed[leader]) | (ids[order] != ids[leader]) | (place[order] != place[leader])
        hit = np.sort(order[later])  # in the order of the rows
        names = rows["block"].to_numpy()
        of = owner[hit]
        out = [(names[i], starts[hit[_slice(of, i)]].tobytes()) for i in np.unique(of)]
        return pd.DataFrame(out, columns=["block", "places"])

    columns = ["bucket", "block", "windows", "checks", "starts", "ids", "named", "first", "held"]
    schema = "bucket long, block long, " + ", ".join(f"{c} binary" for c in columns[2:])
    sent = known.mapInPandas(_each(send, columns), schema)
    met = sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(meet, "block long, places binary")
    return met.groupBy("block").agg(F.collect_list("places").alias("places"))


def _kept(row, window: int, whole: bool) -> Iterator[tuple]:
    """The result rows of a block and its places of windows that start earlier elsewhere."""
    block = Block(row, window)
    n = len(block.starts)
    removed = np.zeros(n, bool)
    valid = np.flatnonzero(block.inside(window))
    if len(valid):
        found, order_of = run_hashes(block.hashes(), window, _WORDS)[valid], block.order()[valid]
        order = np.lexsort((order_of, found))
        new = np.concatenate([[True], found[order][1:] != found[order][:-1]])
        leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        elsewhere = np.zeros(n, bool)
        if row.places is not None:
            elsewhere[np.frombuffer(b"".join(row.places), "<u4")] = True
        later = valid[order][elsewhere[valid[leader]] | (order_of[order] > order_of[leader])]
        change = np.zeros(n + 1, np.int64)
        change[later] += 1
        np.add.at(change, later + window, -1)
        removed = np.cumsum(change)[:n] > 0
    # Kept words with the byte behind each, which becomes a blank.
    lengths = np.where(removed, 0, block.ends - block.starts + 1)
    change = np.zeros(len(block.raw) + 1, np.int64)
    stay = ~removed
    change[block.starts[stay]] += 1
    np.add.at(change, block.ends[stay] + 1, -1)
    raw = np.where(WHITE[block.raw], np.uint8(32), block.raw)[np.cumsum(change)[:-1] > 0].tobytes()
    bounds = np.concatenate([[0], np.cumsum(lengths)])[block.first]
    gone = np.concatenate([[0], np.cumsum(removed)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8)))
    for i in range(len(block.ids)):
        a, b = int(block.first[i]), int(block.first[i + 1])
        body = raw[bounds[i] : max(bounds[i], bounds[i + 1] - 1)]
        name = int(block.ids[i]) if block.named[i] else None
        counts = (name, b - a, int(gone[b] - gone[a]))
        if whole:
            spans = _spans(edges, a, b) if counts[2] else []
            yield *counts, body.decode(), spans
        else:
            yield *counts, hashlib.sha256(body).hexdigest()


def _spans(edges: np.ndarray, a: int, b: int) -> list[tuple[int, int]]:
    """The removed runs of words within [a, b), counted from a."""
    low, high = edges[0::2], edges[1::2]
    mine = slice(int(np.searchsorted(high, a, "right")), int(np.searchsorted(low, b)))
    return [(max(int(s), a) - a, min(int(e), b) - a) for s, e in zip(low[mine], high[mine])]


def _result(docs: DataFrame, doc_id: str, text: str, window: int, whole: bool) -> DataFrame:
    packed = stored(blocks(docs, doc_id, text), "dedup-blocks")
    words = packed.agg(F.sum("words")).first()[0] or 0
    period, cover = cover_for(window)
    anchor_buckets = max(1, math.ceil(words * len(cover) / period / BUCKET))
    buckets = max(1, math.ceil(words / 2 / BUCKET))
    known = packed.join(repeated_anchors(packed, anchor_buckets, window), "block", "left")
    places = earlier_windows(known, anchor_buckets, buckets, window)
    kind = dict(docs.dtypes)[doc_id]
    ends = [("kept", "string"), ("removed", "array<struct<start:int,end:int>>")] if whole else [("kept_sha256", "string")]
    columns = [("doc_id", "long"), ("n_words", "long"), ("n_removed", "long"), *ends]
    make = _each(lambda row: _kept(row, window, whole), [c for c, _ in columns])
    result = packed.join(places, "block", "left").mapInPandas(make, ", ".join(f"{c} {t}" for c, t in columns))
    return result.withColumn("doc_id", F.col("doc_id").cast(kind))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every text without the words of windows that start earlier, one row per input row.

    Columns: doc_id, n_words, n_removed, kept (the words left, joined by one blank), removed (runs of words, the end not
    included). A window is ``window`` consecutive words of one document; it starts earlier in a smaller doc_id, or in the same
    document at an earlier word. All windows are judged on the input, so one that is removed still counts as the earlier one.

    Ids are integers. Rows without an id come last and count as one document, as do rows that share an id: windows of theirs
    that start at the same word are equally early, so repeated rows have equal results. Null and blank texts have no words
    and keep the empty text. Other columns are not read; an empty table gives an empty result. Windows are compared by
    96 bits of hash.
    """
    return _result(docs, doc_id, text, window, True)


def kept_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """As ``without_repeats``, with kept_sha256 (lowercase hex, UTF-8) in place of the texts and runs."""
    return _result(docs, doc_id, text, window, False)


#: The same removal in SQL, all windows compared as texts.
SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS k FROM windows
  ) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later
), parts AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words
), kept AS (
  SELECT parts.doc_id, count(*) FILTER (gone.j IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY parts.j) FILTER (gone.j IS NULL) AS body
  FROM parts LEFT JOIN gone ON parts.doc_id = gone.doc_id AND parts.j = gone.j
  GROUP BY parts.doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id
"""

"""Alignment of two tokenizers' tokens over the same bytes, by lockstep merging.

Both tokenizations of a text are runs of bytes that end at certain offsets. Merging the two lists of ends gives the links,
pairs of tokens that share a byte, and the cuts, offsets where tokens of both end. All documents of a batch are merged
at once: a state vector holds, for each, the current token of A and of B; a step emits the link of every document's
two tokens, marks a cut where both end at one offset, and moves on whichever token ends first. Finished documents
are taken out of the vector. Long documents enter it as several lanes of a bounded number of bytes, each with its own
pair of tokens, so that one of them does not keep a short vector running.

Both tokenizers cut a text at a blank after a character that is not white space: A's pattern ends there, and no merge
of B crosses it. The pieces between such places are therefore encoded once and remembered.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.bpe import byte_characters
from tidegauge.llm.common import once_per_worker
from tidegauge.session import stored

#: Bytes of a lane, and the share of a vector that has to be finished before it is compacted.
LANE, FINISHED = 512, 0.25
#: Text bytes aligned at a time.
BATCH = 1 << 19
#: Pieces a worker remembers before it starts afresh, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 64
#: Pairs whose counts are broadcast (17 bytes each); more are joined.
BROADCAST_PAIRS = 2_000_000
#: Bits of a link's number below its document's.
DOC_BITS = np.uint64(44)
#: Distinct pairs that a task sums up before it hands them on.
HELD_PAIRS = 2_000_000

# The splitting pattern of the byte-level tokenizer, and the sign that stands for a blank in pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "▁"

_BORDER = re.compile(r"(?<=\S)(?= )")
_WIDE_BLANK = re.compile(r"\s ")


def load(a_path: str, b_path: str) -> dict[str, Any]:
    """What the workers need of the two vocabulary files: one entry per token, read on the driver."""
    with open(a_path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in byte_of for c in t)}
    for token in spec.get("added_tokens", []):
        a_bytes.pop(token["id"], None)  # never made from a text
    with open(b_path, "rb") as file:
        b_model = file.read()
    return {"key": uuid.uuid4().hex, "a_bytes": a_bytes, "b_model": b_model}


class Tokens:
    """Byte strings of a vocabulary in one pool, found by id."""

    def __init__(self, strings: dict[int, bytes]):
        size = max(strings) + 1
        self.lengths = np.array([len(strings.get(i, b"")) for i in range(size)], np.int64)
        self.offsets = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.pool = np.frombuffer(b"".join(strings.get(i, b"") for i in range(size)), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The tokens' bytes in a row."""
        lengths = self.lengths[ids].astype(np.int32)
        ends = np.cumsum(lengths, dtype=np.int32)
        places = np.repeat(self.offsets[ids] - ends + lengths, lengths)
        places += np.arange(len(places), dtype=np.int32)
        return self.pool[places]


class Encoder(dict):
    """Piece of text, without its leading blank -> ids as little-endian 32-bit integers."""

    def __init__(self, encode: Callable[[str], list[int]], tokens: Tokens):
        super().__init__()
        self.encode, self.tokens = encode, tokens

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet, all in one text; their borders are cuts of its tokens."""
        if len(self) > REMEMBERED:
            self.clear()
        new = [p for p in pieces.difference(self) if len(p) <= LONGEST_REMEMBERED and p and not p[-1].isspace()]
        if not new:
            return
        ids = np.array(self.encode(" ".join(new)), np.int64)
        known = ids[ids < len(self.tokens.lengths)]
        at = np.cumsum(self.tokens.lengths[known])
        ends = np.cumsum([len(p.encode()) + 1 for p in new])
        cuts = np.searchsorted(at, ends)
        if len(known) < len(ids) or cuts[-1] >= len(at) or (at[cuts] != ends).any():
            return  # a tokenizer lost bytes: one by one, in __missing__
        raw, cuts = known.astype("<u4").tobytes(), [0, *((cuts + 1) * 4).tolist()]
        self.update(zip(new, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.encode(piece), "<u4").tobytes()
        if len(piece) <= LONGEST_REMEMBERED:
            self[piece] = packed
        return packed


def pieces_of(model: sentencepiece.SentencePieceProcessor) -> dict[int, bytes]:
    """Bytes of every piece; control pieces have none."""
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            found[i] = bytes([int(piece[3:-1], 16)])
        elif not model.is_control(i) and not model.is_unknown(i):
            found[i] = piece.replace(BLANK, " ").encode()
    return found


class Pair:
    """The two tokenizers."""

    def __init__(self, spec: dict[str, Any]):
        ranks = {t: i for i, t in spec["a_bytes"].items()}
        a = tiktoken.Encoding(f"a-{spec['key']}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        b = sentencepiece.SentencePieceProcessor(model_proto=spec["b_model"])
        strings = pieces_of(b)
        crossing = [i for i in strings if re.search(f"[^{BLANK}]{BLANK}", b.id_to_piece(i))]
        #: Without a merge over a border, pieces can be encoded one by one.
        self.cuts = not crossing
        self.a_tokens, self.b_tokens = Tokens(spec["a_bytes"]), Tokens(strings)
        self.a = Encoder(lambda piece: a.encode_ordinary(" " + piece), self.a_tokens)
        blank = [b.piece_to_id(BLANK)]
        # The library adds the blank before a text, but nothing to an empty one.
        self.b = Encoder(lambda piece: b.encode(piece) if piece else blank, self.b_tokens)
        self.scale = np.uint64(b.get_piece_size())

    def pieces(self, text: str) -> list[str]:
        """``text`` after its added blank, cut at borders; every piece lost the blank it begins with."""
        if not self.cuts:
            return [text]
        if _WIDE_BLANK.search(" " + text):
            return [p[1:] for p in _BORDER.split(" " + text)]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text the ids by A of a blank and the text, and by B of the text; none where one of them loses bytes."""
        pieces = [self.pieces(text) if text else [] for text in texts]
        if self.cuts:
            distinct = set().union(*pieces)
            self.a.learn(distinct)
            self.b.learn(distinct)
        return [self._encoded(text, p) for text, p in zip(texts, pieces)]

    def _encoded(self, text: str | None, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        a = np.frombuffer(b"".join(map(self.a.__getitem__, pieces)), "<u4").astype(np.int64)
        b = np.frombuffer(b"".join(map(self.b.__getitem__, pieces)), "<u4").astype(np.int64)
        raw = b" " + text.encode() if text else b""
        if any(tokens.joined(ids).tobytes() != raw for tokens, ids in ((self.a_tokens, a), (self.b_tokens, b))):
            a = b = np.empty(0, np.int64)
        return a, b


class Aligned:
    """A batch of documents: tokens and their ends, and per link its lane's document, tokens and cut."""

    def __init__(self, pair: Pair, encoded: list[tuple[np.ndarray, np.ndarray]]):
        self.pair = pair
        self.n_a = np.array([len(a) for a, _ in encoded], np.int64)
        self.n_b = np.array([len(b) for _, b in encoded], np.int64)
        self.first_a = np.concatenate([[0], np.cumsum(self.n_a)])
        self.first_b = np.concatenate([[0], np.cumsum(self.n_b)])
        self.a = np.concatenate([a for a, _ in encoded]) if encoded else np.empty(0, np.int64)
        self.b = np.concatenate([b for _, b in encoded]) if encoded else np.empty(0, np.int64)
        # Documents lie one after the other, with equal bytes on both sides, so offsets go through the batch.
        self.end_a = np.cumsum(pair.a_tokens.lengths[self.a])
        self.end_b = np.cumsum(pair.b_tokens.lengths[self.b])
        self.doc, self.left, self.right, self.cut = self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, token of A, token of B, whether both end together) of every link, in the order of the steps."""
        ends = np.concatenate([[0], self.end_a])[self.first_a]
        lanes = -(-(ends[1:] - ends[:-1]) // LANE)
        doc = np.repeat(np.arange(len(lanes)), lanes)
        start = ends[doc] + LANE * (np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        stop = np.minimum(start + LANE, ends[doc + 1])
        i, j = np.searchsorted(self.end_a, start, "right"), np.searchsorted(self.end_b, start, "right")
        # A lane takes the links whose common bytes begin in it; one that began before is the lane's before.
        end_a, end_b = self.end_a[i], self.end_b[j]
        start_a, start_b = end_a - self.pair.a_tokens.lengths[self.a[i]], end_b - self.pair.b_tokens.lengths[self.b[j]]
        skip = np.maximum(start_a, start_b) < start
        at = np.where(skip, np.minimum(end_a, end_b), start)
        i, j = i + (skip & (end_a <= end_b)), j + (skip & (end_b <= end_a))
        out: list[tuple[np.ndarray, ...]] = []
        while True:
            alive = at < stop
            if np.count_nonzero(alive) <= (1 - FINISHED) * len(alive):
                doc, i, j, at, stop = doc[alive], i[alive], j[alive], at[alive], stop[alive]
                if not len(doc):
                    break
                alive = None
            elif alive.all():
                alive = None
            # Finished lanes stay on their last tokens until the vector is compacted.
            k, m = (i, j) if alive is None else (i[alive], j[alive])
            end_a, end_b = self.end_a[k], self.end_b[m]
            first = np.minimum(end_a, end_b)
            moved_a, moved_b = end_a == first, end_b == first
            out.append((doc if alive is None else doc[alive], k, m, moved_a & moved_b))
            if alive is None:
                i, j, at = i + moved_a, j + moved_b, first
            else:
                i[alive], j[alive], at[alive] = k + moved_a, m + moved_b, first
        if not out:
            none = np.empty(0, np.int64)
            return none, none, none, none.astype(bool)
        doc, i, j, cut = (np.concatenate(x) for x in zip(*out))
        return doc, i, j, cut

    def codes(self) -> np.ndarray:
        """The pair of ids of every link as one number."""
        return self.a[self.left].astype(np.uint64) * self.pair.scale + self.b[self.right].astype(np.uint64)

    def links(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.n_a))

    def groups(self) -> np.ndarray:
        return np.bincount(self.doc[self.cut], minlength=len(self.n_a))

    def group_numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of the group, through the batch, of every token of A and of B."""
        numbers = []
        for tokens, cut in ((self.a, self.left[self.cut]), (self.b, self.right[self.cut])):
            ends = np.zeros(len(tokens) + 1, np.int64)
            ends[cut + 1] = 1
            numbers.append(np.cumsum(ends)[:-1])
        return numbers[0], numbers[1]

    def group_texts(self) -> list[bytes]:
        """The groups of every document, ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = self.group_numbers()
        total = int(self.cut.sum())
        per_a, per_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
        # In the text, a group's tokens of A come before those of B.
        place_a = np.arange(len(self.a)) + (np.cumsum(per_b) - per_b)[group_a] if total else group_a
        place_b = np.arange(len(self.b)) + np.cumsum(per_a)[group_b] if total else group_b
        decimals = once_per_worker("decimals", _Decimals)
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        sign = np.empty(len(ids), np.int64)
        for place, tokens, group, opening in ((place_a, self.a, group_a, ";"), (place_b, self.b, group_b, "|")):
            ids[place] = tokens
            new = np.ones(len(group), bool)
            new[1:] = group[1:] != group[:-1]
            sign[place] = np.where(new, decimals.signs.index(opening), decimals.signs.index(","))
        raw, ends = decimals.joined(ids, sign)
        bounds = np.concatenate([[0], ends])[self.first_a + self.first_b]
        return [raw[s + 1 : e] for s, e in zip(bounds[:-1], bounds[1:])]  # without the first sign


class _Decimals:
    """Ids as decimal numbers with a sign before them."""

    signs = ",;|"

    def __init__(self, size: int = 0):
        self.grow(size)

    def grow(self, size: int) -> None:
        self.size = size
        strings = [f"{s}{i}".encode() for i in range(size) for s in self.signs]
        self.tokens = Tokens(dict(enumerate(strings)) or {0: b""})

    def joined(self, ids: np.ndarray, sign: np.ndarray) -> tuple[bytes, np.ndarray]:
        if len(ids) and int(ids.max()) >= self.size:
            self.grow(int(ids.max()) + 1)
        entries = ids * len(self.signs) + sign
        return self.tokens.joined(entries).tobytes(), np.cumsum(self.tokens.lengths[entries])


def _planes(values: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, then the next ones: the upper ones are mostly zero and compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _pair(spec) -> Pair:
    parts = spec.value
    return once_per_worker(("alignment", parts["key"]), lambda: Pair(parts))


def _batches(pair: Pair, names: pd.Series, texts: pd.Series) -> Iterator[tuple[list, Aligned]]:
    """Aligned parts of a batch, bounded in bytes."""
    ids: list = []
    some: list[str | None] = []
    size = 0
    for name, text in zip(names.array, texts):
        ids.append(None if pd.isna(name) else name)
        some.append(text if isinstance(text, str) else None)
        size += len(some[-1] or "")
        if size > BATCH:
            yield ids, Aligned(pair, pair.encode(some))
            ids, some, size = [], [], 0
    if ids:
        yield ids, Aligned(pair, pair.encode(some))


def tables(spark: SparkSession, a_path: str, b_path: str):
    """Broadcast tokenizer parts of the two vocabulary files (bounded by the vocabularies)."""
    return spark.sparkContext.broadcast(load(a_path, b_path))


def aligned(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of both sides and where they meet: (doc_id, a_ids, b_ids, a_cuts, b_cuts, left, right), one row per input row.

    ``a_cuts`` and ``b_cuts`` number the tokens before each common end, so group g holds the tokens of A from a_cuts[g - 1] to
    a_cuts[g]. ``left`` and ``right`` are the places of the linked tokens. Texts that are null or empty, or whose bytes a
    tokenizer does not keep, have empty arrays. Other columns are not read.
    """
    spec = tables(docs.sparkSession, a_path, b_path)
    names = ["a_ids", "b_ids", "a_cuts", "b_cuts", "left", "right"]

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = _pair(spec)
        for batch in batches:
            for ids, found in _batches(pair, batch["doc_id"], batch["text"]):
                order = np.lexsort((found.right, found.left))  # links of a document in the order of its text
                left, right, cut = found.left[order], found.right[order], found.cut[order]
                bounds = np.concatenate([[0], np.cumsum(found.links())])
                rows = []
                for n, name in enumerate(ids):
                    a0, b0 = found.first_a[n], found.first_b[n]
                    x, y, c = (v[bounds[n] : bounds[n + 1]] for v in (left, right, cut))
                    parts = (found.a[a0 : found.first_a[n + 1]], found.b[b0 : found.first_b[n + 1]])
                    rows.append((name, *parts, x[c] - a0 + 1, y[c] - b0 + 1, x - a0, y - b0))
                yield pd.DataFrame(rows, columns=["doc_id", *names])

    schema = f"doc_id {dict(docs.dtypes)[doc_id]}, " + ", ".join(f"{n} array<long>" for n in names)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(align, schema)


def _measured(docs: DataFrame, spec, doc_id: str, text: str) -> DataFrame:
    """Digest columns that need one document only, and its distinct pairs with how often they are linked."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = _pair(spec)
        for batch in batches:
            for ids, found in _batches(pair, batch["doc_id"], batch["text"]):
                # Few documents make a batch, and pairs of two vocabularies leave room for their numbers above.
                links = np.sort((found.doc.astype(np.uint64) << DOC_BITS) | found.codes())
                starts = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]])) if len(links) else np.empty(0, np.int64)
                times, codes = np.diff(np.append(starts, len(links))), links[starts] & ((np.uint64(1) << DOC_BITS) - np.uint64(1))
                bounds = np.searchsorted(links[starts] >> DOC_BITS, np.arange(len(ids) + 1, dtype=np.uint64))
                texts = found.group_texts()
                yield pd.DataFrame(
                    {
                        "doc_id": ids,
                        "n_a": found.n_a,
                        "n_b": found.n_b,
                        "n_groups": found.groups(),
                        "n_links": found.links(),
                        "groups_sha256": [hashlib.sha256(t).hexdigest() if n else "" for t, n in zip(texts, found.n_a)],
                        # Ascending codes as differences.
                        "pairs": [_planes(np.diff(codes[s:e], prepend=np.uint64(0))) for s, e in zip(bounds[:-1], bounds[1:])],
                        "times": [_planes(times[s:e]) for s, e in zip(bounds[:-1], bounds[1:])],
                    }
                )

    schema = (
        f"doc_id {dict(docs.dtypes)[doc_id]}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs binary, times binary"
    )
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(measure, schema)


def _unpacked(pairs: pd.Series, times: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, times) of every distinct pair of the rows."""
    codes = [np.cumsum(_from_planes(x), dtype=np.uint64) for x in pairs]
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    none = [np.empty(0, np.uint64)]
    return row, np.concatenate(codes or none), np.concatenate([_from_planes(x) for x in times] or none).astype(np.int64)


def _summed(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined, numbers = np.concatenate(codes), np.concatenate(times)
    order = np.argsort(joined, kind="stable")
    joined, numbers = joined[order], numbers[order]
    starts = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]])) if len(joined) else np.empty(0, np.int64)
    return joined[starts], np.add.reduceat(numbers, starts) if len(starts) else numbers


def pair_counts(measured: DataFrame, b_size: int) -> DataFrame:
    """(code, n, best): links of every pair of ids in all documents, and whether no pair has more for its id of B."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, times, held = [], [], 0
        for batch in batches:
            _, c, t = _unpacked(batch["pairs"], batch["times"])
            c, t = _summed([c], [t])
            codes.append(c)
            times.append(t)
            held += len(c)
            if held > HELD_PAIRS:
                c, t = _summed(codes, times)
                codes, times, held = [c], [t], len(c)
                if held > HELD_PAIRS // 2:
                    yield pd.DataFrame({"code": c.astype(np.int64), "n": t})
                    codes, times, held = [], [], 0
        if codes:
            c, t = _summed(codes, times)
            yield pd.DataFrame({"code": c.astype(np.int64), "n": t})

    counts = measured.select("pairs", "times").mapInPandas(count, "code long, n long")
    counts = stored(counts.groupBy("code").agg(F.sum("n").alias("n")), "alignment-counts").withColumn("b", F.col("code") % b_size)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` by a broadcast table of all pairs."""
    table = counts.toArrow()
    code, n, best = (table.column(c).to_numpy() for c in ("code", "n", "best"))
    order = np.argsort(code)
    given = measured.sparkSession.sparkContext.broadcast((code[order], n[order], best[order]))

    @F.pandas_udf("n_best long, count_sum long")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        code, n, best = given.value
        for pairs, times in batches:
            row, codes, t = _unpacked(pairs, times)
            at = np.searchsorted(code, codes.astype(np.int64))
            sums = np.zeros((2, len(pairs)), np.int64)
            np.add.at(sums[0], row, t * best[at])
            np.add.at(sums[1], row, t * n[at])
            yield pd.DataFrame({"n_best": sums[0], "count_sum": sums[1]})

    return measured.withColumn("r", look_up("pairs", "times")).select("*", "r.*")


def _joined(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` by a join with the counts, for more pairs than may be broadcast."""
    named = stored(measured.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row, codes, times = _unpacked(batch["pairs"], batch["times"])
            yield pd.DataFrame({"row": batch["row"].to_numpy()[row], "code": codes.astype(np.int64), "times": times})

    links = named.select("row", "pairs", "times").mapInPandas(spread, "row long, code long, times long")
    sums = (
        links.join(counts, "code")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return named.join(sums, "row", "left").select(*measured.columns, *filled)


def digests(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """The alignment of every text in figures, one row per input row.

    Columns: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links whose pair of ids is linked in all documents at least
    as often as any other pair of its id of B), count_sum (over the links, how often their pair is linked), groups_sha256 (of
    ``a1,a2|b1;a3|b2,b3``, ids in order). Texts that are null or empty, or whose bytes a tokenizer does not keep, have no
    tokens: zeros and ''. Repeated rows count as often as they occur; other columns are not read; an empty table gives an
    empty result. Counts of up to ``broadcast_pairs`` pairs are broadcast, more are joined.
    """
    spec = tables(docs.sparkSession, a_path, b_path)
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    measured = stored(_measured(docs, spec, doc_id, text), "alignment-pairs")
    counts = stored(pair_counts(measured, b_size), "alignment-best")
    found = _looked_up(measured, counts) if counts.count() <= broadcast_pairs else _joined(measured, counts)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

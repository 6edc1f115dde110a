"""Language ID by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one bit per language at every position. Looking an n-gram up is an AND of the masks at
its few positions and returns all languages that contain it at once. A document's n-grams give one popcount per
language; what false positives add to a popcount is known from how full the language's slice is, and is taken off
before the largest one decides.

Filters are fitted on a bounded sample of labelled texts, ``sample_docs`` per language on average; everything else runs
over all texts. N-grams are runs of 3 and 4 characters inside a word and its two borders, lower-cased.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import once_per_worker
from tidegauge.session import stored

UNDETERMINED = "und"
SIZES = (3, 4)
HASHES = 3
POSITION_BITS = 20
#: Most n-grams per language and size, which bounds the filter and what the driver collects to build it.
GRAMS = 40_000
#: An n-gram belongs to a language in which it is at least this often as frequent as in its main language.
SHARE = 0.2
#: Characters worked on at a time, which bounds a worker's memory for texts of any length.
BLOCK = 1 << 19

# Odd 64-bit multipliers of the n-gram hash.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


@dataclass(frozen=True)
class Filters:
    """Masks per position (one array per 64 languages), how full each language's slice is, and the languages."""

    languages: list[str]
    masks: list[np.ndarray]
    fill: np.ndarray
    usual: int = 0  # the most frequent language, for texts of which nothing is known
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def letter_table() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for everything else."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _letters() -> np.ndarray:
    return once_per_worker("letters", letter_table)


def grams(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of all n-grams of ``codes``, where 0 separates words and never stands inside a gram."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inner = np.ones(count, bool)
    for i in range(1, size - 1):
        inner &= codes[i : i + count] != 0
    at = np.flatnonzero(inner)
    hashes = np.full(len(at), size, np.uint64)
    for i in range(size):
        hashes = (hashes ^ codes[at + i].astype(np.uint64)) * MULTIPLIERS[i % 4]
        hashes ^= hashes >> np.uint64(29)
    return hashes, at


def blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, text number of each code) of blocks of texts; a long text is cut at a separator, or anywhere if it has
    none for a whole block."""
    letters = _letters()

    def block(parts: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        zero = np.zeros(1, np.uint32)
        codes = np.concatenate([x for _, p in parts for x in (zero, p)] + [zero])
        owner = np.concatenate([np.full(len(p) + 1, n, np.int64) for n, p in parts] + [np.array([parts[-1][0]])])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        return codes[keep], owner[keep]

    waiting, size = [], 0
    for n, text in enumerate(texts):
        codes = letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        while len(codes):
            part = codes[:BLOCK]
            if len(codes) > BLOCK:
                gaps = np.flatnonzero(part == 0)
                part = part[: gaps[-1] + 1] if len(gaps) else part
            waiting.append((n, part))
            size += len(part)
            codes = codes[len(part) :]
            if size >= BLOCK:
                yield block(waiting)
                waiting, size = [], 0
    if waiting:
        yield block(waiting)


def positions(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The filter positions of n-grams, one array per hash function."""
    for i in range(HASHES):
        yield (hashes >> np.uint64(64 - POSITION_BITS * (i + 1))).astype(np.int64) & ((1 << POSITION_BITS) - 1)


def build(languages: list[str], contained: list[np.ndarray], usual: int) -> Filters:
    """Filters of the n-gram hashes that each language contains."""
    masks = []
    for first in range(0, max(1, len(languages)), 64):
        group = contained[first : first + 64]
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(group) <= np.dtype(t).itemsize * 8)
        mask = np.zeros(1 << POSITION_BITS, kind)
        for bit, hashes in enumerate(group):
            for at in positions(hashes):
                mask[at] |= kind(1 << bit)
        masks.append(mask)
    fill = np.array([np.mean((masks[i // 64] >> masks[i // 64].dtype.type(i % 64)) & 1) for i in range(len(languages))])
    return Filters(languages, masks, fill, usual)


def popcounts(texts: list[str], filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams per text, n-grams per text and language as the filters answer)."""
    total = np.zeros(len(texts), np.int64)
    hits = np.zeros((len(texts), len(filters.languages)), np.int64)
    for codes, owner in blocks(texts):
        for size in SIZES:
            hashes, at = grams(codes, size)
            if not len(at):
                continue
            # An n-gram that begins at a text's leading separator belongs to that text.
            of = owner[at + 1]
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            texts_here = of[starts]
            total[texts_here] += np.diff(np.append(starts, len(of)))
            places = list(positions(hashes))
            for word, mask in enumerate(filters.masks):
                answer = mask[places[0]]
                for place in places[1:]:
                    answer &= mask[place]
                for bit in range(min(64, len(filters.languages) - 64 * word)):
                    one = (answer >> mask.dtype.type(bit)) & mask.dtype.type(1)
                    hits[texts_here, 64 * word + bit] += np.add.reduceat(one, starts, dtype=np.int64)
    return total, hits


def decide(texts: list[str | None], filters: Filters) -> list[tuple[str, float, float]]:
    """(language, score, coverage) of each text."""
    total, hits = popcounts([t or "" for t in texts], filters)
    wrong = filters.fill**HASHES
    known = np.maximum(0.0, (hits - total[:, None] * wrong) / (1 - wrong))
    out = []
    for text, n, counts in zip(texts, total, known):
        if not filters.languages or not text or not (n or any(c.isalpha() for c in text)):
            out.append((UNDETERMINED, 0.0, 0.0))
        elif counts.max() <= 0:
            out.append((filters.languages[filters.usual], 0.0, 0.0))
        else:
            best = int(counts.argmax())  # languages are sorted, so the first in code point order wins a tie
            second = np.delete(counts, best).max(initial=0.0)
            out.append((filters.languages[best], float(1 - second / counts[best]), float(min(1.0, counts[best] / n))))
    return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", sample_docs: int = 1000) -> Filters:
    """Filters from the rows of ``docs`` with a language and a text.

    ``sample_docs`` bounds the texts per language: with more, rows are taken by a hash of ``key`` at the rate that
    gives that many on average. N-grams of the sample are counted per language as a Spark job, and at most ``GRAMS``
    per language and size come back to build the filters. Without labelled texts there are no languages.
    """
    labelled = docs.select(
        F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Filters([], [], np.zeros(0))
    rates = F.create_map(*[F.lit(x) for l in languages for x in (l, min(1.0, sample_docs / sizes[l]))])
    chance = F.shiftrightunsigned(F.xxhash64("key", F.lit("language sample")), 11) / F.lit(float(1 << 53))
    sample = stored(labelled.filter(chance < rates[F.col("lang")]).select("lang", "text"), "language-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, rows in batch.groupby("lang"):
                for codes, _ in blocks(list(rows["text"])):
                    for size in SIZES:
                        values, counts = np.unique(grams(codes, size)[0], return_counts=True)
                        yield pd.DataFrame(
                            {"lang": language, "size": size, "gram": values.view(np.int64), "n": counts.astype(np.int64)}
                        )

    counted = (
        sample.mapInPandas(count, "lang string, size int, gram long, n long")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counted.groupBy("lang", "size").agg(F.sum("n").alias("total"))  # a row per language and size
    rated = counted.filter("n > 1").join(F.broadcast(totals), ["lang", "size"]).withColumn("rate", F.expr("n / total"))
    best = rated.groupBy("size", "gram").agg(F.max("rate").alias("best"))
    kept = rated.join(best, ["size", "gram"]).filter(F.col("rate") >= SHARE * F.col("best"))
    contained = []
    kept = stored(kept.select("lang", "size", "gram", "n"), "language-grams")
    for language in languages:
        parts = [
            kept.filter((F.col("lang") == language) & (F.col("size") == size))
            .orderBy(F.desc("n"), "gram")
            .limit(GRAMS)
            .select("gram")
            .toPandas()["gram"]
            .to_numpy(np.int64)
            for size in SIZES
        ]
        contained.append(np.concatenate(parts).view(np.uint64))
    return build(languages, contained, max(range(len(languages)), key=lambda i: sizes[languages[i]]))


SCHEMA = "lang_pred string, score double, coverage double"


def predictor(docs: DataFrame, filters: Filters):
    """A column function text -> struct(lang_pred, score, coverage). The filters are broadcast; their size is fixed."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf(SCHEMA)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = decide([t if isinstance(t, str) else None for t in batch], shared.value)
            yield pd.DataFrame(found, columns=["lang_pred", "score", "coverage"])

    return predict


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: every fifth document by a checksum of its id; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.filter(F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))


def identified(docs: DataFrame, sample_docs: int = 1000, doc_id: str = "doc_id", lang: str = "lang", text: str = "text"):
    """Language of every whole text: (doc_id, held_out, lang_pred, score, coverage), one row per input row.

    Filters are fitted on rows outside the held-out fold; prediction reads the text alone, so repeated rows and texts
    get equal results. Null texts, texts without a letter, and every text if nothing is labelled, are ``und`` with
    score 0. A text whose n-grams are all unknown gets the most frequent language with score 0. ``score`` is how far
    the second language falls behind, ``coverage`` the share of n-grams that the language contains.
    """
    filters = fit(training_rows(docs, doc_id), lang, text, doc_id, sample_docs)
    found = predictor(docs, filters)(F.col(text))
    return docs.select(
        F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), found.alias("r")
    ).select("doc_id", "held_out", "r.*")

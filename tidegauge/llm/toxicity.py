"""Toxicity as cumulative-link ordinal regression over sparse text features.

Severity grades are ordered: 0 is harmless, 1 toxic, 2 toxic in a text of poor quality. One weight vector serves all
thresholds: P(grade > k) = sigmoid(weights . features - threshold k). The expected severity is the sum of these
probabilities, from 0 to the highest grade.

Features are words and word beginnings, present or not. Only those that stand out are kept: a feature's share of toxic
texts must exceed the overall share by evidence that is the same for tables of any size; the ridge shrinks those that
tell little. The model is fitted on a bounded sample of labelled texts (``sample_docs``). Without labels of both kinds,
or if no feature stands out, nothing is known: every text has severity 0.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import once_per_worker
from tidegauge.session import stored

GRADES = 3
#: Lengths of word beginnings that are features of their own.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Longest word; in longer runs of letters a word may begin at every letter.
LONGEST = 40
#: Evidence above which a feature is kept: the chance of so large a share by accident is below exp(-EVIDENCE).
EVIDENCE = 4.0
#: Most features kept, the most telling first; bounds what the driver collects.
MOST_FEATURES = 4000
REMEMBERED = 400_000
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: list[float]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def word_features(chunk: str) -> Iterator[str]:
    """Features of a run of text without white space: its words, and their beginnings marked with a star."""
    for match in LETTERS.finditer(chunk.lower()):
        word = match.group()
        if len(word) > LONGEST:
            for n in BEGINNINGS:
                yield from (word[i : i + n] + "*" for i in range(len(word) - n + 1))
        else:
            yield word
            yield from (word[:n] + "*" for n in BEGINNINGS if len(word) > n)


def sketch(text: str) -> int:
    """The smallest checksum of the text's word triples; near copies mostly share it."""
    words = text.lower().split()
    return min((hash_text(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)


def hash_text(text: str) -> int:
    from zlib import crc32

    return crc32(text.encode("utf-8", "surrogatepass"))


class Weigher(dict):
    """Chunk of text -> its features that have a weight."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, chunk: str) -> tuple[str, ...]:
        found = tuple({f for f in word_features(chunk) if f in self.weights})
        if len(chunk) <= LONGEST:
            if len(self) > REMEMBERED:
                self.clear()
            self[chunk] = found
        return found

    def features(self, text: str) -> set[str]:
        return set().union(*filter(None, map(self.__getitem__, set(text.split()))))


def exceed(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) per row and threshold."""
    return 1 / (1 + np.exp(-np.clip(scores[:, None] - thresholds[None, :], -30, 30)))


def fit_ordinal(
    rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, features: int, ridge: float = 0.003, rounds: int = 1500
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient ascent (Adam) on the penalised likelihood.

    Row ``rows[i]`` has feature ``cols[i]``; a row's features are averaged, so that a single telling word suffices and the
    length of a text does not matter. Thresholds are a first value and logarithms of gaps, so they stay ordered.
    """
    shares = [np.clip(np.mean(grades > k), 1e-4, 1 - 1e-4) for k in range(GRADES - 1)]
    first = math.log(1 / shares[0] - 1)
    gaps = [math.log(max(0.1, math.log(1 / shares[k] - 1) - math.log(1 / shares[k - 1] - 1))) for k in range(1, GRADES - 1)]
    values = np.concatenate([np.zeros(features), [first], gaps])
    moment, square = np.zeros_like(values), np.zeros_like(values)
    n = len(grades)
    each = (1 / np.maximum(1, np.bincount(rows, minlength=n)))[rows]
    for step in range(1, rounds + 1):
        weights = values[:features]
        thresholds = values[features] + np.concatenate([[0.0], np.cumsum(np.exp(values[features + 1 :]))])
        scores = np.bincount(rows, weights[cols] * each, n)
        above = np.hstack([np.ones((n, 1)), exceed(scores, thresholds), np.zeros((n, 1))])
        slope = above * (1 - above)  # derivative of P(grade > k - 1) by the score
        at = np.arange(n)
        likely = np.maximum(above[at, grades] - above[at, grades + 1], 1e-9)
        by_score = (slope[at, grades] - slope[at, grades + 1]) / likely
        by_threshold = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_threshold[k] = np.sum(slope[:, k + 1] / likely * ((grades == k).astype(float) - (grades == k + 1)))
        gradient = np.concatenate(
            [
                np.bincount(cols, by_score[rows] * each, features) - ridge * weights,
                [by_threshold.sum()],
                [by_threshold[k:].sum() * math.exp(values[features + k]) for k in range(1, GRADES - 1)],
            ]
        )
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        values = values + 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    thresholds = values[features] + np.concatenate([[0.0], np.cumsum(np.exp(values[features + 1 :]))])
    return values[:features], thresholds


def graded(labels: DataFrame, doc_id: str = "doc_id", toxic: str = "toxic", quality: str = "quality") -> DataFrame:
    """(doc_id, grade) of labelled documents; labels without an id or a toxic mark are left out, the worst one counts."""
    grade = F.when(F.col(toxic) == 0, 0).when(F.col(quality) == 1, 1).otherwise(2)
    return (
        labels.filter(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(grade).alias("grade"))
    )


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 20_000, doc_id: str = "doc_id", text: str = "text") -> Model:
    """The model of labelled documents; ``labels`` has (doc_id, grade).

    With more than ``sample_docs`` labels, documents are taken by a hash of their id at the rate that gives that many
    on average. Of texts with the same sketch (mostly near copies) one is kept, so that a large group of copies does
    not pass for evidence. Without labels of both kinds the model knows no features and no thresholds: severity is 0.
    """
    count = labels.count()
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxicity sample")), 11) / F.lit(float(1 << 53))
    chosen = labels.filter(chance < min(1.0, sample_docs / max(1, count)))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    # The chosen labels have a bounded number, so the texts need no shuffle.
    found = texts.join(F.broadcast(chosen), "doc_id")

    @F.pandas_udf("long")
    def sketches(column: pd.Series) -> pd.Series:
        return column.map(sketch)

    sampled = stored(found.select("doc_id", "grade", "text", sketches("text").alias("sketch")), "toxicity-sample")
    single = sampled.groupBy("sketch", "grade").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    sample = sampled.join(F.broadcast(single), "doc_id", "left_semi").select("doc_id", "grade", "text")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("grade") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    harmless, toxic = totals.get(False, 0), totals.get(True, 0)
    if not harmless or not toxic:
        return Model({}, [])

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts_with, toxic_with = Counter(), Counter()
            for grade, body in zip(batch["grade"], batch["text"]):
                features = set().union(*map(word_features, set(body.split())))
                texts_with.update(features)
                if grade > 0:
                    toxic_with.update(features)
            yield pd.DataFrame(
                {"feature": list(texts_with), "n": list(texts_with.values()), "t": [toxic_with[f] for f in texts_with]}
            )

    counted = stored(
        sample.mapInPandas(presence, "feature string, n long, t long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("t").alias("t")),
        "toxicity-features",
    )
    base = toxic / (harmless + toxic)
    # Chernoff's bound on the chance of so large a share: n times the divergence from the overall share.
    share = (F.col("t") - 0.001) / F.col("n")
    divergence = F.col("n") * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))
    telling = (
        counted.filter(F.col("t") > 0)
        .withColumn("evidence", F.when(share > base, divergence))
        .filter(F.col("evidence") > EVIDENCE)
        .orderBy(F.desc("evidence"), "feature")
        .limit(MOST_FEATURES)
        .collect()
    )
    if not telling:
        return Model({}, [])
    names = sorted(r["feature"] for r in telling)
    place = {f: i for i, f in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    @F.pandas_udf("array<int>")
    def selected(column: pd.Series) -> pd.Series:
        known = shared.value
        return column.map(
            lambda body: sorted(known[f] for f in set().union(*map(word_features, set(body.split()))) if f in known)
        )

    rows = sample.select("doc_id", "grade", selected("text").alias("features")).orderBy("doc_id", "grade").collect()
    grades = np.array([r["grade"] for r in rows], np.int64)
    at = np.array([i for i, r in enumerate(rows) for _ in r["features"]], np.int64)
    cols = np.array([f for r in rows for f in r["features"]], np.int64)
    weights, thresholds = fit_ordinal(at, cols, grades, len(names))
    return Model({f: float(w) for f, w in zip(names, weights) if w}, [float(x) for x in thresholds])


def predictor(docs: DataFrame, model: Model):
    """A column function text -> struct(severity, grade, n_features); the broadcast model has a bounded size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int, n_features int")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        weigher = once_per_worker(("toxicity", fitted.key), lambda: Weigher(fitted.weights))
        thresholds = np.array(fitted.thresholds)
        for batch in batches:
            found = [weigher.features(t) if isinstance(t, str) else set() for t in batch]
            scores = np.array([sum(sorted(fitted.weights[f] for f in fs)) / max(1, len(fs)) for fs in found], float)
            above = exceed(scores, thresholds)
            likely = -np.diff(np.hstack([np.ones((len(scores), 1)), above, np.zeros((len(scores), 1))]), axis=1)
            yield pd.DataFrame(
                {
                    "severity": above.sum(axis=1),
                    "grade": likely.argmax(axis=1).astype(np.int32),
                    "n_features": np.array([len(f) for f in found], np.int32),
                }
            )

    return predict


def scored(docs: DataFrame, labels: DataFrame, sample_docs: int = 20_000, doc_id: str = "doc_id", text: str = "text"):
    """Severity of every whole text: (doc_id, severity, grade, n_features), one row per input row.

    ``severity`` is the expected grade (0 to 2), ``grade`` the likeliest, ``n_features`` how many weighty features the
    text has. Null and empty texts have none and get the severity of an ordinary text; repeated rows get equal results.
    """
    model = fit(docs, graded(labels), sample_docs, doc_id, text)
    found = predictor(docs, model)(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), found.alias("r")).select("doc_id", "r.*")

"""A corpus from raw documents: language, toxicity, near duplicates, source mixture, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bpe, language, mixing, ngram_join, toxicity
from tidegauge.llm.common import documents, for_workers
from tidegauge.session import configure, stored, table

#: Least share of a text's n-grams that its language must know. Texts of a learned language are far above it.
COVERAGE = 0.3
#: Expected severity from which a document is rejected: half a grade.
SEVERITY = 0.5

#: Sampling, fitted models and token ids have no SQL.
ORACLE_SQL = None


def ready(spark: SparkSession) -> SparkSession:
    return for_workers(configure(spark))


def _beside(docs: DataFrame) -> DataFrame:
    """The rows as one column, so that what a stage finds out about them clashes with no column of theirs."""
    return docs.select(F.struct("*").alias("doc"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text is in a learned language; texts that are null, without letters or unknown go."""
    ready(spark)
    filters = language.fit(language.training_rows(docs))
    found = _beside(docs).withColumn("found", language.predictor(docs, filters)("doc.text"))
    kept = (F.col("found.lang_pred") != language.UNDETERMINED) & (F.col("found.coverage") >= COVERAGE)
    return found.filter(kept).select("doc.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with an expected severity below half a grade; fitted on the labels of the documents left.

    Null and empty texts have no features and stay. Without labels of both kinds nothing is known to be toxic and all
    documents stay.
    """
    ready(spark)
    labels = toxicity.graded(table(spark, sf_dir, "labels"))
    labels = labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    model = toxicity.fit(docs, labels)
    found = _beside(docs).withColumn("found", toxicity.predictor(docs, model)("doc.text"))
    return found.filter(F.col("found.severity") < SEVERITY).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group linked by shingles, the one with the smallest id, then the smallest text digest.

    Rows are told apart by id and text, so ids may be null or repeated; null ids come last. Of rows with equal id and
    text one stays. Documents without words are in no group and stay.
    """
    ready(spark)
    digest = F.unhex(F.sha2("doc.text", 256))
    named = _beside(docs).withColumn("digest", digest)
    row = F.struct(F.col("doc.doc_id").isNull().alias("unnamed"), F.col("doc.doc_id").alias("doc_id"), "digest")
    linked = ngram_join.linked(named.select(row.alias("row"), F.col("doc.text").alias("text")), "row")
    first = (F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id"))
    keep = linked.filter(first).select(F.col("doc_id.doc_id").alias("kept_id"), F.col("doc_id.digest").alias("kept_digest"))
    keep = stored(keep.distinct(), "pipeline-kept")
    same = F.col("doc.doc_id").eqNullSafe(F.col("kept_id")) & F.col("digest").eqNullSafe(F.col("kept_digest"))
    rows = named.join(keep, same, "left_semi")
    if _repeats(named):
        rows = rows.groupBy(F.col("doc.doc_id").alias("id"), "digest").agg(F.any_value("doc").alias("doc"))
    return rows.select("doc.*")


def _repeats(named: DataFrame) -> bool:
    counted = named.groupBy("doc.doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1").limit(1).count() > 0


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats every document as often as the mixture takes it; documents not taken go, as do those without words.

    Documents are drawn by id and text; what a document's source contributes is one row, and no text is moved.
    """
    configure(spark)
    plan = mixing.planned(stored(mixing.measured(docs), "pipeline-sizes"))
    size = mixing.size_of(F.col("doc.text"))
    known = _beside(docs).withColumns({"size": size, "u": mixing.random_of(F.col("doc.doc_id"), F.col("doc.text"))})
    taken = known.join(plan, F.col("doc.source").eqNullSafe(F.col("of"))).filter(F.col("size") > 0)
    taken = taken.withColumn("times", mixing.times(F.col("size"), F.col("u"))).filter(F.col("times") > 0)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them, one row per document taken.

    A null or empty text has no tokens.
    """
    ready(spark)
    return bpe.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixture", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result but the last is stored in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of the training-data operators: each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    alignment,
    bpe,
    fingerprints,
    language,
    lexical_search,
    licences,
    mixing,
    neighbours,
    ngram_join,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)
from tidegauge.llm.common import documents, llm_query
from tidegauge.session import table


@llm_query("op1_multiset_fingerprints")
def op1_multiset_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited(documents(spark, folder))


@llm_query("op2_lpt_shards")
def op2_lpt_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(documents(spark, folder))


@llm_query("op3_pareto_mixture", mixing.SQL)
def op3_pareto_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@llm_query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(documents(spark, folder))


@llm_query("op5_nn_descent")
def op5_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@llm_query("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked(documents(spark, folder))


@llm_query("op7_licence_scan")
def op7_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scanned(documents(spark, folder)).drop("spans")


@llm_query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@llm_query("op9_bpe_round_trip")
def op9_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@llm_query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(documents(spark, folder), table(spark, folder, "labels"))


@llm_query("op11_lockstep_alignment")
def op11_lockstep_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.digests(documents(spark, folder), a, b)


@llm_query("op12_presence_masks", lexical_search.SQL)
def op12_presence_masks(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked(table(spark, folder, "benchmark"), documents(spark, folder))


@llm_query("op13_difference_cover", substring_dedup.SQL)
def op13_difference_cover(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.kept_digests(documents(spark, folder))

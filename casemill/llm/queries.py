"""Registered queries of this subpackage; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.llm import (
    decontamination,
    impact_search,
    negative_mining,
    ngram_join,
    pages,
    pieces,
    quality_classifier,
    quality_rules,
    search_sql,
    segment_search,
    sharding,
    token_counts,
    token_files,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_classifier.scored(documents, quality_classifier.train(documents, table(spark, sf_dir, "labels")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), sharding.SHARDS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return negative_mining.mine(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_ngram_join, op2_pieces, op3_toxicity, op4_quality_rules, op5_quality_classifier, op6_sharding, op7_token_counts, op8_main_text, op9_token_files, op10_decontamination, op11_ranked_documents, op12_top_k, op13_hard_negatives]
    return {query.__name__: query for query in found}


def llm_checks() -> dict[str, str]:
    return {"op11_ranked_documents": search_sql.LEXICAL, "op12_top_k": search_sql.NEAREST, "op13_hard_negatives": search_sql.NEGATIVES}

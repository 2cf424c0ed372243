"""The operators' queries over the given tables, each with production parameters and over all rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.llm import bpe, classifier, decontaminate, divergence, html_text, language, near_copies, pii, quality, secrets, sharding, simhash, token_counts, whitening

VOCABULARY = "word_bpe_49k.json"


#: Rows of an Arrow batch: with Spark's default of 10,000 a Python worker would hold tens of MB of texts several times over.
BATCH_ROWS = "1000"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, similarity, start, n_words of every document and benchmark item that it holds."""
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base_failed and kept of every document."""
    docs = _read(spark, sf_dir, "documents")
    return quality.assess(docs, quality.train_crf(docs, _read(spark, sf_dir, "labels")))


def op4_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and grown_shard of every document."""
    return sharding.sharded(_read(spark, sf_dir, "documents"))


def op5_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang_pred and score of every document."""
    docs = _read(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    return bpe.round_trip_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets of every document."""
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extracted(_read(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, tokens and over_limit of every document."""
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data of every document."""
    return pii.detected(_read(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that each overuses."""
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _read(spark, sf_dir, "documents")
    return classifier.score(docs, classifier.train(docs, _read(spark, sf_dir, "labels")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading whitened components of every usable embedding."""
    vectors = _read(spark, sf_dir, "embeddings")
    return whitening.whitened(vectors, whitening.fit(vectors))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_duplicates,
        op2_benchmark_decontamination,
        op3_quality_rules,
        op4_jump_hash_shards,
        op5_language_identification,
        op6_bpe_round_trip,
        op7_secret_scan,
        op8_html_main_text,
        op9_token_counts,
        op10_personal_data,
        op11_source_divergence,
        op12_quality_classifier,
        op13_embedding_whitening,
    )
}
ORACLE_SQL: dict[str, str] = {"op4_jump_hash_shards": sharding.ORACLE, "op11_source_divergence": divergence.ORACLE}


# The pipeline's stages: each takes the documents that its predecessor kept.


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The field is fitted on the stage's own input."""
    return quality.kept_documents(docs, quality.train_crf(docs, _read(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word Jaccard similarity of 0.8 or more): the one with the least id."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return near_copies.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, _read(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by the kind's name, n_chars counted anew."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    clean = docs.withColumn("text", secrets.redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return bpe.round_trip_digests(docs, public_tokenizers.path(VOCABULARY))

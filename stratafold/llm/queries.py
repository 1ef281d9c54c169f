"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.llm import embeddings, langid, negatives, quality, secrets, toxicity, tries, warc
from stratafold.llm.common import table
from stratafold.llm.embeddings import near_vectors
from stratafold.llm.mixing import mix, mix_summary
from stratafold.llm.simhash import near_duplicates
from stratafold.llm.tokens import best_fit_documents, packed_documents, token_counts


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_language(docs, langid.fit(docs))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_summary(*mix(table(spark, sf_dir, "documents")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed, _ = packed_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, sizes = tries.ordered_turns(table(spark, sf_dir, "conversations"))
    return tries.trie(*tries.shared_prefixes(turns, sizes))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed, _ = best_fit_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality.oracle(), "op3_embedding_near_dedup": embeddings.oracle(), "op5_warc": warc.oracle(), "op8_secret_scan": secrets.oracle(), "op11_prefix_trie": tries.oracle(), "op13_hard_negatives": negatives.oracle()}

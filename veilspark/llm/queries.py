"""The registered queries of this subpackage: name -> fn(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    align, bpe, embeddedup, exactdedup, langid, lexical, licenses, linededup, minhash, mixing, quality, rules, toxicity)
from .common import crc_mod, workers_import


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer() -> bpe.Tokenizer:
    return bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = tokenizer()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(tok.encode(docs, decoded="decoded"))


def token_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = crc_mod("doc_id", 3) == 1
    chain = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.tag(docs.select("doc_id", "text", held_out.alias("held_out")), chain).select(
        "doc_id", "held_out", "score", (F.col("score") >= toxicity.TOXIC_SCORE).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 5) == 0
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_boilerplate(docs, dropped_col="dropped_lines").select(
        "doc_id", "source", "text", F.col("dropped_lines").cast("long").alias("dropped_lines"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_groups(docs).select("doc_id", "class_id", "class_size", "kept")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs, budget=mixing.BUDGET).select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("p", 6).alias("p"), "kept")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = crc_mod("doc_id", 4) == 2
    model = quality.fit(docs, labels.where(~held_out))
    return quality.score(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", "score", (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "licence", "licence_class", F.col("licence_rule").cast("int").alias(
        "licence_rule"), "sentence_ids")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddedup.embedding_groups(table(spark, sf_dir, "embeddings"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligner = align.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return align.align(table(spark, sf_dir, "documents").select("doc_id", "text"), aligner).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumn(
        "ratio", F.round("ratio", 6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_byte_bpe, op2_toxicity, op3_language_id, op4_line_dedup, op5_minhash_dedup, op6_mixing, op7_quality,
        op8_license_scan, op9_embedding_dedup, op10_exact_dedup, op11_token_alignment, op12_lexical_search,
        op13_quality_rules)
}

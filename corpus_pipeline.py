"""The corpus pipeline: quality classifier, line dedup, near-dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read back as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import linededup, minhash, mixing, quality
from veilspark.llm.common import drop_stored, last_stored, released, stored, workers_import
from veilspark.llm.queries import table, token_digests, tokenizer


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; n_chars follows."""
    return linededup.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    workers_import(spark)
    return minhash.near_dedup(docs)


def mixing_sample(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and kinds of text meet their target shares."""
    return mixing.sample(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    workers_import(spark)
    tok = tokenizer()
    return token_digests(tok.encode(docs.select("doc_id", "text"), decoded="decoded"))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing_sample),
    ("byte-level BPE encoding and decoding", bpe),
]

#: None: a learned classifier and hashed signatures are not SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; once a stage's result is written, what it stored on its way and what it read
    are deleted."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with released(spark) as keep:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
            keep.append(last_stored())
        if read:
            drop_stored(spark, read)
        read = keep[0]
    return STAGES[-1][1](spark, docs, sf_dir)

"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Every step groups only what the step before could not tell apart:

1. byte lengths held by two rows or more survive;
2. of those rows, (length, hash of the first bytes) held by two or more survive;
3. only rows that survive both have their full content hashed and grouped.

All three groupings combine map-side, so a group with a third of all rows costs
one row per task. The joins are plain semi/left joins that AQE may split.

Defined cases: a null text equals the empty text; equal texts in rows with null
ids form groups as any other (a null id never wins over an id); a row repeated
with its id stays once; an empty table gives an empty result. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     prefix_chars: int = 256) -> DataFrame:
    """Groups of two or more equal texts: text_sha256, keep_id (largest id), group_size."""
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("body")).withColumn(
        "bytes", F.octet_length("body"))
    lengths = stored(rows.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bytes"),
                     "lengths")
    prefix = F.xxhash64(F.substring("body", 1, prefix_chars))
    same_length = rows.join(lengths, "bytes", "left_semi").select("id", "bytes", "body", prefix.alias("prefix"))
    prefixes = stored(
        same_length.select("bytes", "prefix").groupBy("bytes", "prefix").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("bytes", "prefix"), "prefixes")
    survivors = (rows.withColumn("prefix", prefix).join(prefixes, ["bytes", "prefix"], "left_semi")
                 .select("id", F.sha2("body", 256).alias("text_sha256")))
    return (survivors.groupBy("text_sha256").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .where("group_size > 1"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 256) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    groups = stored(duplicate_groups(docs, id_col, text_col, prefix_chars), "groups")
    # rows that repeat with their id are counted, then written out again: one of them may stay
    rows = (docs.select(F.col(id_col).alias("id"), F.sha2(whole_text(text_col), 256).alias("text_sha256"))
            .groupBy("id", "text_sha256").agg(F.count(F.lit(1)).alias("copies")))
    found = rows.join(groups, "text_sha256", "left").select(
        "id", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size",
                        ((F.col("copy") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                        "text_sha256")

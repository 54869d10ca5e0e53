"""Queries that once did less than their whole job."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from veilspark.llm import minhash, mixing, rules
from veilspark.llm.common import may_be_among


def test_op6_draws_its_budget_though_a_cell_is_rare(spark, tmp_path):
    rows = [(i, "w " * 200, "a", "en") for i in range(300)] + [(1000, "w " * 5, "b", "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = E.queries()["op6_mixing"](spark, str(tmp_path)).collect()
    tokens = sum(r["tokens"] for r in got)
    assert abs(sum(r["p"] * r["tokens"] for r in got) - mixing.BUDGET * tokens) < 1e-5 * tokens
    assert sum(r["kept"] for r in got) > 200  # one rare document does not set the size of the draw


def test_op13_trusts_every_document_that_the_labels_call_good(spark):
    n = 25_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("plain words").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert rules.trusted_ids(labels).count() == n
    # raw and trusted corpus are one, so no place is likelier in either
    assert rules.ratios(docs, rules.trusted_ids(labels)).where("ratio != 0").count() == 0


def test_op13_without_a_broadcast_of_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, "a c d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1), (3, 0)], "doc_id long, quality int")
    key = "spark.sql.autoBroadcastJoinThreshold"
    few, own = sorted(rules.quality_rules(docs, labels).collect(), key=repr), spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert sorted(rules.quality_rules(docs, labels).collect(), key=repr) == few
    finally:
        spark.conf.set(key, own)


def test_op13_shuffles_no_text_that_is_surely_not_trusted(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("plain words").alias("text")).unionByName(
        spark.createDataFrame([(None, "null id")] * 50 + [(7, "twice")], "doc_id long, text string"))
    trusted = spark.range(0, 20_000, 8).select("id")
    rows = rules.may_be_trusted(docs.withColumnRenamed("doc_id", "id"), trusted.withColumnRenamed("id", "trusted_id"))
    maybe = rows.where("maybe")
    assert rows.count() == 20_051 and maybe.where("id % 8 = 0").count() == 2500
    assert maybe.count() < 2600 and maybe.where("id IS NULL").count() == 0
    # few bits: nearly every id hits one, and the ids decide
    few = rules.may_be_trusted(docs.withColumnRenamed("doc_id", "id"), trusted.withColumnRenamed("id", "trusted_id"), 64)
    assert few.where("maybe").count() == 20_001
    assert rules.marked(docs, trusted).where("good = 1").count() == 2500 and rules.marked(docs, trusted).count() == 20_051


def test_op13_ids_of_two_types(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (None, "d")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1), (3, 1), (2, 0)], "doc_id long, quality int")
    got = rules.marked(docs, rules.trusted_ids(labels)).collect()
    assert sorted(map(tuple, got)) == [("a b", 1), ("c", 0), ("d", 0)]


def test_may_be_among_misses_no_key(spark):
    rows = spark.createDataFrame([(i if i % 10 else None, f"t{i}", i) for i in range(1000)], "a long, b string, bucket_ int")
    keys = rows.where("bucket_ % 7 = 0").selectExpr("a AS x", "b AS y").unionByName(spark.createDataFrame([(5, None)], "x long, y string"))
    got = may_be_among(rows, ["a", "b"], keys, ["x", "y"])
    assert got.columns == ["a", "b", "bucket_", "maybe"] and got.count() == 1000
    assert got.where("maybe AND bucket_ % 7 = 0").count() == 143 and got.where("maybe").count() < 150
    assert may_be_among(rows, ["a", "b"], keys.limit(0), ["x", "y"]).where("maybe").count() == 0


def test_near_dedup_leaves_rows_that_stay_where_they_are(spark):
    """Without a broadcast of the rows that go, the texts of all others are still not shuffled."""
    text = F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), F.col("id").cast("string")) for k in range(8)])
    docs = spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), text.alias("text"))
    copies = docs.where("doc_id < 5").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    key = "spark.sql.autoBroadcastJoinThreshold"
    own = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = minhash.near_dedup(docs.unionByName(copies)).select("doc_id", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set(key, own)
    assert sorted(r["doc_id"] for r in got) == list(range(400))
    assert all(len({r["part"] for r in got if r["doc_id"] // 100 == k}) == 1 for k in range(4))

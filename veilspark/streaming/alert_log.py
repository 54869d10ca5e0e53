"""The per-event alert log (T6-T10): a sink that a replayed batch cannot write twice.

A micro-batch writes its alerts to a folder of its own (stream and batch id), overwriting
what a failed attempt may have left there, and then adds one row to the ledger. A batch
that the ledger has is skipped, and readers see only batches that it has, so neither a
replay nor a half-written batch shows. Each alert's id is a hash of what it says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import detect as D
from ..operators.audit import spread_for_write

LEDGER = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("alerts", T.LongType()),
    T.StructField("stream", T.StringType()),
])
ALERTS = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("trigger_type", T.StringType()),
    T.StructField("log_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("role_name", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def alert_id() -> Column:
    """Deterministic id of an alert: two alerts that say the same have the same."""
    return F.left(F.sha2(F.concat_ws("|", "trigger_type", "log_id", F.coalesce("detail", F.lit(""))), 256), F.lit(32))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, alerts, stream) of every batch that is complete."""
    where = f"{path}/ledger"
    return spark.read.schema(LEDGER).parquet(where) if _exists(spark, where) else spark.createDataFrame([], LEDGER)


def alert_writer(path: str, stream: str):
    """foreachBatch function for a feed of ``event_alerts``; ``stream`` names the query (its checkpoint)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
        if not ledger(spark, path).where(own).isEmpty():
            return
        target = f"{path}/alerts/stream={stream}/batch_id={batch_id}"
        rows = batch.select(alert_id().alias("alert_id"), "trigger_type", "log_id",
                            F.col("event_time").cast("timestamp_ntz").alias("event_time"), "user_name", "role_name",
                            "detail", F.to_date("event_time").alias("event_date"))
        spread_for_write(rows, ["event_date"]).write.mode("overwrite").partitionBy("event_date").parquet(target)
        n = read_batch(spark, path, stream, batch_id).count()
        # one row in one file whose name is the batch's: a second writer would replace it, not add to it
        (spark.createDataFrame([(batch_id, n)], "batch_id long, alerts long").coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/ledger/stream={stream}/batch={batch_id}"))
    return write


def read_batch(spark: SparkSession, path: str, stream: str, batch_id: int) -> DataFrame:
    where = f"{path}/alerts/stream={stream}/batch_id={batch_id}"
    return spark.read.schema(T.StructType(ALERTS.fields[:8])).parquet(where)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts of all complete batches."""
    where = f"{path}/alerts"
    if not _exists(spark, where):
        return spark.createDataFrame([], ALERTS)
    return spark.read.schema(ALERTS).parquet(where).join(ledger(spark, path).select("stream", "batch_id"),
                                                         ["stream", "batch_id"], "left_semi")


def start_event_alerts_to_log(log_stream: DataFrame, role_map: DataFrame, terminations: DataFrame, path: str,
                              checkpoint: str, stream: str = "event_alerts", available_now: bool = True):
    """Run T6-T10 continuously into the alert log."""
    w = D.event_alerts(log_stream, role_map, terminations).writeStream.option(
        "checkpointLocation", checkpoint).foreachBatch(alert_writer(path, stream))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

"""Structured Streaming twins of the detectors and the suspect-log sink (K2); T4 and T5 are in ``stateful``,
the sink of T6-T10 in ``alert_log``.

The batch detectors are plain functions of a DataFrame with a time column, so
the streaming job is the same plan over ``readStream`` plus a watermark:
windows close once the watermark passes their end, late rows beyond
``lateness`` are dropped (the reference has no late-data rule at all; this is
the parameter that makes one explicit).

Sinks are idempotent: each alert has a deterministic ``suspect_id`` and the
``foreachBatch`` writer anti-joins what the log already holds, so a replayed
micro-batch (after a failure, from the checkpoint) appends nothing twice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import detect as D
from ..operators.audit import only_partitions
from ..sources import bindings as B


def events_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1_000) -> DataFrame:
    """Read a directory of event parquet files as a stream (S9: a landing folder;
    a Kafka source plugs in with the same downstream plan). A trigger takes so many files
    at most, so a backfill is cut into micro-batches of bounded size."""
    schema = spark.read.parquet(source_dir).schema
    return (spark.readStream.schema(schema).format("parquet")
            .option("maxFilesPerTrigger", int(max_files_per_trigger)).load(source_dir))


def query_history_stream(events: DataFrame, lateness: str = "30 minutes") -> DataFrame:
    """The query-history binding over a stream, with an event-time watermark.
    Watermarks need TIMESTAMP (not NTZ): the NTZ wall clock is read as UTC."""
    tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError("the detector stream expects spark.sql.session.timeZone=UTC "
                         f"(alert ids hash the UTC window start), got {tz}")
    qh = events.selectExpr(*[f"{e} AS {n}" for n, e in B.query_history_cols(B.SPARK)])
    qh = qh.withColumn("start_time", F.col("start_time").cast("timestamp"))
    return qh.withWatermark("start_time", lateness)


def bulk_export_stream(qh_stream: DataFrame, window: str = "15 minutes") -> DataFrame:
    """T1 over a stream: emits each (window, user, role) group once its window closes."""
    return D.bulk_export(qh_stream, window=window)


def _read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The log so far, or None before its first write (works on any Hadoop file system)."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # path missing or empty
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "does not exist" in str(e):
            return None
        raise


def suspect_log_writer(path: str):
    """K2: foreachBatch function appending new alerts to the suspect log.

    Idempotent: alerts already in the log (same suspect_id) are skipped, so
    replaying a batch after a crash adds nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = (batch.withColumn("detected_at", F.col("window_end")).withColumn("batch_id", F.lit(batch_id))
                .withColumn("detected_date", F.to_date("detected_at"))).persist()  # read for its days and to write
        try:
            out, existing = rows, _read_if_present(spark, path)
            if existing is not None:
                # only the days this batch touches can hold a duplicate: prune to them
                recent = only_partitions(existing, out, ["detected_date"])
                out = out.join(recent.select("suspect_id"), "suspect_id", "left_anti")
            out.write.mode("append").partitionBy("detected_date").parquet(path)
        finally:
            rows.unpersist()
    return write


def start_bulk_export_to_log(spark: SparkSession, source_dir: str, log_path: str, checkpoint: str,
                             lateness: str = "30 minutes", available_now: bool = True):
    """Run T1 continuously from a landing folder into the suspect log."""
    q = bulk_export_stream(query_history_stream(events_stream(spark, source_dir), lateness))
    w = q.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        suspect_log_writer(log_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    return w.start()


def suspect_feed_stream(qh_stream: DataFrame, window: str = "15 minutes", tz: str = "America/New_York") -> DataFrame:
    """T3 over a stream: both patterns from one stateful aggregation per window."""
    return D.suspect_feed_one_pass(qh_stream, window=window, tz=tz)


def start_detection_to_log(spark: SparkSession, source_dir: str, log_path: str, checkpoint: str,
                           lateness: str = "30 minutes", window: str = "15 minutes", available_now: bool = True):
    """Run the full detection task (both patterns) continuously into the suspect log."""
    q = suspect_feed_stream(query_history_stream(events_stream(spark, source_dir), lateness), window)
    w = q.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        suspect_log_writer(log_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=window)
    return w.start()


# --------------------------------------------------------------- audit ingest

def audit_log_writer(log_path: str, reject_path: str):
    """K1 + K12 sink: validate each micro-batch, append valid events to the
    date-partitioned audit log, route rejects aside. Missing columns take the table's
    defaults. Idempotent: log ids are derived from query ids, and only the dates the batch
    touches are read to skip events already written; rejects are written to a folder named
    by the batch, which a replay overwrites."""
    from ..operators import audit as K

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        defaults = {k: v for k, v in K.audit_defaults(_dt.datetime(1970, 1, 1)).items()
                    if k in ("masking_applied", "row_access_applied", "inserted_by_role")}
        rows = K.conform(batch, defaults=defaults).persist()  # read by both sides and for its days
        try:
            good, bad = K.validate(rows)
            good = good.withColumn("event_date", F.to_date("event_time"))
            existing = _read_if_present(spark, log_path)
            if existing is not None:
                good = good.join(only_partitions(existing, good, ["event_date"]).select("log_id"), "log_id", "left_anti")
            good.write.mode("append").partitionBy("event_date").parquet(log_path)
            bad.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()
    return write


def start_audit_ingest(spark: SparkSession, source_dir: str, log_path: str, reject_path: str, checkpoint: str,
                       columns: DataFrame, role_map: DataFrame, available_now: bool = True):
    """Continuous audit logging of statements from the query-log landing folder (column catalog and grants are static)."""
    from ..operators.audit import audit_events_from_queries
    ev = events_stream(spark, source_dir)
    qh = ev.selectExpr(*[f"{e} AS {n}" for n, e in B.query_history_cols(B.SPARK)])
    audit = audit_events_from_queries(qh, columns, role_map, _dt.datetime(1970, 1, 1)).withColumn(
        "inserted_at", F.col("event_time"))
    w = audit.writeStream.option("checkpointLocation", checkpoint).foreachBatch(audit_log_writer(log_path, reject_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def event_alerts_stream(log_stream: DataFrame, role_map: DataFrame, terminations: DataFrame) -> DataFrame:
    """T6-T10 over a stream of audit events: one pass with stream-static joins."""
    return D.event_alerts(log_stream, role_map, terminations)

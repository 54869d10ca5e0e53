"""Suspect cases (K2, K9): evidence of an alert, and case state as events and snapshots.

A case never changes in place. Every action is an event; the state is a fold over a case's
events that does not depend on their order (the last event by time decides the status; a
note or an assignee stays until another one replaces it), so states can be folded again:
state of all events = fold of a snapshot and the later events. Events and snapshots are
written in hash buckets of the suspect. A snapshot holds what was *inserted* up to its time,
so an event that arrives late is among the later ones, whatever its own time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefns import ts_lit
from .audit import SUSPECT_LOG_SCHEMA, conform, spread_for_write
from .detect import IN_HOURS, SERVICE_ACCOUNT_PATTERN, local_hour, phi_scope

BUCKETS = 64
NOTIFY_DAYS = 60
CLOSED = ("CLEARED", "CONFIRMED_BREACH")
STATUSES = ("OPEN", "INVESTIGATING", *CLOSED)

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("suspect_id", T.StringType(), False),
    T.StructField("event_at", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("actor", T.StringType(), False),
    T.StructField("assigned_to", T.StringType(), True),
    T.StructField("investigation_notes", T.StringType(), True),
    T.StructField("inserted_at", T.TimestampNTZType(), False),
])


# evidence ---------------------------------------------------------------------------------

def alert_links(alerts: DataFrame, queries: DataFrame, window: str = "15 minutes", tz: str = "America/New_York",
                time_col: str = "start_time") -> DataFrame:
    """related_query_ids as rows (A5): (suspect_id, query_id) for the queries behind each BULK or OFF_HOURS alert.

    An equi-join on (user, role, window); a query counts for an alert under the alert's own row condition."""
    src = phi_scope(queries).where(F.col("execution_status") == "SUCCESS").select(
        "query_id", "user_name", "role_name", F.window(F.col(time_col), window).start.alias("window_start"),
        (F.col("rows_produced") > 0).alias("bulk"),
        (~local_hour(F.col(time_col), tz).between(*IN_HOURS) & ~F.col("user_name").like(SERVICE_ACCOUNT_PATTERN)).alias("off"))
    a = alerts.select("suspect_id", "trigger_type", F.col("suspect_user").alias("user_name"),
                      F.col("suspect_role").alias("role_name"), "window_start")
    counts = F.when(F.col("trigger_type") == "BULK_PHI_EXPORT", F.col("bulk")).when(
        F.col("trigger_type") == "OFF_HOURS_ACCESS", F.col("off"))
    return src.join(a, ["user_name", "role_name", "window_start"]).where(counts).select("suspect_id", "query_id")


def evidence(links: DataFrame, log: DataFrame) -> DataFrame:
    """Per suspect: its queries, and the audit rows, hospitals and PHI fields that they touched.

    The lists are bounded by what one user runs in one window (queries, log rows), by the hospitals and by
    the columns of the governed tables."""
    rows = links.join(log.select("query_id", "log_id", "hospital_ids_in_result", "phi_columns_accessed"), "query_id", "left")
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    return rows.groupBy("suspect_id").agg(
        F.array_sort(F.collect_set("log_id")).alias("related_log_ids"),
        F.array_sort(F.collect_set("query_id")).alias("related_query_ids"),
        flat("hospital_ids_in_result").alias("hospital_ids_involved"),
        flat("phi_columns_accessed").alias("phi_fields_exposed"))


def suspect_log(alerts: DataFrame, queries: DataFrame, log: DataFrame, now: _dt.datetime,
                window: str = "15 minutes") -> DataFrame:
    """K2: alerts as rows of the suspect log with their evidence and the table's defaults. An alert is detected
    when its window ends, so a later run of the same window gives the same row."""
    found = evidence(alert_links(alerts, queries, window), log)
    rows = alerts.withColumn("detected_at", F.col("window_end")).drop("status").join(found, "suspect_id", "left")
    return conform(rows, SUSPECT_LOG_SCHEMA, {
        "status": F.lit("OPEN"), "hipaa_notification_required": F.lit(False), "inserted_at": ts_lit(now)})


# events -----------------------------------------------------------------------------------

def case_events(suspects: DataFrame, status: Column | str, at: Column, actor: str, assigned_to: Column | str | None = None,
                notes: Column | str | None = None, inserted_at: Column | None = None) -> DataFrame:
    """One event per suspect (those for which ``at`` is not null). The id is a hash of case, time and status."""
    col = lambda v: v if isinstance(v, Column) else F.lit(v)
    rows = suspects.select("suspect_id", at.alias("event_at"), col(status).alias("status"), col(actor).alias("actor"),
                           col(assigned_to).cast("string").alias("assigned_to"), col(notes).cast("string").alias("investigation_notes"),
                           (at if inserted_at is None else inserted_at).alias("inserted_at")).where("event_at IS NOT NULL")
    key = F.concat_ws("|", "suspect_id", F.col("event_at").cast("string"), "status")
    return conform(rows.withColumn("event_id", F.left(F.sha2(key, 256), F.lit(32))), EVENT_SCHEMA)


def as_states(events: DataFrame) -> DataFrame:
    """Each event as the state of a case that has only this one."""
    order = [F.col("event_at").alias("at"), F.col("event_id").alias("id")]
    kept = lambda c: F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("value")))
    return events.select(
        "suspect_id", F.struct(*order, "status", "actor").alias("last"), kept("assigned_to").alias("assigned"),
        kept("investigation_notes").alias("notes"),
        F.when(F.col("status") == "CONFIRMED_BREACH", F.col("event_at")).alias("confirmed_at"), F.lit(1).cast("bigint").alias("events"))


def fold(states: DataFrame) -> DataFrame:
    """One state per case: every field is the greatest of its values, led by time, so any grouping gives the same."""
    return states.groupBy("suspect_id").agg(
        F.max("last").alias("last"), F.max("assigned").alias("assigned"), F.max("notes").alias("notes"),
        F.min("confirmed_at").alias("confirmed_at"), F.sum("events").alias("events"))


def with_state(suspects: DataFrame, states: DataFrame, notify_days: int = NOTIFY_DAYS) -> DataFrame:
    """Suspect-log rows with the fields that their state decides. The notification clock starts with the first
    confirmation, and runs while the case is confirmed; a reopened case is not closed."""
    out = ["status", "assigned_to", "investigation_notes", "hipaa_notification_required", "notification_deadline",
           "closed_at", "closed_by"]
    own = [c for c in suspects.columns if c not in out]
    confirmed = F.coalesce(F.col("last.status") == "CONFIRMED_BREACH", F.lit(False))
    closed = F.col("last.status").isin(*CLOSED)
    return suspects.select(*own).join(states, "suspect_id", "left").select(
        *own, F.coalesce("last.status", F.lit("OPEN")).alias("status"), F.col("assigned.value").alias("assigned_to"),
        F.col("notes.value").alias("investigation_notes"), confirmed.alias("hipaa_notification_required"),
        F.when(confirmed, F.date_add(F.to_date("confirmed_at"), notify_days)).alias("notification_deadline"),
        F.when(closed, F.col("last.at")).alias("closed_at"), F.when(closed, F.col("last.actor")).alias("closed_by"))


# tables -----------------------------------------------------------------------------------

def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("suspect_id"), F.lit(buckets)).cast("int"))


def append_events(events: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Events by insert date and suspect bucket."""
    rows = _bucketed(events, buckets).withColumn("inserted_date", F.to_date("inserted_at"))
    spread_for_write(rows, ["inserted_date", "bucket"]).write.mode("append").partitionBy("inserted_date", "bucket").parquet(
        f"{path}/events")


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


_STAMP = "%Y%m%dT%H%M%S"


def snapshots(spark: SparkSession, path: str) -> list[_dt.datetime]:
    """Times of the complete snapshots (Spark marks a finished write)."""
    out = []
    for name in _folders(spark, f"{path}/snapshots"):
        if "_SUCCESS" in _folders(spark, f"{path}/snapshots/{name}"):
            out.append(_dt.datetime.strptime(name, _STAMP))
    return sorted(out)


def _states_upto(spark: SparkSession, path: str, upto: _dt.datetime) -> DataFrame:
    """States of what was inserted up to a time: the last snapshot before it and the later events, by their date folders."""
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("inserted_date", T.DateType()), T.StructField("bucket", T.IntegerType())])
    events = spark.read.schema(schema).parquet(f"{path}/events")
    events = events.where((F.col("inserted_at") <= ts_lit(upto)) & (F.col("inserted_date") <= F.to_date(ts_lit(upto))))
    before = [s for s in snapshots(spark, path) if s <= upto]
    if not before:
        return fold(as_states(events))
    base = before[-1]
    later = events.where((F.col("inserted_at") > ts_lit(base)) & (F.col("inserted_date") >= F.to_date(ts_lit(base))))
    snap = spark.read.parquet(f"{path}/snapshots/{base.strftime(_STAMP)}").drop("bucket")
    return fold(snap.unionByName(as_states(later)))


def write_snapshot(spark: SparkSession, path: str, upto: _dt.datetime, buckets: int = BUCKETS) -> None:
    """The state of every case by what was inserted up to a whole second; a second run writes the same again."""
    rows = _bucketed(_states_upto(spark, path, upto), buckets)
    (spread_for_write(rows, ["bucket"]).write.mode("overwrite").partitionBy("bucket")
     .parquet(f"{path}/snapshots/{upto.strftime(_STAMP)}"))


def current_states(spark: SparkSession, path: str, as_of: _dt.datetime) -> DataFrame:
    """State of every case that has events, by what was inserted up to ``as_of``."""
    return _states_upto(spark, path, as_of)

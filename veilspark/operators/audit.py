"""Append-only audit tables and their jobs.

There is no ACID table format on the classpath, so every table here is
append-only parquet and every "update" is a new event row (cases: ``cases``; purges:
``purge``). Writers are idempotent where the
reference is not: the archive anti-joins what is already archived (D10), and
detections carry a deterministic id so a re-run adds nothing (K2).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import FULL_ACCESS_ROLES, ROW_BYPASS_ROLES
from ..functions import sqltext as S
from ..functions.timefns import ts_lit

# Audit table schema and allowed values.
PHI_ACCESS_LOG_SCHEMA = T.StructType([
    T.StructField("log_id", T.StringType(), False),
    T.StructField("event_time", T.TimestampNTZType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("query_id", T.StringType(), True),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("user_name", T.StringType(), False),
    T.StructField("display_name", T.StringType(), True),
    T.StructField("role_name", T.StringType(), False),
    T.StructField("secondary_roles", T.ArrayType(T.StringType()), True),
    T.StructField("warehouse_name", T.StringType(), True),
    T.StructField("database_name", T.StringType(), False),
    T.StructField("schema_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("operation_target", T.StringType(), True),
    T.StructField("rows_affected", T.LongType(), True),
    T.StructField("phi_columns_accessed", T.ArrayType(T.StringType()), True),
    T.StructField("hospital_ids_in_result", T.ArrayType(T.StringType()), True),
    T.StructField("masking_applied", T.BooleanType(), True),
    T.StructField("row_access_applied", T.BooleanType(), True),
    T.StructField("client_ip", T.StringType(), True),
    T.StructField("client_app", T.StringType(), True),
    T.StructField("client_environment", T.StringType(), True),
    T.StructField("query_text_hash", T.StringType(), True),
    T.StructField("compliance_flag", T.StringType(), True),
    T.StructField("compliance_notes", T.StringType(), True),
    T.StructField("anomaly_score", T.LongType(), True),
    T.StructField("inserted_at", T.TimestampNTZType(), False),
    T.StructField("inserted_by_role", T.StringType(), False),
])
AUDIT_EVENT_TYPES = (
    "DML_INSERT", "DML_UPDATE", "DML_DELETE", "DDL_CREATE", "DDL_ALTER", "DDL_DROP",
    "POLICY_CHANGE", "ROLE_GRANT", "ROLE_REVOKE", "BREAK_GLASS_ACCESS", "ANOMALY_DETECTED",
)
POLICY_CHANGE_TYPES = (
    "MASKING_POLICY_CREATE", "MASKING_POLICY_ALTER", "MASKING_POLICY_DROP",
    "ROW_ACCESS_CREATE", "ROW_ACCESS_ALTER", "ROW_ACCESS_DROP",
    "POLICY_APPLIED", "POLICY_REMOVED",
    "ROLE_CREATED", "ROLE_DROPPED", "ROLE_GRANTED", "ROLE_REVOKED",
    "NETWORK_POLICY_CHANGE", "PARAMETER_CHANGE",
)
POLICY_CHANGE_SCHEMA = T.StructType([
    T.StructField("change_id", T.StringType(), False),
    T.StructField("changed_at", T.TimestampNTZType(), False),
    T.StructField("changed_by_user", T.StringType(), False),
    T.StructField("changed_by_role", T.StringType(), False),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("query_id", T.StringType(), True),
    T.StructField("change_type", T.StringType(), False),
    T.StructField("object_type", T.StringType(), False),
    T.StructField("object_name", T.StringType(), False),
    T.StructField("definition_before", T.StringType(), True),
    T.StructField("definition_after", T.StringType(), True),
    T.StructField("ticket_reference", T.StringType(), True),
    T.StructField("approved_by", T.StringType(), True),
    T.StructField("business_justification", T.StringType(), True),
    T.StructField("is_emergency_change", T.BooleanType(), True),
    T.StructField("review_status", T.StringType(), True),
    T.StructField("reviewed_by", T.StringType(), True),
    T.StructField("reviewed_at", T.TimestampNTZType(), True),
    T.StructField("inserted_at", T.TimestampNTZType(), False),
])
SUSPECT_LOG_SCHEMA = T.StructType([
    T.StructField("suspect_id", T.StringType(), False),
    T.StructField("detected_at", T.TimestampNTZType(), False),
    T.StructField("related_log_ids", T.ArrayType(T.StringType()), True),
    T.StructField("related_query_ids", T.ArrayType(T.StringType()), True),
    T.StructField("trigger_type", T.StringType(), False),
    T.StructField("trigger_details", T.StringType(), True),
    T.StructField("anomaly_score", T.LongType(), False),
    T.StructField("suspect_user", T.StringType(), False),
    T.StructField("suspect_role", T.StringType(), False),
    T.StructField("suspect_ip", T.StringType(), True),
    T.StructField("hospital_ids_involved", T.ArrayType(T.StringType()), True),
    T.StructField("estimated_row_exposure", T.LongType(), True),
    T.StructField("phi_fields_exposed", T.ArrayType(T.StringType()), True),
    T.StructField("was_data_downloaded", T.BooleanType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("assigned_to", T.StringType(), True),
    T.StructField("investigation_notes", T.StringType(), True),
    T.StructField("hipaa_notification_required", T.BooleanType(), True),
    T.StructField("notification_deadline", T.DateType(), True),
    T.StructField("closed_at", T.TimestampNTZType(), True),
    T.StructField("closed_by", T.StringType(), True),
    T.StructField("inserted_at", T.TimestampNTZType(), False),
])
POLICY_ASSIGNMENT_SCHEMA = T.StructType([
    T.StructField("assignment_id", T.StringType(), False),
    T.StructField("policy_type", T.StringType(), False),
    T.StructField("policy_name", T.StringType(), False),
    T.StructField("database_name", T.StringType(), False),
    T.StructField("schema_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("applied_at", T.TimestampNTZType(), True),
    T.StructField("applied_by", T.StringType(), False),
    T.StructField("ticket_ref", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), True),
])
REVIEW_STATUSES = ("PENDING", "REVIEWED", "ESCALATED")
HOT_DAYS = 90
RETENTION_DAYS = 2555  # 7 years


def conform(df: DataFrame, schema: T.StructType = PHI_ACCESS_LOG_SCHEMA, defaults: dict | None = None) -> DataFrame:
    """Project df onto the table schema: missing nullable columns become typed
    NULLs (or the column default), extra columns are dropped."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(defaults[f.name].cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def audit_defaults(now: _dt.datetime, role: str = "AUDIT_WRITER") -> dict:
    """The table's column defaults: ids, timestamps, masking flags true."""
    return {
        "log_id": F.expr("uuid()"),
        "event_time": ts_lit(now),
        "masking_applied": F.lit(True),
        "row_access_applied": F.lit(True),
        "inserted_at": ts_lit(now),
        "inserted_by_role": F.lit(role),
    }


def policy_assignments(refs: DataFrame, now: _dt.datetime, applied_by: str, ticket_ref: str | None = None) -> DataFrame:
    """K5: rows for the policy registry, one per live binding. The id is a hash of the binding,
    so assigning it again can be skipped with an anti-join (see new_assignments)."""
    row = refs.select(
        F.when(F.col("policy_kind") == "ROW_ACCESS_POLICY", "ROW_ACCESS").otherwise("MASKING").alias("policy_type"),
        F.lower("policy_name").alias("policy_name"), F.col("ref_database_name").alias("database_name"),
        F.col("ref_schema_name").alias("schema_name"), F.col("ref_entity_name").alias("table_name"),
        F.when(F.col("policy_kind") != "ROW_ACCESS_POLICY", F.col("ref_column_name")).alias("column_name"))
    natural = F.concat_ws("|", "policy_type", "policy_name", "database_name", "schema_name", "table_name",
                          F.coalesce("column_name", F.lit("")))
    return conform(row.withColumn("assignment_id", F.left(F.sha2(natural, 256), F.lit(32))), POLICY_ASSIGNMENT_SCHEMA, {
        "applied_at": ts_lit(now), "applied_by": F.lit(applied_by), "ticket_ref": F.lit(ticket_ref), "is_active": F.lit(True)})


def new_assignments(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """K5 append: the assignments that the registry does not hold as active yet."""
    return rows.join(registry.where("is_active").select("assignment_id"), "assignment_id", "left_anti")


def validate(df: DataFrame, schema: T.StructType = PHI_ACCESS_LOG_SCHEMA,
             allowed: dict[str, tuple] | None = None) -> tuple[DataFrame, DataFrame]:
    """K1 check before an append: rows violating NOT NULL or a value list go to
    a reject frame with the reason; valid rows are returned for writing."""
    allowed = allowed if allowed is not None else {"event_type": AUDIT_EVENT_TYPES}
    reasons = []
    for f in schema.fields:
        if not f.nullable and f.name in df.columns:
            reasons.append(F.when(F.col(f.name).isNull(), F.lit(f"NULL {f.name}")))
    for c, values in allowed.items():
        if c in df.columns:
            reasons.append(F.when(~F.col(c).isin(*values), F.concat(F.lit(f"BAD {c}="), F.col(c))))
    reason = F.concat_ws("; ", F.array_compact(F.array(*reasons))) if reasons else F.lit("")
    tagged = df.withColumn("_reject_reason", reason)
    good = tagged.where(F.col("_reject_reason") == "").drop("_reject_reason")
    bad = tagged.where(F.col("_reject_reason") != "").withColumnRenamed("_reject_reason", "reject_reason")
    return good, bad


def spread_for_write(df: DataFrame, partition_cols) -> DataFrame:
    """Cluster rows by the output partition columns for a write. The rebalance hint lets
    adaptive execution split a large day, month or hospital by bytes over as many writer
    tasks as it needs, and merge small ones, whatever the data's size."""
    return df.hint("rebalance", *[F.col(c) for c in partition_cols])


def append(df: DataFrame, path: str, partition_by: tuple = ("event_date",), time_col: str = "event_time",
           max_records_per_file: int | None = None) -> None:
    """Append-only write, partitioned by event date (the audit clustering key).

    Rows are clustered by partition value before writing (see spread_for_write), then
    sorted by time inside each file."""
    out = df
    if "event_date" in partition_by and "event_date" not in df.columns:
        out = out.withColumn("event_date", F.to_date(time_col))
    out = spread_for_write(out, partition_by).sortWithinPartitions(*partition_by, time_col)
    w = out.write.mode("append").partitionBy(*partition_by).option("compression", "snappy")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)


def archive_candidates(log: DataFrame, as_of: _dt.datetime, days: int = HOT_DAYS,
                       archived: DataFrame | None = None) -> DataFrame:
    """K4: rows older than `days` on both event_time and inserted_at, with year and
    month partition columns. Rows already in the archive are skipped (left anti on
    log_id), so monthly runs never copy a row twice."""
    cutoff = ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    out = log.where((F.col("event_time") < cutoff) & (F.col("inserted_at") < cutoff)).select(
        "*", F.year("event_time").alias("year"), F.month("event_time").alias("month"))
    if archived is not None:
        # a row can only collide with archived rows of its own (year, month):
        # read just those partitions of the archive, not seven years of it
        out = out.join(only_partitions(archived, out, ["year", "month"]).select("log_id", "year", "month"),
                       ["log_id", "year", "month"], "left_anti")
    return out


def only_partitions(target: DataFrame, incoming: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of `target` in the partitions that `incoming` can collide with.

    The distinct values of each partition column (days, months, years: bounded by the
    calendar) become one membership test per column, so the scan of a partitioned target
    is pruned statically. Several columns may let through a few partitions more than
    needed, never fewer."""
    out = target
    for c in cols:
        values = [r[0] for r in incoming.select(c).distinct().collect()]
        test = F.col(c).isin(*[v for v in values if v is not None]) if values else F.lit(False)
        out = out.where(test | F.col(c).isNull() if None in values else test)
    return out


def write_archive(candidates: DataFrame, path: str, max_records_per_file: int = 2_000_000) -> None:
    """K4 sink: parquet + snappy, partitioned year/month, append (never overwrite).
    maxRecordsPerFile keeps files near the reference's 250 MB cap; the rebalance keeps
    one month from landing in a single task."""
    (spread_for_write(candidates, ("year", "month"))
     .write.mode("append").partitionBy("year", "month")
     .option("compression", "snappy").option("maxRecordsPerFile", int(max_records_per_file))
     .parquet(path))


def retention_class(time_col: Column, as_of: _dt.datetime, hot_days: int = HOT_DAYS,
                    retention_days: int = RETENTION_DAYS) -> Column:
    """HOT (<= 90 days), ARCHIVE (<= 7 years), else EXPIRED."""
    age = F.datediff(F.to_date(ts_lit(as_of)), F.to_date(time_col))
    return F.when(age <= hot_days, "HOT").when(age <= retention_days, "ARCHIVE").otherwise("EXPIRED")


# ---------------------------------------------------------------------------
# Audit events derived from the query log (scoped, privacy-safe).
# ---------------------------------------------------------------------------

def audit_events_from_queries(qh: DataFrame, columns: DataFrame, role_map: DataFrame, now: _dt.datetime,
                              session_schema: str = "PUBLIC") -> DataFrame:
    """Audit rows of the statements in a query log: SHA-256 of the text instead of the text, and what it did.

    Event type, tables and PHI columns follow the names in the text (``functions.sqltext``), resolved against
    the column catalog (table_catalog, table_schema, table_name, column_name): one row per known table that a
    statement names, or one for its first table, or for none. Reads are no audit events. The hospitals are
    those that the text asks for, else those that the role's grants open on that day; the flags say whether
    the role is under masks and under the row policy. Catalog and grants have one row per table and role,
    so the joins multiply nothing, and the plan runs on a stream too."""
    known = columns.groupBy(
        F.col("table_catalog").alias("database_name"), F.col("table_schema").alias("schema_name"), "table_name").agg(
        F.collect_set(F.upper("column_name")).alias("_columns"))
    grants = role_map.groupBy(F.col("mapped_role").alias("role_name")).agg(F.collect_set(
        F.struct("hospital_id", "effective_from", "effective_to")).alias("_grants"))
    # an explode of one value keeps Spark from writing the expression in again wherever the column is used, in lambdas once an element
    ev = qh.select("*", F.explode(F.array(S.names(F.col("query_text")))).alias("_names"))
    ev = ev.withColumn("event_type", S.event_type(F.col("_names"))).where(F.col("event_type").isNotNull())
    nothing = F.array(F.struct(F.col("database_name"), F.lit(session_schema).alias("schema_name"), F.lit("NONE").alias("table_name")))
    named = S.tables(F.col("_names"), F.col("database_name"), F.lit(session_schema))
    asked = S.literals_of(F.col("query_text"), "hospital_id")
    ev = ev.select("*", F.explode(F.array(F.struct(named.alias("tables"), asked.alias("asked")))).alias("_found"))
    ev = ev.select("*", F.col("_found.asked").alias("_asked"), F.when(F.size("_found.tables") > 0, F.col("_found.tables"))
                   .otherwise(nothing).alias("_tables")).drop("_found")
    ev = ev.select("*", F.posexplode("_tables").alias("_place", "_t")).drop("database_name", "_tables").select(
        "*", "_t.database_name", "_t.schema_name", "_t.table_name").drop("_t")
    ev = ev.join(known, ["database_name", "schema_name", "table_name"], "left").where(
        (F.col("_place") == 0) | F.col("_columns").isNotNull()).join(grants, "role_name", "left")
    day = F.to_date("start_time")
    open_now = F.filter("_grants", lambda g: (g["effective_from"] <= day) & (g["effective_to"].isNull() | (g["effective_to"] >= day)))
    hospitals = F.when(F.size("_asked") > 0, F.col("_asked")).otherwise(F.array_distinct(F.transform(open_now, lambda g: g["hospital_id"])))
    place = F.when(F.col("_place") > 0, F.concat(F.lit("-"), F.col("_place").cast("string"))).otherwise("")
    no_columns = F.array().cast("array<string>")
    return ev.select(
        F.concat(F.lit("QL-"), F.col("query_id"), place).alias("log_id"),
        F.col("start_time").alias("event_time"), "event_type",
        "query_id", "session_id", "user_name", "role_name", "warehouse_name", "database_name", "schema_name", "table_name",
        F.col("rows_produced").alias("rows_affected"),
        S.columns_named(F.col("_names"), F.coalesce("_columns", no_columns)).alias("phi_columns_accessed"),
        F.array_sort(F.coalesce(hospitals, F.array().cast("array<string>"))).alias("hospital_ids_in_result"),
        (~F.col("role_name").isin(*FULL_ACCESS_ROLES)).alias("masking_applied"),
        (~F.col("role_name").isin(*ROW_BYPASS_ROLES)).alias("row_access_applied"),
        F.sha2(F.col("query_text"), 256).alias("query_text_hash"),
        ts_lit(now).alias("inserted_at"),
        F.lit("AUDIT_WRITER").alias("inserted_by_role"),
    )

"""Registered queries: audit logs, detectors and log reports (K*, T*, V1–V4, V14, V15, V27, V28)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .catalog import register
from .functions.timefns import months_before, ts_lit
from .operators import audit as K
from .operators import cases as CA
from .operators import detect as T
from .operators import purge as P
from .plans import reports as R
from .sources import bindings as B
from .sources import metadata as M

AS_OF = B.EVENTS_AS_OF
SNAPSHOT_AT = B.EVENTS_AS_OF.replace(day=16)


@register("v1_login_audit")
def v1(spark, sf_dir):
    return R.login_audit(B.login_history(spark, sf_dir), AS_OF)


@register("v2_phi_access_summary")
def v2(spark, sf_dir):
    return R.access_summary(B.phi_access_log(spark, sf_dir), AS_OF)


@register("v4_policy_change_timeline")
def v4(spark, sf_dir):
    return R.policy_change_timeline(B.security_policy_changes(spark, sf_dir))


@register("v14_daily_event_trend")
def v14(spark, sf_dir):
    return R.daily_event_trend(B.phi_access_log(spark, sf_dir), AS_OF)


@register("v15_audit_gaps")
def v15(spark, sf_dir):
    return R.audit_gaps(spark, B.phi_access_log(spark, sf_dir), AS_OF)


@register("t1_bulk_phi_export")
def t1(spark, sf_dir):
    return T.bulk_export(B.query_history(spark, sf_dir))


@register("t1_alert_query_links")
def t1_links(spark, sf_dir):
    qh = B.query_history(spark, sf_dir)
    return T.alert_query_links(T.bulk_export(qh), qh)


@register("t2_off_hours_access")
def t2(spark, sf_dir):
    return T.off_hours_access(B.query_history(spark, sf_dir), window="1 day")  # the 15-minute slice is t2_off_hours_access_15min


@register("t3_suspect_feed")
def t3(spark, sf_dir):
    """Bulk exports of 15 minutes and off-hours access of a day, with their routing tier (both patterns on the
    reference's 15-minute slice: t3_suspect_feed_one_pass_15min)."""
    return T.suspect_feed(B.query_history(spark, sf_dir), off_hours_window="1 day").withColumn(
        "severity", T.severity(F.col("anomaly_score")))


def suspects_with_state(spark, sf_dir, suspects=None):
    """breach_suspect_log (K2) + case events (K9) -> current state, by a snapshot and the later events.

    Analyst actions are derived per suspect: half of the cases are taken up after 30 min; top scores are
    confirmed after 6 h; of the others every third hour's are cleared after 1 h, and every sixth hour's
    opened again after 26 h."""
    if suspects is None:
        suspects = T.suspect_feed_one_pass(B.query_history(spark, sf_dir)).withColumn("detected_at", F.col("window_end"))
    hour, top = F.hour("detected_at"), F.col("anomaly_score") >= 90
    after = lambda test, text: F.when(test, F.col("detected_at") + F.expr(f"INTERVAL {text}"))
    assigned = F.concat(F.lit("analyst"), (hour % 4).cast("string"), F.lit("@hospital.example.org"))
    events = [
        CA.case_events(suspects, "INVESTIGATING", after(top | (hour % 2 == 0), "30 MINUTES"), "ANALYST", assigned, "taken up"),
        CA.case_events(suspects, "CONFIRMED_BREACH", after(top, "6 HOURS"), "HIPAA_OFFICER", "hipaa-officer@hospital.example.org"),
        CA.case_events(suspects, "CLEARED", after(~top & (hour % 3 == 0), "1 HOURS"), "ANALYST", None, "no breach"),
        CA.case_events(suspects, "INVESTIGATING", after(~top & (hour % 6 == 0), "26 HOURS"), "HIPAA_OFFICER", None, "opened again"),
    ]
    log = reduce(lambda a, b: a.unionByName(b), events)
    early = F.col("inserted_at") <= ts_lit(SNAPSHOT_AT)
    snapshot = CA.fold(CA.as_states(log.where(early)))
    return CA.with_state(suspects, CA.fold(snapshot.unionByName(CA.as_states(log.where(~early)))))


@register("v3_open_breach_suspects")
def v3(spark, sf_dir):
    return R.open_suspects(suspects_with_state(spark, sf_dir), AS_OF)


@register("k9_case_state_counts")
def k9(spark, sf_dir):
    s = suspects_with_state(spark, sf_dir)
    return s.groupBy("trigger_type", "status", "assigned_to", "investigation_notes", "closed_by").agg(
        F.count(F.lit(1)).alias("suspects"),
        F.sum(F.col("hipaa_notification_required").cast("int")).cast("bigint").alias("notifications"),
        F.min("notification_deadline").alias("first_deadline"), F.max("closed_at").alias("last_closed"))


@register("v27_session_drilldown")
def v27(spark, sf_dir):
    qh = B.query_history(spark, sf_dir)
    flagged = T.session_bulk_export(qh)
    return R.session_drilldown(qh, flagged)


@register("t11_session_bulk_export")
def t11(spark, sf_dir):
    return T.session_bulk_export(B.query_history(spark, sf_dir))


def _as_text(df):
    """Array columns as sorted, comma-separated text."""
    return df.withColumns({f.name: F.array_join(F.array_sort(f.name), ",") for f in df.schema.fields
                           if f.dataType.typeName() == "array"})


@register("v28_access_summary_12m")
def v28a(spark, sf_dir):
    since = months_before(AS_OF, 12)
    s = R.access_summary(B.phi_access_log(spark, sf_dir), AS_OF, days=(AS_OF - since).days, sort=False)
    return s.where(F.col("first_access") >= F.to_date(ts_lit(since))).orderBy(F.col("total_rows_affected").desc())


@register("v28_policy_changes_12m")
def v28b(spark, sf_dir):
    t = R.policy_change_timeline(B.security_policy_changes(spark, sf_dir), sort=False)
    return t.where(F.col("changed_at") >= F.add_months(F.to_date(ts_lit(AS_OF)), -12)).orderBy(
        F.col("changed_at").desc())


@register("v28_break_glass_events")
def v28c(spark, sf_dir):
    """Every column of the log."""
    log = K.conform(B.phi_access_log(spark, sf_dir))
    return _as_text(log.where(F.col("event_type") == "BREAK_GLASS_ACCESS")).orderBy(F.col("event_time").desc())


def _suspect_log(spark, sf_dir):
    qh = B.query_history(spark, sf_dir)
    return CA.suspect_log(T.suspect_feed_one_pass(qh), qh, B.phi_access_log(spark, sf_dir), AS_OF)


@register("v28_confirmed_breaches")
def v28d(spark, sf_dir):
    """Every column of the suspect log, with its evidence and state."""
    s = suspects_with_state(spark, sf_dir, _suspect_log(spark, sf_dir))
    return _as_text(s.where(F.col("status") == "CONFIRMED_BREACH")).orderBy(F.col("detected_at").desc())


@register("t4_unusual_role_access")
def t4(spark, sf_dir):
    return T.unusual_role_access(B.phi_access_log(spark, sf_dir), AS_OF)


@register("t5_repeated_failures")
def t5(spark, sf_dir):
    return T.repeated_failures(B.login_history(spark, sf_dir), min_failures=5)


@register("t6_cross_hospital_attempts")
def t6(spark, sf_dir):
    return T.cross_hospital_attempts(B.phi_access_log(spark, sf_dir), B.hospital_role_map(spark, sf_dir))


@register("t7_after_termination")
def t7(spark, sf_dir):
    users = M.users(spark, sf_dir)
    term = users.where(F.col("deleted_on").isNotNull()).select(
        F.col("name").alias("user_name"), F.col("deleted_on").alias("terminated_at"))
    return T.after_termination(B.phi_access_log(spark, sf_dir), term)


@register("t8_policy_bypass_attempts")
def t8(spark, sf_dir):
    return T.policy_bypass_attempts(B.phi_access_log(spark, sf_dir))


@register("t9_outside_allow_list")
def t9(spark, sf_dir):
    log = B.phi_access_log(spark, sf_dir).select("log_id", "event_time", "user_name", "role_name", "client_ip")
    return T.outside_allow_list(log, "client_ip")


@register("t9_break_glass_range_use")
def t9b(spark, sf_dir):
    log = B.login_history(spark, sf_dir).select("event_timestamp", "user_name", "client_ip", "is_success")
    return T.break_glass_use(log, "client_ip", spark)


@register("t10_dev_large_results")
def t10(spark, sf_dir):
    return T.dev_large_results(B.phi_access_log(spark, sf_dir)).select(
        "log_id", "event_time", "user_name", "role_name", "client_environment", "rows_affected")


@register("t13_audit_scope_volume")
def t13(spark, sf_dir):
    """Volume before and after scoping, per day. What dashboards send is a routine read."""
    read = F.col("client_app").isin("TABLEAU", "POWER_BI") & F.col("event_type").startswith("DML_")
    log = B.phi_access_log(spark, sf_dir).select(
        F.to_date("event_time").alias("day"), F.when(read, "SELECT").otherwise(F.col("event_type")).alias("event_type"),
        "client_ip")
    kept = T.in_audit_scope(F.col("event_type"), F.col("client_ip")).cast("int")
    return log.groupBy("day").agg(F.count(F.lit(1)).alias("all_events"), F.sum(kept).cast("bigint").alias("scoped_events"))


@register("k1_audit_validation")
def k1(spark, sf_dir):
    log = K.conform(B.phi_access_log(spark, sf_dir))
    good, bad = K.validate(log)
    return (good.select(F.lit("VALID").alias("outcome"), F.lit("").alias("reason"))
            .unionByName(bad.select(F.lit("REJECTED").alias("outcome"), F.col("reject_reason").alias("reason")))
            .groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("n")))


@register("k4_archive_candidates")
def k4(spark, sf_dir):
    c = K.archive_candidates(B.archive_source(spark, sf_dir), B.ARCHIVE_AS_OF)
    return c.select("log_id", "event_time", "inserted_at", "year", "month")


@register("k11_retention_classes")
def k11(spark, sf_dir):
    src = B.archive_source(spark, sf_dir)
    return src.groupBy(K.retention_class(F.col("event_time"), B.ARCHIVE_AS_OF).alias("retention_class")).agg(
        F.count(F.lit(1)).alias("n"))


@register("k10_purge_report")
def k10(spark, sf_dir):
    """Months of the hot log against what the monthly job would have archived: which may be purged."""
    hot = B.archive_source(spark, sf_dir)
    return P.purge_report(hot, K.archive_candidates(hot, B.ARCHIVE_AS_OF), B.ARCHIVE_AS_OF).select(
        "year", "month", "hot_rows", "archived_rows", "verdict")


@register("k12_audit_events_from_queries")
def k12(spark, sf_dir):
    ev = K.audit_events_from_queries(B.query_history(spark, sf_dir), M.column_catalog(spark, sf_dir),
                                     B.hospital_role_map(spark, sf_dir), AS_OF)
    return _as_text(ev).select(
        "log_id", "event_time", "event_type", "user_name", "role_name", "database_name", "schema_name", "table_name",
        "query_text_hash", "phi_columns_accessed", "hospital_ids_in_result", "masking_applied", "row_access_applied")


@register("a5_alert_query_links")
def a5(spark, sf_dir):
    """related_query_ids of both patterns, as rows."""
    qh = B.query_history(spark, sf_dir)
    return CA.alert_links(T.suspect_feed_one_pass(qh), qh)


CRON_AS_OF = B.EVENTS_AS_OF.replace(day=15, hour=10)


@register("t3_dlp_cron_run")
def t3_cron(spark, sf_dir):
    """One run of the 15-minute task at 2024-01-15 10:00 (the reference's exact form)."""
    return T.dlp_run(B.query_history(spark, sf_dir), CRON_AS_OF)


@register("k3_policy_change_validation")
def k3(spark, sf_dir):
    """K3: the change log checked against its schema, change types and review statuses before append."""
    ch = B.security_policy_changes(spark, sf_dir)
    good, bad = K.validate(ch, K.POLICY_CHANGE_SCHEMA,
                           {"change_type": K.POLICY_CHANGE_TYPES, "review_status": K.REVIEW_STATUSES})
    return (good.select(F.lit("VALID").alias("outcome"), F.lit("").alias("reason"))
            .unionByName(bad.select(F.lit("REJECTED").alias("outcome"), F.col("reject_reason").alias("reason")))
            .groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("n")))


@register("t2_off_hours_access_15min")
def t2_15(spark, sf_dir):
    """T2 with the reference's own 15-minute slice."""
    return T.off_hours_access(B.query_history(spark, sf_dir), window="15 minutes")


@register("t3_suspect_feed_one_pass_15min")
def t3_one_pass(spark, sf_dir):
    """T1 and T2 on the same 15-minute windows from one scan and one shuffle."""
    return T.suspect_feed_one_pass(B.query_history(spark, sf_dir), window="15 minutes")


@register("t6_t10_event_alerts")
def t6_t10(spark, sf_dir):
    """All per-event detectors as one alert feed (the same plan runs as a stream)."""
    users = M.users(spark, sf_dir)
    term = users.where(F.col("deleted_on").isNotNull()).select(
        F.col("name").alias("user_name"), F.col("deleted_on").alias("terminated_at"))
    return T.event_alerts(B.phi_access_log(spark, sf_dir), B.hospital_role_map(spark, sf_dir), term)


@register("k2_suspect_log")
def k2(spark, sf_dir):
    """K2: the 15-minute feed as rows of the suspect log, with its evidence (arrays as text)."""
    return _as_text(_suspect_log(spark, sf_dir))


@register("k5_policy_assignments")
def k5(spark, sf_dir):
    """K5: the live bindings as rows of the policy registry."""
    return K.policy_assignments(M.policy_references(spark, sf_dir), AS_OF, "SECURITYADMIN", "CHG0002001")

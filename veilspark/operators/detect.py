"""Exfiltration and misuse detectors (T1–T13) as batch DataFrame functions.

The reference runs its detector every 15 minutes over the trailing 15-minute
slice. Over history that is a tumbling window aligned on the quarter hour:
one group per (window, user, role) equals one cron run's group. The same
functions run inside Structured Streaming (``veilspark.streaming``) where
the window is closed by a watermark.

Scale notes: every detector is a filter plus one grouped aggregate whose
functions (count, sum, min, max, bool_or, bounded collect_set) combine
map-side, so a hot user costs one partial row per task before the shuffle.
Per-alert query ids are *not* collected into arrays (a hot user could have
millions); ``alert_query_links`` returns them as rows through a join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..context import FULL_ACCESS_ROLES, PHI_DATABASES, ROW_BYPASS_ROLES
from ..functions.addresses import AddressSet, network_key, networks_of
from ..functions.timefns import date_lit, local_hour, ts_lit

# Fixed values from the reference detector.
BULK_ROWS_THRESHOLD = 50_000
BULK_SCORE_DIVISOR = 5_000
OFF_HOURS_SCORE = 45
OFF_HOURS_MIN_QUERIES = 3
IN_HOURS = (6, 22)  # inclusive: 22:00-22:59 counts as in-hours, as in the SQL
SERVICE_ACCOUNT_PATTERN = "%_SVC_%"


def _window(ts: Column, duration: str, slide: str | None = None) -> Column:
    return F.window(ts, duration, slide) if slide else F.window(ts, duration)


def suspect_id(trigger, user: Column, role: Column, start: Column) -> Column:
    """Deterministic alert id: re-running a window yields the same id (dedup key)."""
    t = trigger if isinstance(trigger, Column) else F.lit(trigger)
    return F.left(F.sha2(F.concat_ws("|", t, user, role, start.cast("string")), 256), F.lit(32))


def phi_scope(qh: DataFrame, databases=PHI_DATABASES) -> DataFrame:
    return qh.where(F.col("database_name").isin(*databases))


def _group_window(time_col: str, window: str, slide: str | None, fixed) -> Column:
    if fixed is not None:  # one cron run: the whole slice is the group's window
        return F.struct(ts_lit(fixed[0]).alias("start"), ts_lit(fixed[1]).alias("end"))
    return _window(F.col(time_col), window, slide)


def bulk_export(qh: DataFrame, window: str = "15 minutes", threshold: int = BULK_ROWS_THRESHOLD,
                slide: str | None = None, time_col: str = "start_time", fixed_window=None) -> DataFrame:
    """T1 BULK_PHI_EXPORT: per (window, user, role) more than `threshold` rows produced."""
    src = phi_scope(qh).where((F.col("execution_status") == "SUCCESS") & (F.col("rows_produced") > 0))
    g = src.groupBy(_group_window(time_col, window, slide, fixed_window).alias("w"), "user_name", "role_name").agg(
        F.count(F.lit(1)).alias("query_count"),
        F.sum("rows_produced").alias("total_rows"),
        F.array_sort(F.collect_set("warehouse_name")).alias("warehouses"),
    )
    g = g.where(F.col("total_rows") > threshold)
    return g.select(
        suspect_id("BULK_PHI_EXPORT", F.col("user_name"), F.col("role_name"), F.col("w.start")).alias("suspect_id"),
        F.lit("BULK_PHI_EXPORT").alias("trigger_type"),
        F.to_json(F.struct(
            F.col("query_count"), F.col("total_rows"), F.lit(window).alias("time_window"), F.col("warehouses"),
        )).alias("trigger_details"),
        F.least(F.lit(100), F.floor(F.col("total_rows") / BULK_SCORE_DIVISOR)).cast("bigint").alias("anomaly_score"),
        F.col("user_name").alias("suspect_user"),
        F.col("role_name").alias("suspect_role"),
        F.lit(None).cast("string").alias("suspect_ip"),
        F.col("total_rows").cast("bigint").alias("estimated_row_exposure"),
        F.lit("OPEN").alias("status"),
        F.col("query_count").cast("bigint").alias("related_query_count"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
    )


def off_hours_access(qh: DataFrame, window: str = "15 minutes", tz: str = "America/New_York",
                     in_hours=IN_HOURS, min_queries: int = OFF_HOURS_MIN_QUERIES,
                     strict_service_like: bool = False, time_col: str = "start_time", fixed_window=None) -> DataFrame:
    """T2 OFF_HOURS_ACCESS: local hour outside [6, 22], non-service users, >= 3 queries."""
    svc = (F.col("user_name").contains("_SVC_") if strict_service_like
           else F.col("user_name").like(SERVICE_ACCOUNT_PATTERN))
    src = phi_scope(qh).where(
        ~local_hour(F.col(time_col), tz).between(*in_hours)
        & (F.col("execution_status") == "SUCCESS")
        & ~svc
    )
    g = src.groupBy(_group_window(time_col, window, None, fixed_window).alias("w"), "user_name", "role_name").agg(
        F.min(time_col).alias("access_time"),
        F.count(F.lit(1)).alias("query_count"),
        F.array_sort(F.collect_set("database_name")).alias("databases"),
        F.sum("rows_produced").alias("total_rows"),
    )
    g = g.where(F.col("query_count") >= min_queries)
    return g.select(
        suspect_id("OFF_HOURS_ACCESS", F.col("user_name"), F.col("role_name"), F.col("w.start")).alias("suspect_id"),
        F.lit("OFF_HOURS_ACCESS").alias("trigger_type"),
        F.to_json(F.struct(
            F.date_format("access_time", "yyyy-MM-dd HH:mm:ss").alias("access_time"),
            F.col("query_count"), F.col("databases"),
        )).alias("trigger_details"),
        F.lit(OFF_HOURS_SCORE).cast("bigint").alias("anomaly_score"),
        F.col("user_name").alias("suspect_user"),
        F.col("role_name").alias("suspect_role"),
        F.lit(None).cast("string").alias("suspect_ip"),
        F.col("total_rows").cast("bigint").alias("estimated_row_exposure"),
        F.lit("OPEN").alias("status"),
        F.col("query_count").cast("bigint").alias("related_query_count"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
    )


def suspect_feed(qh: DataFrame, bulk_window: str = "15 minutes", off_hours_window: str = "15 minutes",
                 tz: str = "America/New_York") -> DataFrame:
    """Both detectors with common columns (the INSERT ... UNION ALL)."""
    return bulk_export(qh, bulk_window).unionByName(off_hours_access(qh, off_hours_window, tz))


def suspect_feed_one_pass(qh: DataFrame, window: str = "15 minutes", tz: str = "America/New_York",
                          threshold: int = BULK_ROWS_THRESHOLD, min_queries: int = OFF_HOURS_MIN_QUERIES,
                          in_hours=IN_HOURS, fixed_window=None, time_col: str = "start_time") -> DataFrame:
    """T3 when both patterns share a window: one scan, one shuffle.

    A single grouped aggregate keeps each pattern's measures behind its own
    row condition; every group then explodes into at most two alerts (no union,
    so the aggregate is not computed twice). Same rows as suspect_feed()."""
    base = phi_scope(qh).where(F.col("execution_status") == "SUCCESS")
    is_bulk = F.col("rows_produced") > 0
    is_off = ~local_hour(F.col(time_col), tz).between(*in_hours) & ~F.col("user_name").like(SERVICE_ACCOUNT_PATTERN)
    src = base.where(is_bulk | is_off).select("*", is_bulk.alias("_b"), is_off.alias("_o"))
    g = src.groupBy(_group_window(time_col, window, None, fixed_window).alias("w"), "user_name", "role_name").agg(
        F.count(F.when(F.col("_b"), F.lit(1))).alias("b_count"),
        F.sum(F.when(F.col("_b"), F.col("rows_produced"))).alias("b_rows"),
        F.array_sort(F.collect_set(F.when(F.col("_b"), F.col("warehouse_name")))).alias("b_wh"),
        F.min(F.when(F.col("_o"), F.col(time_col))).alias("o_time"),
        F.count(F.when(F.col("_o"), F.lit(1))).alias("o_count"),
        F.array_sort(F.collect_set(F.when(F.col("_o"), F.col("database_name")))).alias("o_dbs"),
        F.sum(F.when(F.col("_o"), F.col("rows_produced"))).alias("o_rows"),
    )

    def alert(trigger, details, score, exposure, count):
        return F.struct(F.lit(trigger).alias("trigger_type"), details.alias("trigger_details"),
                        score.cast("bigint").alias("anomaly_score"), exposure.cast("bigint").alias("estimated_row_exposure"),
                        count.cast("bigint").alias("related_query_count"))

    bulk = F.when(F.col("b_rows") > threshold, alert(
        "BULK_PHI_EXPORT",
        F.to_json(F.struct(F.col("b_count").alias("query_count"), F.col("b_rows").alias("total_rows"),
                           F.lit(window).alias("time_window"), F.col("b_wh").alias("warehouses"))),
        F.least(F.lit(100), F.floor(F.col("b_rows") / BULK_SCORE_DIVISOR)), F.col("b_rows"), F.col("b_count")))
    off = F.when(F.col("o_count") >= min_queries, alert(
        "OFF_HOURS_ACCESS",
        F.to_json(F.struct(F.date_format("o_time", "yyyy-MM-dd HH:mm:ss").alias("access_time"),
                           F.col("o_count").alias("query_count"), F.col("o_dbs").alias("databases"))),
        F.lit(OFF_HOURS_SCORE), F.col("o_rows"), F.col("o_count")))
    a = g.select("w", "user_name", "role_name",
                 F.explode(F.filter(F.array(bulk, off), lambda x: x.isNotNull())).alias("a"))
    return a.select(
        suspect_id(F.col("a.trigger_type"), F.col("user_name"), F.col("role_name"), F.col("w.start")).alias("suspect_id"),
        "a.trigger_type", "a.trigger_details", "a.anomaly_score",
        F.col("user_name").alias("suspect_user"), F.col("role_name").alias("suspect_role"),
        F.lit(None).cast("string").alias("suspect_ip"),
        "a.estimated_row_exposure", F.lit("OPEN").alias("status"), "a.related_query_count",
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
    )


def trailing_slice(df: DataFrame, as_of: _dt.datetime, minutes: int = 15, time_col: str = "start_time") -> DataFrame:
    """Rows of the last `minutes` minutes before `as_of` (both ends inclusive).
    Pushed to the parquet scan as a range filter on the time column."""
    now = ts_lit(as_of)
    return df.where((F.col(time_col) >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES")) & (F.col(time_col) <= now))


def dlp_run(qh: DataFrame, as_of: _dt.datetime, minutes: int = 15, tz: str = "America/New_York") -> DataFrame:
    """One run of the scheduled detection task at `as_of`: both patterns over the
    trailing slice, grouped by user and role (the reference's INSERT ... SELECT)."""
    start = as_of - _dt.timedelta(minutes=minutes)
    sl = trailing_slice(qh, as_of, minutes)
    return suspect_feed_one_pass(sl, window=f"{minutes} minutes", tz=tz, fixed_window=(start, as_of))


def alert_query_links(alerts: DataFrame, qh: DataFrame, window: str = "15 minutes",
                      time_col: str = "start_time") -> DataFrame:
    """related_query_ids as rows: (suspect_id, query_id) for each BULK alert.

    An equi-join on (user, role, window start). Spark broadcasts the alerts if they are
    under its threshold and otherwise shuffles both sides (AQE splits a skewed user)."""
    src = phi_scope(qh).where((F.col("execution_status") == "SUCCESS") & (F.col("rows_produced") > 0))
    src = src.select("query_id", "user_name", "role_name", _window(F.col(time_col), window).start.alias("window_start"))
    a = alerts.where(F.col("trigger_type") == "BULK_PHI_EXPORT").select(
        "suspect_id", F.col("suspect_user").alias("user_name"), F.col("suspect_role").alias("role_name"), "window_start")
    return src.join(a, ["user_name", "role_name", "window_start"]).select("suspect_id", "query_id")


def session_bulk_export(qh: DataFrame, threshold: int = BULK_ROWS_THRESHOLD) -> DataFrame:
    """A single session producing more than `threshold` rows (the comment's intent)."""
    src = phi_scope(qh).where((F.col("execution_status") == "SUCCESS") & (F.col("rows_produced") > 0))
    g = src.groupBy("session_id", "user_name", "role_name").agg(
        F.count(F.lit(1)).alias("query_count"),
        F.sum("rows_produced").cast("bigint").alias("total_rows"),
        F.min("start_time").alias("first_query"),
        F.max("start_time").alias("last_query"),
    )
    return g.where(F.col("total_rows") > threshold).withColumn(
        "anomaly_score", F.least(F.lit(100), F.floor(F.col("total_rows") / BULK_SCORE_DIVISOR)).cast("bigint"))


def severity(score: Column, high: int = 70, medium: int = 40) -> Column:
    """Routing tier from the anomaly score (thresholds are parameters)."""
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def unusual_role_access(log: DataFrame, as_of: _dt.datetime, detect_days: int = 7,
                        time_col: str = "event_time") -> DataFrame:
    """T4 UNUSUAL_ROLE_ACCESS: a (role, ip) pair first seen inside the detection
    period although the role was already active before it (role used from a new IP).

    One scan: pairs are one combinable aggregate, and a role's own start is the least of its
    pairs' starts, a window over pairs (not over events)."""
    start = ts_lit(as_of) - F.expr(f"INTERVAL {int(detect_days)} DAYS")
    pairs = log.where(F.col(time_col) < ts_lit(as_of)).groupBy("role_name", "client_ip").agg(
        F.min(time_col).alias("first_seen"),
        F.min_by("user_name", F.struct(F.col(time_col), F.col("log_id"))).alias("first_user"),
        F.count(F.lit(1)).alias("events"),
    )
    with_start = pairs.withColumn("role_first_seen", F.min("first_seen").over(W.partitionBy("role_name")))
    return with_start.where((F.col("first_seen") >= start) & (F.col("role_first_seen") < start)).select(
        "role_name", "client_ip", "first_seen", "first_user", "events")


#: units in which open failures are carried on, from the bucket up; None: a user's whole time
CARRY_UNITS = ("DAY", "MONTH", None)


def repeated_failures(logins: DataFrame, min_failures: int = 5, bucket: str = "1 hour") -> DataFrame:
    """T5 REPEATED_FAILURE: more than `min_failures` failed logins followed by a success.

    Every failure belongs to the next success of the same user. A run of failures with the
    success that closes it, or without one yet, is an associative summary: (failures, first
    failure, success or none). Runs are found inside each (user, bucket) and then combined by a
    prefix scan over units of growing length (bucket, day, month, all): in a unit the open runs
    before a success join it, so at most two summaries leave the unit, the first closed
    run (failures of earlier units may still join it) and the open rest. A run closed by a
    later success of its unit is complete and goes on alone, or out if it is too short to
    report. One scan of the log; no step sorts more of a user's rows than one unit has.
    """
    ev = logins.select(
        "user_name",
        F.col("event_timestamp").alias("ts"),
        F.col("is_success").alias("ok"),
        F.window("event_timestamp", bucket).start.alias("bucket"),
    )
    # failures sort before a success at the same instant
    earlier = lambda *keys: W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    ev = ev.withColumn("seg", F.coalesce(F.sum(F.col("ok").cast("int")).over(
        earlier("user_name", "bucket").orderBy("ts", "ok")), F.lit(0)))
    runs = ev.groupBy("user_name", "bucket", "seg").agg(
        F.sum((~F.col("ok")).cast("int")).alias("fails"),
        F.min(F.when(~F.col("ok"), F.col("ts"))).alias("first_fail"),
        F.min(F.when(F.col("ok"), F.col("ts"))).alias("success_at"),
    ).select("user_name", F.col("bucket").alias("unit"), F.col("seg").alias("place"), "fails", "first_fail", "success_at",
             ((F.col("seg") > 0) & F.col("success_at").isNotNull()).alias("complete"))
    reportable = ~F.col("complete") | (F.col("fails") > min_failures)
    for unit in CARRY_UNITS:
        runs = runs.where(reportable).select(
            "*", (F.date_trunc(unit, "unit") if unit else F.lit("1970-01-01").cast("timestamp")).cast("timestamp_ntz").alias("up"),
            # a complete run is a group of its own
            F.when(F.col("complete"), F.xxhash64("unit", "place", "success_at")).alias("alone"))
        closed = F.col("success_at").isNotNull()
        k = F.coalesce(F.sum(closed.cast("int")).over(
            earlier("user_name", "up", "alone").orderBy("unit", "place")), F.lit(0))
        runs = runs.withColumn("k", k).groupBy("user_name", "up", "alone", "k").agg(
            F.sum("fails").alias("fails"), F.min("first_fail").alias("first_fail"),
            F.max("success_at").alias("success_at"), F.max("complete").alias("complete"))
        runs = runs.select("user_name", F.col("up").alias("unit"), F.col("k").alias("place"), "fails", "first_fail", "success_at",
                           (F.col("complete") | ((F.col("k") > 0) & F.col("success_at").isNotNull())).alias("complete"))
    return runs.where(F.col("success_at").isNotNull() & (F.col("fails") > min_failures)).select(
        "user_name", "success_at", F.col("fails").cast("bigint").alias("failures"), F.col("first_fail").alias("first_failure"))


def cross_hospital_attempts(log: DataFrame, role_map: DataFrame) -> DataFrame:
    """T6 CROSS_HOSPITAL_ATTEMPT: hospitals in an event's result that its role held no
    mapping for on the event's own day (bypass roles exempt)."""
    grants = role_map.select(F.col("mapped_role").alias("g_role"), F.col("hospital_id").alias("g_hospital"),
                             "effective_from", "effective_to").distinct()
    ev = log.where(~F.col("role_name").isin(*ROW_BYPASS_ROLES)).select(
        "log_id", "event_time", "user_name", "role_name", F.explode("hospital_ids_in_result").alias("hospital_id"))
    day = F.to_date("event_time")
    held = ((F.col("role_name") == F.col("g_role")) & (F.col("hospital_id") == F.col("g_hospital"))
            & (F.col("effective_from") <= day) & (F.col("effective_to").isNull() | (F.col("effective_to") >= day)))
    return ev.join(grants, held, "left_anti")


def after_termination(log: DataFrame, terminations: DataFrame, hours: int = 24,
                      until_hours: int | None = None) -> DataFrame:
    """T7 AFTER_TERMINATION (J8 interval join): access within `hours` before a user's (first)
    termination or after it, up to `until_hours` after if given. Equi-join on user + time range."""
    t = terminations.groupBy("user_name").agg(F.min("terminated_at").alias("terminated_at"))
    j = log.join(t, "user_name").where(
        F.col("event_time") >= F.col("terminated_at") - F.expr(f"INTERVAL {int(hours)} HOURS"))
    if until_hours is not None:
        j = j.where(F.col("event_time") <= F.col("terminated_at") + F.expr(f"INTERVAL {int(until_hours)} HOURS"))
    return j.select("log_id", "event_time", "user_name", "role_name", "terminated_at")


# The PHI column names recognised by the coverage check.
PHI_COLUMN_NAMES = (
    "patient_ssn", "ssn", "social_security_number",
    "patient_dob", "date_of_birth", "birth_date",
    "patient_name", "first_name", "last_name", "full_name",
    "patient_mrn", "mrn", "medical_record_number",
    "patient_phone", "phone", "phone_number",
    "patient_email", "email", "email_address",
    "patient_address_1", "street_address", "address",
    "patient_zip", "zip_code", "postal_code",
)


def _phi_columns_read() -> Column:
    phi = F.array(*[F.lit(c) for c in PHI_COLUMN_NAMES])
    lowered = F.transform("phi_columns_accessed", lambda c: F.lower(c))
    return F.array_join(F.array_sort(F.array_intersect(lowered, phi)), ",")


def _bypasses_policy(exempt_roles=FULL_ACCESS_ROLES) -> Column:
    phi = F.array(*[F.lit(c) for c in PHI_COLUMN_NAMES])
    lowered = F.transform("phi_columns_accessed", lambda c: F.lower(c))
    return (F.arrays_overlap(lowered, phi) & ~F.coalesce("masking_applied", F.lit(False))
            & ~F.col("role_name").isin(*exempt_roles))


def policy_bypass_attempts(log: DataFrame, exempt_roles=FULL_ACCESS_ROLES) -> DataFrame:
    """T8 POLICY_BYPASS_ATTEMPT: PHI columns read without masking by a non-exempt role
    (an unknown masking flag counts as unmasked)."""
    return log.where(_bypasses_policy(exempt_roles)).select(
        "log_id", "event_time", "user_name", "role_name", _phi_columns_read().alias("phi_columns"))


def dev_large_results(log: DataFrame, max_rows: int = 1000) -> DataFrame:
    """DEV-environment access returning more than `max_rows` rows."""
    return log.where((F.col("client_environment") == "DEV") & (F.col("rows_affected") > max_rows))


# Allowed-network list of the production network policy.
ALLOWED_CIDRS = (
    ("10.1.0.0/16", "H01 Cincinnati campus"),
    ("10.2.0.0/16", "H02 Dayton campus"),
    ("10.3.0.0/16", "H03 Cleveland campus"),
    ("10.4.0.0/16", "H04 Columbus campus"),
    ("10.5.0.0/16", "H05 Toledo campus"),
    ("10.6.0.0/16", "H06 Akron campus"),
    ("10.7.0.0/16", "H07 Indianapolis campus"),
    ("10.8.0.0/16", "H08 Fort Wayne campus"),
    ("10.9.0.0/16", "H09 Evansville campus"),
    ("10.10.0.0/16", "H10 Louisville campus"),
    ("10.11.0.0/16", "H11 Lexington campus"),
    ("10.12.0.0/16", "H12 Ann Arbor campus"),
    ("172.16.100.0/24", "Corporate VPN (data engineering)"),
    ("172.16.101.0/24", "Contractor VPN (reviewed quarterly)"),
    ("172.16.200.0/28", "Break-glass emergency access"),
)
BREAK_GLASS_CIDR = "172.16.200.0/28"


def allowed_networks(cidrs=ALLOWED_CIDRS) -> AddressSet:
    return AddressSet.of(cidr for cidr, _ in cidrs)


def allow_list(spark, cidrs=ALLOWED_CIDRS) -> DataFrame:
    """The networks as rows: cidr, site, and the key that match_cidrs joins on."""
    rows = [(cidr, site, *network_key(cidr)) for cidr, site in cidrs]
    return spark.createDataFrame(rows, "cidr string, site string, family int, prefix_len int, hi bigint, lo bigint")


def match_cidrs(df: DataFrame, ip_col: str, ranges: DataFrame, lengths=None) -> DataFrame:
    """J7 range join as an equi-join: each address is expanded into one network per
    (family, prefix length) of the list, then joined on the network. No nested-loop join,
    whatever the list size. ``lengths`` names the prefix lengths that the list has; if it
    is not given, a job reads them (at most 33 and 129 rows)."""
    if lengths is None:
        lengths = [tuple(r) for r in ranges.select("family", "prefix_len").distinct().collect()]
    keyed = df.withColumn("_k", F.explode(networks_of(F.col(ip_col), lengths)))
    r = ranges.select(F.struct("family", "prefix_len", "hi", "lo").alias("_k"), "cidr", "site")
    return keyed.join(r, "_k").drop("_k")


def is_outside(ip: Column, networks: AddressSet) -> Column:
    """Whether an address is in none of the networks (null and malformed addresses count as outside)."""
    return ~networks.holds(ip)


def outside_ranges(df: DataFrame, ip_col: str, networks: AddressSet) -> DataFrame:
    """Rows whose address is in none of the networks."""
    return df.where(is_outside(F.col(ip_col), networks))


def outside_allow_list(df: DataFrame, ip_col: str, cidrs=ALLOWED_CIDRS) -> DataFrame:
    """Rows whose address is in no allowed range. The allow list is configuration, given
    as (cidr, site) rows of IPv4 or IPv6 networks: one search per row, no join, no shuffle."""
    return outside_ranges(df, ip_col, allowed_networks(cidrs))


def break_glass_use(df: DataFrame, ip_col: str, spark) -> DataFrame:
    own = [c for c in ALLOWED_CIDRS if c[0] == BREAK_GLASS_CIDR]
    return match_cidrs(df, ip_col, allow_list(spark, own), [network_key(c)[:2] for c, _ in own])


# Event types kept by the scoped audit.
SCOPED_EVENT_PREFIXES = ("DML_", "DDL_")
SCOPED_EVENT_TYPES = ("POLICY_CHANGE", "ROLE_GRANT", "ROLE_REVOKE", "BREAK_GLASS_ACCESS", "ANOMALY_DETECTED")


def in_audit_scope(event_type: Column, client_ip: Column, cidrs=ALLOWED_CIDRS) -> Column:
    """DML/DDL, policy, grant and break-glass events, and whatever comes from outside the allowed networks."""
    keep = event_type.isin(*SCOPED_EVENT_TYPES)
    for p in SCOPED_EVENT_PREFIXES:
        keep = keep | event_type.startswith(p)
    return F.coalesce(keep, F.lit(False)) | is_outside(client_ip, allowed_networks(cidrs))


def audit_scope(log: DataFrame, cidrs=ALLOWED_CIDRS) -> DataFrame:
    """The events worth an audit row; routine reads from inside the networks are dropped."""
    return log.where(in_audit_scope(F.col("event_type"), F.col("client_ip"), cidrs))


def with_alert_lookups(log: DataFrame, role_map: DataFrame, terminations: DataFrame) -> DataFrame:
    """The log with the grants of each event's role (an array: a role's hospitals and periods) and the
    first termination of its user. Both tables have one row per key, so no event is multiplied."""
    grants = role_map.groupBy(F.col("mapped_role").alias("_role")).agg(F.collect_set(
        F.struct("hospital_id", "effective_from", "effective_to")).alias("_grants"))
    ends = terminations.groupBy(F.col("user_name").alias("_user")).agg(F.min("terminated_at").alias("_terminated_at"))
    return (log.join(grants, F.col("role_name") == F.col("_role"), "left")
            .join(ends, F.col("user_name") == F.col("_user"), "left").drop("_role", "_user"))


def alerts_of_event(networks: AddressSet, hours: int = 24, max_rows: int = 1000) -> Column:
    """All alerts (trigger_type, detail) of one event with its lookups, as an array: T6 to T10."""
    alert = lambda kind, detail: F.struct(
        F.lit(kind).alias("trigger_type"), detail.cast("string").alias("detail"))
    none = F.array().cast("array<struct<trigger_type:string,detail:string>>")
    when = lambda test, found: F.when(F.coalesce(test, F.lit(False)), found).otherwise(none)
    day = F.to_date("event_time")

    def held(hospital: Column) -> Column:
        return F.coalesce(F.exists("_grants", lambda g: (g["hospital_id"] == hospital) & (g["effective_from"] <= day)
                                   & (g["effective_to"].isNull() | (g["effective_to"] >= day))), F.lit(False))

    t6 = when(~F.col("role_name").isin(*ROW_BYPASS_ROLES) & F.col("hospital_ids_in_result").isNotNull(), F.transform(
        F.filter("hospital_ids_in_result", lambda h: ~held(h)), lambda h: alert("CROSS_HOSPITAL_ATTEMPT", h)))
    near_end = F.col("event_time") >= F.col("_terminated_at") - F.expr(f"INTERVAL {int(hours)} HOURS")
    t7 = when(near_end, F.array(alert("AFTER_TERMINATION", F.col("_terminated_at"))))
    t8 = when(_bypasses_policy(), F.array(alert("POLICY_BYPASS_ATTEMPT", _phi_columns_read())))
    t9 = when(is_outside(F.col("client_ip"), networks), F.array(alert("OUTSIDE_ALLOW_LIST", F.col("client_ip"))))
    t10 = when((F.col("client_environment") == "DEV") & (F.col("rows_affected") > max_rows),
               F.array(alert("DEV_LARGE_RESULT", F.col("rows_affected"))))
    return F.concat(t6, t7, t8, t9, t10)


def event_alerts(log: DataFrame, role_map: DataFrame, terminations: DataFrame,
                 networks: AddressSet | None = None) -> DataFrame:
    """T6-T10 as one feed of per-event alerts with a common schema
    (trigger_type, log_id, event_time, user_name, role_name, detail).

    One scan of the log: every event meets its role's grants and its user's termination, and
    an array of its alerts is exploded. The same plan runs in batch and as a stream-static
    Structured Streaming query."""
    rows = with_alert_lookups(log, role_map, terminations)
    found = F.explode(alerts_of_event(networks if networks is not None else allowed_networks()))
    return rows.select("log_id", "event_time", "user_name", "role_name", found.alias("a")).select(
        "a.trigger_type", "log_id", "event_time", "user_name", "role_name", "a.detail")

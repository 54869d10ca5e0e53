"""Compliance reports (V1–V31) as ordinary DataFrames.

Each takes its input frames and an ``as_of`` clock. Status texts are fixed
values of the reference checks; the reference's emoji prefixes are kept out of
the values (plain PASS/FAIL/WARNING/REVIEW words) so results are easy to join
and filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timefns import date_lit, day_boundaries_between, hour_boundaries_between, is_business_day, ts_lit
from ..operators.detect import PHI_COLUMN_NAMES
from ..session import cut_lineage
from ..sources.metadata import date_spine

PHI_DATABASES_ALL = ("RAW_DB", "CLEANSED_DB", "AUDIT_DB", "PHI_POLICIES_DB")


def _ago(as_of, days: int):
    return ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def _sorted_list(c: str, sep: str = ", "):
    """LISTAGG(DISTINCT c, sep) WITHIN GROUP (ORDER BY c)."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


# --------------------------------------------------------------------- logs

def login_audit(logins: DataFrame, as_of: _dt.datetime, days: int = 90, in_hours=(6, 22), sort: bool = True) -> DataFrame:
    """V1: logins of the last `days` days with compliance status and off-hours flag."""
    out = logins.where(F.col("event_timestamp") >= _ago(as_of, days)).select(
        F.col("event_timestamp").alias("login_time"),
        "user_name", "client_ip",
        F.col("reported_client_type").alias("client_type"),
        F.col("reported_client_version").alias("client_version"),
        F.col("first_authentication_factor").alias("auth_method_1"),
        F.col("second_authentication_factor").alias("auth_method_2"),
        F.col("is_success").alias("login_succeeded"),
        "error_code", "error_message",
        F.when(~F.col("is_success"), "FAILED_LOGIN")
        .when(F.col("second_authentication_factor").isNull(), "SINGLE_FACTOR_WARNING")
        .otherwise("OK").alias("compliance_status"),
        (~F.hour("event_timestamp").between(*in_hours)).alias("is_off_hours"),
    )
    return out.orderBy(F.col("login_time").desc()) if sort else out


def access_summary(log: DataFrame, as_of: _dt.datetime, days: int = 90, sort: bool = True) -> DataFrame:
    """V2: per user, role, event type and object over the last `days` days."""
    src = log.where(F.col("event_time") >= _ago(as_of, days))
    obj = F.concat(F.col("database_name"), F.lit("."), F.col("schema_name"), F.lit("."), F.col("table_name"))
    out = src.groupBy("user_name", "role_name", "event_type", obj.alias("object_full_name")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("rows_affected").cast("bigint").alias("total_rows_affected"),
        F.min("event_time").alias("first_access"),
        F.max("event_time").alias("last_access"),
        # distinct days are bounded by the lookback (<= days + 1), so an exact set
        # per group is small and merges map-side: one shuffle, no Expand
        F.size(F.collect_set(F.to_date("event_time"))).cast("bigint").alias("active_days"),
        F.bool_or("masking_applied").alias("masking_was_applied"),
        F.bool_or("row_access_applied").alias("row_access_was_applied"),
    )
    return out.orderBy(F.col("total_rows_affected").desc()) if sort else out


def open_suspects(suspects: DataFrame, as_of: _dt.datetime, sort: bool = True) -> DataFrame:
    """V3: OPEN/INVESTIGATING suspects with hours since detection (hour boundaries)
    and SLA status: > 24 OVERDUE, > 12 APPROACHING_SLA, else WITHIN_SLA."""
    now = ts_lit(as_of)
    hrs = hour_boundaries_between(F.col("detected_at"), now)
    out = suspects.where(F.col("status").isin("OPEN", "INVESTIGATING")).select(
        "suspect_id", "detected_at", "trigger_type", "anomaly_score", "suspect_user", "suspect_role",
        "estimated_row_exposure", "status",
        hrs.alias("hours_since_detected"),
        F.when(hrs > 24, "OVERDUE").when(hrs > 12, "APPROACHING_SLA").otherwise("WITHIN_SLA").alias("sla_status"),
    )
    return out.orderBy(F.col("anomaly_score").desc(), F.col("detected_at").asc()) if sort else out


def policy_change_timeline(changes: DataFrame, sort: bool = True) -> DataFrame:
    """V4: each change with the first failing control."""
    out = changes.select(
        "changed_at", "changed_by_user", "change_type", "object_type", "object_name", "ticket_reference",
        "approved_by", "is_emergency_change", "review_status",
        F.when(F.col("ticket_reference").isNull(), "MISSING_TICKET")
        .when(F.col("approved_by").isNull(), "MISSING_APPROVAL")
        .when(F.col("is_emergency_change") == F.lit(True), "EMERGENCY_REVIEW_REQUIRED")
        .otherwise("COMPLIANT").alias("compliance_check"),
    )
    return out.orderBy(F.col("changed_at").desc()) if sort else out


def daily_event_trend(log: DataFrame, as_of: _dt.datetime, days: int = 30, sort: bool = True) -> DataFrame:
    """Events per day and type over the last `days` days."""
    out = log.where(F.col("event_time") >= _ago(as_of, days)).groupBy(
        F.to_date("event_time").alias("log_date"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )
    return out.orderBy(F.col("log_date").desc(), F.col("event_count").desc()) if sort else out


def audit_gaps(spark: SparkSession, log: DataFrame, as_of: _dt.datetime, days: int = 30, low: int = 10,
               sort: bool = True) -> DataFrame:
    """A `days`-long date spine left-joined to daily counts. Zero on a
    business day (Mon–Fri) -> REVIEW, under `low` -> LOW, else OK.

    Daily counts are one grouped aggregate (partial per task) of at most `days` + 1 rows."""
    daily = log.where(F.col("event_time") >= _ago(as_of, days)).groupBy(
        F.to_date("event_time").alias("check_date")).agg(F.count(F.lit(1)).alias("record_count"))
    spine = date_spine(spark, as_of.date() if isinstance(as_of, _dt.datetime) else as_of, days)
    n = F.coalesce(F.col("record_count"), F.lit(0)).cast("bigint")
    out = spine.join(daily, "check_date", "left").select(
        "check_date",
        n.alias("audit_records"),
        F.when((n == 0) & is_business_day("check_date"), "REVIEW").when(n < low, "LOW").otherwise("OK").alias("gap_check"),
    )
    return out.orderBy(F.col("check_date").desc()) if sort else out


def session_drilldown(qh: DataFrame, sessions: DataFrame, sort: bool = True) -> DataFrame:
    """Every query of the flagged sessions in time order (equi-join on session_id)."""
    out = qh.join(sessions.select("session_id").distinct(), "session_id", "left_semi").select(
        "session_id", "query_id", "query_text", "database_name", "rows_produced", "execution_status", "start_time")
    return out.orderBy("session_id", "start_time") if sort else out


# ----------------------------------------------------------------- metadata

def database_ownership(databases: DataFrame, phi_dbs=PHI_DATABASES_ALL) -> DataFrame:
    """V5 (1A): PHI databases must be owned by SECURITYADMIN."""
    is_phi = F.col("database_name").isin(*phi_dbs)
    return databases.select(
        "database_name", "database_owner",
        F.when(is_phi & (F.col("database_owner") == "SECURITYADMIN"), "PASS")
        .when(is_phi & (F.col("database_owner") != "SECURITYADMIN"), "FAIL - PHI DB must be SECURITYADMIN-owned")
        .otherwise("OK").alias("ownership_check"),
    ).orderBy("database_name")


def sysadmin_phi_access(privs: DataFrame) -> DataFrame:
    """V6 (1B): direct SYSADMIN privileges on PHI databases (expected none)."""
    return privs.where(
        (F.col("grantee_name") == "SYSADMIN") & (F.col("object_type") == "DATABASE")
        & F.col("object_name").isin("RAW_DB", "CLEANSED_DB")
    ).select("grantee_name", "privilege_type", F.col("object_name").alias("database_name"),
             F.lit("CRITICAL FAIL - SYSADMIN has PHI database access").alias("finding"))


def mask_bindings(refs: DataFrame, masking_policies: DataFrame, database: str = "CLEANSED_DB") -> DataFrame:
    """V7 (2A): mask bindings on a database joined to the policy catalogue."""
    r = refs.where((F.col("policy_kind") == "MASKING_POLICY") & (F.col("ref_database_name") == database))
    return r.join(masking_policies.select("policy_name", "policy_kind"), ["policy_name", "policy_kind"]).select(
        F.col("ref_database_name").alias("database_name"), F.col("ref_schema_name").alias("schema_name"),
        F.col("ref_entity_name").alias("table_name"), F.col("ref_column_name").alias("column_name"),
        "policy_name", "policy_kind", F.lit("Masking applied").alias("status"))


def unmasked_phi_columns(columns: DataFrame, refs: DataFrame, database: str = "CLEANSED_DB") -> DataFrame:
    """V8 (2B): known PHI column names without a mask binding (expected none).
    Names are compared case-folded on both sides."""
    phi = columns.where((F.col("table_catalog") == database) & F.lower("column_name").isin(*PHI_COLUMN_NAMES))
    masked = refs.where((F.col("policy_kind") == "MASKING_POLICY") & (F.col("ref_database_name") == database)).select(
        F.col("ref_database_name").alias("table_catalog"), F.col("ref_schema_name").alias("table_schema"),
        F.col("ref_entity_name").alias("table_name"), F.lower("ref_column_name").alias("_col"))
    keys = ["table_catalog", "table_schema", "table_name", "_col"]
    return (phi.withColumn("_col", F.lower("column_name")).join(masked, keys, "left_anti")
            .select("table_catalog", "table_schema", "table_name", "column_name",
                    F.lit("FAIL - PHI column missing masking policy").alias("finding")))


def row_policies_applied(refs: DataFrame, row_policies: DataFrame, databases=("RAW_DB", "CLEANSED_DB")) -> DataFrame:
    """V9 (3A)."""
    r = refs.where((F.col("policy_kind") == "ROW_ACCESS_POLICY") & F.col("ref_database_name").isin(*databases))
    return r.join(row_policies.select("policy_name"), "policy_name").select(
        "ref_database_name", "ref_schema_name", F.col("ref_entity_name").alias("table_name"),
        F.col("ref_column_name").alias("policy_column"), "policy_name",
        F.lit("Row-access policy applied").alias("status"))


def mapping_status(role_map: DataFrame, as_of) -> DataFrame:
    """V10 (3B): active / active until / EXPIRED per mapping row."""
    today = date_lit(as_of)
    to = F.col("effective_to")
    return role_map.select(
        "mapped_role", "hospital_id", "effective_from", "effective_to", "granted_by", "ticket_ref",
        F.when(to.isNull(), "Active (no end date)")
        .when(to >= today, F.concat(F.lit("Active until "), to.cast("string")))
        .when(to < today, "EXPIRED - role still in mapping table")
        .otherwise("Unknown").alias("access_status"),
    ).orderBy("mapped_role", "hospital_id")


def destructive_audit_privileges(privs: DataFrame) -> DataFrame:
    """V13 (5A): DELETE/UPDATE/TRUNCATE on audit tables (expected none)."""
    return privs.where(
        (F.col("object_catalog") == "AUDIT_DB") & F.col("privilege_type").isin("DELETE", "UPDATE", "TRUNCATE")
        & (F.col("object_type") == "TABLE")
    ).select("grantee_name", "privilege_type", "object_name",
             F.lit("CRITICAL - Destructive privilege on audit table").alias("finding"))


#: users of one chunk of a role's list
CHUNK = 1_000


def role_user_chunks(roles: DataFrame, grants_to_users: DataFrame, users: DataFrame, phi_roles, size: int = CHUNK) -> DataFrame:
    """V16/A6 without a limit: (role_name, chunk, users): each role's active users in order, in lists of ``size``,
    numbered from 1; a role without users has one empty list.

    (role, user) pairs are range-partitioned, so a role of any size lies over as many tasks as it needs; a
    pair's number is its place in its task and the counts of the tasks before (one row per task and role).
    The partitioning is checkpointed, as a range's bounds are sampled: numbers must come from one drawing."""
    r = roles.where(F.col("name").isin(*phi_roles)).select(F.col("name").alias("role_name"))
    g = grants_to_users.select(F.col("role").alias("role_name"), F.col("grantee_name").alias("user_name"))
    u = users.where(F.col("deleted_on").isNull()).select(F.col("name").alias("user_name"))
    pairs = g.join(r, "role_name", "left_semi").join(u, "user_name", "left_semi").select("role_name", "user_name").distinct()
    dealt = cut_lineage(pairs.repartitionByRange("role_name", "user_name").withColumn("part", F.spark_partition_id()))
    before = W.partitionBy("role_name").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy("role_name", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "role_name", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(W.partitionBy("role_name", "part").orderBy("user_name"))
    numbered = dealt.withColumn("place", place).join(starts, ["role_name", "part"]).select(
        "role_name", "user_name", (F.floor((F.col("start") + F.col("place") - 1) / size) + 1).alias("chunk"))
    lists = numbered.groupBy("role_name", "chunk").agg(F.array_sort(F.collect_list("user_name")).alias("users"))
    return r.distinct().join(lists, "role_name", "left").select(
        "role_name", F.coalesce("chunk", F.lit(1)).cast("bigint").alias("chunk"),
        F.coalesce("users", F.array().cast("array<string>")).alias("users"))


def phi_role_users(roles: DataFrame, grants_to_users: DataFrame, users: DataFrame, phi_roles, size: int = CHUNK) -> DataFrame:
    """V16 (6A): active users per PHI role; ORPHAN when none, REVIEW when > 10. The list as text is a view of the
    first chunk, and says how many more there are."""
    chunks = role_user_chunks(roles, grants_to_users, users, phi_roles, size)
    n = F.sum(F.size("users")).cast("bigint")
    agg = chunks.groupBy("role_name").agg(n.alias("assigned_user_count"), F.max(F.when(
        F.col("chunk") == 1, F.array_join("users", ", "))).alias("first"))
    n = F.col("assigned_user_count")
    more = F.when(n > size, F.concat(F.lit(", … ("), (n - size).cast("string"), F.lit(" more)"))).otherwise("")
    return agg.select(
        "role_name", "assigned_user_count", F.concat("first", more).alias("assigned_users"),
        F.when(n == 0, "ORPHAN - No users assigned").when(n > 10, "REVIEW - High user count for PHI role")
        .otherwise("OK").alias("access_check"),
    ).orderBy("role_name")


def inactive_phi_users(users: DataFrame, grants_to_users: DataFrame, as_of, roles, days: int = 60) -> DataFrame:
    """V17 (6B): active users with a PHI role who never logged in or not for `days` days."""
    u = users.where(F.col("deleted_on").isNull() & (
        F.col("last_success_login").isNull() | (F.col("last_success_login") < _ago(as_of, days))))
    g = grants_to_users.where(F.col("role").isin(*roles))
    j = u.join(g, u["name"] == g["grantee_name"])
    agg = j.groupBy(u["name"].alias("user_name"), F.col("last_success_login").alias("last_login")).agg(
        _sorted_list("role").alias("phi_roles_assigned"))
    dsl = day_boundaries_between(F.col("last_login"), ts_lit(as_of))
    return agg.select(
        "user_name", "last_login", dsl.alias("days_since_login"), "phi_roles_assigned",
        F.lit("REVIEW - Inactive user with PHI access").alias("finding"),
    ).orderBy(F.col("days_since_login").desc_nulls_first())


def network_policy_check(flat: DataFrame, expected: str = "HIPAA_PRODUCTION_POLICY") -> DataFrame:
    """V18 (7B): network policy setting per account from the flattened JSON."""
    v = F.col("value")
    return flat.where(F.col("key") == "NETWORK_POLICY").select(
        *[c for c in flat.columns if c not in ("key", "value")], "key", "value",
        F.when(v == expected, "PASS - Correct production network policy applied")
        .when(v == "", "FAIL - No network policy at account level")
        .otherwise(F.concat(F.lit("REVIEW - Unexpected network policy: "), v)).alias("policy_check"),
    )


def public_phi_grants(grants_to_roles: DataFrame) -> DataFrame:
    """V20 (hardening 1): PUBLIC holding grants on PHI databases."""
    return grants_to_roles.where(
        (F.col("grantee_name") == "PUBLIC") & F.col("object_name").isin("RAW_DB", "CLEANSED_DB", "AUDIT_DB")
        & F.col("deleted_on").isNull()
    ).select("grantee_name", "privilege_type", "object_name", F.lit("RISK: PUBLIC role has PHI access").alias("finding"))


def public_grant_option(grants_to_roles: DataFrame) -> DataFrame:
    """V21 (hardening 2): PUBLIC grants with grant option."""
    return grants_to_roles.where(
        (F.col("grantee_name") == "PUBLIC") & (F.col("grant_option") == F.lit(True)) & F.col("deleted_on").isNull()
    ).select("grantee_name", "grant_option", "privilege", "object_name",
             F.lit("RISK: Future grants to PUBLIC on PHI schema").alias("finding"))


def service_accounts_with_human_roles(users: DataFrame, grants_to_users: DataFrame,
                                      human_roles=("HIPAA_OFFICER", "ANALYST_CLINICAL", "ANALYST_REVENUE")) -> DataFrame:
    """V22 (hardening 3): service accounts (name LIKE '%SVC%') holding human roles."""
    u = users.where(F.col("name").like("%SVC%") & F.col("deleted_on").isNull())
    g = grants_to_users.where(F.col("role").isin(*human_roles))
    return u.join(g, u["name"] == g["grantee_name"]).select(
        u["name"].alias("service_account"), g["role"].alias("unexpected_role"),
        F.lit("RISK: Service account has human user role").alias("finding"))


def warehouses_without_autosuspend(warehouses: DataFrame) -> DataFrame:
    """V23 (hardening 4)."""
    return warehouses.where((F.col("auto_suspend") == 0) & F.col("deleted_on").isNull()).select(
        F.col("name").alias("warehouse_name"), "auto_suspend",
        F.lit("WARNING: No auto-suspend configured").alias("finding"))


def access_review(users: DataFrame, grants_to_users: DataFrame, as_of) -> DataFrame:
    """V25 + V26: active users, MFA, days since login, all roles, and the action."""
    u = users.where(F.col("deleted_on").isNull())
    j = u.join(grants_to_users, u["name"] == grants_to_users["grantee_name"], "left")
    dsl = F.datediff(date_lit(as_of), F.to_date("last_success_login")).cast("bigint")
    agg = j.groupBy(
        u["name"].alias("username"), "display_name", "email", "last_success_login", "has_mfa",
        dsl.alias("days_since_login"),
    ).agg(
        F.array_join(F.array_sort(F.collect_list("role")), ", ").alias("roles_assigned"),
        F.count("role").alias("role_count"),
    )
    action = (F.when(F.col("last_success_login").isNull() & (F.col("role_count") > 0),
                     "REMOVE_ROLE - never logged in")
              .when(F.col("days_since_login") > 60, "DISABLE - inactive over 60 days")
              .when(~F.col("has_mfa"), "ENFORCE_MFA - enrol within 48h")
              .otherwise("NONE"))
    return agg.select("username", "display_name", "email", "last_success_login", "has_mfa", "days_since_login",
                      F.when(F.col("role_count") > 0, F.col("roles_assigned")).alias("roles_assigned"),
                      action.alias("review_action")).orderBy(F.col("days_since_login").desc_nulls_first())


def mapping_data_quality(role_map: DataFrame, as_of) -> DataFrame:
    """First missing audit field of each active mapping."""
    today = date_lit(as_of)
    return role_map.where(F.col("effective_to").isNull() | (F.col("effective_to") >= today)).select(
        "mapped_role", "hospital_id", "effective_from", "effective_to", "granted_by", "ticket_ref",
        F.when(F.col("granted_by").isNull(), "FAIL: missing granted_by")
        .when(F.col("ticket_ref").isNull(), "FAIL: missing ticket_ref")
        .when(F.col("business_reason").isNull(), "FAIL: missing business_reason")
        .when(F.col("effective_from").isNull(), "FAIL: missing effective_from")
        .otherwise("PASS").alias("data_quality_check"),
    ).orderBy("mapped_role", "hospital_id")


# Tables that must carry the hospital isolation policy.
REQUIRED_ROW_POLICY_TABLES = (
    ("CLEANSED_DB", "CLINICAL", "PATIENTS"),
    ("RAW_DB", "EHR", "PATIENT_DEMOGRAPHICS"),
    ("RAW_DB", "BILLING", "CLAIMS"),
)


def required_row_policies(spark: SparkSession, refs: DataFrame, policy: str = "PATIENT_HOSPITAL_ISOLATION",
                          required=REQUIRED_ROW_POLICY_TABLES) -> DataFrame:
    """Each required table with PASS/FAIL on carrying the row policy."""
    req = spark.createDataFrame(list(required), "db string, schema_name string, tbl string")
    applied = refs.where((F.col("policy_kind") == "ROW_ACCESS_POLICY") & (F.col("policy_name") == policy)).select(
        F.col("ref_database_name").alias("db"), F.col("ref_schema_name").alias("schema_name"),
        F.col("ref_entity_name").alias("tbl"), F.lit(1).alias("_hit")).distinct()
    return req.join(applied, ["db", "schema_name", "tbl"], "left").select(
        "db", "schema_name", "tbl",
        F.when(F.col("_hit").isNotNull(), "PASS: policy applied").otherwise("FAIL: policy missing").alias("policy_check"),
    ).orderBy("db", "tbl")


def table_mask_bindings(refs: DataFrame, database: str, schema: str, table: str) -> DataFrame:
    """Mask bindings of one table with a status per column."""
    return refs.where(
        (F.col("ref_database_name") == database) & (F.col("ref_schema_name") == schema)
        & (F.col("ref_entity_name") == table) & (F.col("policy_kind") == "MASKING_POLICY")
    ).select(F.col("ref_column_name").alias("column_name"), "policy_name",
             F.when(F.col("policy_name").isNotNull(), "BOUND").otherwise("UNBOUND").alias("binding_status"))

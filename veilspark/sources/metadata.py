"""Account metadata as DataFrames.

The reference reads a warehouse's information schema. Here each metadata frame
is derived from the activity data so that it grows with it:

users             one per events.user_id; last successful login from the login stream
grants_to_users   each user's primary role plus PHI_READER / HIPAA_OFFICER grants
roles             roles seen in grants plus the PHI role catalogue
grants_to_roles   the grant ledger (grant events, revocations as deleted_on)
object_privileges active, distinct privileges of the ledger
databases         catalogs seen in the ledger or the query log; owner = latest OWNERSHIP grantee
warehouses        warehouses seen in the query log
column_catalog    (catalog, schema, table, column) seen in the audit log
policy_references current policy bindings = latest change per column in the change log
masking_policies / row_access_policies   policies ever created in the change log
task_history      one detection-task run per 15-minute slot of activity
network_info      one JSON settings document per account
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as B
from .tables import read_table

# The PHI role catalogue checked by the access review.
PHI_ROLES = (
    "HIPAA_OFFICER", "PHI_READER",
    "HOSPITAL_ADMIN_H01", "HOSPITAL_ADMIN_H02", "HOSPITAL_ADMIN_H03",
    "HOSPITAL_ADMIN_H04", "HOSPITAL_ADMIN_H05", "HOSPITAL_ADMIN_H06",
    "HOSPITAL_ADMIN_H07", "HOSPITAL_ADMIN_H08", "HOSPITAL_ADMIN_H09",
    "HOSPITAL_ADMIN_H10", "HOSPITAL_ADMIN_H11", "HOSPITAL_ADMIN_H12",
    "ANALYST_CLINICAL", "ANALYST_REVENUE",
)
# Roles checked for inactive users (the reference's partial list).
INACTIVE_CHECK_ROLES = (
    "HIPAA_OFFICER", "PHI_READER",
    "HOSPITAL_ADMIN_H01", "HOSPITAL_ADMIN_H02", "HOSPITAL_ADMIN_H03",
    "ANALYST_CLINICAL", "ANALYST_REVENUE",
)


def _user_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    # last successful login, by the login stream's own failure rule
    return ev.groupBy("user_id").agg(F.expr(f"max(CASE WHEN NOT {B.LOGIN_FAILED} THEN ts END)").alias("last_ok"))


def users_cols(d: B.Dialect):
    name = B.user_name_expr(d)
    shifted = d.ts_plus_days(d.ntz("last_ok"), "-(user_id % 5) * 20")
    return [
        ("user_id", "user_id"),
        ("name", name),
        ("display_name", f"'User ' || {d.s('user_id')}"),
        ("email", f"lower({name}) || '@hospital.example.org'"),
        ("last_success_login", f"CASE WHEN user_id % 9 = 0 THEN NULL ELSE {shifted} END"),
        ("has_mfa", "user_id % 4 <> 0"),
        ("deleted_on", f"CASE WHEN user_id % 23 = 22 THEN {d.ts('2024-01-20 00:00:00')} END"),
    ]


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_base(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in users_cols(B.SPARK)])


def grants_to_users_parts(d: B.Dialect):
    name = B.user_name_expr(d)
    return [
        ([], [("grantee_name", name), ("role", B.role_name_expr(d))]),
        (["user_id % 7 = 0", "user_id % 6 <> 4"], [("grantee_name", name), ("role", "'PHI_READER'")]),
        (["user_id % 50 = 1"], [("grantee_name", name), ("role", "'HIPAA_OFFICER'")]),
    ]


def grants_to_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read_table(spark, sf_dir, "events").select("user_id").distinct()
    out = None
    for filters, cols in grants_to_users_parts(B.SPARK):
        part = ids
        for f in filters:
            part = part.where(F.expr(f))
        part = part.selectExpr(*[f"{e} AS {n}" for n, e in cols])
        out = part if out is None else out.unionByName(part)
    return out


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = grants_to_users(spark, sf_dir).select(F.col("role").alias("name"))
    catalogue = spark.createDataFrame([(r,) for r in PHI_ROLES], "name string")
    return seen.unionByName(catalogue).distinct()


def grants_to_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.grant_ledger(spark, sf_dir).withColumn("privilege", F.col("privilege_type"))


def object_privileges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        B.grant_ledger(spark, sf_dir)
        .where(F.col("deleted_on").isNull())
        .select("grantee_name", "privilege_type", "object_type", "object_name", "object_catalog")
        .distinct()
    )


def databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = B.grant_ledger(spark, sf_dir)
    owners = (
        ledger.where((F.col("privilege_type") == "OWNERSHIP") & (F.col("object_type") == "DATABASE"))
        .groupBy(F.col("object_name").alias("database_name"))
        .agg(F.max_by("grantee_name", F.struct("granted_on", "grant_id")).alias("owner"))
    )
    names = (
        ledger.select(F.col("object_catalog").alias("database_name"))
        .unionByName(B.query_history(spark, sf_dir).select("database_name"))
        .distinct()
    )
    return names.join(owners, "database_name", "left").select(
        "database_name", F.coalesce("owner", F.lit("SYSADMIN")).alias("database_owner")
    )


def auto_suspend_of(name: Column) -> Column:
    """A warehouse's seconds until it suspends (0: never)."""
    return F.when(name == "ETL_WH", F.lit(0)).otherwise(F.lit(600)).cast("bigint")


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = B.query_history(spark, sf_dir).select(F.col("warehouse_name").alias("name")).distinct()
    return names.select(
        "name",
        auto_suspend_of(F.col("name")).alias("auto_suspend"),
        F.when(F.col("name") == "PHI_WH", F.lit("HIPAA_CREDIT_MONITOR")).otherwise(F.lit("null")).alias("resource_monitor"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_on"),
    )


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.phi_access_log(spark, sf_dir)
    return (
        log.select(
            F.col("database_name").alias("table_catalog"),
            F.col("schema_name").alias("table_schema"),
            "table_name",
            F.explode("phi_columns_accessed").alias("column_name"),
        ).distinct()
    )


def policy_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current bindings: the latest change per bound column wins; removals unbind.

    One grouped aggregate (max over a struct led by the change time) instead of a
    window sort: it combines map-side, so a hot column costs one partial row per task.
    """
    ch = B.security_policy_changes(spark, sf_dir)
    keys = ["ref_database_name", "ref_schema_name", "ref_entity_name", "ref_column_name"]
    latest = ch.groupBy(*keys).agg(
        F.max(F.struct("changed_at", "change_id", "change_type", "policy_name", "object_type")).alias("last")
    )
    return latest.where(F.col("last.change_type") != "POLICY_REMOVED").select(
        # the kind is the changed object's own: masks, row policies, authentication policies
        F.col("last.object_type").alias("policy_kind"),
        F.col("last.policy_name").alias("policy_name"),
        *keys,
    )


def masking_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = B.security_policy_changes(spark, sf_dir)
    return (ch.where(F.col("object_type") == "MASKING_POLICY").select("policy_name").distinct()
            .withColumn("policy_kind", F.lit("MASKING_POLICY")))


def row_access_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = B.security_policy_changes(spark, sf_dir)
    return (ch.where(F.col("object_type") == "ROW_ACCESS_POLICY").select("policy_name").distinct()
            .withColumn("policy_kind", F.lit("ROW_ACCESS_POLICY")))


def task_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    runs = ev.groupBy(F.window(F.col("ts").cast("timestamp_ntz"), "15 minutes").alias("w")).agg(
        F.max("value").alias("max_value")
    )
    return runs.select(
        F.lit("DLP_MONITORING_TASK").alias("name"),
        F.col("w.end").alias("scheduled_time"),
        F.when(F.col("max_value") > 450, F.lit("FAILED")).otherwise(F.lit("SUCCEEDED")).alias("state"),
    )


def network_info_cols(d: B.Dialect):
    policy = ("CASE user_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'LEGACY_VPN_POLICY' "
              "ELSE 'HIPAA_PRODUCTION_POLICY' END")
    return [
        ("account", B.user_name_expr(d)),
        ("info", f"'{{\"NETWORK_POLICY\": \"' || {policy} || '\", \"ACCOUNT_ID\": ' || {d.s('user_id')} || '}}'"),
    ]


def network_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read_table(spark, sf_dir, "events").select("user_id").distinct()
    return ids.selectExpr(*[f"{e} AS {n}" for n, e in network_info_cols(B.SPARK)])


def flatten_json(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """FLATTEN(PARSE_JSON(text)) -> one (key, value) row per top-level key."""
    return df.select(*keep, F.explode(F.from_json(F.col(text_col), "map<string,string>")).alias("key", "value"))


def date_spine(spark: SparkSession, end_date, days: int) -> DataFrame:
    """`days` consecutive dates ending at end_date (S7), gap-free by construction."""
    from ..functions.timefns import date_lit
    end = date_lit(end_date)
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(end, days - 1), end)).alias("check_date")
    )

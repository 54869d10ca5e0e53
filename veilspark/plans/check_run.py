"""The weekly check run (K7) and the scorecard's counts (V19): one pass over each source.

Every source is read once. One grouped aggregate reduces it to its distinct keys, and each
of these rows is exploded into *facts*: (kind, key, seen, last). A fact says that something
was seen so often, or which change of it was the last. The facts of all sources are united
and grouped by (kind, key), which joins what different sources say of one column or
database, and a last conditional aggregate of one row holds every check's count.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefns import ts_lit
from ..operators.detect import PHI_COLUMN_NAMES

_LAST = "struct<at:timestamp_ntz,id:string,what:string,kind:string,name:string>"
_FACT = f"struct<kind:string,key:string,seen:bigint,last:{_LAST}>"

# Databases that must belong to SECURITYADMIN, and those that hold PHI.
OWNED_DATABASES = ("RAW_DB", "CLEANSED_DB", "AUDIT_DB", "PHI_POLICIES_DB")
PHI_DATABASES = ("RAW_DB", "CLEANSED_DB")
AUDITED_DATABASES = ("RAW_DB", "CLEANSED_DB", "AUDIT_DB")
HUMAN_ROLES = ("HIPAA_OFFICER", "ANALYST_CLINICAL", "ANALYST_REVENUE")
NETWORK_POLICY = "HIPAA_PRODUCTION_POLICY"
ISOLATION_POLICY = "PATIENT_HOSPITAL_ISOLATION"
DETECTION_TASK = "DLP_MONITORING_TASK"


def _last(at: Column, ident: Column, what: Column, kind: Column | None = None, name: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(at.cast("timestamp_ntz").alias("at"), ident.cast("string").alias("id"), what.alias("what"),
                    (none if kind is None else kind).alias("kind"), (none if name is None else name).alias("name"))


def _fact(when: Column, kind: str, key: Column, seen: Column | int = 1, last: Column | None = None) -> Column:
    """A fact if ``when`` holds, else null."""
    n = F.lit(seen) if isinstance(seen, int) else seen
    return F.when(F.coalesce(when, F.lit(False)), F.struct(
        F.lit(kind).alias("kind"), key.cast("string").alias("key"), n.cast("bigint").alias("seen"),
        (F.lit(None).cast(_LAST) if last is None else last).alias("last")).cast(_FACT))


def _facts(rows: DataFrame, *facts: Column) -> DataFrame:
    """The facts that hold, one row each."""
    return rows.select(F.explode(F.array_compact(F.array(*facts))).alias("f")).select("f.*")


def _check(n: Column, check: str) -> Column:
    """A count that belongs to one check as it stands."""
    return _fact(n > 0, "check", F.lit(check), n)


def _column_key(database: Column, schema: Column, table: Column, column: Column) -> Column:
    return F.concat_ws("|", database, schema, table, F.lower(column))


# sources ----------------------------------------------------------------------------------

def grant_facts(ledger: DataFrame) -> DataFrame:
    """1A (owners), 1B, 5A, H1, H2 from the grant ledger. Privileges count once however often they were granted."""
    key = ["grantee_name", "privilege_type", "object_type", "object_name", "object_catalog"]
    live = F.col("deleted_on").isNull()
    g = ledger.groupBy(*key).agg(
        F.count_if(live).alias("live"), F.count_if(live & F.coalesce("grant_option", F.lit(False))).alias("with_option"),
        F.max(F.struct("granted_on", "grant_id")).alias("granted"))
    database = F.col("object_type") == "DATABASE"
    held = (F.col("live") > 0).cast("bigint")
    public = F.col("grantee_name") == "PUBLIC"
    return _facts(
        g,
        _check(F.when((F.col("grantee_name") == "SYSADMIN") & database & F.col("object_name").isin(*PHI_DATABASES), held), "1B"),
        _check(F.when((F.col("object_catalog") == "AUDIT_DB") & F.col("privilege_type").isin("DELETE", "UPDATE", "TRUNCATE")
                      & (F.col("object_type") == "TABLE"), held), "5A"),
        _check(F.when(public & F.col("object_name").isin(*AUDITED_DATABASES), F.col("live")), "H1"),
        _check(F.when(public, F.col("with_option")), "H2"),
        _fact(F.col("object_catalog").isin(*OWNED_DATABASES), "database", F.col("object_catalog")),
        _fact((F.col("privilege_type") == "OWNERSHIP") & database & F.col("object_name").isin(*OWNED_DATABASES), "owner",
              F.col("object_name"), last=_last(F.col("granted.granted_on"), F.col("granted.grant_id"), F.col("grantee_name"))))


def query_facts(queries: DataFrame, auto_suspend: Column) -> DataFrame:
    """1A (databases in use) and H4 (warehouses in use; ``auto_suspend`` of ``warehouse_name``) from the query log."""
    g = queries.select("database_name", "warehouse_name").distinct()
    return _facts(g, _fact(F.col("database_name").isin(*OWNED_DATABASES), "database", F.col("database_name")),
                  _fact(auto_suspend == 0, "warehouse", F.col("warehouse_name")))


def policy_facts(changes: DataFrame) -> DataFrame:
    """2A, 2B (bound columns), 3A and the policies that exist, from the change log."""
    key = ["ref_database_name", "ref_schema_name", "ref_entity_name", "ref_column_name", "object_type", "policy_name"]
    g = changes.groupBy(*key).agg(F.max(F.struct("changed_at", "change_id", "change_type")).alias("c"))
    column = _column_key(*[F.col(c) for c in key[:4]])
    return _facts(g, _fact(F.lit(True), "column", column, 0, _last(
        F.col("c.changed_at"), F.col("c.change_id"), F.col("c.change_type"), F.col("object_type"), F.col("policy_name"))),
        _fact(F.lit(True), "policy", F.concat_ws("|", "object_type", "policy_name")))


def log_facts(log: DataFrame, as_of: _dt.datetime, days: int = 30) -> DataFrame:
    """2B (PHI columns seen), 5B and 5C (events per day of the last ``days``) from the audit log."""
    end = F.to_date(ts_lit(as_of))
    recent = F.col("event_time") >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    day = F.when(recent, F.to_date("event_time"))
    g = log.groupBy(day.alias("day"), "database_name", "schema_name", "table_name", "phi_columns_accessed").agg(
        F.count(F.lit(1)).alias("n"))
    column = lambda c: _column_key(F.col("database_name"), F.col("schema_name"), F.col("table_name"), c)
    read = F.filter("phi_columns_accessed", lambda c: F.lower(c).isin(*PHI_COLUMN_NAMES))
    seen = F.transform(read, lambda c: _fact(F.col("database_name") == "CLEANSED_DB", "column", column(c)))
    on_spine = F.col("day").between(F.date_sub(end, days - 1), end)
    own = F.array(_check(F.when(F.col("day").isNotNull(), F.col("n")), "5B"),
                  _fact(on_spine, "day", F.col("day"), F.col("n")))
    both = F.array_compact(F.concat(own, F.coalesce(seen, F.array().cast(f"array<{_FACT}>"))))
    return g.select(F.explode(both).alias("f")).select("f.*")


def mapping_facts(role_map: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """3B: mappings that have expired, from the hospital role map."""
    n = role_map.agg(F.count_if(F.col("effective_to") < F.to_date(ts_lit(as_of))).alias("n"))
    return _facts(n, _check(F.col("n"), "3B"))


def account_facts(users: DataFrame, grants: DataFrame, as_of: _dt.datetime, phi_roles: Iterable[str],
                  inactive_roles: Iterable[str], days: int = 60) -> DataFrame:
    """6A (users per PHI role), 6B and H3 from the active users and their roles: one row per user, with the few
    roles that any check asks for."""
    asked = sorted({*phi_roles, *inactive_roles, *HUMAN_ROLES})
    held = grants.where(F.col("role").isin(*asked)).groupBy(F.col("grantee_name").alias("name")).agg(
        F.array_sort(F.collect_set("role")).alias("roles"))
    u = users.where(F.col("deleted_on").isNull()).select("name", "last_success_login").join(held, "name")
    idle = F.col("last_success_login").isNull() | (
        F.col("last_success_login") < ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
    has = lambda roles: F.arrays_overlap("roles", F.array(*[F.lit(r) for r in roles]))
    human = F.size(F.array_intersect("roles", F.array(*[F.lit(r) for r in HUMAN_ROLES])))
    counts = u.agg(
        *[F.count_if(F.array_contains("roles", r)).alias(r) for r in phi_roles],
        F.count_if(idle & has(inactive_roles)).alias("idle"),
        F.sum(F.when(F.col("name").like("%SVC%"), human).otherwise(0)).alias("human"))
    off = reduce(lambda a, b: a + b, [((F.col(r) == 0) | (F.col(r) > 10)).cast("bigint") for r in phi_roles])
    return _facts(counts, _check(off, "6A"), _check(F.col("idle"), "6B"), _check(F.col("human"), "H3"))


def network_facts(network: DataFrame, text_col: str = "info") -> DataFrame:
    """7B: accounts without the production network policy, from each account's settings document."""
    value = F.get_json_object(text_col, "$.NETWORK_POLICY")
    n = network.select(value.alias("v")).agg(
        F.count_if(F.col("v") != NETWORK_POLICY).alias("other"), F.count_if(F.col("v") == "").alias("none"))
    return _facts(n, _check(F.col("other"), "7B"), _check(F.col("none"), "7B without"))


def task_facts(tasks: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Successful detection runs of the last hour, from the task history."""
    at = F.col("scheduled_time")
    n = tasks.agg(F.count_if((F.col("name") == DETECTION_TASK) & (F.col("state") == "SUCCEEDED")
                             & (at >= ts_lit(as_of) - F.expr("INTERVAL 1 HOURS")) & (at <= ts_lit(as_of))).alias("n"))
    return _facts(n, _check(F.col("n"), "task"))


# checks -----------------------------------------------------------------------------------

def check_counts(sources: Iterable[DataFrame], days: int = 30, low: int = 10) -> DataFrame:
    """One row: the count of every check, from the facts of the sources (a source that was left out counts as empty)."""
    facts = reduce(DataFrame.unionByName, sources)
    g = facts.groupBy("kind", "key").agg(F.sum("seen").alias("seen"), F.max("last").alias("last"))
    # a database is known from any of its facts; who owned it last decides
    kind = lambda k: F.col("kind") == k
    is_database = kind("database") | kind("owner")
    g = g.groupBy(F.when(is_database, "database").otherwise(F.col("kind")).alias("kind"), "key").agg(
        F.sum("seen").alias("seen"), F.max("last").alias("last"), F.max(kind("database")).alias("in_use"))
    bound = kind("column") & F.col("last.what").isNotNull() & (F.col("last.what") != "POLICY_REMOVED")
    on_row = F.col("last.kind") == "ROW_ACCESS_POLICY"
    masked = bound & (F.col("last.kind") == "MASKING_POLICY")
    cleansed = F.col("key").startswith("CLEANSED_DB|")
    policy = lambda p: kind("policy") & F.col("key").like(p)
    plain = ("1B", "3B", "5A", "5B", "6A", "6B", "7B", "7B without", "H1", "H2", "H3", "task")
    return g.agg(
        *[F.coalesce(F.sum(F.when(kind("check") & (F.col("key") == c), F.col("seen"))), F.lit(0)).alias(c) for c in plain],
        F.count_if(kind("database") & F.col("in_use") & (F.coalesce("last.what", F.lit("SYSADMIN")) != "SECURITYADMIN")).alias("1A"),
        F.count_if(masked & cleansed).alias("2A"),
        F.count_if(kind("column") & (F.col("seen") > 0) & ~F.coalesce(masked, F.lit(False))).alias("2B"),
        F.count_if(bound & on_row & F.split_part("key", F.lit("|"), F.lit(1)).isin(*PHI_DATABASES)).alias("3A"),
        (F.lit(days) - F.count_if(kind("day") & (F.col("seen") >= low))).alias("5C"),
        F.count_if(kind("warehouse")).alias("H4"),
        F.count_if(policy(f"ROW_ACCESS_POLICY|{ISOLATION_POLICY}")).alias("isolation"),
        F.count_if(policy("MASKING_POLICY|MASK_%")).alias("masks"))


# The checks of a weekly run: id, category, name, and what a count says.
CHECKS = (
    ("1A", "RBAC", "PHI database ownership", "none"),
    ("1B", "RBAC", "SYSADMIN PHI access", "none"),
    ("2A", "POLICY", "Masking policies applied", "some"),
    ("2B", "POLICY", "PHI columns without mask", "none"),
    ("3A", "POLICY", "Row policies applied", "some"),
    ("3B", "ACCESS", "Expired hospital mappings", "review"),
    ("5A", "AUDIT", "Destructive audit privileges", "none"),
    ("5B", "AUDIT", "Audit events in 30 days", "some"),
    ("5C", "AUDIT", "Days with audit gaps", "review"),
    ("6A", "ACCESS", "PHI roles without users or with many", "review"),
    ("6B", "ACCESS", "Inactive users with PHI access", "review"),
    ("7B", "NETWORK", "Accounts off the network policy", "network"),
    ("H1", "HARDENING", "PUBLIC PHI grants", "none"),
    ("H2", "HARDENING", "PUBLIC grant option", "none"),
    ("H3", "HARDENING", "Service accounts with human roles", "none"),
    ("H4", "HARDENING", "Warehouses without auto-suspend", "none"),
)


def _verdict(check: str, rule: str) -> Column:
    n = F.col(check)
    if rule == "network":
        return F.when(F.col("7B without") > 0, "FAIL").when(n > 0, "REVIEW").otherwise("PASS")
    if rule == "some":
        return F.when(n > 0, "PASS").otherwise("FAIL")
    return F.when(n == 0, "PASS").otherwise("REVIEW" if rule == "review" else "FAIL")


def check_rows(counts: DataFrame, run_at: _dt.datetime) -> DataFrame:
    """K7: the run's rows: run_at, check_id, category, check_name, result, n, detail."""
    rows = [F.struct(F.lit(i).alias("check_id"), F.lit(category).alias("category"), F.lit(name).alias("check_name"),
                     _verdict(i, rule).alias("result"), F.col(i).cast("bigint").alias("n"),
                     F.concat(F.col(i).cast("string"), F.lit(" row(s)")).alias("detail")) for i, category, name, rule in CHECKS]
    return counts.select(ts_lit(run_at).alias("run_at"), F.explode(F.array(*rows)).alias("r")).select("run_at", "r.*")


def append_results(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """K7 append, keyed by (run, check): rows that the results table has are skipped. Returns how many were written.

    The table is partitioned by the run's date, and only the dates of ``rows`` are read."""
    dated = rows.withColumn("run_date", F.to_date("run_at"))
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    new = dated
    if here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(here):
        days = [r[0] for r in dated.select("run_date").distinct().collect()]  # the dates of one run
        known = spark.read.schema(dated.schema).parquet(path).where(F.col("run_date").isin(*days))
        new = dated.join(known.select("run_at", "check_id"), ["run_at", "check_id"], "left_anti")
    new = spark.createDataFrame(new.collect(), dated.schema)  # a few rows, one per check
    n = new.count()
    if n:
        new.coalesce(1).write.mode("append").partitionBy("run_date").parquet(path)
    return n

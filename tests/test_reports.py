"""Report thresholds on small fixtures (access review, ownership, scorecard)."""
import datetime as dt

from pyspark.sql import functions as F

from veilspark.functions.timefns import months_before
from veilspark.plans import check_run as CR
from veilspark.plans import checks as C
from veilspark.plans import reports as R

AS_OF = dt.datetime(2024, 3, 1)


def users_df(spark, rows):
    return spark.createDataFrame(rows, "name string, display_name string, email string, last_success_login timestamp_ntz, "
                                       "has_mfa boolean, deleted_on timestamp_ntz")


def test_phi_role_user_counts(spark):
    users = [(f"U{i}", None, None, dt.datetime(2024, 2, 1), True, None) for i in range(12)]
    users.append(("GONE", None, None, None, True, dt.datetime(2024, 1, 1)))
    grants = [(f"U{i}", "PHI_READER") for i in range(11)] + [(f"U{i}", "ANALYST_REVENUE") for i in range(10)] + \
             [("GONE", "HIPAA_OFFICER")]
    roles = spark.createDataFrame([("PHI_READER",), ("ANALYST_REVENUE",), ("HIPAA_OFFICER",), ("OTHER",)], "name string")
    out = R.phi_role_users(roles, spark.createDataFrame(grants, "grantee_name string, role string"),
                           users_df(spark, users), ["PHI_READER", "ANALYST_REVENUE", "HIPAA_OFFICER"])
    got = {r["role_name"]: (r["assigned_user_count"], r["access_check"].split(" ")[0]) for r in out.collect()}
    assert got == {"PHI_READER": (11, "REVIEW"), "ANALYST_REVENUE": (10, "OK"), "HIPAA_OFFICER": (0, "ORPHAN")}


def test_inactive_users_boundary(spark):
    users = users_df(spark, [
        ("A", None, None, dt.datetime(2024, 1, 1, 0, 0), True, None),    # 60 days before as_of: not < cutoff
        ("B", None, None, dt.datetime(2023, 12, 31, 23, 59), True, None),  # just over 60 days
        ("C", None, None, None, True, None),                              # never logged in
        ("D", None, None, None, True, dt.datetime(2024, 1, 1)),            # deleted
    ])
    grants = ("A", "PHI_READER"), ("B", "PHI_READER"), ("B", "ANALYST_CLINICAL"), ("C", "PHI_READER"), ("D", "PHI_READER")
    out = R.inactive_phi_users(users, spark.createDataFrame(list(grants), "grantee_name string, role string"), AS_OF,
                               ["PHI_READER", "ANALYST_CLINICAL"])
    rows = out.collect()
    assert [r["user_name"] for r in rows] == ["C", "B"]          # NULLS FIRST, then most inactive
    assert rows[1]["phi_roles_assigned"] == "ANALYST_CLINICAL, PHI_READER" and rows[1]["days_since_login"] == 61


def test_access_review_actions(spark):
    users = users_df(spark, [
        ("NEVER", None, None, None, True, None),
        ("OLD", None, None, dt.datetime(2023, 12, 1), True, None),
        ("NOMFA", None, None, dt.datetime(2024, 2, 20), False, None),
        ("FINE", None, None, dt.datetime(2024, 2, 20), True, None),
    ])
    grants = spark.createDataFrame([("NEVER", "PHI_READER"), ("OLD", "DS_ROLE"), ("FINE", "DS_ROLE"), ("FINE", "ANALYST_BASE")],
                                   "grantee_name string, role string")
    got = {r["username"]: (r["review_action"].split(" ")[0], r["roles_assigned"])
           for r in R.access_review(users, grants, AS_OF.date()).collect()}
    assert got == {"NEVER": ("REMOVE_ROLE", "PHI_READER"), "OLD": ("DISABLE", "DS_ROLE"),
                   "NOMFA": ("ENFORCE_MFA", None), "FINE": ("NONE", "ANALYST_BASE, DS_ROLE")}


def test_database_ownership(spark):
    dbs = spark.createDataFrame([("RAW_DB", "SECURITYADMIN"), ("AUDIT_DB", "SYSADMIN"), ("MARTS_DB", "SYSADMIN")],
                                "database_name string, database_owner string")
    got = {r[0]: r[2].split(" ")[0] for r in R.database_ownership(dbs).collect()}
    assert got == {"RAW_DB": "PASS", "AUDIT_DB": "FAIL", "MARTS_DB": "OK"}


LEDGER = ("grant_id string, grantee_name string, privilege_type string, object_type string, object_catalog string, object_name string, "
          "grant_option boolean, granted_on timestamp_ntz, deleted_on timestamp_ntz")
CHANGES = ("change_id string, changed_at timestamp_ntz, change_type string, object_type string, policy_name string, ref_database_name string, "
           "ref_schema_name string, ref_entity_name string, ref_column_name string")
DAY = dt.datetime(2024, 2, 1)


def test_scorecard_always_reports_the_task_check(spark):
    tasks = spark.createDataFrame([("DLP_MONITORING_TASK", dt.datetime(2024, 2, 29, 22, 0), "SUCCEEDED")],
                                  "name string, scheduled_time timestamp_ntz, state string")
    rows = C.scorecard(spark.createDataFrame([], LEDGER), spark.createDataFrame([], CHANGES), tasks, AS_OF).collect()
    got = {r["check_name"]: r["result"] for r in rows}
    assert got["DLP Monitoring Task Active"] == "FAIL"      # last success 2 h ago: a row, not silence
    assert got["Hospital Isolation Policy Exists"] == "FAIL" and got["Masking Policies (expect >=12)"] == "WARNING"
    assert got["SYSADMIN PHI Access"] == "PASS" and len(rows) == 5


def sources(spark):
    d, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)
    ledger = spark.createDataFrame([
        ("g1", "SYSADMIN", "USAGE", "DATABASE", "RAW_DB", "RAW_DB", False, d, None),
        ("g2", "SYSADMIN", "USAGE", "DATABASE", "RAW_DB", "RAW_DB", True, later, None),       # granted twice: one privilege
        ("g3", "SYSADMIN", "SELECT", "DATABASE", "CLEANSED_DB", "CLEANSED_DB", False, d, later),  # revoked
        ("g4", "SECURITYADMIN", "OWNERSHIP", "DATABASE", "RAW_DB", "RAW_DB", False, d, None),
        ("g5", "DS_ROLE", "OWNERSHIP", "DATABASE", "RAW_DB", "RAW_DB", False, later, None),   # the last owner of RAW_DB
        ("g6", "SECURITYADMIN", "OWNERSHIP", "DATABASE", "AUDIT_DB", "AUDIT_DB", False, d, None),
        ("g7", "X", "DELETE", "TABLE", "AUDIT_DB", "AUDIT_DB.PUBLIC.LOG", False, d, None),
        ("g8", "PUBLIC", "USAGE", "SCHEMA", "MARTS_DB", "MARTS_DB.P", True, d, None),
        ("g9", "PUBLIC", "USAGE", "DATABASE", "AUDIT_DB", "AUDIT_DB", False, d, None)], LEDGER)
    queries = spark.createDataFrame([("CLEANSED_DB", "ETL_WH"), ("MARTS_DB", "PHI_WH"), ("RAW_DB", "ETL_WH")],
                                    "database_name string, warehouse_name string")
    row = lambda i, at, what, kind, policy, db, col: (i, at, what, kind, policy, db, "S", "T", col)
    changes = spark.createDataFrame([
        row("c1", d, "POLICY_APPLIED", "MASKING_POLICY", "MASK_SSN", "CLEANSED_DB", "SSN"),
        row("c2", d, "POLICY_APPLIED", "MASKING_POLICY", "MASK_NAME", "CLEANSED_DB", "PATIENT_NAME"),
        row("c3", later, "POLICY_REMOVED", "MASKING_POLICY", "MASK_NAME", "CLEANSED_DB", "PATIENT_NAME"),
        row("c4", d, "POLICY_APPLIED", "ROW_ACCESS_POLICY", "PATIENT_HOSPITAL_ISOLATION", "RAW_DB", "HOSPITAL_ID"),
        row("c5", d, "POLICY_APPLIED", "ROW_ACCESS_POLICY", "PATIENT_HOSPITAL_ISOLATION", "MARTS_DB", "HOSPITAL_ID")], CHANGES)
    log = spark.createDataFrame(
        [(DAY + dt.timedelta(days=k, hours=i), "CLEANSED_DB", "S", "T", ["SSN", "Patient_Name"]) for k in range(25) for i in range(12)]
        + [(DAY + dt.timedelta(days=26), "CLEANSED_DB", "S", "T", ["DX"])] + [(dt.datetime(2023, 5, 1), "RAW_DB", "S", "T", ["SSN"])],
        "event_time timestamp_ntz, database_name string, schema_name string, table_name string, phi_columns_accessed array<string>")
    role_map = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),), (None,)], "effective_to date")
    users = users_df(spark, [(f"U{i}", None, None, dt.datetime(2024, 2, 20), True, None) for i in range(12)]
                     + [("ETL_SVC", None, None, None, True, None), ("GONE", None, None, None, True, DAY)])
    grants = spark.createDataFrame([(f"U{i}", "PHI_READER") for i in range(12)]
                                   + [("ETL_SVC", "HIPAA_OFFICER"), ("ETL_SVC", "ANALYST_REVENUE"), ("GONE", "ANALYST_CLINICAL")],
                                   "grantee_name string, role string")
    network = spark.createDataFrame([("a", '{"NETWORK_POLICY": "HIPAA_PRODUCTION_POLICY"}'), ("b", '{"NETWORK_POLICY": "OLD"}'), ("c", '{"X": 1}')],
                                    "account string, info string")
    roles = ["PHI_READER", "HIPAA_OFFICER", "ANALYST_CLINICAL"]
    return [CR.grant_facts(ledger), CR.query_facts(queries, F.when(F.col("warehouse_name") == "ETL_WH", 0)), CR.policy_facts(changes),
            CR.log_facts(log, AS_OF), CR.mapping_facts(role_map, AS_OF), CR.account_facts(users, grants, AS_OF, roles, roles),
            CR.network_facts(network)]


def test_a_weekly_run_by_hand(spark):
    got = {r["check_id"]: (r["n"], r["result"]) for r in CR.check_rows(CR.check_counts(sources(spark)), AS_OF).collect()}
    assert got == {
        "1A": (2, "FAIL"),    # RAW_DB by DS_ROLE, CLEANSED_DB in use without an owner
        "1B": (1, "FAIL"), "2A": (1, "PASS"), "2B": (1, "FAIL"), "3A": (1, "PASS"), "3B": (1, "REVIEW"), "5A": (1, "FAIL"),
        "5B": (301, "PASS"),
        "5C": (5, "REVIEW"),  # 25 of the 30 days from 1 February on have ten events
        "6A": (2, "REVIEW"),  # twelve readers; no clinical analyst
        "6B": (1, "REVIEW"), "7B": (1, "REVIEW"), "H1": (1, "FAIL"), "H2": (1, "FAIL"), "H3": (2, "FAIL"), "H4": (1, "FAIL")}


def test_check_sources_may_be_empty(spark):
    empty = [CR.grant_facts(spark.createDataFrame([], LEDGER)), CR.policy_facts(spark.createDataFrame([], CHANGES))]
    rows = CR.check_rows(CR.check_counts(empty), AS_OF).collect()
    assert len(rows) == 16 and all(r["n"] == (30 if r["check_id"] == "5C" else 0) for r in rows)


def test_one_scan_per_source(spark, sf_dir, scratch):
    from veilspark import queries_meta as Q
    from veilspark.sources import bindings as B
    plan = Q.k7(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # grants, queries, changes, log; users and their grants (the binding makes three kinds of grant); networks; nation x3, supplier
    assert plan.count("FileScan parquet") <= 4 + 1 + 3 + 1 + len(B.role_map_parts(B.SPARK)) + 1
    for n, facts in enumerate((CR.grant_facts(B.grant_ledger(spark, sf_dir)), CR.policy_facts(B.security_policy_changes(spark, sf_dir)),
                               CR.log_facts(B.phi_access_log(spark, sf_dir), AS_OF))):
        assert facts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1, n


def test_results_are_appended_once_per_run_and_check(spark, scratch):
    path = f"{scratch}/results"
    rows = CR.check_rows(CR.check_counts(sources(spark)), AS_OF)
    assert CR.append_results(spark, rows.where("check_id < '5'"), path) == 6
    assert CR.append_results(spark, rows, path) == 10
    assert CR.append_results(spark, rows, path) == 0
    assert CR.append_results(spark, CR.check_rows(CR.check_counts(sources(spark)), AS_OF + dt.timedelta(days=7)), path) == 16
    assert spark.read.parquet(path).count() == 32


def test_role_lists_in_chunks(spark):
    users = users_df(spark, [(f"U{i:04d}", None, None, None, True, None) for i in range(250)])
    grants = [(f"U{i:04d}", "BIG") for i in range(250)] * 2 + [("U0007", "SMALL"), ("NOBODY", "SMALL")]
    roles = spark.createDataFrame([("BIG",), ("SMALL",), ("NONE",), ("OTHER",)], "name string")
    args = (roles, spark.createDataFrame(grants, "grantee_name string, role string").repartition(7), users, ["BIG", "SMALL", "NONE"])
    rows = {(r["role_name"], r["chunk"]): r["users"] for r in R.role_user_chunks(*args, size=40).collect()}
    assert sorted(rows) == [("BIG", k) for k in range(1, 8)] + [("NONE", 1), ("SMALL", 1)]
    assert [u for k in range(1, 8) for u in rows["BIG", k]] == [f"U{i:04d}" for i in range(250)]
    assert all(len(rows["BIG", k]) == 40 for k in range(1, 7)) and rows["SMALL", 1] == ["U0007"] and rows["NONE", 1] == []
    text = {r["role_name"]: r for r in R.phi_role_users(*args, size=40).collect()}
    assert text["BIG"]["assigned_user_count"] == 250 and text["BIG"]["assigned_users"].endswith("U0039, … (210 more)")
    assert text["NONE"]["assigned_users"] == "" and text["SMALL"]["assigned_users"] == "U0007"


def test_mfa_control_is_seen(spark):
    refs = spark.createDataFrame([("AUTHENTICATION_POLICY",)], "policy_kind string")
    flat = spark.createDataFrame([], "account string, key string, value string")
    wh = spark.createDataFrame([], "name string, resource_monitor string, deleted_on timestamp_ntz")
    assert [r["status"] for r in C.three_controls(refs, flat, wh).collect()] == ["ACTIVE"]
    assert [r["status"] for r in C.three_controls(refs.limit(0), flat, wh).collect()] == ["MISSING"]


def test_months_before():
    d = dt.datetime
    assert months_before(d(2024, 2, 29, 5), 12) == d(2023, 2, 28, 5) and months_before(d(2024, 1, 31), 2) == d(2023, 11, 30)

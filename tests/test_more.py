"""Grants/revokes, synthetic data, cron slice, role closure, small-cell suppression."""
import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from veilspark.context import SecurityContext
from veilspark.operators import deident as DI
from veilspark.operators import detect as D
from veilspark.operators import grants as G
from veilspark.operators.rowaccess import apply_row_policy, grant_hospital_access, revoke_hospital_access
from veilspark.sources import bindings as B
from veilspark.sources import synth as S


def test_grant_then_revoke(spark, sf_dir):
    pts = B.patients(spark, sf_dir)
    rm = B.hospital_role_map(spark, sf_dir)
    ctx = SecurityContext(role="HOSPITAL_ADMIN_H13", as_of=dt.datetime(2024, 6, 1), salts=B.QUERY_SALTS)
    assert apply_row_policy(pts, rm, ctx).count() == 0
    rm2 = rm.unionByName(grant_hospital_access(spark, "HOSPITAL_ADMIN_H13", "H05", dt.date(2024, 5, 1),
                                               "SECURITYADMIN", "new campus", "CHG0009999"))
    h05 = pts.where(F.col("hospital_id") == "H05").count()
    assert apply_row_policy(pts, rm2, ctx).count() == h05
    rm3 = revoke_hospital_access(rm2, "HOSPITAL_ADMIN_H13", "H05", dt.date(2024, 5, 31))
    assert apply_row_policy(pts, rm3, ctx).count() == 0


def test_synthetic_patients_conventions(spark):
    df = S.synthetic_patients(spark, 5000, partitions=4)
    assert df.count() == 5000 and df.select("patient_id").distinct().count() == 5000
    bad = df.where(~F.col("patient_ssn").startswith("999-") | ~F.col("patient_phone").startswith("555-")
                   | ~F.col("patient_email").endswith("@example.com"))
    assert bad.count() == 0
    again = S.synthetic_patients(spark, 5000, partitions=7)
    assert again.exceptAll(df).count() == 0  # seedable, independent of partitioning


def test_trailing_slice_bounds(spark):
    d = dt.datetime
    df = spark.createDataFrame([(d(2024, 1, 15, 9, 44, 59),), (d(2024, 1, 15, 9, 45),), (d(2024, 1, 15, 10, 0),),
                                (d(2024, 1, 15, 10, 0, 1),)], "start_time timestamp_ntz")
    got = [r[0] for r in D.trailing_slice(df, d(2024, 1, 15, 10, 0)).orderBy("start_time").collect()]
    assert got == [d(2024, 1, 15, 9, 45), d(2024, 1, 15, 10, 0)]


def test_closure_reaches_sysadmin_through_dbt_role(spark):
    privs = spark.createDataFrame([("DBT_ROLE", "SELECT", "DATABASE", "CLEANSED_DB", "CLEANSED_DB"),
                                   ("PHI_READER", "SELECT", "TABLE", "CLEANSED_DB.CLINICAL.PATIENTS", "CLEANSED_DB")],
                                  "grantee_name string, privilege_type string, object_type string, object_name string, "
                                  "object_catalog string")
    eff = G.effective_privileges(G.role_edges(spark), privs)
    rows = {(r["role"], r["object_name"], r["via_role"]) for r in eff.collect()}
    assert ("SYSADMIN", "CLEANSED_DB", "DBT_ROLE") in rows                           # D2: inherited access
    assert ("SECURITYADMIN", "CLEANSED_DB.CLINICAL.PATIENTS", "PHI_READER") in rows  # two hops
    assert not any(r[0] == "SYSADMIN" and r[2] == "PHI_READER" for r in rows)


def test_suppression_matches_brute_force(spark, sf_dir):
    lds = DI.limited_data_set(B.patients(spark, sf_dir), "s", "HIPAA_OFFICER", "DUA-1")
    q = ["state", "birth_year"]
    rows = lds.select(*q).collect()
    cnt = collections.Counter(tuple(r) for r in rows)
    expected = sum(v for v in cnt.values() if v >= 3)
    assert DI.suppress_small_cells(lds, q, k_min=3).count() == expected


def test_limited_data_set_is_the_officers(spark, sf_dir):
    p = B.patients(spark, sf_dir)
    with pytest.raises(PermissionError):
        DI.limited_data_set(p, "s", "DS_ROLE", "DUA-1")
    with pytest.raises(ValueError):
        DI.limited_data_set(p, "s", "HIPAA_OFFICER")


def test_policy_drift_states(spark):
    desired = spark.createDataFrame([("M", "A", None, ["X"]), ("M", "B", None, ["X"]), ("R", "P", "T1", None)],
                                    "policy_type string, policy_name string, target string, full_roles array<string>")
    live = spark.createDataFrame([("M", "A", None, ["X"]), ("M", "B", None, ["X", "Y"]), ("R", "P", "T2", None)],
                                 "policy_type string, policy_name string, target string, full_roles array<string>")
    got = {(r["policy_name"], r["target"]): r["drift_status"] for r in G.policy_drift(desired, live).collect()}
    assert got == {("A", None): "OK", ("B", None): "CHANGED", ("P", "T1"): "MISSING", ("P", "T2"): "EXTRA"}


def test_governed_view_sql(spark, sf_dir):
    from veilspark.operators.masking import PATIENT_BINDINGS
    from veilspark.plans.governed import governed_view
    ctx = SecurityContext(role="ANALYST_CLINICAL", as_of=dt.datetime(2024, 6, 1), salts=B.QUERY_SALTS)
    governed_view(spark, "patients_v", B.patients(spark, sf_dir), B.hospital_role_map(spark, sf_dir), ctx,
                  PATIENT_BINDINGS)
    rows = spark.sql("SELECT DISTINCT patient_ssn FROM patients_v WHERE patient_ssn IS NOT NULL").collect()
    assert [r[0] for r in rows] == ["XXX-XX-XXXX"]


def test_closure_of_deep_chains_and_cycles(spark):
    from veilspark.operators import grants as G
    chain = [(f"r{i}", f"r{i + 1}") for i in range(40)] + [("a", "b"), ("b", "c"), ("c", "a")]
    got = {tuple(r) for r in G.role_closure(spark.createDataFrame(chain, "parent_role string, child_role string")).collect()}
    want = {(f"r{i}", f"r{j}") for i in range(41) for j in range(i, 41)} | {(x, y) for x in "abc" for y in "abc"}
    assert got == want


def test_a_thousand_partition_days(spark, scratch):
    from pyspark.sql import functions as F
    from veilspark.operators.audit import only_partitions
    days = spark.range(1000).select(F.expr("date_add(date'2020-01-01', cast(id as int))").alias("day"), "id")
    path = f"{scratch}/days"
    days.coalesce(1).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    assert only_partitions(table, days.where("id < 999"), ["day"]).count() == 999
    one = only_partitions(table, days.where("id = 5"), ["day"])
    assert one.count() == 1 and "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    assert only_partitions(table, days.limit(0), ["day"]).count() == 0


def test_layout_readiness_over_many_files(spark, scratch):
    from pyspark.sql import functions as F
    from veilspark.operators import grants as G
    path = f"{scratch}/files"
    rows = spark.range(400).select(F.when(F.col("id") < 100, "H1").otherwise("H2").alias("hospital_id"), "id")
    rows.repartitionByRange(4, "id").write.parquet(path)
    got = {r["hospital_id"]: r for r in G.layout_readiness(spark.read.parquet(path)).collect()}
    assert {h: r["rows"] for h, r in got.items()} == {"H1": 100, "H2": 300}
    assert all(r["total_files"] == 4 for r in got.values())
    assert got["H1"]["layout_status"] == "READY" and got["H2"]["layout_status"] == "NOT_READY"

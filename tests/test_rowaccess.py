"""Row isolation tests A-E, multiplicity, plan shape."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from veilspark.context import SecurityContext
from veilspark.operators.rowaccess import apply_row_policy
from veilspark.sources import bindings as B

AS_OF = dt.datetime(2024, 6, 1)


def visible(spark, sf_dir, role, method="semi"):
    pts = B.patients(spark, sf_dir)
    rm = B.hospital_role_map(spark, sf_dir)
    out = apply_row_policy(pts, rm, SecurityContext(role=role, as_of=AS_OF), method=method)
    return sorted(r[0] for r in out.select("hospital_id").distinct().collect()), out.count()


def expected_hospitals(spark, sf_dir, role):
    """Brute force over the (small) mapping rows: hospitals with an active grant."""
    d = AS_OF.date()
    return sorted({r["hospital_id"] for r in B.hospital_role_map(spark, sf_dir).collect()
                   if r["mapped_role"] == role and r["effective_from"] <= d
                   and (r["effective_to"] is None or r["effective_to"] >= d)})


def test_isolation_hospital_admin(spark, sf_dir):
    hs, _ = visible(spark, sf_dir, "HOSPITAL_ADMIN_H01")
    exp = expected_hospitals(spark, sf_dir, "HOSPITAL_ADMIN_H01")
    assert "H01" in exp and hs == exp


@pytest.mark.parametrize("role", ["HIPAA_OFFICER", "ACCOUNTADMIN", "SECURITYADMIN", "PHI_READER"])
def test_bypass_sees_all(spark, sf_dir, role):
    hs, n = visible(spark, sf_dir, role)
    assert n == B.patients(spark, sf_dir).count() and len(hs) == 12


@pytest.mark.parametrize("role", ["DS_ROLE", "ANALYST_REVENUE", "SYSADMIN", None])
def test_expired_future_unmapped_null_see_nothing(spark, sf_dir, role):
    assert visible(spark, sf_dir, role)[1] == 0


def test_ends_today_still_visible(spark, sf_dir):
    hs, n = visible(spark, sf_dir, "ANALYST_CLINICAL")
    assert n > 0 and len(hs) >= 1


def test_semi_and_isin_agree_and_keep_multiplicity(spark, sf_dir):
    # H01 has three base mapping rows (duplicates); the row count must equal the raw count.
    exp = expected_hospitals(spark, sf_dir, "HOSPITAL_ADMIN_H01")
    raw = B.patients(spark, sf_dir).where(F.col("hospital_id").isin(*exp)).count()
    assert visible(spark, sf_dir, "HOSPITAL_ADMIN_H01", "isin")[1] == raw
    assert visible(spark, sf_dir, "HOSPITAL_ADMIN_H01", "semi")[1] == raw


def test_partition_pruning_on_partitioned_table(spark, sf_dir, scratch):
    path = f"{scratch}/patients_by_hospital"
    B.patients(spark, sf_dir).write.partitionBy("hospital_id").parquet(path)
    df = spark.read.parquet(path)
    rm = B.hospital_role_map(spark, sf_dir)
    out = apply_row_policy(df, rm, SecurityContext(role="HOSPITAL_ADMIN_H03", as_of=AS_OF), method="isin")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hospital_id" in plan and "H03" in plan
    exp = expected_hospitals(spark, sf_dir, "HOSPITAL_ADMIN_H03")
    assert out.count() == df.where(F.col("hospital_id").isin(*exp)).count()


def test_semi_join_is_broadcast(spark, sf_dir):
    pts = B.patients(spark, sf_dir)
    out = apply_row_policy(pts, B.hospital_role_map(spark, sf_dir), SecurityContext(role="HOSPITAL_ADMIN_H02", as_of=AS_OF),
                           method="semi")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_a_revoke_shows_in_a_view_made_before(spark, sf_dir, scratch):
    from veilspark.operators.masking import PATIENT_BINDINGS
    from veilspark.plans.governed import governed_view
    ctx = SecurityContext(role="HOSPITAL_ADMIN_H04", as_of=AS_OF, salts=B.QUERY_SALTS)
    path = f"{scratch}/map"
    rm = B.hospital_role_map(spark, sf_dir)
    rm.write.parquet(path)
    governed_view(spark, "governed_h04", B.patients(spark, sf_dir), spark.read.parquet(path), ctx, PATIENT_BINDINGS)
    assert spark.sql("select * from governed_h04").count() > 0
    rm.where(F.col("mapped_role") != ctx.role).write.mode("overwrite").parquet(path)
    spark.catalog.refreshTable("governed_h04")  # the map's files were replaced: Spark lists them anew
    assert spark.sql("select * from governed_h04").count() == 0


def test_partitioned_table_is_pruned_at_run_time(spark, sf_dir, scratch):
    path = f"{scratch}/patients_by_hospital"
    B.patients(spark, sf_dir).write.partitionBy("hospital_id").parquet(path)
    out = apply_row_policy(spark.read.parquet(path), B.hospital_role_map(spark, sf_dir),
                           SecurityContext(role="HOSPITAL_ADMIN_H03", as_of=AS_OF))
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()

"""Golden values per role (reference tests A-E) on the FIXTURES rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from veilspark.context import SecurityContext
from veilspark.functions import masks as M
from veilspark.operators.masking import PATIENT_BINDINGS, apply_masks

ROWS = [
    ("TEST-001", "H01", "John Test-Patient", "999-99-0001", dt.date(1978, 3, 15), "MRN-SYNTHETIC-001", "555-TEST-0001",
     "test.patient@example.com", "123 Test Street", "45201", "E11.65", dt.date(2024, 1, 10), dt.date(2024, 1, 15), "1234567890"),
    ("TEST-002", "H02", "Jane Synthetic-Test", "999-99-0002", dt.date(1925, 7, 4), "MRN-SYNTHETIC-002", "555-TEST-0002",
     "jane.test@example.com", "456 Demo Avenue", "46201", "C7A.1", dt.date(2024, 2, 1), dt.date(2024, 2, 5), "0987654321"),
    ("TEST-NULL", "H01", None, None, None, None, None, None, None, None, None, dt.date(2024, 3, 1), dt.date(2024, 3, 2),
     "1111111111"),
]
SCHEMA = ("patient_id string, hospital_id string, patient_name string, patient_ssn string, patient_dob date, "
          "patient_mrn string, patient_phone string, patient_email string, patient_address_1 string, patient_zip string, "
          "primary_dx_code string, admission_date date, discharge_date date, attending_npi string")


@pytest.fixture(scope="module")
def pts(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def masked(pts, role, env="PROD"):
    ctx = SecurityContext(role=role, env=env, salts={"mrn": "test-salt", "account": "other-salt"})
    return {r["patient_id"]: r.asDict() for r in apply_masks(pts, PATIENT_BINDINGS, ctx).collect()}


def test_officer_sees_everything(pts):
    r = masked(pts, "HIPAA_OFFICER")["TEST-001"]
    assert (r["patient_name"], r["patient_ssn"], r["patient_dob"], r["patient_mrn"], r["patient_zip"], r["primary_dx_code"]) == \
        ("John Test-Patient", "999-99-0001", dt.date(1978, 3, 15), "MRN-SYNTHETIC-001", "45201", "E11.65")


def test_hospital_admin_partial(pts):
    r = masked(pts, "HOSPITAL_ADMIN_H01")["TEST-001"]
    assert r["patient_ssn"] == "XXX-XX-0001"
    assert r["patient_name"] == "John Test-Patient" and r["patient_dob"] == dt.date(1978, 3, 15)
    assert r["patient_mrn"] == "MRN-SYNTHETIC-001" and r["patient_zip"] == "45201" and r["primary_dx_code"] == "E11.65"


def test_analyst_heavy(pts):
    import hashlib
    r = masked(pts, "ANALYST_CLINICAL")["TEST-001"]
    tok = "MRN-" + hashlib.sha256(b"MRN-SYNTHETIC-001test-salt").hexdigest()[:12]
    assert (r["patient_name"], r["patient_ssn"], r["patient_dob"], r["patient_mrn"], r["patient_zip"], r["primary_dx_code"]) == \
        ("J***", "XXX-XX-XXXX", dt.date(1978, 1, 1), tok, "452**", "E11")
    assert r["patient_phone"] == "***-***-****" and r["patient_email"] == "***@***.***"
    assert r["patient_address_1"] == "*** REDACTED ***" and r["attending_npi"] == "1234567890"


def test_ds_role_deidentified(pts):
    m = masked(pts, "DS_ROLE")
    a, b = m["TEST-001"], m["TEST-002"]
    assert (a["patient_name"], a["patient_ssn"], a["patient_dob"], a["patient_zip"], a["primary_dx_code"]) == \
        ("***", None, dt.date(1978, 1, 1), "452**", "E11")
    assert (b["patient_dob"], b["patient_zip"], b["primary_dx_code"]) == (dt.date(1930, 1, 1), "462**", "C7A")


@pytest.mark.parametrize("role", ["SECURITYADMIN", "SYSADMIN", "PUBLIC", None])
def test_default_deny(pts, role):
    r = masked(pts, role)["TEST-001"]
    assert (r["patient_name"], r["patient_ssn"], r["patient_dob"], r["patient_mrn"], r["patient_zip"], r["primary_dx_code"]) == \
        ("***", "XXX-XX-XXXX", None, "***", "00000", "***")
    assert r["attending_npi"] == "**********"


@pytest.mark.parametrize("role", ["HIPAA_OFFICER", "HOSPITAL_ADMIN_H01", "ANALYST_CLINICAL", "DS_ROLE", "PUBLIC"])
def test_null_row_stays_null(pts, role):
    r = masked(pts, role)["TEST-NULL"]
    for c in ("patient_name", "patient_ssn", "patient_dob", "patient_mrn", "patient_phone", "patient_email",
              "patient_address_1", "patient_zip", "primary_dx_code"):
        assert r[c] is None


def test_dev_masks_officer(pts):
    r = masked(pts, "HIPAA_OFFICER", env="DEV")["TEST-001"]
    assert r["patient_ssn"] == "XXX-XX-XXXX" and r["patient_name"] == "***"


def test_account_number_revenue_only(spark):
    df = spark.createDataFrame([("A123",)], "a string")
    rev = df.select(M.mask_account_number(F.col("a"), "ANALYST_REVENUE", salt="s").alias("m")).first()["m"]
    clin = df.select(M.mask_account_number(F.col("a"), "ANALYST_CLINICAL", salt="s").alias("m")).first()["m"]
    assert rev.startswith("ACCT-") and len(rev) == 13 and clin == "***"


def test_like_wildcard_and_strict(spark):
    df = spark.createDataFrame([("HOSPITALXADMINX1",)], "r string")
    like = df.select(M.mask_ssn(F.lit("999-99-0001"), F.col("r")).alias("m")).first()["m"]
    strict = df.select(M.mask_ssn(F.lit("999-99-0001"), F.col("r"), strict_like=True).alias("m")).first()["m"]
    assert like == "XXX-XX-0001" and strict == "XXX-XX-XXXX"


def test_role_literal_folds_to_one_branch(pts):
    plan = apply_masks(pts, PATIENT_BINDINGS, SecurityContext(role="ANALYST_CLINICAL", salts={"mrn": "s"}))._jdf.queryExecution().optimizedPlan().toString()
    assert "HOSPITAL_ADMIN" not in plan and "DS_ROLE" not in plan

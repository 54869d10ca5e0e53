"""Registered queries: masks, row isolation, governed reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import register
from .context import SecurityContext
from .operators.masking import CLAIMS_BINDINGS, PATIENT_BINDINGS, apply_masks
from .operators.rowaccess import apply_row_policy, visible_rows_by_key
from .plans.governed import governed_patients
from .sources import bindings as B

AS_OF = B.PATIENT_AS_OF


def _ctx(role):
    return SecurityContext(role=role, as_of=AS_OF, salts=B.QUERY_SALTS)


# Rows visible per hospital under a role (row policy only).
def _visible(role, method="semi"):
    def q(spark, sf_dir):
        pts = B.patients(spark, sf_dir).select("patient_id", "hospital_id")
        rm = B.hospital_role_map(spark, sf_dir)
        return visible_rows_by_key(apply_row_policy(pts, rm, _ctx(role), method=method))
    return q


register("v11_visible_per_hospital_admin_h01")(_visible("HOSPITAL_ADMIN_H01", method="isin"))
register("r1_visible_per_hospital_semi_admin_h05")(_visible("HOSPITAL_ADMIN_H05", method="semi"))
register("r1_visible_bypass_securityadmin")(_visible("SECURITYADMIN"))
register("r2_visible_expired_ds_role")(_visible("DS_ROLE"))
register("r2_visible_ends_today_analyst_clinical")(_visible("ANALYST_CLINICAL"))
register("r2_visible_future_analyst_revenue")(_visible("ANALYST_REVENUE"))


# M1–M11 via M13: the whole patient table masked for one role (masks only).
def _masked_patients(role):
    def q(spark, sf_dir):
        return apply_masks(B.patients(spark, sf_dir).drop("created_at", "updated_at"), PATIENT_BINDINGS, _ctx(role))
    return q


for _role in ("HIPAA_OFFICER", "HOSPITAL_ADMIN_H01", "ANALYST_CLINICAL", "ANALYST_REVENUE", "DS_ROLE", "SECURITYADMIN"):
    register(f"m13_masked_patients_{_role.lower()}")(_masked_patients(_role))


# Billing masks on claims.
def _masked_claims(role):
    def q(spark, sf_dir):
        return apply_masks(B.claims(spark, sf_dir), CLAIMS_BINDINGS, _ctx(role))
    return q


for _role in ("ANALYST_REVENUE", "ANALYST_CLINICAL", "HOSPITAL_ADMIN_H03", "DS_ROLE"):
    register(f"m12_masked_claims_{_role.lower()}")(_masked_claims(_role))


# DEV environment masks even the officer.
@register("m22_masked_patients_dev_officer")
def m22(spark, sf_dir):
    ctx = SecurityContext(role="HIPAA_OFFICER", as_of=AS_OF, env="DEV", salts=B.QUERY_SALTS)
    return apply_masks(B.patients(spark, sf_dir).drop("created_at", "updated_at"), PATIENT_BINDINGS, ctx)


# Governed read: row policy then masks (hospital admin sees own hospital, partially masked).
@register("governed_patients_hospital_admin_h02")
def governed_h02(spark, sf_dir):
    return governed_patients(spark, sf_dir, _ctx("HOSPITAL_ADMIN_H02")).drop("created_at", "updated_at")


# User predicates after masking see masked values (M13 semantics).
@register("governed_filter_on_masked_zip_analyst")
def governed_filter_masked(spark, sf_dir):
    g = governed_patients(spark, sf_dir, _ctx("ANALYST_CLINICAL"))
    return (g.where(F.col("patient_zip").like("1%"))
            .groupBy("hospital_id", "patient_zip").agg(F.count(F.lit(1)).alias("n")))


# Role-by-role masked sample, 5 rows per role (the LIMIT is the feature).
@register("v12_role_sample")
def v12(spark, sf_dir):
    out = None
    for role in ("HIPAA_OFFICER", "HOSPITAL_ADMIN_H01", "ANALYST_CLINICAL", "DS_ROLE"):
        g = governed_patients(spark, sf_dir, _ctx(role)).select(
            "patient_id", "patient_name", "patient_ssn", "patient_dob", "patient_mrn", "patient_zip", "hospital_id")
        part = g.orderBy("patient_id").limit(5).withColumn("viewer_role", F.lit(role))
        out = part if out is None else out.unionByName(part)
    return out


def flagship(spark, sf_dir):
    """Governed patients for HOSPITAL_ADMIN_H01 and ANALYST_CLINICAL side by side:
    visible rows per hospital and masked ZIP."""
    out = None
    for role in ("HOSPITAL_ADMIN_H01", "ANALYST_CLINICAL"):
        g = governed_patients(spark, sf_dir, _ctx(role))
        part = (g.groupBy("hospital_id", "patient_zip").agg(F.count(F.lit(1)).alias("patients"))
                .withColumn("viewer_role", F.lit(role)))
        out = part if out is None else out.unionByName(part)
    return out


@register("r3_governed_from_registry_analyst")
def r3_registry(spark, sf_dir):
    """Patients read as CLEANSED_DB.CLINICAL.PATIENTS under the policies the live registry binds."""
    from .plans.governed import governed_from_registry
    from .sources.metadata import policy_references
    return governed_from_registry(B.patients(spark, sf_dir).drop("created_at", "updated_at"),
                                  policy_references(spark, sf_dir), B.hospital_role_map(spark, sf_dir),
                                  _ctx("ANALYST_CLINICAL"), "CLEANSED_DB", "CLINICAL", "PATIENTS")

"""Registered queries: tokens, de-identification, DEV copies, load integrity, grants as data, views, the landing stream
(M14–M21, S9, S11, S12, K6, K8)."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from .catalog import register
from .context import SecurityContext
from .functions.tokens import detokenize_ssn, join_rate, tokenize_ssn
from .operators import deident as DI
from .operators.masking import PATIENT_BINDINGS
from .operators.rowaccess import apply_row_policy, grant_hospital_access, revoke_hospital_access, visible_rows_by_key
from .plans.governed import governed_view
from .session import checkpoint_dir
from .sources import bindings as B
from .sources import synth as S
from .streaming.detect_stream import start_detection_to_log

# The token key of the test deployment (production injects its own).
TOKEN_KEY = "TEST_FPE_KEY_V1"
DEV_KEY = "DEV_REFRESH_KEY_V1"
QUASI = ["state", "zip3", "birth_year"]


@register("m14_ssn_tokens_patients")
def m14p(spark, sf_dir):
    p = B.patients(spark, sf_dir).select("patient_id", "patient_ssn")
    return tokenize_ssn(p, "patient_ssn", TOKEN_KEY, out="ssn_token")


@register("m14_ssn_tokens_claims")
def m14c(spark, sf_dir):
    c = B.claims(spark, sf_dir).select("claim_id", "patient_ssn")
    return tokenize_ssn(c, "patient_ssn", TOKEN_KEY, out="ssn_token")


@register("m15_detokenize_roundtrip")
def m15(spark, sf_dir):
    p = B.patients(spark, sf_dir).select("patient_id", "patient_ssn")
    t = tokenize_ssn(p, "patient_ssn", TOKEN_KEY, out="ssn_token")
    back = detokenize_ssn(t, "ssn_token", TOKEN_KEY, out="ssn_back", role="HIPAA_OFFICER")
    return back.agg(
        F.count("patient_ssn").alias("ssns"),
        F.count_distinct(F.regexp_replace("patient_ssn", "-", "")).alias("distinct_ssns"),
        F.count_distinct(F.regexp_replace("ssn_token", "-", "")).alias("distinct_tokens"),
        F.sum((F.col("ssn_back") == F.col("patient_ssn")).cast("int")).cast("bigint").alias("roundtrip_ok"),
        F.sum((F.col("ssn_token") == F.col("patient_ssn")).cast("int")).cast("bigint").alias("fixed_points"),
    )


@register("m16_join_rate")
def m16(spark, sf_dir):
    p = B.patients(spark, sf_dir).select("patient_ssn")
    c = B.claims(spark, sf_dir).select("patient_ssn")
    raw = join_rate(p, c, "patient_ssn", "patient_ssn", "raw_text")
    pt = tokenize_ssn(p, "patient_ssn", TOKEN_KEY, out="tok", keep_format=False)
    ct = tokenize_ssn(c, "patient_ssn", TOKEN_KEY, out="tok", keep_format=False)
    tok = join_rate(pt, ct, "tok", "tok", "fpe_token")
    return raw.unionByName(tok)


@register("m17_safe_harbor_mart")
def m17(spark, sf_dir):
    return DI.safe_harbor(B.patients(spark, sf_dir), B.PATIENT_AS_OF.date(), B.QUERY_SALTS["mrn"])


@register("m18_zip3_safe")
def m18(spark, sf_dir):
    p = B.patients(spark, sf_dir).select("patient_id", "patient_zip")
    return DI.zip3_safe(p, "patient_zip").select("patient_id", "zip3")


def _lds(spark, sf_dir):
    return DI.limited_data_set(B.patients(spark, sf_dir), B.QUERY_SALTS["mrn"], role="HIPAA_OFFICER", agreement="DUA-2024-017")


@register("m19_limited_data_set")
def m19(spark, sf_dir):
    return _lds(spark, sf_dir)


@register("m20_reid_risk_summary")
def m20(spark, sf_dir):
    return DI.reid_risk_summary(_lds(spark, sf_dir), QUASI, k_min=5)


@register("m20_suppressed_lds")
def m20s(spark, sf_dir):
    return DI.suppress_small_cells(_lds(spark, sf_dir), QUASI, k_min=5)


@register("m21_population_health")
def m21a(spark, sf_dir):
    return DI.population_health(m17(spark, sf_dir), min_cell=11, dims=("state", "age_band"))


@register("m21_revenue_cycle")
def m21b(spark, sf_dir):
    return DI.revenue_cycle(B.claims(spark, sf_dir), min_cell=11)


@register("m21_quality_metrics")
def m21c(spark, sf_dir):
    return DI.quality_metrics(m17(spark, sf_dir), min_cell=11)


@register("s11_dev_refresh_patients")
def s11(spark, sf_dir):
    return S.deidentify_copy(B.patients(spark, sf_dir).drop("created_at", "updated_at"), DEV_KEY)


@register("s12_load_key_diff")
def s12(spark, sf_dir):
    """Keys of the orders source missing from (or added to) the derived claims load."""
    src = B.read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("claim_id"))
    return S.load_key_diff(src, B.claims(spark, sf_dir), ["claim_id"])


@register("s12_load_fingerprint")
def s12f(spark, sf_dir):
    src = B.read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("claim_id"))
    return S.load_fingerprint(src, ["claim_id"], "source").unionByName(
        S.load_fingerprint(B.claims(spark, sf_dir), ["claim_id"], "target"))


@register("k6_visible_after_changes")
def k6(spark, sf_dir):
    """Grants as data: a new campus role is granted H05, another role's H03 ends the day before; rows visible to each."""
    rm = B.hospital_role_map(spark, sf_dir)
    rm = rm.unionByName(grant_hospital_access(spark, "HOSPITAL_ADMIN_H13", "H05", date(2024, 5, 1), "SECURITYADMIN", "new campus",
                                              "CHG0009999", map_id="K6"))
    rm = revoke_hospital_access(rm, "HOSPITAL_ADMIN_H03", "H03", date(2024, 5, 31))
    pts = B.patients(spark, sf_dir).select("patient_id", "hospital_id")
    parts = [visible_rows_by_key(apply_row_policy(pts, rm, SecurityContext(role=r, as_of=B.PATIENT_AS_OF))).select(
        F.lit(r).alias("viewer_role"), "hospital_id", "patient_count")
        for r in ("HOSPITAL_ADMIN_H13", "HOSPITAL_ADMIN_H03", "HOSPITAL_ADMIN_H01")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("k8_governed_view_sql")
def k8(spark, sf_dir):
    """A temp view that holds the policy, queried by SQL."""
    ctx = SecurityContext(role="ANALYST_CLINICAL", as_of=B.PATIENT_AS_OF, salts=B.QUERY_SALTS)
    governed_view(spark, "k8_patients", B.patients(spark, sf_dir), B.hospital_role_map(spark, sf_dir), ctx, PATIENT_BINDINGS)
    return spark.sql("SELECT hospital_id, left(patient_zip, 1) AS zip1, count(*) AS n, count(DISTINCT patient_ssn) AS ssns "
                     "FROM k8_patients GROUP BY ALL")


@register("s9_landing_stream_alerts")
def s9(spark, sf_dir):
    """The landing folder as a stream into the suspect log (S9, K2): what is in the log once all files are read."""
    work = f"{checkpoint_dir(spark).rstrip('/')}/veilspark-s9/{uuid.uuid4().hex}"
    source = f"{sf_dir.rstrip('/')}/events.parque[t]"  # a pattern: the driver's folder holds other tables too
    start_detection_to_log(spark, source, f"{work}/log", f"{work}/checkpoint").awaitTermination()
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return spark.read.parquet(f"{work}/log").select(
        "suspect_id", "trigger_type", "anomaly_score", "suspect_user", "suspect_role", "related_query_count",
        ntz("window_start"), ntz("window_end"), F.col("detected_date").cast("date").alias("detected_date"))

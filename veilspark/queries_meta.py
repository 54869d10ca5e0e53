"""Registered queries: metadata checks, scorecard, grants and policy-as-code."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import register
from .operators import grants as G
from .plans import check_run as C
from .plans import checks
from .plans import reports as R
from .sources import bindings as B
from .sources import metadata as M

EV_AS_OF = B.EVENTS_AS_OF
REVIEW_AS_OF = B.REVIEW_AS_OF
PATIENT_AS_OF = B.PATIENT_AS_OF


@register("v5_database_ownership")
def v5(spark, sf_dir):
    return R.database_ownership(M.databases(spark, sf_dir))


@register("v6_sysadmin_phi_access_direct")
def v6(spark, sf_dir):
    return R.sysadmin_phi_access(M.object_privileges(spark, sf_dir))


@register("v7_mask_bindings")
def v7(spark, sf_dir):
    return R.mask_bindings(M.policy_references(spark, sf_dir), M.masking_policies(spark, sf_dir))


@register("v8_unmasked_phi_columns")
def v8(spark, sf_dir):
    return R.unmasked_phi_columns(M.column_catalog(spark, sf_dir), M.policy_references(spark, sf_dir))


@register("v9_row_policies_applied")
def v9(spark, sf_dir):
    return R.row_policies_applied(M.policy_references(spark, sf_dir), M.row_access_policies(spark, sf_dir))


@register("v10_mapping_status")
def v10(spark, sf_dir):
    return R.mapping_status(B.hospital_role_map(spark, sf_dir), PATIENT_AS_OF.date())


@register("v13_destructive_audit_privileges")
def v13(spark, sf_dir):
    return R.destructive_audit_privileges(M.object_privileges(spark, sf_dir))


@register("v16_phi_role_users")
def v16(spark, sf_dir):
    return R.phi_role_users(M.roles(spark, sf_dir), M.grants_to_users(spark, sf_dir), M.users(spark, sf_dir),
                            M.PHI_ROLES)


@register("a6_role_user_chunks")
def a6(spark, sf_dir):
    """The lists of v16 as numbered chunks of three users."""
    return R.role_user_chunks(M.roles(spark, sf_dir), M.grants_to_users(spark, sf_dir), M.users(spark, sf_dir),
                              M.PHI_ROLES, size=3).withColumn("users", F.array_join("users", ", "))


@register("v17_inactive_phi_users")
def v17(spark, sf_dir):
    return R.inactive_phi_users(M.users(spark, sf_dir), M.grants_to_users(spark, sf_dir), REVIEW_AS_OF,
                                M.INACTIVE_CHECK_ROLES)


@register("s8_flatten_network_info")
def s8(spark, sf_dir):
    return M.flatten_json(M.network_info(spark, sf_dir), "info", keep=("account",))


@register("v18_network_policy_check")
def v18(spark, sf_dir):
    return R.network_policy_check(M.flatten_json(M.network_info(spark, sf_dir), "info", keep=("account",)))


@register("v19_scorecard")
def v19(spark, sf_dir):
    return checks.scorecard(B.grant_ledger(spark, sf_dir), B.security_policy_changes(spark, sf_dir),
                            M.task_history(spark, sf_dir), EV_AS_OF)


@register("v20_public_phi_grants")
def v20(spark, sf_dir):
    return R.public_phi_grants(M.grants_to_roles(spark, sf_dir))


@register("v21_public_grant_option")
def v21(spark, sf_dir):
    return R.public_grant_option(M.grants_to_roles(spark, sf_dir))


@register("v22_service_accounts_human_roles")
def v22(spark, sf_dir):
    return R.service_accounts_with_human_roles(M.users(spark, sf_dir), M.grants_to_users(spark, sf_dir))


@register("v23_warehouses_without_autosuspend")
def v23(spark, sf_dir):
    return R.warehouses_without_autosuspend(M.warehouses(spark, sf_dir))


@register("v24_three_controls")
def v24(spark, sf_dir):
    flat = M.flatten_json(M.network_info(spark, sf_dir), "info", keep=("account",))
    return checks.three_controls(M.policy_references(spark, sf_dir), flat, M.warehouses(spark, sf_dir))


@register("v25_access_review")
def v25(spark, sf_dir):
    return R.access_review(M.users(spark, sf_dir), M.grants_to_users(spark, sf_dir), REVIEW_AS_OF.date())


@register("v29_mapping_data_quality")
def v29(spark, sf_dir):
    return R.mapping_data_quality(B.hospital_role_map(spark, sf_dir), PATIENT_AS_OF.date())


@register("v30_required_row_policies")
def v30(spark, sf_dir):
    return R.required_row_policies(spark, M.policy_references(spark, sf_dir))


@register("v31_patient_table_mask_bindings")
def v31(spark, sf_dir):
    return R.table_mask_bindings(M.policy_references(spark, sf_dir), "CLEANSED_DB", "CLINICAL", "PATIENTS")


@register("s5_policy_references_masking")
def s5(spark, sf_dir):
    return M.policy_references(spark, sf_dir).where(F.col("policy_kind") == "MASKING_POLICY")


@register("g1_effective_privileges")
def g1(spark, sf_dir):
    return G.effective_privileges(G.role_edges(spark), M.object_privileges(spark, sf_dir))


@register("g1_sysadmin_phi_access_effective")
def g1_sys(spark, sf_dir):
    eff = G.effective_privileges(G.role_edges(spark), M.object_privileges(spark, sf_dir))
    return eff.where((F.col("role") == "SYSADMIN") & F.col("object_catalog").isin("RAW_DB", "CLEANSED_DB")).select(
        "role", "privilege_type", "object_type", "object_name", "via_role")


# Desired state of the policy configuration (policy-as-code rows).
DESIRED_MASKS = ("MASK_SSN", "MASK_DOB", "MASK_PATIENT_NAME", "MASK_MRN", "MASK_PHONE", "MASK_EMAIL",
                 "MASK_ADDRESS_STREET", "MASK_ZIP_CODE", "MASK_DIAGNOSIS_CODE")
DESIRED_FULL_ROLES = ("ACCOUNTADMIN", "HIPAA_OFFICER", "PHI_READER")
DESIRED_ROW_TARGETS = ("CLEANSED_DB.CLINICAL.PATIENTS", "CLEANSED_DB.BILLING.CLAIMS", "RAW_DB.EHR.PATIENT_EVENTS")


def desired_policies(spark):
    rows = [("MASKING_POLICY", m, None, list(DESIRED_FULL_ROLES)) for m in DESIRED_MASKS]
    rows += [("ROW_ACCESS_POLICY", "PATIENT_HOSPITAL_ISOLATION", t, None) for t in DESIRED_ROW_TARGETS]
    return spark.createDataFrame(rows, "policy_type string, policy_name string, target string, full_roles array<string>")


def live_policies(spark, sf_dir):
    """Live state: masks with their latest full-role definition; row policy targets."""
    ch = B.security_policy_changes(spark, sf_dir)
    # the live definition is the latest non-null one (unbind events carry none)
    defs = ch.where((F.col("object_type") == "MASKING_POLICY") & F.col("definition_after").isNotNull()).groupBy(
        "policy_name").agg(
        F.max(F.struct("changed_at", "change_id", "definition_after")).alias("last"))
    masks = defs.select(F.lit("MASKING_POLICY").alias("policy_type"), "policy_name",
                        F.lit(None).cast("string").alias("target"),
                        F.split(F.col("last.definition_after"), ",").alias("full_roles"))
    refs = M.policy_references(spark, sf_dir).where(F.col("policy_kind") == "ROW_ACCESS_POLICY")
    rows = refs.select(F.lit("ROW_ACCESS_POLICY").alias("policy_type"), "policy_name",
                       F.concat_ws(".", "ref_database_name", "ref_schema_name", "ref_entity_name").alias("target"),
                       F.lit(None).cast("array<string>").alias("full_roles")).distinct()
    return masks.unionByName(rows)


@register("g2_policy_drift")
def g2(spark, sf_dir):
    return G.policy_drift(desired_policies(spark), live_policies(spark, sf_dir))


@register("g3_weakened_policies")
def g3(spark, sf_dir):
    return G.weakened_policies(B.security_policy_changes(spark, sf_dir))


@register("g4_change_control")
def g4(spark, sf_dir):
    return G.change_control(B.security_policy_changes(spark, sf_dir))


@register("g5_layout_readiness")
def g5(spark, sf_dir):
    return G.layout_readiness(B.patients(spark, sf_dir))


def check_sources(spark, sf_dir):
    """Each source of the weekly run, as facts."""
    return [
        C.grant_facts(B.grant_ledger(spark, sf_dir)),
        C.query_facts(B.query_history(spark, sf_dir), M.auto_suspend_of(F.col("warehouse_name"))),
        C.policy_facts(B.security_policy_changes(spark, sf_dir)),
        C.log_facts(B.phi_access_log(spark, sf_dir), EV_AS_OF),
        C.mapping_facts(B.hospital_role_map(spark, sf_dir), PATIENT_AS_OF),
        C.account_facts(M.users(spark, sf_dir), M.grants_to_users(spark, sf_dir), REVIEW_AS_OF, M.PHI_ROLES,
                        M.INACTIVE_CHECK_ROLES),
        C.network_facts(M.network_info(spark, sf_dir)),
    ]


@register("k7_validation_results")
def k7(spark, sf_dir):
    """The weekly run: checks 1A to 7B and the four hardening checks."""
    return C.check_rows(C.check_counts(check_sources(spark, sf_dir)), EV_AS_OF)

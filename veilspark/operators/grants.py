"""Grants and policy-as-code, as tables.

G1  effective privileges: role edges closed transitively, joined to direct grants
G2  drift between desired policy rows and the live state
G3  weakened policies: the full-visibility role set grew
G4  change-control completeness: ticket and approvals
G5  layout readiness of a table before a row policy is attached
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

# Role hierarchy edges (child granted to parent; parent inherits).
_FIXED_EDGES = [
    ("HIPAA_OFFICER", "PHI_READER"),
    ("ANALYST_CLINICAL", "ANALYST_BASE"),
    ("ANALYST_REVENUE", "ANALYST_BASE"),
    ("DS_ROLE", "ANALYST_BASE"),
    ("SECURITYADMIN", "HIPAA_OFFICER"),
    ("SECURITYADMIN", "AUDIT_READER"),
    ("SYSADMIN", "DBT_ROLE"),
    ("SYSADMIN", "PIPELINE_ROLE"),
    ("SECURITYADMIN", "AUDIT_WRITER"),
]
HOSPITALS = 12


def role_edges(spark: SparkSession) -> DataFrame:
    """parent_role, child_role. The per-hospital edges follow one rule:
    every HOSPITAL_ADMIN_Hnn inherits ANALYST_BASE and reports to SECURITYADMIN."""
    edges = list(_FIXED_EDGES)
    for i in range(1, HOSPITALS + 1):
        h = f"HOSPITAL_ADMIN_H{i:02d}"
        edges.append((h, "ANALYST_BASE"))
        edges.append(("SECURITYADMIN", h))
    return spark.createDataFrame(edges, "parent_role string, child_role string")


def role_closure(edges: DataFrame) -> DataFrame:
    """(role, inherited_role) for every role reachable through grants, including the role
    itself. Each round joins the pairs found so far with themselves, so the reach doubles:
    a chain of n grants takes log2(n) rounds. It stops at the fixpoint, whatever the depth
    (cycles too). Every round is checkpointed, so its plan holds one join, not all before."""
    e = edges.select(F.col("parent_role").alias("role"), F.col("child_role").alias("inherited_role"))
    roles = e.select("role").union(e.select("inherited_role")).distinct()
    reach = cut_lineage(roles.select("role", F.col("role").alias("inherited_role")).unionByName(e).distinct())
    known = reach.count()
    while True:
        step = (reach.select("role", F.col("inherited_role").alias("mid"))
                .join(reach.select(F.col("role").alias("mid"), "inherited_role"), "mid").drop("mid"))
        reach = cut_lineage(step.distinct())  # holds reach itself: every role reaches itself
        now = reach.count()
        if now == known:
            return reach
        known = now


def effective_privileges(edges: DataFrame, privileges: DataFrame) -> DataFrame:
    """G1: every (role, privilege, object) a role holds directly or through inheritance."""
    closure = role_closure(edges)
    p = privileges.select(F.col("grantee_name").alias("inherited_role"), "privilege_type", "object_type",
                          "object_name", "object_catalog")
    return (p.join(closure, "inherited_role")
            .select("role", "privilege_type", "object_type", "object_name", "object_catalog",
                    F.col("inherited_role").alias("via_role"))
            .withColumn("is_direct", F.col("role") == F.col("via_role")))


def policy_drift(desired: DataFrame, live: DataFrame) -> DataFrame:
    """Desired vs live policy rows -> MISSING / EXTRA / CHANGED / OK.

    Both sides: policy_type, policy_name, target, full_roles (array or null).
    A full outer join on (type, name, target); role sets compared sorted and null-safe."""
    k = ["policy_type", "policy_name", "target"]
    d = desired.select(*[F.col(c).alias(f"d_{c}") for c in k], F.array_sort("full_roles").alias("desired_roles"))
    lv = live.select(*[F.col(c).alias(f"l_{c}") for c in k], F.array_sort("full_roles").alias("live_roles"))
    # target is null for policies without one: compare it null-safe
    cond = ((F.col("d_policy_type") == F.col("l_policy_type")) & (F.col("d_policy_name") == F.col("l_policy_name"))
            & F.col("d_target").eqNullSafe(F.col("l_target")))
    j = d.join(lv, cond, "full_outer")
    status = (F.when(F.col("l_policy_name").isNull(), "MISSING")
              .when(F.col("d_policy_name").isNull(), "EXTRA")
              .when(~F.col("desired_roles").eqNullSafe(F.col("live_roles")), "CHANGED")
              .otherwise("OK"))
    return j.select(*[F.coalesce(f"d_{c}", f"l_{c}").alias(c) for c in k],
                    F.array_join("desired_roles", ",").alias("desired_roles"),
                    F.array_join("live_roles", ",").alias("live_roles"), status.alias("drift_status"))


def weakened_policies(changes: DataFrame) -> DataFrame:
    """Policy alterations whose full-visibility role set gained roles."""
    before = F.split(F.col("definition_before"), ",")
    after = F.split(F.col("definition_after"), ",")
    added = F.array_sort(F.array_except(after, before))
    return changes.where(F.col("definition_before").isNotNull() & F.col("definition_after").isNotNull()).select(
        "change_id", "changed_at", "changed_by_user", "policy_name",
        F.array_join(added, ",").alias("roles_added"),
    ).where(F.col("roles_added") != "")


def change_control(changes: DataFrame) -> DataFrame:
    """PHI policy changes need a ticket; row-policy and emergency changes need two approvers."""
    approvers = F.when(F.col("approved_by").isNull(), F.lit(0)).otherwise(F.size(F.split("approved_by", ",")))
    needs_two = (F.col("object_type") == "ROW_ACCESS_POLICY") | (F.col("is_emergency_change") == F.lit(True))
    status = (F.when(F.col("ticket_reference").isNull(), "FAIL: missing ticket")
              .when(needs_two & (approvers < 2), "FAIL: needs two approvals")
              .when(approvers < 1, "FAIL: missing approval")
              .otherwise("PASS"))
    return changes.select("change_id", "changed_at", "object_type", "policy_name", "ticket_reference",
                          approvers.cast("bigint").alias("approvals"), needs_two.alias("needs_two_approvals"),
                          status.alias("control_status"))


def layout_readiness(df: DataFrame, key: str = "hospital_id", max_file_share: float = 0.5) -> DataFrame:
    """For each key value, rows and the number of input files holding it.
    A key spread over most files gains nothing from pruning: NOT_READY."""
    # one scan: rows per (file, key); the rest works on that small result
    held = cut_lineage(df.select(key, F.input_file_name().alias("_file")).groupBy("_file", key).agg(
        F.count(F.lit(1)).alias("_rows")))
    total_files = held.select("_file").distinct().count()
    per = held.groupBy(key).agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("files"))
    share = F.col("files") / F.lit(total_files)
    return per.withColumn("total_files", F.lit(total_files).cast("bigint")).select(key, "rows", "files", "total_files",
                    F.when((F.col("total_files") > 1) & (share > max_file_share), "NOT_READY").otherwise("READY")
                    .alias("layout_status"))

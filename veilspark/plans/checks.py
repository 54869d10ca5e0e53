"""Scorecard (V19) and three-control status."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .check_run import check_counts, grant_facts, policy_facts, task_facts

# Result ranking of the scorecard.
RESULT_RANK = {"CRITICAL FAIL": 1, "FAIL": 2, "WARNING": 3, "REVIEW": 4}


def scorecard(ledger: DataFrame, changes: DataFrame, tasks: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Five checks, severity-ordered, from one pass over each of the three sources (the machinery of
    the weekly run). The task check always yields a row (FAIL when there was no successful run in the last hour)."""
    counts = check_counts([grant_facts(ledger), policy_facts(changes), task_facts(tasks, as_of)])

    def row(category: str, name: str, count: str, result: Column, suffix: str) -> Column:
        n = F.col(count).cast("bigint")
        return F.struct(F.lit(category).alias("category"), F.lit(name).alias("check_name"), result.alias("result"),
                        F.concat(n.cast("string"), F.lit(suffix)).alias("detail"), n.alias("n"))

    n = F.col
    rows = F.array(
        row("RBAC", "SYSADMIN PHI Access", "1B", F.when(n("1B") == 0, "PASS").otherwise("FAIL"), " privilege(s) found"),
        row("AUDIT", "Audit Table Immutability", "5A", F.when(n("5A") == 0, "PASS").otherwise("CRITICAL FAIL"),
            " destructive privilege(s) found"),
        row("POLICY", "Hospital Isolation Policy Exists", "isolation", F.when(n("isolation") > 0, "PASS").otherwise("FAIL"),
            " row-access policies found"),
        row("POLICY", "Masking Policies (expect >=12)", "masks", F.when(n("masks") >= 12, "PASS").otherwise("WARNING"),
            " masking policies found"),
        row("AUDIT", "DLP Monitoring Task Active", "task", F.when(n("task") > 0, "PASS").otherwise("FAIL"),
            " successful run(s) in the last hour"))
    out = counts.select(F.explode(rows).alias("r")).select("r.*")
    rank = F.lit(5)
    for text, r in sorted(RESULT_RANK.items(), key=lambda kv: -kv[1]):
        rank = F.when(F.col("result") == text, F.lit(r)).otherwise(rank)
    return out.orderBy(rank, "category", "check_name")


def three_controls(refs: DataFrame, network_flat: DataFrame, warehouses: DataFrame) -> DataFrame:
    """MFA policy, network policy per account, resource monitor on PHI_WH."""
    mfa = refs.where(F.col("policy_kind") == "AUTHENTICATION_POLICY").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("Account MFA policy").alias("control"), F.lit(None).cast("string").alias("subject"),
        F.when(F.col("n") > 0, "ACTIVE").otherwise("MISSING").alias("status"))
    net = network_flat.where(F.col("key") == "NETWORK_POLICY").select(
        F.lit("Network policy at account").alias("control"), F.col("account").alias("subject"),
        F.when(F.col("value") != "", "ACTIVE").otherwise("MISSING").alias("status"))
    rm = warehouses.where((F.col("name") == "PHI_WH") & F.col("deleted_on").isNull()).select(
        F.lit("Resource monitor on PHI_WH").alias("control"), F.col("name").alias("subject"),
        F.when(F.col("resource_monitor") != "null", "ACTIVE").otherwise("MISSING").alias("status"))
    return mfa.unionByName(net).unionByName(rm)

"""Hospital row isolation.

R1 policy: bypass roles see everything; any other role sees a row only when an
*active* mapping (R2: effective_from <= today <= effective_to, open end allowed)
grants that role the row's hospital. The reference text compares the inner
column with itself (always true); we build the intended equality.

The policy is a left-semi join with the role map, planned by Spark: the active hospitals
are broadcast when they are under the session's threshold, and prune partitions at run
time. Grants are read whenever the plan runs, so a revoke, an expiry of the map's rows or
a new grant shows in the next query of a view or stream. A semi join never duplicates
rows, even with duplicate mappings. ``method="isin"`` turns the hospitals into literals
when the frame is built, for a one-shot read that wants static pruning (R4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import SecurityContext
from ..functions.timefns import date_lit

def active_mappings(role_map: DataFrame, ctx: SecurityContext) -> DataFrame:
    """R2: mappings of ctx.role valid on ctx.as_of (both ends inclusive)."""
    today = date_lit(ctx.as_of_date)
    return role_map.where(
        (F.col("mapped_role") == F.lit(ctx.role))
        & (F.col("effective_from") <= today)
        & (F.col("effective_to").isNull() | (F.col("effective_to") >= today))
    )


def active_hospitals(role_map: DataFrame, ctx: SecurityContext, key: str = "hospital_id") -> DataFrame:
    return active_mappings(role_map, ctx).select(F.col("hospital_id").alias(key)).distinct()


def row_policy_predicate(hospitals: list[str], key: str = "hospital_id") -> Column:
    return F.col(key).isin(*hospitals) if hospitals else F.lit(False)


def apply_row_policy(
    df: DataFrame,
    role_map: DataFrame,
    ctx: SecurityContext,
    key: str = "hospital_id",
    method: str = "semi",
) -> DataFrame:
    """Filter df to the rows ctx may see. Never changes row multiplicity."""
    if method not in ("semi", "isin"):
        raise ValueError(f"unknown method {method!r}: 'semi' (grants read at run time) or 'isin' (a one-shot read)")
    if ctx.role is None:
        return df.where(F.lit(False))  # default deny; folds to an empty relation
    if ctx.bypasses_row_policy():
        return df
    allowed = active_hospitals(role_map, ctx, key)
    if method == "isin":
        return df.where(row_policy_predicate([r[0] for r in allowed.collect()], key))
    return df.join(allowed, on=key, how="left_semi")


def visible_rows_by_key(df: DataFrame, key: str = "hospital_id") -> DataFrame:
    """Rows visible per hospital (after the policy was applied)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("patient_count"))


MAPPING_SCHEMA = ("map_id string, mapped_role string, hospital_id string, access_type string, effective_from date, "
                  "effective_to date, granted_by string, business_reason string, ticket_ref string")


def grant_hospital_access(spark, role: str, hospital_id: str, effective_from, granted_by: str, business_reason: str,
                          ticket_ref: str | None, access_type: str = "READ", effective_to=None,
                          map_id: str | None = None) -> DataFrame:
    """K6 insert: one mapping row to append to the role map (adding a hospital is
    data, not a policy change)."""
    import uuid
    row = (map_id or str(uuid.uuid4()), role, hospital_id, access_type, effective_from, effective_to, granted_by,
           business_reason, ticket_ref)
    return spark.createDataFrame([row], MAPPING_SCHEMA)


def revoke_hospital_access(role_map: DataFrame, role: str, hospital_id: str, end_date) -> DataFrame:
    """K6 removal by end-dating: matching rows end at `end_date` (never later
    than an existing end); history stays, the policy stops matching after it."""
    hit = (F.col("mapped_role") == role) & (F.col("hospital_id") == hospital_id)
    end = date_lit(end_date)
    new_to = F.when(hit, F.when(F.col("effective_to").isNull(), end).otherwise(F.least("effective_to", end))) \
        .otherwise(F.col("effective_to"))
    return role_map.withColumn("effective_to", new_to)

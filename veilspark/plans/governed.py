"""governed(): the read path of a protected table.

Order matters and follows the reference: the row policy filters on the *raw*
key first, then masks are applied, then the caller's own transformations see
masked masked values. The row policy is a semi join with the role map that runs with every
query. Because the role is a literal, every mask folds to a single branch, so the whole
read stays in one codegen stage.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..context import SecurityContext
from ..operators.masking import CLAIMS_BINDINGS, PATIENT_BINDINGS, apply_masks
from ..operators.rowaccess import apply_row_policy
from ..sources import bindings as B


def governed_frame(
    df: DataFrame,
    role_map: DataFrame,
    ctx: SecurityContext,
    masks: Mapping[str, str],
    row_key: str | None = "hospital_id",
    method: str = "semi",
) -> DataFrame:
    if row_key is not None:
        df = apply_row_policy(df, role_map, ctx, key=row_key, method=method)
    return apply_masks(df, masks, ctx)


def governed_patients(spark: SparkSession, sf_dir: str, ctx: SecurityContext, method: str = "semi",
                      source: DataFrame | None = None) -> DataFrame:
    src = source if source is not None else B.patients(spark, sf_dir)
    return governed_frame(src, B.hospital_role_map(spark, sf_dir), ctx, PATIENT_BINDINGS, method=method)


def governed_claims(spark: SparkSession, sf_dir: str, ctx: SecurityContext, method: str = "semi") -> DataFrame:
    return governed_frame(B.claims(spark, sf_dir), B.hospital_role_map(spark, sf_dir), ctx, CLAIMS_BINDINGS,
                          method=method)


def governed_view(spark: SparkSession, name: str, df: DataFrame, role_map: DataFrame, ctx: SecurityContext,
                  masks: Mapping[str, str], row_key: str | None = "hospital_id") -> DataFrame:
    """Register the governed frame as a temp view so SQL users query masked,
    row-filtered data (``spark.sql("SELECT ... FROM <name>")``). The view holds
    the plan, not data: every query re-applies the policy, grants included."""
    g = governed_frame(df, role_map, ctx, masks, row_key)
    g.createOrReplaceTempView(name)
    return g


def bindings_from_registry(refs: DataFrame, database: str, schema: str, table: str) -> tuple[dict, str | None]:
    """R3 / M13 driven by the live registry: (column -> mask name, row-policy column or None)
    for one table. The list is one table's columns; the driver needs it to build the projection."""
    from pyspark.sql import functions as F

    rows = refs.where((F.col("ref_database_name") == database) & (F.col("ref_schema_name") == schema)
                      & (F.col("ref_entity_name") == table)).select("policy_kind", "policy_name", "ref_column_name")
    masks, row_key = {}, None
    for r in rows.collect():
        if r["policy_kind"] == "MASKING_POLICY":
            masks[r["ref_column_name"].lower()] = r["policy_name"].lower()
        elif r["policy_kind"] == "ROW_ACCESS_POLICY":
            row_key = r["ref_column_name"].lower()
    return masks, row_key


def governed_from_registry(df: DataFrame, refs: DataFrame, role_map: DataFrame, ctx: SecurityContext,
                           database: str, schema: str, table: str, method: str = "semi") -> DataFrame:
    """Read `df` as table database.schema.table under whatever policies the registry
    currently binds to it: the row policy if attached, then each bound mask."""
    masks, row_key = bindings_from_registry(refs, database, schema, table)
    return governed_frame(df, role_map, ctx, masks, row_key=row_key, method=method)

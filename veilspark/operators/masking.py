"""Binding masks to a table's columns and applying them on read.

A binding is ``column -> mask name``. ``apply_masks`` rewrites the table in one
``select``: bound columns are replaced by their masked expression under the
same name, others pass through. Predicates written after it see masked values,
which is the required semantics (a filter on a masked column therefore cannot
reach the parquet scan; filters on unmasked columns still do).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import SecurityContext
from ..functions.masks import get_mask

# The reference's bindings on the patient table (10 columns) and
# the billing columns covered by the remaining two masks.
PATIENT_BINDINGS = {
    "patient_name": "mask_patient_name",
    "patient_ssn": "mask_ssn",
    "patient_dob": "mask_dob",
    "patient_mrn": "mask_mrn",
    "patient_phone": "mask_phone",
    "patient_email": "mask_email",
    "patient_address_1": "mask_address_street",
    "patient_zip": "mask_zip_code",
    "primary_dx_code": "mask_diagnosis_code",
    "attending_npi": "mask_npi",
}
CLAIMS_BINDINGS = {
    "account_number": "mask_account_number",
    "medication_name": "mask_medication_name",
}


def masked_column(name: str, mask: str, ctx: SecurityContext, role=None):
    fn = get_mask(mask)
    return fn(F.col(name), ctx.role if role is None else role, ctx).alias(name)


def apply_masks(df: DataFrame, bindings: Mapping[str, str], ctx: SecurityContext, role=None) -> DataFrame:
    """Replace each bound column by its masked value (role literal, or a role column)."""
    lower = {k.lower(): v for k, v in bindings.items()}
    cols = []
    for name in df.columns:
        mask = lower.get(name.lower())
        cols.append(masked_column(name, mask, ctx, role) if mask else F.col(name))
    return df.select(*cols)


def unbind(bindings: Mapping[str, str], *columns: str) -> dict:
    """Detach masks from columns (the reference's UNSET MASKING POLICY)."""
    drop = {c.lower() for c in columns}
    return {k: v for k, v in bindings.items() if k.lower() not in drop}

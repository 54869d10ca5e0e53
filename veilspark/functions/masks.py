"""Role-dependent column masks as native Spark expressions (no UDF).

Every mask has the same shape: a null guard first, then the full-access roles,
then ``HOSPITAL_ADMIN_%``, then the analysts, then DS_ROLE, else a default
deny. The role is a literal in normal use, so Catalyst folds the CASE to the
one branch that applies; passing a role *column* evaluates the same policy per
row (used by the multi-role sample and by tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..context import (
    ANALYST_ROLES,
    DOB_CAP_YEAR,
    DS_ROLE,
    FULL_ACCESS_ROLES,
    HOSPITAL_ADMIN_PATTERN,
    SecurityContext,
)

MaskFn = Callable[..., Column]

# ---------------------------------------------------------------------------
# The literal outputs of the reference masks.
# ---------------------------------------------------------------------------
SSN_MASKED = "XXX-XX-XXXX"
SSN_LAST4_PREFIX = "XXX-XX-"
NAME_MASKED = "***"
NAME_INITIAL_SUFFIX = "***"
MRN_TOKEN_PREFIX = "MRN-"
MRN_TOKEN_HEX = 12
GENERIC_MASKED = "***"
PHONE_MASKED = "***-***-****"
ADDRESS_MASKED = "*** REDACTED ***"
ZIP_MASKED = "00000"
ZIP3_SUFFIX = "**"
EMAIL_MASKED = "***@***.***"
NPI_MASKED = "**********"
ACCOUNT_TOKEN_PREFIX = "ACCT-"
ACCOUNT_TOKEN_HEX = 8


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _role(role) -> Column:
    if isinstance(role, Column):
        return role
    return F.lit(role).cast("string")


def _hospital_admin(role: Column, strict: bool = False) -> Column:
    # Default keeps LIKE semantics ('_' is a wildcard, as in the policy text);
    # strict=True matches the literal prefix only.
    if strict:
        return role.startswith("HOSPITAL_ADMIN_")
    return role.like(HOSPITAL_ADMIN_PATTERN)


class MaskSpec:
    """Describes one policy: the value shown per role tier.

    Each tier is a function ``value_column -> Column``; ``None`` means the
    tier is not listed in the policy and falls through to the next one.
    """

    def __init__(self, name, full, hospital_admin, analyst, ds, default, analyst_roles=ANALYST_ROLES,
                 ds_roles=(DS_ROLE,), full_extra=()):
        self.name = name
        self.full = full
        self.hospital_admin = hospital_admin
        self.analyst = analyst
        self.ds = ds
        self.default = default
        self.analyst_roles = tuple(analyst_roles)
        self.ds_roles = tuple(ds_roles)
        self.full_extra = tuple(full_extra)

    def __call__(self, value, role, full_roles=FULL_ACCESS_ROLES, strict_like: bool = False) -> Column:
        v = _col(value)
        r = _role(role)
        expr = F.when(v.isNull(), F.lit(None))
        full = tuple(full_roles) + self.full_extra
        if full:
            expr = expr.when(r.isin(*full), self.full(v))
        if self.hospital_admin is not None:
            expr = expr.when(_hospital_admin(r, strict_like), self.hospital_admin(v))
        if self.analyst is not None and self.analyst_roles:
            expr = expr.when(r.isin(*self.analyst_roles), self.analyst(v))
        if self.ds is not None and self.ds_roles:
            expr = expr.when(r.isin(*self.ds_roles), self.ds(v))
        # A null role matches no branch and gets the default: deny by default.
        return expr.otherwise(self.default(v))


def _same(v: Column) -> Column:
    return v


def _const(text):
    return lambda v: F.lit(text)


def _null(_v: Column) -> Column:
    return F.lit(None)


def _ssn_last4(v: Column) -> Column:
    return F.concat(F.lit(SSN_LAST4_PREFIX), F.right(F.regexp_replace(v, "-", ""), F.lit(4)))


def _year_only(v: Column) -> Column:
    return F.make_date(F.year(v), F.lit(1), F.lit(1))


def _year_capped(cap_year: int):
    return lambda v: F.make_date(F.greatest(F.year(v), F.lit(cap_year)), F.lit(1), F.lit(1))


def _initial(v: Column) -> Column:
    return F.concat(F.left(v, F.lit(1)), F.lit(NAME_INITIAL_SUFFIX))


def sha_token(v: Column, salt: str, prefix: str, n: int) -> Column:
    """Deterministic opaque token: prefix + first n hex chars of SHA-256(value || salt)."""
    return F.concat(F.lit(prefix), F.left(F.sha2(F.concat(v, F.lit(salt)), 256), F.lit(n)))


def _zip3(v: Column) -> Column:
    return F.concat(F.left(v, F.lit(3)), F.lit(ZIP3_SUFFIX))


def _dx3(v: Column) -> Column:
    return F.left(v, F.lit(3))


def mask_ssn(value, role, **kw) -> Column:
    return MaskSpec("mask_ssn", _same, _ssn_last4, _const(SSN_MASKED), _null, _const(SSN_MASKED))(value, role, **kw)


def mask_dob(value, role, cap_year: int = DOB_CAP_YEAR, **kw) -> Column:
    return MaskSpec("mask_dob", _same, _same, _year_only, _year_capped(cap_year), _null)(value, role, **kw)


def mask_patient_name(value, role, **kw) -> Column:
    return MaskSpec("mask_patient_name", _same, _same, _initial, None, _const(NAME_MASKED))(value, role, **kw)


def mask_mrn(value, role, salt: str, **kw) -> Column:
    tok = lambda v: sha_token(v, salt, MRN_TOKEN_PREFIX, MRN_TOKEN_HEX)
    return MaskSpec("mask_mrn", _same, _same, tok, tok, _const(GENERIC_MASKED))(value, role, **kw)


def mask_phone(value, role, **kw) -> Column:
    return MaskSpec("mask_phone", _same, _same, None, None, _const(PHONE_MASKED))(value, role, **kw)


def mask_address_street(value, role, **kw) -> Column:
    return MaskSpec("mask_address_street", _same, _same, None, None, _const(ADDRESS_MASKED))(value, role, **kw)


def mask_zip_code(value, role, **kw) -> Column:
    return MaskSpec("mask_zip_code", _same, _same, _zip3, _zip3, _const(ZIP_MASKED))(value, role, **kw)


def mask_email(value, role, **kw) -> Column:
    return MaskSpec("mask_email", _same, _same, None, None, _const(EMAIL_MASKED))(value, role, **kw)


def mask_diagnosis_code(value, role, **kw) -> Column:
    return MaskSpec("mask_diagnosis_code", _same, _same, _dx3, _dx3, _const(GENERIC_MASKED))(value, role, **kw)


def mask_medication_name(value, role, **kw) -> Column:
    return MaskSpec("mask_medication_name", _same, _same, _same, _same, _const(GENERIC_MASKED))(value, role, **kw)


def mask_npi(value, role, **kw) -> Column:
    # Full list includes analysts and DS_ROLE: NPI is a public identifier.
    spec = MaskSpec("mask_npi", _same, _same, None, None, _const(NPI_MASKED),
                    full_extra=ANALYST_ROLES + (DS_ROLE,))
    return spec(value, role, **kw)


def mask_account_number(value, role, salt: str, **kw) -> Column:
    tok = lambda v: sha_token(v, salt, ACCOUNT_TOKEN_PREFIX, ACCOUNT_TOKEN_HEX)
    spec = MaskSpec("mask_account_number", _same, _same, tok, None, _const(GENERIC_MASKED),
                    analyst_roles=("ANALYST_REVENUE",))
    return spec(value, role, **kw)


# name -> builder(value, role, ctx) ; users may register their own.
_REGISTRY: dict[str, Callable] = {}


def register_mask(name: str, fn: Callable) -> None:
    """Add a mask ``fn(value_col, role, ctx) -> Column`` under ``name``."""
    _REGISTRY[name.lower()] = fn


def _wrap(fn, salt_key=None, cap=False):
    def build(value, role, ctx: SecurityContext | None = None):
        kw = {}
        if ctx is not None:
            kw["full_roles"] = ctx.full_access_roles
        if salt_key:
            if ctx is None or not ctx.salts.get(salt_key):
                raise ValueError(f"{fn.__name__} needs a secret: SecurityContext(salts={{{salt_key!r}: ...}})")
            kw["salt"] = ctx.salts[salt_key]
        return fn(value, role, **kw)
    return build


for _name, _fn, _salt in [
    ("mask_ssn", mask_ssn, None),
    ("mask_dob", mask_dob, None),
    ("mask_patient_name", mask_patient_name, None),
    ("mask_mrn", mask_mrn, "mrn"),
    ("mask_phone", mask_phone, None),
    ("mask_address_street", mask_address_street, None),
    ("mask_zip_code", mask_zip_code, None),
    ("mask_email", mask_email, None),
    ("mask_diagnosis_code", mask_diagnosis_code, None),
    ("mask_medication_name", mask_medication_name, None),
    ("mask_npi", mask_npi, None),
    ("mask_account_number", mask_account_number, "account"),
]:
    register_mask(_name, _wrap(_fn, _salt))


def get_mask(name: str) -> Callable:
    return _REGISTRY[name.lower()]


def mask_names() -> list[str]:
    return sorted(_REGISTRY)

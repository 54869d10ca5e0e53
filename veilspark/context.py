"""Security context: who is asking, and when.

Every policy in this library is a function of the caller's role and of "now".
Spark has no session role, so both are explicit and bound into the plan as
literals when a DataFrame is built. Binding "now" as ``as_of`` also makes every
report reproducible.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference policies for identical results.
# ---------------------------------------------------------------------------
# Roles that see every masked column in clear text.
FULL_ACCESS_ROLES = ("ACCOUNTADMIN", "HIPAA_OFFICER", "PHI_READER")
# LIKE pattern of the per-hospital treating-provider roles.
HOSPITAL_ADMIN_PATTERN = "HOSPITAL_ADMIN_%"
# Analyst roles (heavily masked).
ANALYST_ROLES = ("ANALYST_CLINICAL", "ANALYST_REVENUE")
# De-identified research role.
DS_ROLE = "DS_ROLE"
# Roles that bypass the hospital row-isolation policy.
ROW_BYPASS_ROLES = ("ACCOUNTADMIN", "SECURITYADMIN", "HIPAA_OFFICER", "PHI_READER")
# Birth-year cap of the de-identified DOB.
DOB_CAP_YEAR = 1930
# Databases holding PHI (detection scope).
PHI_DATABASES = ("RAW_DB", "CLEANSED_DB")


@dataclass(frozen=True)
class SecurityContext:
    """Caller identity and clock.

    role     primary role, matched by exact name (no inheritance), None = deny
    user     user name (audit columns)
    as_of    "now" as a naive UTC datetime; CURRENT_DATE is its date
    tz       display time zone for off-hours rules
    env      PROD / QA / DEV; DEV masks even the full-access roles
    salts    token salts (mrn, account); there is no default, a mask that needs one asks for it
    """

    role: str | None
    user: str = "SYSTEM"
    as_of: _dt.datetime = field(default_factory=lambda: _dt.datetime(2024, 6, 1))
    tz: str = "America/New_York"
    env: str = "PROD"
    salts: dict = field(default_factory=dict)

    @property
    def as_of_date(self) -> _dt.date:
        return self.as_of.date()

    @property
    def full_access_roles(self) -> tuple:
        # Environment override: in DEV nobody sees clear PHI.
        return () if self.env.upper() == "DEV" else FULL_ACCESS_ROLES

    def with_role(self, role: str | None) -> "SecurityContext":
        return replace(self, role=role)

    def bypasses_row_policy(self) -> bool:
        return self.role in ROW_BYPASS_ROLES and self.env.upper() != "DEV"


def as_datetime(value) -> _dt.datetime:
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    return _dt.datetime.fromisoformat(str(value))

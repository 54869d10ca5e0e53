"""De-identified and limited data sets, small-cell risk, aggregated marts.

M17 Safe Harbor mart: direct identifiers removed, geography reduced to state,
    dates to year, ages 90 and over collapsed to "90+", the MRN replaced by a
    salted token.
M18 ZIP3 areas of 20,000 people or fewer -> "000", by their published list.
M19 limited data set: identifiers removed, ZIP3 / birth year / state / dates kept.
M20 re-identification risk: equivalence classes over quasi-identifiers, their
    size k, the share of rows in classes with k < K; suppression keeps only
    rows of classes with k >= K (a semi join; AQE splits a hot class).
M21 aggregated marts with a minimum cell size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masks import sha_token
from ..functions.timefns import date_lit

# Hospital -> state of its campus (from the hospital seed list).
HOSPITAL_STATE = {
    "H01": "OH", "H02": "OH", "H03": "OH", "H04": "OH", "H05": "OH", "H06": "OH",
    "H07": "IN", "H08": "IN", "H09": "IN", "H10": "KY", "H11": "KY", "H12": "MI",
}
# Three-digit ZIP areas of 20,000 people or fewer, which the privacy rule's
# guidance lists (2000 census) and Safe Harbor replaces by 000.
RESTRICTED_ZIP3 = ("036", "059", "063", "102", "203", "556", "692", "790", "821", "823", "830", "831", "878", "879",
                   "884", "890", "893")
AGE_CAP = 90


def state_of(hospital_col="hospital_id"):
    c = F.col(hospital_col) if isinstance(hospital_col, str) else hospital_col
    expr = F.lit(None).cast("string")
    for h, s in sorted(HOSPITAL_STATE.items(), reverse=True):
        expr = F.when(c == h, s).otherwise(expr)
    return expr


def age_at(dob, on) -> F.Column:
    """Whole years between dob and `on` (dates)."""
    return F.floor(F.months_between(on, dob) / 12).cast("int")


def zip3_safe(df: DataFrame, zip_col: str, out: str = "zip3", restricted=RESTRICTED_ZIP3) -> DataFrame:
    """First three ZIP digits, or '000' where that area has too few people. Which areas
    these are is a published list (a parameter), so the rule does not depend on the data."""
    z3 = F.left(F.col(zip_col), F.lit(3))
    return df.withColumn(out, F.when(z3.isin(*restricted), F.lit("000")).otherwise(z3))


def safe_harbor(patients: DataFrame, as_of: _dt.date, mrn_salt: str) -> DataFrame:
    """The MARTS-zone patient table."""
    today = date_lit(as_of)
    age = age_at(F.col("patient_dob"), F.col("admission_date"))
    return patients.select(
        sha_token(F.col("patient_mrn"), mrn_salt, "MRN-", 12).alias("patient_token"),
        state_of("hospital_id").alias("state"),
        F.when(age >= AGE_CAP, F.lit(None)).otherwise(F.year("patient_dob")).alias("birth_year"),
        F.when(age >= AGE_CAP, F.lit(f"{AGE_CAP}+")).otherwise(age.cast("string")).alias("age_at_admission"),
        F.year("admission_date").alias("admission_year"),
        F.year("discharge_date").alias("discharge_year"),
        F.left("primary_dx_code", F.lit(3)).alias("dx_category"),
        F.datediff("discharge_date", "admission_date").alias("length_of_stay"),
        today.alias("extract_date"),
    )


def limited_data_set(patients: DataFrame, mrn_salt: str, role: str | None = None, agreement: str | None = None) -> DataFrame:
    """Identifiers removed; ZIP3, birth year, state and service dates kept. Only the HIPAA officer may
    produce it, and only under a data use agreement, whose reference is asked for."""
    if role != "HIPAA_OFFICER":
        raise PermissionError(f"role {role} may not produce a limited data set (HIPAA_OFFICER only)")
    if not agreement:
        raise ValueError("a limited data set needs the reference of its data use agreement")
    df = zip3_safe(patients, "patient_zip")
    return df.select(
        sha_token(F.col("patient_mrn"), mrn_salt, "MRN-", 12).alias("patient_token"),
        state_of("hospital_id").alias("state"),
        "zip3",
        F.year("patient_dob").alias("birth_year"),
        "admission_date", "discharge_date",
        F.col("primary_dx_code").alias("dx_code"),
    )


def equivalence_classes(df: DataFrame, quasi: list[str]) -> DataFrame:
    """Class size k per combination of quasi-identifiers (one grouped count,
    combined map-side; a hot class costs one partial row per task)."""
    return df.groupBy(*quasi).agg(F.count(F.lit(1)).alias("k"))


def reid_risk_summary(df: DataFrame, quasi: list[str], k_min: int = 5) -> DataFrame:
    """Rows and classes per class-size band, plus the max re-identification risk 1/k."""
    cls = equivalence_classes(df, quasi)
    band = (F.when(F.col("k") == 1, "k=1").when(F.col("k") < k_min, f"k<{k_min}")
            .when(F.col("k") < 2 * k_min, f"k<{2 * k_min}").otherwise(f"k>={2 * k_min}"))
    return cls.groupBy(band.alias("k_band")).agg(
        F.count(F.lit(1)).alias("classes"),
        F.sum("k").cast("bigint").alias("rows"),
        F.round(F.max(1.0 / F.col("k")), 6).alias("max_risk"),
    )


def suppress_small_cells(df: DataFrame, quasi: list[str], k_min: int = 5) -> DataFrame:
    """Keep rows whose class has at least k_min members (left semi join)."""
    ok = equivalence_classes(df, quasi).where(F.col("k") >= k_min).select(*quasi)
    return df.join(ok, [df[c].eqNullSafe(ok[c]) for c in quasi], "left_semi")


def population_health(mart: DataFrame, min_cell: int = 11, dims=("state", "age_band", "dx_chapter")) -> DataFrame:
    """Patients and mean stay per cell of `dims` (state, age band, diagnosis
    chapter = first character of the ICD-10 category); cells under `min_cell` are withheld."""
    band = F.when(F.col("age_at_admission") == "90+", "90+").otherwise(
        F.concat((F.floor(F.col("age_at_admission").cast("int") / 10) * 10).cast("int").cast("string"), F.lit("s")))
    m = mart.withColumn("age_band", band).withColumn("dx_chapter", F.left("dx_category", F.lit(1)))
    g = m.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("patients"), F.round(F.avg("length_of_stay"), 4).alias("avg_length_of_stay"))
    return g.where(F.col("patients") >= min_cell)


def revenue_cycle(claims: DataFrame, min_cell: int = 11) -> DataFrame:
    """Claim counts and amounts per state, month and medication."""
    g = claims.groupBy(state_of("hospital_id").alias("state"),
                       F.date_trunc("month", F.col("claim_date")).cast("date").alias("claim_month"),
                       "medication_name").agg(
        F.count(F.lit(1)).alias("claims"), F.round(F.sum("claim_amount"), 2).alias("total_amount"))
    return g.where(F.col("claims") >= min_cell)


def quality_metrics(mart: DataFrame, min_cell: int = 11) -> DataFrame:
    """Stays per state and admission year from the de-identified mart: long stays (over a week), same-day
    discharges, and records without a diagnosis or an age; cells under `min_cell` are withheld."""
    share = lambda test: F.round(F.count_if(test) / F.count(F.lit(1)), 4)
    g = mart.groupBy("state", "admission_year").agg(
        F.count(F.lit(1)).alias("stays"), F.round(F.avg("length_of_stay"), 4).alias("avg_length_of_stay"),
        share(F.col("length_of_stay") > 7).alias("long_stay_share"),
        share(F.col("length_of_stay") == 0).alias("same_day_share"),
        share(F.col("dx_category").isNull() | F.col("age_at_admission").isNull()).alias("incomplete_share"))
    return g.where(F.col("stays") >= min_cell)

"""Synthetic patients (S10), DEV refresh copies (S11), load integrity.

S10 generates any number of fake patients with the reference's test-data
conventions (999- SSNs, 555 phone numbers, example.com mail) from
``spark.range``: every column is a hash-derived expression of the row id, so
the generator is seedable, parallel and needs no driver-side data.

S11 replaces identifiers of a real table with synthetic values keyed on the
original value (same input -> same replacement, so joins survive), keeping
structure and the distributions that matter (birth year, ZIP3, dates).

S12 fingerprints a load: row count plus order-free checksums, compared
between source and target, with an anti-join key diff for the detail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def _h(seed: int, *cols: Column) -> Column:
    """Non-negative 63-bit hash of the inputs."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(2 ** 62))


def synthetic_patients(spark: SparkSession, n: int, seed: int = 42, hospitals: int = 12,
                       partitions: int | None = None) -> DataFrame:
    """N fake patients, generated in parallel from a row id."""
    ids = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    i = F.col("id")
    h = lambda k: _h(seed + k, i)
    dob = F.make_date((1920 + h(1) % 100).cast("int"), (1 + h(2) % 12).cast("int"), (1 + h(3) % 28).cast("int"))
    adm = F.date_add(F.lit("2024-01-01").cast("date"), (h(4) % 365).cast("int"))
    return ids.select(
        F.concat(F.lit("SYN-"), F.lpad(i.cast("string"), 9, "0")).alias("patient_id"),
        F.concat(F.lit("H"), F.lpad((1 + h(5) % hospitals).cast("string"), 2, "0")).alias("hospital_id"),
        F.concat(F.lit("Test-Patient "), i.cast("string")).alias("patient_name"),
        F.concat(F.lit("999-"), F.lpad((h(6) % 100).cast("string"), 2, "0"), F.lit("-"),
                 F.lpad((h(7) % 10000).cast("string"), 4, "0")).alias("patient_ssn"),
        dob.alias("patient_dob"),
        F.concat(F.lit("MRN-SYNTHETIC-"), F.lpad(i.cast("string"), 9, "0")).alias("patient_mrn"),
        F.concat(F.lit("555-TEST-"), F.lpad((h(8) % 10000).cast("string"), 4, "0")).alias("patient_phone"),
        F.concat(F.lit("test.patient"), i.cast("string"), F.lit("@example.com")).alias("patient_email"),
        F.concat((100 + h(9) % 9900).cast("string"), F.lit(" Test Street")).alias("patient_address_1"),
        F.lpad((10000 + h(10) % 90000).cast("string"), 5, "0").alias("patient_zip"),
        F.concat(F.expr("chr(65 + cast(pmod(xxhash64(id, 11), 26) as int))"),
                 F.lpad((h(12) % 100).cast("string"), 2, "0")).alias("primary_dx_code"),
        adm.alias("admission_date"),
        F.date_add(adm, (h(13) % 10).cast("int")).alias("discharge_date"),
        F.concat(F.lit("1"), F.lpad((h(14) % 1000).cast("string"), 9, "0")).alias("attending_npi"),
    )


def _syn(seed: str, c: Column) -> Column:
    return F.sha2(F.concat(c.cast("string"), F.lit(seed)), 256)


def _number(digest: Column, start: int, digits: int, modulus: int) -> Column:
    """A number below ``modulus`` from ``digits`` hex digits of a digest."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint") % modulus


def deidentify_copy(patients: DataFrame, key: str) -> DataFrame:
    """DEV copy of the patient table: same shape, synthetic identifiers that cannot be
    turned back. A patient id becomes the same new id wherever it occurs; SSNs are in the
    never-issued 999- range; admissions and discharges move by the same 1-365 days per patient;
    diagnoses are cut to their category, provider numbers replaced."""
    pid, name, ssn, mail, addr, phone, dob, mrn, npi = (F.col(c) for c in (
        "patient_id", "patient_name", "patient_ssn", "patient_email", "patient_address_1", "patient_phone",
        "patient_dob", "patient_mrn", "attending_npi"))
    p, s, d = _syn(key, pid), _syn(key, ssn), _syn(key, dob)
    shift = (_number(p, 21, 6, 365) + 1).cast("int")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return patients.select(
        F.concat(F.lit("D"), F.left(p, F.lit(16))).alias("patient_id"), "hospital_id",
        F.when(name.isNotNull(), F.concat(F.lit("Patient "), F.left(_syn(key, name), F.lit(8)))).alias("patient_name"),
        F.when(ssn.isNotNull(), F.concat(F.lit("999-"), two(_number(s, 1, 4, 100)), F.lit("-"),
                                         F.lpad(_number(s, 5, 6, 10000).cast("string"), 4, "0"))).alias("patient_ssn"),
        F.when(dob.isNotNull(), F.make_date(F.year(dob), (_number(d, 1, 2, 12) + 1).cast("int"),
                                            (_number(d, 3, 2, 28) + 1).cast("int"))).alias("patient_dob"),
        F.when(mrn.isNotNull(), F.concat(F.lit("MRN-DEV-"), F.left(_syn(key, mrn), F.lit(10)))).alias("patient_mrn"),
        F.when(phone.isNotNull(), F.concat(F.lit("555-"), F.lpad(_number(_syn(key, phone), 1, 6, 10000000).cast("string"),
                                                                 7, "0"))).alias("patient_phone"),
        F.when(mail.isNotNull(), F.concat(F.lit("user."), F.left(_syn(key, mail), F.lit(10)), F.lit("@example.com")))
        .alias("patient_email"),
        F.when(addr.isNotNull(), F.concat(F.lit("1 "), F.left(_syn(key, addr), F.lit(6)), F.lit(" Street")))
        .alias("patient_address_1"),
        F.when(F.col("patient_zip").isNotNull(), F.concat(F.left("patient_zip", F.lit(3)), F.lit("00"))).alias("patient_zip"),
        F.left("primary_dx_code", F.lit(3)).alias("primary_dx_code"),
        F.date_sub("admission_date", shift).alias("admission_date"),
        F.date_sub("discharge_date", shift).alias("discharge_date"),
        F.when(npi.isNotNull(), F.concat(F.lit("1"), F.lpad(_number(_syn(key, npi), 1, 10, 1000000000).cast("string"), 9, "0")))
        .alias("attending_npi"),
    )


def load_fingerprint(df: DataFrame, key_cols: list[str], label: str) -> DataFrame:
    """Rows and an order-free checksum of the key columns.

    The checksum sums, as an exact decimal, the first 60 bits of SHA-256 of each
    row's keys: any lost, extra or altered key moves it, while row order and
    partitioning do not. It is a plain aggregate, combined map-side."""
    keys = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    k = F.conv(F.left(F.sha2(keys, 256), F.lit(15)), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.lit(label).alias("side"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(k).cast("decimal(38,0)").alias("key_checksum"),
    )


def load_key_diff(source: DataFrame, target: DataFrame, key_cols: list[str]) -> DataFrame:
    """S12 detail: keys missing from the target and keys the target added; a null key equals none.

    One grouping of both sides' keys. Its partitions are as many as the session's setting says and are not merged:
    keys compress so well that merging by bytes would put millions of them into one task."""
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = lambda df, s, t: df.select(*key_cols, F.lit(s).alias("_s"), F.lit(t).alias("_t"))
    both = side(source, True, False).unionByName(side(target, False, True)).repartition(parts, *key_cols)
    seen = both.groupBy(*key_cols).agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    null = F.greatest(F.lit(False), *[F.col(c).isNull() for c in key_cols])
    problems = F.array(F.when(F.col("_s") & (null | ~F.col("_t")), "MISSING_IN_TARGET"),
                       F.when(F.col("_t") & (null | ~F.col("_s")), "EXTRA_IN_TARGET"))
    return seen.select(*key_cols, F.explode(F.array_compact(problems)).alias("problem"))

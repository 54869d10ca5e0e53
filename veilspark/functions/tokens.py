"""Join-safe, format-preserving SSN tokens (M14), detokenization.

The SSN is canonicalised first (non-digits removed), so "123-45-6789" and
"123456789" give the same token: the join across tables survives, which is
exactly what a plain hash of the raw text broke.

The cipher is a 10-round *unbalanced Feistel network* over the 9 digits,
split into a 4-digit left part L and a 5-digit right part R:

    even round i:  L = (L + F(i, R)) mod 10^4
    odd round i:   R = (R + F(i, L)) mod 10^5

F(i, x) = the first 15 hex digits of SHA-256(key:i:x), read as an integer.
Every round is invertible, so the map is a bijection on 000000000..999999999
(no collisions, unlike hashing mod 10^9) and detokenization runs the rounds
backwards with subtraction. This is a keyed pseudorandom permutation in the
Feistel construction; it is *not* NIST FF1/FF3 and makes no such claim.

Everything is native and runs as generated code: each round is a projection behind a
generator (``_barrier``), so no rule inlines one round into the next, or all of them into a
filter that a join infers. (A form with all rounds in one projection grew with every round; one
inside the ``aggregate`` higher-order function is interpreted, at less than half the rate.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
LEFT_DIGITS = 4
RIGHT_DIGITS = 5


def _round_fn(key: str, i: int, x: Column, modulus: int) -> Column:
    h = F.sha2(F.concat(F.lit(f"{key}:{i}:"), x.cast("string")), 256)
    return F.pmod(F.conv(F.left(h, F.lit(15)), 16, 10).cast("bigint"), F.lit(modulus))


def canonical_digits(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "[^0-9]", "")


def _barrier(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed here, once: a generator's output is not inlined into what reads it,
    and no filter or join key on it moves below."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def feistel(df: DataFrame, halves: str, key: str, inverse: bool = False) -> DataFrame:
    """All rounds over a struct column (l, r), as generated code, each behind a barrier, so the expressions
    stay one round long whatever the optimizer does with them."""
    ml, mr = 10 ** LEFT_DIGITS, 10 ** RIGHT_DIGITS
    sign = -1 if inverse else 1
    numbers = list(range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS))
    for step, i in enumerate(numbers):
        s = F.col(halves)
        if i % 2 == 0:
            l = F.pmod(s["l"] + sign * _round_fn(key, i, s["r"], ml), F.lit(ml)).cast("bigint")
            new = F.struct(l.alias("l"), s["r"].alias("r"))
        else:
            r = F.pmod(s["r"] + sign * _round_fn(key, i, s["l"], mr), F.lit(mr)).cast("bigint")
            new = F.struct(s["l"].alias("l"), r.alias("r"))
        new = F.when(s.isNotNull(), new)
        nxt = f"{halves}{step}"
        df = _barrier(df, nxt, new).drop(halves).withColumnRenamed(nxt, halves)
    return df


def _apply(df: DataFrame, col: str, out: str, key: str, inverse: bool, keep_format: bool) -> DataFrame:
    src = F.col(col)
    tmp, raw = f"__{out}_feistel", f"__{out}_digits"
    df = df.withColumn(raw, canonical_digits(src))
    digits = F.col(raw)
    half = lambda start, n: F.substring(digits, start, n).cast("bigint")
    df = df.withColumn(tmp, F.when(F.length(digits) == 9, F.struct(
        half(1, LEFT_DIGITS).alias("l"), half(LEFT_DIGITS + 1, RIGHT_DIGITS).alias("r")))).drop(raw)
    df = feistel(df, tmp, key, inverse)
    s = F.col(tmp)
    tok = F.concat(F.lpad(s["l"].cast("string"), LEFT_DIGITS, "0"), F.lpad(s["r"].cast("string"), RIGHT_DIGITS, "0"))
    if keep_format:
        dashed = F.concat(F.substring(tok, 1, 3), F.lit("-"), F.substring(tok, 4, 2), F.lit("-"), F.substring(tok, 6, 4))
        tok = F.when(src.contains("-"), dashed).otherwise(tok)
    return df.withColumn(out, tok).drop(tmp)


def tokenize_ssn(df: DataFrame, col: str, key: str, out: str | None = None, keep_format: bool = True) -> DataFrame:
    """Add (or replace) `out` with the FPE token of `col`; invalid or null input -> null."""
    return _apply(df, col, out or col, key, inverse=False, keep_format=keep_format)


#: roles that may see a real SSN behind its token
DETOKENIZE_ROLES = ("HIPAA_OFFICER", "PHI_READER")


def detokenize_ssn(df: DataFrame, col: str, key: str, out: str | None = None, keep_format: bool = True,
                   role: str | None = None) -> DataFrame:
    """Inverse of tokenize_ssn with the same key. Only ``DETOKENIZE_ROLES`` may: for any other role it raises."""
    if role not in DETOKENIZE_ROLES:
        raise PermissionError(f"role {role} may not detokenize (allowed: {', '.join(DETOKENIZE_ROLES)})")
    return _apply(df, col, out or col, key, inverse=True, keep_format=keep_format)


def join_rate(left: DataFrame, right: DataFrame, left_key: str, right_key: str, label: str) -> DataFrame:
    """matched/total per side for one key pair (distinct keys; null keys never match).

    Each side is reduced to its distinct keys before the outer join, so the join
    moves one row per key, and the totals are plain counts."""
    lk = left.select(F.col(left_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    rk = right.select(F.col(right_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    j = lk.withColumn("_l", F.lit(1)).join(rk.withColumn("_r", F.lit(1)), "k", "full_outer")
    return j.agg(
        F.lit(label).alias("stage"),
        F.sum(F.col("_l").isNotNull().cast("int")).cast("bigint").alias("left_keys"),
        F.sum(F.col("_r").isNotNull().cast("int")).cast("bigint").alias("right_keys"),
        F.sum((F.col("_l").isNotNull() & F.col("_r").isNotNull()).cast("int")).cast("bigint").alias("matched_keys"),
    ).select("stage", "left_keys", "right_keys", "matched_keys",
             F.round(F.col("matched_keys") / F.col("left_keys"), 6).alias("left_match_rate"))

"""Purge hot audit rows by manifest.

A month's manifest is its number of rows and two sums of row hashes: equal for equal
multisets of rows, whatever their order and files, and additive. A month may be purged
when all its hot rows are old enough to be archived and the archive's manifest equals
what was purged of the month before plus what is still hot. No row is joined with the
archive: hot rows are grouped once, the archive is read for the months in question
only, and a row that the archive lost or changed keeps its month.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import ts_lit
from .audit import HOT_DAYS

KEYS = ["year", "month"]
SUMS = ["rows", "sum1", "sum2"]


def with_month(log: DataFrame) -> DataFrame:
    return log.select("*", F.year("event_time").alias("year"), F.month("event_time").alias("month"))


def manifest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(year, month, rows, sum1, sum2) of rows that have year and month, over the given columns."""
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)"))
    return rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"), h(1).alias("sum1"), h(2).alias("sum2"))


def purge_report(hot: DataFrame, archived: DataFrame, as_of: _dt.datetime, days: int = HOT_DAYS,
                 purged: DataFrame | None = None, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """Per month with hot rows: hot and archived rows, and PURGE, or why it stays (NOT_DUE: rows that are too new;
    MISMATCH: the archive does not hold exactly these rows).

    ``archived`` has year and month (its partitions) and the hot table's columns; ``purged`` holds the manifests of
    former purges. ``months`` limits both sides to these months, so the archive's other folders are not read."""
    cutoff = ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    columns = hot.columns
    rows = with_month(hot)
    if months is not None:
        rows, archived = only_months(rows, months), only_months(archived, months)
        purged = None if purged is None else only_months(purged, months)
    due = (F.col("event_time") < cutoff) & (F.col("inserted_at") < cutoff)
    own = manifest(rows, columns)
    new = rows.groupBy(*KEYS).agg(F.count_if(~due).alias("new"))
    side = lambda df, name: df.select(*KEYS, *[F.col(c).alias(f"{name}_{c}") for c in SUMS])
    out = own.join(new, KEYS).join(side(manifest(archived, columns), "archived"), KEYS, "left")
    if purged is not None:
        before = purged.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        out = out.join(side(before, "purged"), KEYS, "left")
    else:
        out = out.select("*", *[F.lit(0).alias(f"purged_{c}") for c in SUMS])
    zero = lambda c: F.coalesce(c, F.lit(0))
    agree = F.lit(True)
    for c in SUMS:
        agree = agree & (F.col(c) + zero(F.col(f"purged_{c}")) == F.col(f"archived_{c}"))
    verdict = F.when(F.col("new") > 0, "NOT_DUE").when(F.coalesce(agree, F.lit(False)), "PURGE").otherwise("MISMATCH")
    return out.select(*KEYS, F.col("rows").alias("hot_rows"), zero(F.col("archived_rows")).alias("archived_rows"),
                      verdict.alias("verdict"), "sum1", "sum2")


def only_months(df: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of these months, as a test on the partition columns."""
    test = F.lit(False)
    for year in sorted({y for y, _ in months}):
        test = test | ((F.col("year") == year) & F.col("month").isin(*sorted(m for y, m in months if y == year)))
    return df.where(test)


def due_months(hot: DataFrame, as_of: _dt.datetime, days: int = HOT_DAYS) -> list[tuple[int, int]]:
    """Months with hot rows that are all due (one row per month of the calendar comes to the driver)."""
    cutoff = ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    due = (F.col("event_time") < cutoff) & (F.col("inserted_at") < cutoff)
    rows = with_month(hot).groupBy(*KEYS).agg(F.bool_and(due).alias("due")).where("due").collect()
    return sorted((r["year"], r["month"]) for r in rows)


def purge(hot: DataFrame, archived: DataFrame, as_of: _dt.datetime, days: int = HOT_DAYS,
          purged: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(survivors, manifests): the hot rows that stay, to be written to a new folder (nothing is deleted in
    place), and the manifests of the months that go, to be added to ``purged``."""
    months = due_months(hot, as_of, days)
    report = purge_report(hot, archived, as_of, days, purged, months).where("verdict = 'PURGE'")
    gone = [(r["year"], r["month"]) for r in report.select(*KEYS).collect()]
    out = report.select(*KEYS, F.col("hot_rows").alias("rows"), "sum1", "sum2")
    if not gone:
        return hot, out
    rows = with_month(hot)
    test = F.lit(False)
    for year, month in gone:
        test = test | ((F.col("year") == year) & (F.col("month") == month))
    return rows.where(~F.coalesce(test, F.lit(False))).select(*hot.columns), out

"""Time helpers with the reference's exact semantics.

Time columns are TIMESTAMP_NTZ holding UTC wall-clock values, so results do
not depend on the session time zone.
"""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (never shifted by the session time zone)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.to_timestamp_ntz(F.lit(text))


def date_lit(value) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.to_date(F.lit(str(value)))


def ntz(c) -> Column:
    """Normalise a time column to TIMESTAMP_NTZ (parquet NTZ passes through)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def hour_boundaries_between(start, end) -> Column:
    """DATEDIFF('hour', start, end): number of hour *boundaries* crossed.

    10:59 -> 11:01 is 1, unlike timestampdiff which counts elapsed hours.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (F.datediff(F.to_date(e), F.to_date(s)) * F.lit(24) + F.hour(e) - F.hour(s)).cast("bigint")


def day_boundaries_between(start, end) -> Column:
    """DATEDIFF('day', start, end) on dates."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.datediff(F.to_date(e), F.to_date(s)).cast("bigint")


def months_before(value: _dt.datetime, months: int) -> _dt.datetime:
    """The same day and time so many months before (the month's last day if it has no such day)."""
    n = value.year * 12 + value.month - 1 - months
    year, month = n // 12, n % 12 + 1
    return value.replace(year=year, month=month, day=min(value.day, calendar.monthrange(year, month)[1]))


def local_hour(c, tz: str) -> Column:
    """Hour of a UTC wall-clock value seen in ``tz`` (DST-aware)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(tz), c))


def is_business_day(d) -> Column:
    """Monday..Friday (the reference's comment; Spark dayofweek has Sunday=1)."""
    d = F.col(d) if isinstance(d, str) else d
    return F.dayofweek(d).between(2, 6)


def minus_days(ts: Column, days: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(days)} DAYS")


def minus_minutes(ts: Column, minutes: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(minutes)} MINUTES")

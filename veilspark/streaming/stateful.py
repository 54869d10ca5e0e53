"""T4 and T5 over streams with arbitrary state (transformWithState) and event-time timers.

Both answer only what the watermark has closed, from state that does not depend on the
order in which events arrived: T5 keeps a user's events until the watermark has passed
them and then reads them in order; T4 keeps, per role, what is new in each period until the
period is over. Rows later than the watermark are dropped by Spark before they get here.
State ends by event time too: a user without events, or an address a role has not used, for
``forget`` days is forgotten (batch over a longer history would still remember it).

The state store must be RocksDB (``use_rocksdb``), as transformWithState asks for it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_DAY_US = 86_400_000_000

T5_OUTPUT = T.StructType([
    T.StructField("user_name", T.StringType()),
    T.StructField("success_at", T.TimestampType()),
    T.StructField("failures", T.LongType()),
    T.StructField("first_failure", T.TimestampType()),
])
T4_OUTPUT = T.StructType([
    T.StructField("role_name", T.StringType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("first_user", T.StringType()),
    T.StructField("events", T.LongType()),
])


def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, off the heap, with changelog checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    """Rows with times as microseconds since the epoch (or None) as a frame of that schema."""
    out = pd.DataFrame(rows, columns=schema.names)
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out[f.name] = pd.to_datetime(out[f.name], unit="us")
        elif isinstance(f.dataType, T.LongType):
            out[f.name] = out[f.name].astype("int64")
    return out


class RepeatedFailures(StatefulProcessor):
    """T5 for one user: events wait (in microseconds, with their outcome) until the watermark has passed them."""

    def __init__(self, min_failures: int, forget_days: int | None):
        self.min_failures, self.forget = min_failures, forget_days and forget_days * _DAY_US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, ok boolean")
        self.open = handle.getValueState("open", "fails long, first long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least = None
        for pdf in rows:
            new = list(zip(pdf["at"].tolist(), pdf["ok"].tolist()))
            if new:
                self.waiting.appendList(new)
                least = min(least, min(new)[0]) if least is not None else min(new)[0]
        if least is not None:
            self.handle.registerTimer(least // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fails, first, last = self.open.get() if self.open.exists() else (0, None, 0)
        waiting = sorted(tuple(x) for x in self.waiting.get()) if self.waiting.exists() else []
        out = []
        for at, ok in waiting:
            if at > passed:
                break
            last = max(last, at)
            if not ok:
                fails, first = fails + 1, at if fails == 0 else first
                continue
            if fails > self.min_failures:
                out.append((key[0], at, fails, first))
            fails, first = 0, None
        rest = [x for x in waiting if x[0] > passed]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[0][0] // 1000 + 1)
        else:
            self.waiting.clear()
        idle = self.forget and not rest and last + self.forget <= passed
        if idle or (not fails and not rest):
            self.open.clear()
        else:
            self.open.update((fails, first, last))
            if self.forget and not rest:
                self.handle.registerTimer((last + self.forget) // 1000 + 1)
        return iter([_frame(out, T5_OUTPUT)] if out else [])

    def close(self) -> None:
        pass


def repeated_failures_stream(logins: DataFrame, min_failures: int = 5, lateness: str = "30 minutes",
                             forget_days: int | None = 400) -> DataFrame:
    """T5 over a stream of logins: equal to the batch detector on the events that the watermark has passed,
    whatever order they came in. State per user: the events of the lateness, and one summary."""
    src = logins.select(
        "user_name", F.col("event_timestamp").cast("timestamp").alias("ts"),
        F.coalesce("is_success", F.lit(False)).alias("ok")).withWatermark("ts", lateness)
    src = src.withColumn("at", F.unix_micros("ts"))
    return src.groupBy("user_name").transformWithStateInPandas(
        statefulProcessor=RepeatedFailures(min_failures, forget_days), outputStructType=T5_OUTPUT,
        outputMode="Append", timeMode="EventTime")


class NewRoleAddresses(StatefulProcessor):
    """T4 for one role: addresses first used in a period, told when the period is over."""

    def __init__(self, period_days: int, forget_days: int | None):
        self.period = period_days * _DAY_US
        self.forget = forget_days and forget_days * _DAY_US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.active = handle.getValueState("active", "first long")
        # per (period, address): the first event's time, id and user, and how many there were
        self.new = handle.getMapState("new", "period long, client_ip string",
                                      "first long, log_id string, user_name string, events long")
        self.known = handle.getMapState("known", "client_ip string", "last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found: dict[tuple, tuple] = {}
        for pdf in rows:
            pdf = pdf.assign(period=pdf["at"] // self.period).sort_values(["at", "log_id"])
            for (period, ip), g in pdf.groupby(["period", "client_ip"], dropna=False, sort=False):
                head = (int(g["at"].iat[0]), g["log_id"].iat[0], g["user_name"].iat[0])
                k = (int(period), None if pd.isna(ip) else ip)
                n = len(g)
                if k in found:
                    n += found[k][3]
                    head = min(head, found[k][:3])
                found[k] = (*head, n)
        if not found:
            return iter([])
        first = min(v[0] for v in found.values())
        if self.active.exists():
            first = min(first, self.active.get()[0])
        self.active.update((first,))
        for k, v in found.items():
            if self.new.containsKey(k):
                before = tuple(self.new.getValue(k))
                v = (*min(v[:3], before[:3]), v[3] + before[3])
            self.new.updateValue(k, v)
        for period in {k[0] for k in found}:
            self.handle.registerTimer((period + 1) * self.period // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        first = self.active.get()[0]
        over = sorted((tuple(k), tuple(v)) for k, v in self.new.iterator() if (k[0] + 1) * self.period <= passed)
        out = []
        for (period, ip), (at, _, user, n) in over:
            last = self.known.getValue((ip,))[0] if self.known.containsKey((ip,)) else None
            start = period * self.period
            if last is not None and self.forget and last + self.forget < start:
                last = None
            if last is None and first < start:
                out.append((key[0], ip, at, user, n))
            self.known.updateValue((ip,), (start,))
            self.new.removeKey((period, ip))
        if self.forget:
            for (ip,), (last,) in list(self.known.iterator()):
                if last + self.forget < passed - self.period:
                    self.known.removeKey((ip,))
        return iter([_frame(out, T4_OUTPUT)] if out else [])

    def close(self) -> None:
        pass


def unusual_role_access_stream(log: DataFrame, period_days: int = 7, lateness: str = "1 hour",
                               forget_days: int | None = 400) -> DataFrame:
    """T4 over a stream of audit events, in periods of ``period_days`` counted from 1970-01-01: each period's
    answer equals the batch detector's with ``as_of`` at its end. Events without an address are left out."""
    src = log.where(F.col("client_ip").isNotNull()).select(
        "role_name", "client_ip", "user_name", "log_id",
        F.col("event_time").cast("timestamp").alias("ts")).withWatermark("ts", lateness)
    src = src.withColumn("at", F.unix_micros("ts"))
    return src.groupBy("role_name").transformWithStateInPandas(
        statefulProcessor=NewRoleAddresses(period_days, forget_days), outputStructType=T4_OUTPUT,
        outputMode="Append", timeMode="EventTime")


def period_end(at: _dt.datetime, period_days: int = 7) -> _dt.datetime:
    """End of the T4 period that a time is in."""
    days = (at - _dt.datetime(1970, 1, 1)).days
    return _dt.datetime(1970, 1, 1) + _dt.timedelta(days=(days // period_days + 1) * period_days)

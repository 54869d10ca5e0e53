"""Streaming twins: closed windows equal the batch detector; sink is idempotent."""
import datetime as dt
import os
import random
import shutil

from pyspark.sql import functions as F

from veilspark.operators import detect as D
from veilspark.sources import bindings as B
from veilspark.sources import metadata as M
from veilspark.streaming import alert_log as AL
from veilspark.streaming import detect_stream as S
from veilspark.streaming import stateful as ST


def test_bulk_export_stream_equals_batch_on_closed_windows(spark, sf_dir, scratch):
    src = f"{scratch}/landing/events"
    os.makedirs(src)
    shutil.copy(f"{sf_dir}/events.parquet", f"{src}/part-0000.parquet")  # a file lands in the watched folder
    log = f"{scratch}/suspects"
    q = S.start_bulk_export_to_log(spark, src, log, f"{scratch}/ckpt", lateness="30 minutes")
    q.awaitTermination(300)
    streamed = spark.read.parquet(log)
    batch = D.bulk_export(B.query_history(spark, sf_dir))
    # the stream emits a window once the watermark passes it: compare closed windows only
    max_end = streamed.agg(F.max("window_end")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(max_end).cast("timestamp_ntz"))
    s_ids = {r[0] for r in streamed.select("suspect_id").collect()}
    b_ids = {r[0] for r in closed.select("suspect_id").collect()}
    assert s_ids == b_ids and len(s_ids) > 0
    # replaying the sink over the same alerts appends nothing
    writer = S.suspect_log_writer(log)
    before = spark.read.parquet(log).count()
    writer(spark.read.parquet(log).drop("detected_at", "batch_id"), 999)
    assert spark.read.parquet(log).count() == before


def run_in_batches(spark, parts, schema, stream_of, name, scratch):
    """One file per micro-batch, in this order; all that the query gives."""
    path = f"{scratch}/{name}"
    os.makedirs(path)
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/{name}-{n}")
        part = next(f for f in os.listdir(f"{scratch}/{name}-{n}") if f.endswith(".parquet"))
        shutil.copy(f"{scratch}/{name}-{n}/{part}", f"{path}/{n:03d}.parquet")
        os.utime(f"{path}/{n:03d}.parquet", (n + 1, n + 1))  # read in order of age
    ST.use_rocksdb(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = stream_of(stream).writeStream.outputMode("append").format("memory").queryName(name).option(
        "checkpointLocation", f"{scratch}/ck-{name}").trigger(availableNow=True).start()
    q.awaitTermination(600)
    assert q.exception() is None
    return [tuple(r) for r in spark.sql(f"select * from {name}").collect()]


def shuffled_within(rows, key, minutes, rng):
    """Rows in an arrival order that is late by less than so many minutes."""
    return sorted(rows, key=lambda r: key(r) + dt.timedelta(minutes=rng.random() * minutes))


def test_repeated_failures_stream_equals_batch_in_any_order(spark, scratch):
    rng = random.Random(4)
    schema = "user_name string, event_timestamp timestamp_ntz, is_success boolean"
    rows = []
    for u in ("A", "B", "HOT"):
        t = dt.datetime(2024, 1, 1)
        for _ in range(300 if u == "HOT" else 90):
            t += dt.timedelta(seconds=rng.choice([20, 200, 900]))
            rows.append((u, t, rng.random() < 0.2))
    arrived = shuffled_within(rows, lambda r: r[1], 25, rng)
    assert arrived != sorted(arrived, key=lambda r: r[1])
    parts = [arrived[k:k + 80] for k in range(0, len(arrived), 80)]
    got = run_in_batches(spark, parts, schema, lambda s: ST.repeated_failures_stream(s, 3), "t5_any_order", scratch)
    end = max(r[1] for r in rows) - dt.timedelta(minutes=30)
    batch = D.repeated_failures(spark.createDataFrame(rows, schema), 3).where(F.col("success_at") <= F.lit(end)).collect()
    assert sorted(got) == sorted(map(tuple, batch)) and len(batch) > 5


def test_unusual_role_access_stream_equals_batch_per_period(spark, scratch):
    rng = random.Random(9)
    schema = "log_id string, event_time timestamp_ntz, user_name string, role_name string, client_ip string"
    start = ST.period_end(dt.datetime(2024, 1, 1)) - dt.timedelta(days=7)
    rows = [(f"L{n}", start + dt.timedelta(minutes=rng.randrange(28 * 24 * 60)), f"u{rng.randrange(9)}", f"R{rng.randrange(4)}",
             f"10.0.0.{int(rng.paretovariate(0.7)) % 60}") for n in range(700)]
    rows += [(f"N{n}", start + dt.timedelta(days=15 + n), "new", "LATE_ROLE", f"10.9.9.{n}") for n in range(9)]
    rows.append(("END", start + dt.timedelta(days=29), "u0", "R0", "10.0.0.1"))  # the fourth period is over
    arrived = shuffled_within(rows, lambda r: r[1], 55, rng)
    parts = [arrived[k:k + 150] for k in range(0, len(arrived), 150)]
    got = run_in_batches(spark, parts, schema, ST.unusual_role_access_stream, "t4_periods", scratch)
    log, want, end = spark.createDataFrame(rows, schema), [], start
    closed = max(r[1] for r in rows) - dt.timedelta(hours=1)
    while (end := end + dt.timedelta(days=7)) <= closed:
        want += map(tuple, D.unusual_role_access(log, end).collect())
    assert sorted(got) == sorted(want) and any(r[0] == "LATE_ROLE" for r in want)
    assert not any(r[0] == "LATE_ROLE" and r[2] < start + dt.timedelta(days=21) for r in got)  # its first period is no news


def test_forgotten_state(spark, scratch):
    schema = "log_id string, event_time timestamp_ntz, user_name string, role_name string, client_ip string"
    first = ST.period_end(dt.datetime(2024, 1, 1)) + dt.timedelta(hours=2)
    days = [0, 1, 8, 60, 61, 80]
    parts = [[(str(d), first + dt.timedelta(days=d), "u", "R", "10.0.0.7" if d != 1 else "10.0.0.8")] for d in days]
    for forget, want in ((None, []), (30, [60])):
        got = run_in_batches(spark, parts, schema, lambda s: ST.unusual_role_access_stream(s, forget_days=forget),
                             f"t4_forget_{forget}", scratch)
        assert [r[2] for r in got] == [first + dt.timedelta(days=d) for d in want]


def test_alert_log_takes_each_batch_once(spark, sf_dir, scratch):
    from veilspark.sources import metadata as M
    log = B.phi_access_log(spark, sf_dir)
    path = f"{scratch}/audit_for_alerts"
    log.repartition(3).write.parquet(path)
    rm = B.hospital_role_map(spark, sf_dir)
    term = M.users(spark, sf_dir).where(F.col("deleted_on").isNotNull()).select(
        F.col("name").alias("user_name"), F.col("deleted_on").alias("terminated_at"))
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = f"{scratch}/alerts"
    AL.start_event_alerts_to_log(stream, rm, term, out, f"{scratch}/ck-al").awaitTermination(600)
    got, batch = AL.read_alerts(spark, out), D.event_alerts(log, rm, term)
    cols = ["trigger_type", "log_id", "event_time", "user_name", "role_name", "detail"]
    n = batch.count()
    assert got.count() == n > 0 and got.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert AL.ledger(spark, out).count() == 3 and AL.ledger(spark, out).agg(F.sum("alerts")).first()[0] == n
    write = AL.alert_writer(out, "event_alerts")
    write(batch, 1)  # a replay, even of other rows: the batch is in the ledger
    assert AL.read_alerts(spark, out).count() == n
    # a batch that broke off after its alerts were written is not seen, and is written anew
    half = AL.alert_writer(out, "other")
    half(batch.limit(5), 0)
    shutil.rmtree(f"{out}/ledger/stream=other")
    assert AL.read_alerts(spark, out).count() == n
    half(batch.limit(5), 0)
    assert AL.read_alerts(spark, out).count() == n + 5


def test_full_detection_stream_equals_one_pass_batch(spark, sf_dir, scratch):
    src = f"{scratch}/landing2/events"
    os.makedirs(src)
    shutil.copy(f"{sf_dir}/events.parquet", f"{src}/part-0000.parquet")
    log = f"{scratch}/suspects2"
    q = S.start_detection_to_log(spark, src, log, f"{scratch}/ckpt2")
    q.awaitTermination(300)
    streamed = spark.read.parquet(log)
    max_end = streamed.agg(F.max("window_end")).first()[0]
    batch = D.suspect_feed_one_pass(B.query_history(spark, sf_dir)).where(
        F.col("window_end") <= F.lit(max_end).cast("timestamp_ntz"))
    assert {r[0] for r in streamed.select("suspect_id").collect()} == {r[0] for r in batch.select("suspect_id").collect()}
    assert "detected_date" in streamed.columns


def test_audit_ingest_stream_is_complete_and_idempotent(spark, sf_dir, scratch):
    from veilspark.operators import audit as K
    src = f"{scratch}/landing3/events"
    os.makedirs(src)
    shutil.copy(f"{sf_dir}/events.parquet", f"{src}/part-0000.parquet")
    log, rej = f"{scratch}/audit_log", f"{scratch}/rejects"
    catalog, grants = M.column_catalog(spark, sf_dir), B.hospital_role_map(spark, sf_dir)
    S.start_audit_ingest(spark, src, log, rej, f"{scratch}/ck6", catalog, grants).awaitTermination(300)
    written = spark.read.parquet(log)
    batch = K.audit_events_from_queries(B.query_history(spark, sf_dir), catalog, grants, dt.datetime(2024, 1, 31))
    n_events = batch.count()
    assert written.count() == n_events and written.select("log_id").distinct().count() == n_events
    assert "event_date" in written.columns
    # replay the same micro-batch through the sink: nothing is appended twice
    writer = S.audit_log_writer(log, rej)
    writer(batch, 7)
    assert spark.read.parquet(log).count() == n_events


def test_event_alerts_stream_equals_batch(spark, sf_dir, scratch):
    from veilspark.sources import metadata as M
    log = B.phi_access_log(spark, sf_dir)
    path = f"{scratch}/audit"
    log.write.parquet(path)
    rm = B.hospital_role_map(spark, sf_dir)
    users = M.users(spark, sf_dir)
    term = users.where(F.col("deleted_on").isNotNull()).select(F.col("name").alias("user_name"),
                                                               F.col("deleted_on").alias("terminated_at"))
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = S.event_alerts_stream(stream, rm, term).writeStream.outputMode("append").format("memory") \
        .queryName("event_alerts").option("checkpointLocation", f"{scratch}/ck7").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.sql("select * from event_alerts")
    batch = D.event_alerts(spark.read.parquet(path), rm, term)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0
    assert {r[0] for r in got.select("trigger_type").distinct().collect()} >= {
        "CROSS_HOSPITAL_ATTEMPT", "POLICY_BYPASS_ATTEMPT", "OUTSIDE_ALLOW_LIST"}


def test_governed_read_on_a_stream(spark, sf_dir, scratch):
    from veilspark.context import SecurityContext
    from veilspark.operators.masking import PATIENT_BINDINGS
    from veilspark.plans.governed import governed_frame
    path = f"{scratch}/patients"
    B.patients(spark, sf_dir).write.parquet(path)
    ctx = SecurityContext(role="HOSPITAL_ADMIN_H01", as_of=dt.datetime(2024, 6, 1), salts=B.QUERY_SALTS)
    rm = B.hospital_role_map(spark, sf_dir)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = governed_frame(stream, rm, ctx, PATIENT_BINDINGS).writeStream.format("memory").queryName("gov_stream") \
        .option("checkpointLocation", f"{scratch}/ck8").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.sql("select * from gov_stream")
    batch = governed_frame(spark.read.parquet(path), rm, ctx, PATIENT_BINDINGS)
    assert got.count() == batch.count() > 0 and got.exceptAll(batch).count() == 0
    assert {r[0] for r in got.select("hospital_id").distinct().collect()} == {"H01"}


def test_a_replayed_audit_batch_adds_nothing(spark, sf_dir, scratch):
    from veilspark.operators import audit as K
    batch = B.phi_access_log(spark, sf_dir).limit(50).drop("masking_applied")
    bad = batch.limit(3).withColumn("event_type", F.lit("NO_SUCH_TYPE")).withColumn("log_id", F.concat(F.lit("x"), "log_id"))
    write = S.audit_log_writer(f"{scratch}/log", f"{scratch}/rejects")
    for _ in range(2):
        write(batch.unionByName(bad), 7)
    log, rejects = spark.read.parquet(f"{scratch}/log"), spark.read.parquet(f"{scratch}/rejects")
    assert rejects.count() >= 3 and log.count() + rejects.count() == 53
    assert log.where("masking_applied is null").count() == 0
    assert K.PHI_ACCESS_LOG_SCHEMA is not None

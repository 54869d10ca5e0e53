"""Audit jobs: archive idempotence, purge, validation, case state, retention."""
import datetime as dt
import re

from pyspark.sql import functions as F

from veilspark.operators import audit as K
from veilspark.operators import cases as CA
from veilspark.operators import detect as D
from veilspark.operators import purge as P
from veilspark.sources import bindings as B


def test_archive_twice_adds_nothing(spark, sf_dir, scratch):
    src = B.archive_source(spark, sf_dir)
    path = f"{scratch}/archive"
    first = K.archive_candidates(src, B.ARCHIVE_AS_OF)
    n = first.count()
    K.write_archive(first, path)
    again = K.archive_candidates(src, B.ARCHIVE_AS_OF, archived=spark.read.parquet(path))
    assert again.count() == 0
    # the archive side is read only for the candidate months (partition pruning)
    recent = K.archive_candidates(src.where(F.col("event_time") >= F.lit("2001-03-01").cast("timestamp_ntz")),
                                  B.ARCHIVE_AS_OF, archived=spark.read.parquet(path))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)
    arch = spark.read.parquet(path)
    assert arch.count() == n and {"year", "month"} <= set(arch.columns)


def test_archive_needs_both_clocks(spark):
    d = dt.datetime
    df = spark.createDataFrame([
        ("a", d(2024, 1, 1), d(2024, 1, 1)),      # both old -> archived
        ("b", d(2024, 1, 1), d(2024, 5, 30)),     # inserted recently -> stays
        ("c", d(2024, 5, 30), d(2024, 1, 1)),     # event recent -> stays
    ], "log_id string, event_time timestamp_ntz, inserted_at timestamp_ntz")
    got = [r["log_id"] for r in K.archive_candidates(df, d(2024, 6, 1)).collect()]
    assert got == ["a"]


def month_rows(year, month, n, lag=0):
    return [(f"{year}{month:02d}-{i}", dt.datetime(year, month, 1 + i % 27), dt.datetime(year, month, 1 + i % 27) + dt.timedelta(days=lag), i)
            for i in range(n)]


LOG = "log_id string, event_time timestamp_ntz, inserted_at timestamp_ntz, n int"


def test_purge_by_manifest(spark, scratch):
    as_of = dt.datetime(2024, 6, 1)
    rows = [r for m in range(1, 6) for r in month_rows(2023, m, 40 + m)] + month_rows(2024, 2, 30) + month_rows(2024, 5, 20)
    rows += month_rows(2023, 5, 3, lag=400)   # inserted too late: May 2023 is not due
    rows.append(rows[0])                       # a repeated row counts
    hot = spark.createDataFrame(rows, LOG)
    path = f"{scratch}/archive"
    kept = hot.where("not (log_id = '202302-7')").withColumn("n", F.when(F.col("log_id") == "202303-5", -1).otherwise(F.col("n")))
    K.write_archive(K.archive_candidates(kept, as_of), path)
    archive = spark.read.parquet(path)
    report = {(r["year"], r["month"]): r["verdict"] for r in P.purge_report(hot, archive, as_of).collect()}
    assert report == {(2023, 1): "PURGE", (2023, 2): "MISMATCH", (2023, 3): "MISMATCH", (2023, 4): "PURGE", (2023, 5): "NOT_DUE",
                      (2024, 2): "PURGE", (2024, 5): "NOT_DUE"}
    rest, gone = P.purge(hot, archive, as_of)
    assert sorted((r["year"], r["month"], r["rows"]) for r in gone.collect()) == [(2023, 1, 42), (2023, 4, 44), (2024, 2, 30)]
    left = {(r["event_time"].year, r["event_time"].month) for r in rest.collect()}
    assert left == {(2023, 2), (2023, 3), (2023, 5), (2024, 5)} and rest.columns == hot.columns
    # a row that arrives after its month was purged is archived and purged in its turn
    late = spark.createDataFrame([("late", dt.datetime(2023, 1, 9), dt.datetime(2023, 2, 1), 7)], LOG)
    K.write_archive(K.archive_candidates(late, as_of), path)
    again = spark.read.parquet(path)
    verdict = lambda purged: P.purge_report(late, again, as_of, purged=purged).first()["verdict"]
    assert verdict(gone) == "PURGE" and verdict(None) == "MISMATCH"


def test_purge_reads_only_its_months(spark, scratch):
    as_of = dt.datetime(2024, 6, 1)
    path = f"{scratch}/archive"
    K.write_archive(K.archive_candidates(spark.createDataFrame([r for y in (2019, 2020, 2021, 2022) for m in (1, 2) for r in month_rows(y, m, 5)], LOG), as_of), path)
    hot = spark.createDataFrame(month_rows(2021, 2, 5), LOG)
    months = P.due_months(hot, as_of)
    report = P.purge_report(hot, spark.read.parquet(path), as_of, months=months)
    assert months == [(2021, 2)] and [r["verdict"] for r in report.collect()] == ["PURGE"]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*2021[^\]]*", plan) and "log_id" in plan
    assert not any("Join" in x and "log_id" in x for x in plan.splitlines())


def test_validate_routes_bad_rows(spark):
    df = spark.createDataFrame([
        ("L1", dt.datetime(2024, 1, 1), "DML_INSERT", "S1"),
        ("L2", dt.datetime(2024, 1, 1), "USER_DISABLED", "S2"),
        ("L3", dt.datetime(2024, 1, 1), "DML_DELETE", None),
    ], "log_id string, event_time timestamp_ntz, event_type string, session_id string")
    good, bad = K.validate(df)
    assert [r["log_id"] for r in good.collect()] == ["L1"]
    reasons = {r["log_id"]: r["reject_reason"] for r in bad.collect()}
    assert "BAD event_type" in reasons["L2"] and "NULL session_id" in reasons["L3"]


def test_append_partitioned_and_conformed(spark, sf_dir, scratch):
    log = K.conform(B.phi_access_log(spark, sf_dir))
    K.append(log, f"{scratch}/log")
    back = spark.read.parquet(f"{scratch}/log")
    assert back.count() == log.count() and "event_date" in back.columns


def case(spark, rows):
    """(suspect, hours, status, actor, assigned, notes, inserted after hours)"""
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    full = [(f"{s}-{h}-{st}", s, t(h), st, who, given, note, t(ins)) for s, h, st, who, given, note, ins in rows]
    return spark.createDataFrame(full, CA.EVENT_SCHEMA)


HISTORY = [("S1", 1, "INVESTIGATING", "a", "ann", "looks odd", 1), ("S1", 5, "CONFIRMED_BREACH", "b", None, None, 5),
           ("S2", 2, "CLEARED", "a", None, "fine", 2), ("S2", 9, "INVESTIGATING", "b", "bob", None, 9),
           ("S3", 3, "CLEARED", "c", "cy", "noise", 3), ("S4", 4, "CONFIRMED_BREACH", "b", None, "first", 4),
           ("S4", 6, "INVESTIGATING", "b", None, None, 6), ("S4", 30, "CONFIRMED_BREACH", "d", "dee", None, 30)]
# an event of the first hours that reaches the log late
LATE = [("S3", 2, "INVESTIGATING", "a", "ann", "late", 40)]


def states_of(spark, states):
    sus = spark.createDataFrame([(f"S{i}", "OPEN", i) for i in range(1, 6)], "suspect_id string, status string, anomaly_score int")
    return {r["suspect_id"]: r for r in CA.with_state(sus, states).collect()}


def test_case_state_fields(spark):
    got = states_of(spark, CA.fold(CA.as_states(case(spark, HISTORY + LATE))))
    assert {k: r["status"] for k, r in got.items()} == {"S1": "CONFIRMED_BREACH", "S2": "INVESTIGATING", "S3": "CLEARED",
                                                        "S4": "CONFIRMED_BREACH", "S5": "OPEN"}
    assert got["S1"]["assigned_to"] == "ann" and got["S1"]["investigation_notes"] == "looks odd" and got["S1"]["closed_by"] == "b"
    assert got["S1"]["notification_deadline"] == dt.date(2024, 3, 1) and got["S1"]["hipaa_notification_required"]
    assert got["S2"]["closed_at"] is None and got["S2"]["assigned_to"] == "bob" and got["S2"]["investigation_notes"] == "fine"
    assert got["S3"]["closed_at"] == dt.datetime(2024, 1, 1, 3) and got["S3"]["investigation_notes"] == "noise"
    assert got["S4"]["notification_deadline"] == dt.date(2024, 3, 1) and got["S4"]["closed_by"] == "d"  # the first confirmation counts
    assert got["S5"]["assigned_to"] is None and not got["S5"]["hipaa_notification_required"]


def test_snapshots_and_later_events_give_the_same_state(spark, scratch):
    path = f"{scratch}/cases"
    CA.append_events(case(spark, HISTORY), path, buckets=3)
    noon, night = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 20)
    early = states_of(spark, CA.current_states(spark, path, noon))
    CA.write_snapshot(spark, path, noon, buckets=3)
    CA.write_snapshot(spark, path, noon, buckets=3)  # once more: the same folder
    assert CA.snapshots(spark, path) == [noon]
    assert states_of(spark, CA.current_states(spark, path, noon)) == early
    CA.append_events(case(spark, LATE), path, buckets=3)
    want = states_of(spark, CA.fold(CA.as_states(case(spark, HISTORY + LATE))))
    now = CA.current_states(spark, path, night)
    assert states_of(spark, now) == want
    # only the days from the snapshot on are read
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*inserted_date[^\]]*>=", plan)
    CA.write_snapshot(spark, path, night, buckets=3)
    assert states_of(spark, CA.current_states(spark, path, night)) == want and len(CA.snapshots(spark, path)) == 2


def test_evidence_of_both_patterns(spark, sf_dir):
    qh, log = B.query_history(spark, sf_dir), B.phi_access_log(spark, sf_dir)
    alerts = D.suspect_feed_one_pass(qh)
    n = {r["suspect_id"]: r["related_query_count"] for r in alerts.collect()}
    rows = CA.suspect_log(alerts, qh, log, dt.datetime(2024, 1, 31)).collect()
    assert len(rows) == len(n) and {r["suspect_id"]: len(r["related_query_ids"]) for r in rows} == n
    assert all(r["hospital_ids_involved"] and r["phi_fields_exposed"] and r["related_log_ids"] for r in rows)
    # an off-hours alert has its own queries only
    t = dt.datetime(2024, 1, 10, 4, 30)
    q = spark.createDataFrame([(f"Q{i}", "U", "R", "RAW_DB", "PHI_WH", t, "SUCCESS", i % 2) for i in range(4)]
                              + [("Q9", "U", "R", "RAW_DB", "PHI_WH", t, "FAIL", 1), ("Q8", "V", "R", "RAW_DB", "PHI_WH", t, "SUCCESS", 60_000)],
                              "query_id string, user_name string, role_name string, database_name string, warehouse_name string, "
                              "start_time timestamp_ntz, execution_status string, rows_produced int")
    links = CA.alert_links(D.suspect_feed_one_pass(q), q)
    kinds = dict(D.suspect_feed_one_pass(q).select("suspect_id", "trigger_type").collect())
    got = sorted((kinds[r["suspect_id"]], r["query_id"]) for r in links.collect())
    assert got == [("BULK_PHI_EXPORT", "Q8")] + [("OFF_HOURS_ACCESS", f"Q{i}") for i in range(4)]


TEXTS = {
    'SELECT a FROM RAW_DB.EHR.PATIENTS': (None, None, None),
    "insert into cleansed_db.clinical.patients (patient_name, \"PATIENT_DOB\") values ('PATIENT_ZIP', 1) -- SSN": (
        "DML_INSERT", ["CLEANSED_DB.CLINICAL.PATIENTS"], ["PATIENT_DOB", "PATIENT_NAME"]),
    "DELETE FROM patients p WHERE p.ssn = 'it''s -- no comment' AND x = '/*'": ("DML_DELETE", ["RAW_DB.PUBLIC.PATIENTS"], []),
    'update "RAW_DB" . ehr."PATIENTS" set "SSN" = NULL': ("DML_UPDATE", ["RAW_DB.EHR.PATIENTS"], ["SSN"]),
    "CREATE TABLE t AS SELECT * FROM RAW_DB.EHR.PATIENTS": ("DDL_CREATE", ["RAW_DB.PUBLIC.T", "RAW_DB.EHR.PATIENTS"], ["PATIENT_NAME", "SSN"]),
    "DELETE FROM RAW_DB.EHR.PATIENTS WHERE (SELECT COUNT(*) FROM x) > 2 * 3": ("DML_DELETE", ["RAW_DB.EHR.PATIENTS"], []),
    "MERGE INTO RAW_DB.EHR.PATIENTS t USING s ON 1=1 WHEN MATCHED THEN UPDATE SET patient_name_old = 1": ("DML_UPDATE", ["RAW_DB.EHR.PATIENTS"], []),
    "/* DELETE FROM x */ DROP TABLE IF EXISTS CLEANSED_DB.CLINICAL.PATIENTS": ("DDL_DROP", ["CLEANSED_DB.CLINICAL.PATIENTS"], []),
    "GRANT ROLE PHI_READER TO USER u": ("ROLE_GRANT", ["RAW_DB.PUBLIC.NONE"], []),
    "": (None, None, None),
}


def test_audit_events_follow_the_text(spark):
    qh = spark.createDataFrame([(f"Q{i}", t, "s", "u", "HOSPITAL_ADMIN_H01" if i % 2 else "PHI_READER", "W", "RAW_DB", dt.datetime(2024, 1, 10), 5)
                                for i, t in enumerate(TEXTS)],
                               "query_id string, query_text string, session_id string, user_name string, role_name string, warehouse_name string, "
                               "database_name string, start_time timestamp_ntz, rows_produced int")
    columns = spark.createDataFrame([("CLEANSED_DB", "CLINICAL", "PATIENTS", c) for c in ("PATIENT_NAME", "patient_dob", "PATIENT_ZIP", "SSN")]
                                    + [("RAW_DB", "EHR", "PATIENTS", c) for c in ("SSN", "PATIENT_NAME")],
                                    "table_catalog string, table_schema string, table_name string, column_name string")
    d = dt.date
    grants = spark.createDataFrame([("HOSPITAL_ADMIN_H01", "H01", d(2024, 1, 1), None), ("HOSPITAL_ADMIN_H01", "H02", d(2024, 1, 11), None)],
                                   "mapped_role string, hospital_id string, effective_from date, effective_to date")
    got = {}
    for r in K.audit_events_from_queries(qh, columns, grants, dt.datetime(2024, 2, 1)).collect():
        got.setdefault(r["query_id"], []).append(r)
    for i, (text, (kind, tables, cols)) in enumerate(TEXTS.items()):
        rows = got.get(f"Q{i}", [])
        if kind is None:
            assert not rows, text
            continue
        known = [t for t in tables if t in ("RAW_DB.EHR.PATIENTS", "CLEANSED_DB.CLINICAL.PATIENTS")]
        names = [f"{r['database_name']}.{r['schema_name']}.{r['table_name']}" for r in rows]
        assert sorted(names) == sorted({tables[0], *known}), text
        assert all(r["event_type"] == kind for r in rows)
        assert sorted({c for r in rows for c in r["phi_columns_accessed"]}) == cols, text
        admin = bool(i % 2)
        assert all(r["masking_applied"] is admin and r["row_access_applied"] is admin for r in rows)
        assert all(r["hospital_ids_in_result"] == (["H01"] if admin else []) for r in rows)


def test_hospitals_asked_for_in_the_text(spark):
    from veilspark.functions import sqltext as S
    texts = ["DELETE FROM t WHERE hospital_id IN ('H01', 'H02') OR \"HOSPITAL_ID\" = 'H03'", "UPDATE t SET x = 'hospital_id'", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(S.literals_of(F.col("t"), "hospital_id").alias("h")).collect()
    assert [r["h"] for r in rows] == [["H01", "H02", "H03"], [], None]


def test_retention_classes(spark):
    as_of = dt.datetime(2024, 6, 1)
    df = spark.createDataFrame([(dt.datetime(2024, 3, 3),), (dt.datetime(2024, 3, 2),), (dt.datetime(2017, 6, 10),),
                                (dt.datetime(2010, 1, 1),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(K.retention_class(F.col("t"), as_of)).collect()]
    assert got == ["HOT", "ARCHIVE", "ARCHIVE", "EXPIRED"]

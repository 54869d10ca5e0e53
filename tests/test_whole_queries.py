"""Queries that once did less than their whole job, or whose memory or time grew faster than their input."""
import datetime as dt

import __spark_entry__ as E
from veilspark.sources.synth import load_key_diff


def events(spark, path, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{path}/events.parquet")


def test_the_suspect_feed_sees_off_hours_access_spread_over_a_night(spark, tmp_path):
    night = [dt.datetime(2024, 1, 10, 5, 0), dt.datetime(2024, 1, 10, 6, 30), dt.datetime(2024, 1, 10, 8, 10)]  # 0:00 to 3:10 in New York
    events(spark, tmp_path, [(i, t, 1, "view", 0.5, "{}") for i, t in enumerate(night)] + [(9, night[0], 2, "view", 0.5, "{}")])
    got = E.queries()["t3_suspect_feed"](spark, str(tmp_path)).collect()
    assert [(r["trigger_type"], r["suspect_user"], r["related_query_count"], r["severity"]) for r in got] == [
        ("OFF_HOURS_ACCESS", "U0001", 3, "MEDIUM")]


def test_key_diff_with_null_and_repeated_keys_in_one_grouping(spark):
    cols = "a string, b int"
    source = spark.createDataFrame([("x", 1), ("x", 1), ("y", None), (None, None), ("only", 2)], cols)
    target = spark.createDataFrame([("x", 1), ("y", None), ("new", 3), ("new", 3)], cols)
    out = load_key_diff(source, target, ["a", "b"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([
        ("only", 2, "MISSING_IN_TARGET"), ("y", None, "MISSING_IN_TARGET"), (None, None, "MISSING_IN_TARGET"),
        ("y", None, "EXTRA_IN_TARGET"), ("new", 3, "EXTRA_IN_TARGET")], key=repr)
    plan = load_key_diff(source, target, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_query_texts_are_scanned_once(spark, sf_dir):
    plan = E.queries()["k12_audit_events_from_queries"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"|/\*[\s\S]*?\*/|") == 1  # the scanner's pattern
    assert plan.count("hospital_id\\b") == 1  # the pattern of literals

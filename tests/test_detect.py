"""Detector boundary rows (FIXTURES §4) and brute-force checks."""
import datetime as dt
import ipaddress
import itertools
import random
import re

from pyspark.sql import functions as F

from veilspark.functions import addresses as A
from veilspark.operators import detect as D
from veilspark.plans import reports as R

QH_SCHEMA = ("query_id string, query_text string, session_id string, user_name string, role_name string, "
             "warehouse_name string, database_name string, start_time timestamp_ntz, execution_status string, rows_produced bigint")


def qh_rows(spark, rows):
    full = [(f"Q{i}", "select 1", f"{u}-s", u, r, "PHI_WH", db, t, st, n)
            for i, (u, r, db, t, st, n) in enumerate(rows)]
    return spark.createDataFrame(full, QH_SCHEMA)


def test_bulk_threshold_and_score(spark):
    t = dt.datetime(2024, 1, 10, 10, 1)
    qh = qh_rows(spark, [
        ("A", "R", "RAW_DB", t, "SUCCESS", 50_000),               # exactly 50,000: not flagged
        ("B", "R", "RAW_DB", t, "SUCCESS", 25_000), ("B", "R", "CLEANSED_DB", t, "SUCCESS", 25_001),  # 50,001 -> score 10
        ("C", "R", "RAW_DB", t, "SUCCESS", 600_000),              # capped at 100
        ("D", "R", "MARTS_DB", t, "SUCCESS", 900_000),            # not a PHI database
        ("E", "R", "RAW_DB", t, "FAIL", 900_000),                 # failed query
    ])
    got = {r["suspect_user"]: r["anomaly_score"] for r in D.bulk_export(qh).collect()}
    assert got == {"B": 10, "C": 100}


def test_bulk_window_boundaries(spark):
    qh = qh_rows(spark, [
        ("A", "R", "RAW_DB", dt.datetime(2024, 1, 10, 10, 14, 59), "SUCCESS", 30_000),
        ("A", "R", "RAW_DB", dt.datetime(2024, 1, 10, 10, 15, 0), "SUCCESS", 30_000),  # next quarter hour
    ])
    assert D.bulk_export(qh).count() == 0


def test_off_hours_new_york_and_dst(spark):
    # UTC times -> New York hours: 10:30Z = 05:30 EST (off), 11:30Z = 06:30 EST (in),
    # 03:30Z = 22:30 EST (in), 04:30Z = 23:30 EST (off)
    def rows(u, ts_list):
        return [(u, "R", "RAW_DB", t, "SUCCESS", 1) for t in ts_list]
    d = dt.datetime
    qh = qh_rows(spark,
                 rows("EARLY", [d(2024, 1, 10, 10, 30), d(2024, 1, 10, 10, 31), d(2024, 1, 10, 10, 32)])
                 + rows("SIX", [d(2024, 1, 10, 11, 30)] * 3)
                 + rows("TEN_PM", [d(2024, 1, 10, 3, 30)] * 3)
                 + rows("ELEVEN", [d(2024, 1, 10, 4, 30)] * 3)
                 + rows("TWO_ONLY", [d(2024, 1, 10, 4, 30)] * 2)
                 # 2024-03-10 10:30Z is 06:30 EDT (in-hours) but would be 05:30 without DST
                 + rows("DST", [d(2024, 3, 10, 10, 30)] * 3)
                 + rows("DBT_SVC", [d(2024, 1, 10, 4, 30)] * 3)
                 + rows("DBT_SVC_ACCOUNT", [d(2024, 1, 10, 4, 30)] * 3))
    got = sorted(r["suspect_user"] for r in D.off_hours_access(qh, window="15 minutes").collect())
    # DBT_SVC is *not* excluded by '%_SVC_%' (needs a character after), DBT_SVC_ACCOUNT is.
    assert got == ["DBT_SVC", "EARLY", "ELEVEN"]
    strict = sorted(r["suspect_user"] for r in D.off_hours_access(qh, window="15 minutes", strict_service_like=True).collect())
    assert "DBT_SVC" in strict and "DBT_SVC_ACCOUNT" not in strict


def brute_failures(events, k=5):
    out = []
    for user, grp in itertools.groupby(sorted(events, key=lambda e: (e[0], e[1], e[2])), key=lambda e: e[0]):
        fails, first = 0, None
        for _, ts, ok in grp:
            if ok:
                if fails > k:
                    out.append((user, ts, fails, first))
                fails, first = 0, None
            else:
                first = first or ts
                fails += 1
    return sorted(out)


def test_repeated_failures_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    events = []
    for u in ("U1", "U2", "U3"):
        t = base
        for _ in range(400):
            t += dt.timedelta(minutes=rnd.choice([1, 7, 45, 130]))
            events.append((u, t, rnd.random() < 0.25))
    df = spark.createDataFrame(events, "user_name string, event_timestamp timestamp_ntz, is_success boolean")
    got = sorted(tuple(r) for r in D.repeated_failures(df, 5).collect())
    assert got == brute_failures(events, 5)
    assert len(got) > 0


def test_cidr_match_equals_range_check(spark):
    ips = ["10.1.2.3", "10.12.255.255", "10.13.0.1", "172.16.100.7", "172.16.101.9", "172.16.102.1",
           "172.16.200.15", "172.16.200.16", "8.8.8.8"]
    df = spark.createDataFrame([(i,) for i in ips], "client_ip string")
    outside = sorted(r[0] for r in D.outside_allow_list(df, "client_ip").collect())
    assert outside == ["10.13.0.1", "172.16.102.1", "172.16.200.16", "8.8.8.8"]
    # the equi-join on (prefix length, network) finds the others
    inside = sorted(r[0] for r in D.match_cidrs(df, "client_ip", D.allow_list(spark)).select("client_ip").collect())
    assert inside == sorted(set(ips) - set(outside))
    bg = sorted(r[0] for r in D.break_glass_use(df, "client_ip", spark).collect())
    assert bg == ["172.16.200.15"]


def test_sla_hour_boundaries(spark):
    as_of = dt.datetime(2024, 1, 31, 12, 0)
    d = dt.datetime
    rows = [("S12", d(2024, 1, 31, 0, 30)), ("S13", d(2024, 1, 30, 23, 59)), ("S24", d(2024, 1, 30, 12, 1)),
            ("S25", d(2024, 1, 30, 11, 59))]
    df = spark.createDataFrame([(s, t, "BULK_PHI_EXPORT", 10, "U", "R", 1, "OPEN") for s, t in rows],
                               "suspect_id string, detected_at timestamp_ntz, trigger_type string, anomaly_score int, "
                               "suspect_user string, suspect_role string, estimated_row_exposure bigint, status string")
    got = {r["suspect_id"]: (r["hours_since_detected"], r["sla_status"]) for r in R.open_suspects(df, as_of).collect()}
    assert got == {"S12": (12, "WITHIN_SLA"), "S13": (13, "APPROACHING_SLA"), "S24": (24, "APPROACHING_SLA"),
                   "S25": (25, "OVERDUE")}


def test_audit_gap_rules(spark):
    as_of = dt.datetime(2024, 1, 31)
    counts = {dt.date(2024, 1, 29): 0, dt.date(2024, 1, 28): 0, dt.date(2024, 1, 30): 9, dt.date(2024, 1, 26): 10,
              dt.date(2024, 1, 31): 0}
    rows = []
    for day in (dt.date(2024, 1, 2) + dt.timedelta(days=i) for i in range(30)):
        for j in range(counts.get(day, 12)):
            rows.append((dt.datetime(day.year, day.month, day.day, 1, j),))
    log = spark.createDataFrame(rows, "event_time timestamp_ntz")
    got = {r["check_date"]: r["gap_check"] for r in R.audit_gaps(spark, log, as_of).collect()}
    assert got[dt.date(2024, 1, 29)] == "REVIEW"   # Monday, zero
    assert got[dt.date(2024, 1, 28)] == "LOW"      # Sunday, zero
    assert got[dt.date(2024, 1, 30)] == "LOW"      # 9 records
    assert got[dt.date(2024, 1, 26)] == "OK"       # 10 records
    assert got[dt.date(2024, 1, 31)] == "REVIEW"   # Wednesday, no events yet
    assert len(got) == 30


def test_one_pass_feed_equals_union_and_scans_once(spark, sf_dir):
    from veilspark.sources import bindings as B
    qh = B.query_history(spark, sf_dir)
    one = D.suspect_feed_one_pass(qh, window="15 minutes")
    two = D.suspect_feed(qh, bulk_window="15 minutes", off_hours_window="15 minutes")
    cols = sorted(one.columns)
    assert sorted(two.columns) == cols
    assert one.select(cols).exceptAll(two.select(cols)).count() == 0
    assert two.select(cols).exceptAll(one.select(cols)).count() == 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_repeated_failures_with_a_hot_account(spark):
    """One account holds a third of all logins: still exact, and the per-event
    window is partitioned by (user, bucket), never by user alone."""
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    events = []
    for u, n in (("HOT", 20_000), ("A", 5_000), ("B", 5_000), ("C", 5_000), ("D", 5_000), ("E", 5_000),
                 ("F", 5_000), ("G", 5_000), ("H", 5_000)):
        t = base
        p_ok = 0.08 if u == "HOT" else 0.3
        for _ in range(n):
            t += dt.timedelta(seconds=rnd.choice([5, 30, 90, 600]))
            events.append((u, t, rnd.random() < p_ok))
    df = spark.createDataFrame(events, "user_name string, event_timestamp timestamp_ntz, is_success boolean")
    out = D.repeated_failures(df, 5)
    got = sorted(tuple(r) for r in out.collect())
    assert got == brute_failures(events, 5) and any(r[0] == "HOT" for r in got)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the event-level window is keyed by (user, bucket); only per-bucket summaries are windowed by user
    assert re.search(r"windowspecdefinition\(user_name#\d+, bucket#\d+, ts#\d+", plan)


def test_malformed_and_ipv6_addresses_are_outside(spark):
    ips = ["10.1.2.300", "10.0.256.1", "10.1.2", "10.1.2.3.4", "2001:db8::1", "::ffff:10.1.2.3", "", "x", None, "10.1.02.3", "10.1.2.3"]
    df = spark.createDataFrame([(i,) for i in ips], "client_ip string")
    assert [r[0] for r in D.outside_allow_list(df, "client_ip").collect()] == ips[:-1]
    assert D.match_cidrs(df, "client_ip", D.allow_list(spark)).count() == 1


def outside_by_hand(ip, networks):
    try:
        a = ipaddress.ip_address(ip)
    except ValueError:
        return True
    return not any(a in ipaddress.ip_network(n) for n in networks)


NETWORKS = ["10.1.0.0/16", "10.2.0.0/16", "172.16.200.0/28", "0.0.0.7/32", "255.255.255.0/24", "2001:db8::/33", "2001:db8:8000::/33",
            "fe80::/10", "::1/128", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:fff0/124", "2001:db9:0:1::/64"]
ADDRESSES = ["10.1.0.0", "10.2.255.255", "10.3.0.0", "10.0.255.255", "172.16.200.15", "172.16.200.16", "0.0.0.7", "255.255.255.255",
             "2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "2001:DB8::1", "2001:db9::", "2001:db9:0:1::ffff", "2001:db9:0:2::",
             "::1", "::", "::2", "fe80::1", "febf:ffff::", "fec0::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff",
             "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffef", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":1:2:3:4:5:6:7",
             "1:2:3:4:5:6:7:", "12345::", "g::1", "::ffff:10.1.2.3", "2001:db8::10.1.2.3", "2001:db8::10.1.2.300", "::10.1.2.3", "1::10.1.2",
             "10.1.2.3:80", "2001:db8:::1", "", " 10.1.2.3", "10.1.2.03", "fe80::1%eth0"]


def test_address_sets_hold_what_the_networks_hold(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES] + [(None,)], "ip string").coalesce(1)
    held = A.AddressSet.of(NETWORKS).holds(F.col("ip"))
    got = {r["ip"]: r["held"] for r in df.select("ip", held.alias("held")).collect()}
    assert got.pop(None) is False
    # a zone, as in fe80::1%eth0, is no part of a network address here
    want = {a: not outside_by_hand(a, NETWORKS) and "%" not in a for a in ADDRESSES}
    assert got == want
    sites = [(n, f"site {i}") for i, n in enumerate(NETWORKS)]
    rows = D.match_cidrs(df, "ip", D.allow_list(spark, sites)).select("ip", "cidr").collect()
    pairs = {(a, n) for a in ADDRESSES if "%" not in a and not outside_by_hand(a, NETWORKS) for n in NETWORKS
             if ipaddress.ip_address(a) in ipaddress.ip_network(n)}
    assert {tuple(r) for r in rows} == pairs and len(rows) == len(pairs)


def test_address_sets_are_merged_and_random_ones_agree(spark):
    assert len(A.AddressSet.of(["10.0.0.0/9", "10.128.0.0/9", "10.5.0.0/16", "2001:db8::/33", "2001:db8:8000::/33"]).intervals) == 2
    assert A.AddressSet.of([]).intervals == ()
    rnd = random.Random(2)
    nets = [str(ipaddress.ip_network((rnd.getrandbits(32), rnd.randint(6, 32)), strict=False)) for _ in range(60)]
    nets += [str(ipaddress.ip_network((rnd.getrandbits(128), rnd.randint(3, 128)), strict=False)) for _ in range(60)]
    ips = [str(ipaddress.ip_address(rnd.getrandbits(32))) for _ in range(200)]
    ips += [str(ipaddress.IPv6Address(rnd.getrandbits(128))) for _ in range(200)]
    ips += [str(x) for n in nets for x in (ipaddress.ip_network(n)[0], ipaddress.ip_network(n)[-1])]
    df = spark.createDataFrame([(a,) for a in ips], "ip string")
    got = df.select("ip", A.AddressSet.of(nets).holds(F.col("ip")).alias("held")).collect()
    assert all(r["held"] == (not outside_by_hand(r["ip"], nets)) for r in got)


def test_an_address_is_parsed_once_per_row(spark):
    df = spark.createDataFrame([("10.1.2.3",)], "client_ip string")
    plan = D.outside_allow_list(df, "client_ip")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(client_ip") == 1 and plan.count("RLIKE") <= 3 and "Join" not in plan


def test_event_alerts_are_one_scan_and_equal_each_detector(spark, sf_dir, scratch):
    from veilspark.sources import bindings as B
    path = f"{scratch}/audit"
    B.phi_access_log(spark, sf_dir).write.parquet(path)
    log, rm = spark.read.parquet(path), B.hospital_role_map(spark, sf_dir)
    ends = log.groupBy("user_name").agg(F.max("event_time").alias("terminated_at")).where(F.crc32("user_name") % 7 == 0)
    ends = spark.createDataFrame(ends.collect(), ends.schema)
    feed = D.event_alerts(log, rm, ends)
    base = ["log_id", "event_time", "user_name", "role_name"]
    kind = lambda name, df, detail: df.select(F.lit(name).alias("trigger_type"), *base, F.col(detail).cast("string").alias("detail"))
    parts = [kind("CROSS_HOSPITAL_ATTEMPT", D.cross_hospital_attempts(log, rm), "hospital_id"),
             kind("AFTER_TERMINATION", D.after_termination(log, ends), "terminated_at"),
             kind("POLICY_BYPASS_ATTEMPT", D.policy_bypass_attempts(log), "phi_columns"),
             kind("OUTSIDE_ALLOW_LIST", D.outside_allow_list(log, "client_ip"), "client_ip"),
             kind("DEV_LARGE_RESULT", D.dev_large_results(log), "rows_affected")]
    each = parts[0]
    for p in parts[1:]:
        each = each.unionByName(p)
    feed = feed.select(each.columns)
    assert feed.exceptAll(each).count() == 0 and each.exceptAll(feed).count() == 0
    assert feed.select("trigger_type").distinct().count() == 5
    scans = [x for x in feed._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "audit" in x]
    assert len(scans) == 1


def test_repeated_failures_is_one_scan(spark, sf_dir, scratch):
    from veilspark.sources import bindings as B
    path = f"{scratch}/logins"
    B.login_history(spark, sf_dir).write.parquet(path)
    plan = D.repeated_failures(spark.read.parquet(path), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_repeated_failures_over_days_and_months(spark):
    """Runs that stay open over hours, days and months, successes in between, users without one."""
    rnd = random.Random(21)
    events = []
    for u in range(12):
        t = dt.datetime(2023, 11, 20)
        for _ in range(150):
            t += dt.timedelta(hours=rnd.choice([0, 1, 5, 30, 200]), seconds=rnd.randint(0, 50))
            events.append((f"U{u}", t, u != 11 and rnd.random() < (0.02, 0.1, 0.3)[u % 3]))
    df = spark.createDataFrame(events, "user_name string, event_timestamp timestamp_ntz, is_success boolean").repartition(5)
    for k in (0, 2, 5):
        assert sorted(tuple(r) for r in D.repeated_failures(df, k).collect()) == brute_failures(events, k)


def test_cross_hospital_is_judged_on_the_events_day(spark):
    d, t = dt.date, dt.datetime
    grants = spark.createDataFrame([("R", "H01", d(2024, 1, 5), d(2024, 1, 10)), ("R", "H02", d(2024, 1, 20), None)],
                                   "mapped_role string, hospital_id string, effective_from date, effective_to date")
    log = spark.createDataFrame([(str(n), t(2024, 1, day), "u", "R", [h]) for n, (day, h) in enumerate(
        [(4, "H01"), (5, "H01"), (10, "H01"), (11, "H01"), (19, "H02"), (20, "H02"), (30, "H02")])],
        "log_id string, event_time timestamp_ntz, user_name string, role_name string, hospital_ids_in_result array<string>")
    assert sorted(r["log_id"] for r in D.cross_hospital_attempts(log, grants).collect()) == ["0", "3", "4"]


def test_unknown_masking_flag_counts_as_unmasked(spark):
    rows = [(str(n), dt.datetime(2024, 1, 1), "u", "R", ["PATIENT_SSN"], flag) for n, flag in enumerate([True, False, None])]
    log = spark.createDataFrame(rows, "log_id string, event_time timestamp_ntz, user_name string, role_name string, "
                                      "phi_columns_accessed array<string>, masking_applied boolean")
    assert sorted(r["log_id"] for r in D.policy_bypass_attempts(log).collect()) == ["1", "2"]


def test_repeated_terminations_do_not_multiply_rows(spark):
    t = dt.datetime
    log = spark.createDataFrame([("a", t(2024, 1, 9, 12), "u", "R"), ("b", t(2024, 3, 1), "u", "R")],
                                "log_id string, event_time timestamp_ntz, user_name string, role_name string")
    ends = spark.createDataFrame([("u", t(2024, 1, 10)), ("u", t(2024, 1, 10)), ("u", t(2024, 2, 1))],
                                 "user_name string, terminated_at timestamp_ntz")
    assert [r["log_id"] for r in D.after_termination(log, ends).orderBy("log_id").collect()] == ["a", "b"]
    assert [r["log_id"] for r in D.after_termination(log, ends, until_hours=48).collect()] == ["a"]

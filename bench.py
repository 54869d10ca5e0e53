"""Benchmark: the governance workload's headline queries at one scale factor.

Prints ONE JSON line:
  {"metric": "governance_suite_total", "value": <sum of query seconds>, "unit": "sec",
   "queries": {name: sec, ...}, "sf": ..., "ratios": {...}, "rows": {...}}

Every query is forced with the ``noop`` sink (full evaluation, nothing
collected to the driver). Each is run twice; the faster run is reported.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from veilspark.context import SecurityContext  # noqa: E402
from veilspark.operators.audit import spread_for_write  # noqa: E402
from veilspark.functions.tokens import tokenize_ssn  # noqa: E402
from veilspark.operators import detect as D  # noqa: E402
from veilspark.operators.masking import PATIENT_BINDINGS, apply_masks  # noqa: E402
from veilspark.operators.rowaccess import apply_row_policy  # noqa: E402
from veilspark.plans import checks as C  # noqa: E402
from veilspark.plans import reports as R  # noqa: E402
from veilspark.session import build_session, checkpoint_dir  # noqa: E402
from veilspark.sources import bindings as B  # noqa: E402
from veilspark.sources import metadata as M  # noqa: E402
from veilspark.sources.tables import read_table  # noqa: E402


def run(df) -> float:
    """Seconds to build (if given as a function) and run a frame."""
    t = time.perf_counter()
    df = df() if callable(df) else df
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def best(df, n: int = 2) -> float:
    return min(run(df) for _ in range(n))


def wide_fact(spark, sf_dir):
    """Patient events: lineitem x orders x patients, one row per line item, with
    the PHI columns and the hospital key (the reference's 2.1 B-row fact)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = B.patients(spark, sf_dir).withColumn("o_custkey", F.regexp_replace("patient_id", "^P", "").cast("bigint"))
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, "o_custkey")
            .select("patient_id", "hospital_id", "patient_name", "patient_ssn", "patient_dob", "patient_mrn",
                    "patient_phone", "patient_email", "patient_address_1", "patient_zip", "primary_dx_code",
                    "attending_npi", "l_orderkey", "l_linenumber", "l_extendedprice",
                    F.to_date("l_shipdate").alias("event_date")))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="veilspark-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    base = os.path.join(checkpoint_dir(spark), f"bench-{int(time.time())}")
    fact = wide_fact(spark, sf_dir)
    # flat copy: 2 files per core (a cluster table has many splits; one small file would be one task)
    fact.repartition(cpus * 2, "patient_id").write.mode("overwrite").parquet(f"{base}/fact_flat")
    (spread_for_write(fact, ["hospital_id"]).sortWithinPartitions("hospital_id", "event_date")
     .write.mode("overwrite").partitionBy("hospital_id").parquet(f"{base}/fact_by_hospital"))
    flat = spark.read.parquet(f"{base}/fact_flat")
    part = spark.read.parquet(f"{base}/fact_by_hospital")
    # the grant map is a stored table in production: write it once, read it back
    B.hospital_role_map(spark, sf_dir).coalesce(1).write.mode("overwrite").parquet(f"{base}/hospital_role_map")
    role_map = spark.read.parquet(f"{base}/hospital_role_map")
    admin = SecurityContext(role="HOSPITAL_ADMIN_H03", as_of=B.PATIENT_AS_OF, salts=B.QUERY_SALTS)
    analyst = SecurityContext(role="ANALYST_CLINICAL", as_of=B.PATIENT_AS_OF, salts=B.QUERY_SALTS)

    def revenue(df):
        return df.groupBy("hospital_id", "event_date").agg(F.sum("l_extendedprice").alias("revenue"))

    def all_columns_digest(df):
        return df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h"))

    q = {}
    best(revenue(flat), 1)  # warm the JVM and the file cache
    q["r1_policy_off_flat"] = best(revenue(flat))
    q["r1_policy_on_flat_semi"] = best(lambda: revenue(apply_row_policy(flat, role_map, admin)))
    q["r1_policy_on_flat_isin"] = best(lambda: revenue(apply_row_policy(flat, role_map, admin, method="isin")))
    q["r1_same_rows_by_hand"] = best(revenue(flat.where(F.col("hospital_id") == "H03")))
    q["r1_policy_off_partitioned"] = best(revenue(part))
    q["r1_policy_on_partitioned_isin"] = best(lambda: revenue(apply_row_policy(part, role_map, admin, method="isin")))
    q["m13_raw_scan"] = best(all_columns_digest(flat))
    q["m13_masked_scan"] = best(all_columns_digest(apply_masks(flat, PATIENT_BINDINGS, analyst)))

    ssn = flat.select("patient_ssn")
    tok = tokenize_ssn(ssn, "patient_ssn", "BENCH_KEY", out="tok").agg(F.count_distinct("tok"))
    n_ssn = flat.count()
    q["m14_tokenize_distinct"] = best(tok)

    qh = B.query_history(spark, sf_dir)
    q["t3_detection_batch"] = best(D.suspect_feed(qh, off_hours_window="1 day"))
    q["t3_detection_one_pass"] = best(D.suspect_feed_one_pass(qh, window="15 minutes"))
    log = B.phi_access_log(spark, sf_dir)
    users = M.users(spark, sf_dir)
    term = users.where(F.col("deleted_on").isNotNull()).select(
        F.col("name").alias("user_name"), F.col("deleted_on").alias("terminated_at"))
    q["t6_t10_event_alerts"] = best(lambda: D.event_alerts(log, role_map, term))
    q["v2_access_summary"] = best(R.access_summary(log, B.EVENTS_AS_OF, sort=False))
    q["v15_gap_check"] = best(R.audit_gaps(spark, log, B.EVENTS_AS_OF, sort=False))
    q["v19_scorecard"] = best(C.scorecard(B.grant_ledger(spark, sf_dir), B.security_policy_changes(spark, sf_dir),
                                          M.task_history(spark, sf_dir), B.EVENTS_AS_OF))

    q = {k: round(v, 4) for k, v in q.items()}
    ratios = {
        "row_policy_on_off_flat": round(q["r1_policy_on_flat_semi"] / q["r1_policy_off_flat"], 3),
        "row_policy_vs_same_rows_by_hand": round(q["r1_policy_on_flat_semi"] / q["r1_same_rows_by_hand"], 3),
        "row_policy_on_off_partitioned": round(q["r1_policy_on_partitioned_isin"] / q["r1_policy_off_partitioned"], 3),
        "masked_vs_raw_scan": round(q["m13_masked_scan"] / q["m13_raw_scan"], 3),
    }
    out = {
        "metric": "governance_suite_total",
        "value": round(sum(q.values()), 4),
        "unit": "sec",
        "queries": q,
        "sf": sf,
        "ratios": ratios,
        "rows": {"fact_rows": n_ssn, "tokens_per_sec": round(n_ssn / q["m14_tokenize_distinct"], 1)},
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

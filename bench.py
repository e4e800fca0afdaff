"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS].

The twelve subscription tables are derived from the driver tables once and
written to the shared checkpoint folder (as a deployment stores them, the
subscription-keyed ones bucketed by subscription_id); that step is timed as
``materialize_tables``. Each query is then built and run to completion (full
result written to Spark's no-op sink) and timed.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Buckets for the subscription-keyed tables (BENCH_BUCKETS; 0 = plain Parquet). At sf0.1 the
# bucketed files only add per-file overhead; on a cluster set it to the shuffle parallelism.
BUCKETS = int(os.environ.get("BENCH_BUCKETS", "0"))

HEADLINE = [
    "revenue_by_product", "monthly_recurring_revenue", "active_subscribers", "churn_events", "churn_rate",
    "retention_rate", "cohort_retention", "customer_ltv", "owner_tenure", "attribution_first_touch",
    "payment_retries", "revenue_by_billing_frequency", "integrity_report", "plan_moves", "lifecycle_events",
    "journeys", "churn_risk_score", "report_executive", "report_customer", "survival_curve",
    "document_rule_report", "pre_churn_behaviour", "corporate_accounts", "churn_rate_by_product",
    "seat_utilisation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from subledger.plans.catalog import load_all
    from subledger.session import local_session, scratch_path
    from subledger.sources.fixtures import Tables

    spark = local_session(cpus, "subledger-bench")
    catalog = load_all()
    t0 = time.time()
    # subscription-keyed tables bucketed by subscription_id (one bucket per core), as stored tables
    t = Tables(spark, sf_dir).materialized(scratch_path(spark, "tables"), buckets=BUCKETS)
    timings = {"materialize_tables": round(time.time() - t0, 3)}
    for name in HEADLINE:
        if name not in catalog:
            continue
        t1 = time.time()  # build included: some operators checkpoint intermediate results eagerly
        df = catalog[name].build(t)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t1, 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": timings,
                      "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()

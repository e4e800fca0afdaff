"""Results must not depend on the session time zone (all timestamps are timestamp_ntz)."""

import pytest

from subledger.plans.catalog import load_all
from subledger.plans.compare import compare

NAMES = ["support_vs_churn", "payment_retries", "engagement_trend", "subscription_state_asof", "lifecycle_events",
         "churn_features", "trial_registrations"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_other_zone(name, spark, duck):
    from subledger.sources.fixtures import Tables
    from tests.conftest import SF_ORACLE

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        q = load_all()[name]
        r = compare(q.build(Tables(spark, SF_ORACLE)), q.oracle_sql(), duck)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["match"], (r.get("sample_spark_only"), r.get("sample_oracle_only"))

"""Edge fixtures for the derivations: small hand tables replacing the mapped ones."""

import datetime as dt
from decimal import Decimal

import pytest

from subledger.operators import derive as D
from subledger.operators import kpi as K
from subledger.sources.schemas import TABLES


def _subs(spark, rows):
    full = []
    for sid, owner, plan, start, end, reason in rows:
        status = "ended" if end else "active"
        full.append((sid, owner, None, plan, start, start, end or start, end, status, True, None, reason, None,
                     dt.datetime(2020, 1, 1)))
    return spark.createDataFrame(full, TABLES["subscriptions"].schema)


@pytest.fixture(scope="module")
def base(spark):
    from subledger.sources.fixtures import Tables

    return Tables(spark, "/root/testdata/sf0.001")


D0 = dt.date


def test_churn_grace_boundary(spark, base):
    subs = _subs(spark, [
        ("A1", "C1", "PLN003", D0(2023, 1, 1), D0(2023, 3, 1), "voluntary_cancel"),
        ("A2", "C1", "PLN003", D0(2023, 3, 31), None, None),          # starts exactly end + 30: continues
        ("B1", "C2", "PLN003", D0(2023, 1, 1), D0(2023, 3, 1), "voluntary_cancel"),
        ("B2", "C2", "PLN003", D0(2023, 4, 1), None, None),           # one day later: churn
        ("E1", "C3", "PLN003", D0(2023, 1, 1), D0(2024, 1, 20), "non_renewal"),  # undecided at as_of
        ("F1", "C4", "PLN003", D0(2023, 1, 1), D0(2023, 6, 1), "payment_failure"),
        ("F2", "C4", "PLN003", D0(2022, 12, 1), D0(2023, 5, 1), "plan_change"),  # overlapping, ends earlier
    ])
    t = base.with_tables(subscriptions=subs)
    got = {r["subscription_id"]: r["churn_type"] for r in D.churn_events(t).collect()}
    assert got == {"B1": "Voluntary", "F1": "Involuntary"}


def test_tenure_merges_overlaps(spark, base):
    subs = _subs(spark, [
        ("A1", "C1", "PLN003", D0(2023, 1, 1), D0(2023, 3, 1), "non_renewal"),
        ("A2", "C1", "PLN003", D0(2023, 2, 1), D0(2023, 2, 15), "non_renewal"),  # inside A1
        ("A3", "C1", "PLN003", D0(2023, 3, 1), D0(2023, 4, 1), "non_renewal"),   # touches A1
        ("A4", "C1", "PLN003", D0(2023, 6, 1), D0(2023, 6, 11), "non_renewal"),
    ])
    t = base.with_tables(subscriptions=subs)
    r = D.owner_tenure(t).collect()[0]
    assert r["tenure_days"] == 90 + 10 and r["islands"] == 2


def test_active_calendar_same_day_and_month_end(spark, base):
    subs = _subs(spark, [
        ("Z", "C1", "PLN003", D0(2023, 5, 10), D0(2023, 5, 10), "non_renewal"),  # zero length: never active
        ("M", "C2", "PLN003", D0(2023, 1, 31), D0(2023, 3, 31), "non_renewal"),  # ends on Mar 31: not active then
    ])
    t = base.with_tables(subscriptions=subs)
    months = sorted((r["subscription_id"], r["month"]) for r in D.active_calendar(t).collect())
    assert months == [("M", D0(2023, 1, 1)), ("M", D0(2023, 2, 1))]


def test_billing_schedule_month_end(spark, base):
    subs = _subs(spark, [("J", "C1", "PLN003", D0(2024, 1, 31), None, None)])
    t = base.with_tables(subscriptions=subs)
    rows = D.billing_schedule(t, "2024-05-01").orderBy("period_no").collect()
    assert [r["period_start"] for r in rows] == [D0(2024, 1, 31), D0(2024, 2, 29), D0(2024, 3, 31), D0(2024, 4, 30)]


def test_mrr_factors(spark, base):
    subs = _subs(spark, [
        ("D", "C1", "PLN001", D0(2023, 1, 1), None, None),   # Daily 30 -> 900
        ("W", "C2", "PLN002", D0(2023, 1, 1), None, None),   # Weekly 150 -> 650
        ("Y", "C3", "PLN004", D0(2023, 1, 1), None, None),   # Annual 5000 -> 416.67
    ])
    t = base.with_tables(subscriptions=subs)
    r = K.monthly_recurring_revenue(t).filter("month = date'2023-06-01'").collect()[0]
    assert abs(r["mrr"] - (900 + 650 + 5000 / 12)) < 0.01


def _events(spark, rows):
    """rows: (event_id, subscription_id, event_type, event_at)"""
    full = [(eid, sid, None, None, et, at, None, None, None, None, None, at) for eid, sid, et, at in rows]
    return spark.createDataFrame(full, TABLES["subscription_events"].schema)


def _payments(spark, rows):
    """rows: (payment_id, subscription_id, attempted_at, status)"""
    full = [(pid, sid, at, Decimal("10.00"), "KES", st, "card", None,
             "timeout" if st == "failed" else None, at) for pid, sid, at, st in rows]
    return spark.createDataFrame(full, TABLES["payments"].schema)


T0 = dt.datetime


def test_cancel_reverse_cancel(spark, base):
    ev = _events(spark, [
        ("E1", "S1", "cancellation_requested", T0(2023, 1, 1, 9)),
        ("E2", "S1", "cancellation_reversed", T0(2023, 1, 2, 9)),
        ("E3", "S1", "cancellation_requested", T0(2023, 1, 5, 9)),
        ("E4", "S1", "subscription_ended", T0(2023, 2, 1, 9)),
        ("E5", "S2", "cancellation_requested", T0(2023, 1, 1, 9)),
    ])
    t = base.with_tables(subscription_events=ev)
    got = {r["request_event_id"]: r["outcome"] for r in D.cancellation_outcomes(t).collect()}
    assert got == {"E1": "reversed", "E3": "completed", "E5": "pending"}


def test_retry_chains(spark, base):
    subs = _subs(spark, [("S1", "C1", "PLN003", D0(2023, 1, 1), D0(2023, 6, 1), "payment_failure")])
    pay = _payments(spark, [
        ("P1", "S1", T0(2023, 1, 1), "failed"), ("P2", "S1", T0(2023, 1, 3), "failed"),
        ("P3", "S1", T0(2023, 1, 6), "successful"),                       # recovered after 5 days
        ("P4", "S1", T0(2023, 2, 1), "successful"),                       # first time
        ("P5", "S1", T0(2023, 3, 1), "failed"), ("P6", "S1", T0(2023, 3, 2), "failed"),  # run ends failed
    ])
    t = base.with_tables(subscriptions=subs, payments=pay)
    got = {r["chain_no"]: (r["attempts"], r["outcome"], r["days_to_recover"])
           for r in D.payment_retries(t).collect()}
    assert got == {0: (3, "recovered", 5), 1: (1, "first_time", None), 2: (2, "lost", None)}


def test_attribution_ties_and_late_touches(spark, base):
    subs = _subs(spark, [("S1", "C1", "PLN003", D0(2023, 1, 10), None, None),
                         ("S2", "C2", "PLN003", D0(2023, 1, 10), None, None)])
    tp_rows = [
        ("T2", "C1", T0(2023, 1, 5, 11), "Email"), ("T1", "C1", T0(2023, 1, 5, 11), "Direct"),  # same instant
        ("T3", "C1", T0(2023, 1, 20, 11), "Referral"),                                           # after start
        ("T4", "C2", T0(2023, 2, 1, 11), "Paid Search"),                                          # only after
    ]
    tp = spark.createDataFrame([(i, c_, at, ch, None, "click", None, at) for i, c_, at, ch in tp_rows],
                               TABLES["marketing_touchpoints"].schema)
    t = base.with_tables(subscriptions=subs, marketing_touchpoints=tp)
    first = {r["customer_id"]: r["channel"] for r in D.attribution(t, "first").collect()}
    last = {r["customer_id"]: r["channel"] for r in D.attribution(t, "last").collect()}
    assert first == {"C1": "Direct", "C2": "Unattributed"}
    assert last == {"C1": "Email", "C2": "Unattributed"}


def test_organisation_band_boundaries(spark):
    from pyspark.sql import functions as F

    from subledger.functions.columns import organisation_band
    sizes = [1, 49, 50, 249, 250, 999, 1000, 4999, 5000]
    df = spark.createDataFrame([(s,) for s in sizes], "size int")
    got = [r["b"] for r in df.select(organisation_band(F.col("size")).alias("b")).collect()]
    assert got == ["Micro", "Micro", "Small", "Small", "Medium", "Medium", "Large", "Large", "Enterprise"]


def test_two_currencies_are_never_mixed(spark, base):
    subs = _subs(spark, [("S1", "C1", "PLN003", D0(2023, 1, 1), None, None),
                         ("S2", "C2", "PLN003", D0(2023, 1, 1), None, None)])
    pay = _payments(spark, [("P1", "S1", T0(2023, 1, 2), "successful"), ("P2", "S2", T0(2023, 1, 3), "successful")])
    from pyspark.sql import functions as F
    pay = pay.withColumn("currency", F.when(F.col("payment_id") == "P2", "USD").otherwise(F.col("currency")))
    t = base.with_tables(subscriptions=subs, payments=pay)
    got = {(r["currency"], float(r["gross_revenue"])) for r in K.gross_subscription_revenue(t).collect()}
    assert got == {("KES", 10.0), ("USD", 10.0)}


def test_survival_when_everyone_at_risk_churns(spark, base):
    from subledger.operators.diagnostics import survival_curve
    subs = _subs(spark, [("S1", "C1", "PLN003", D0(2023, 1, 1), D0(2023, 1, 20), "voluntary_cancel"),
                         ("S2", "C2", "PLN003", D0(2023, 1, 1), D0(2023, 1, 25), "voluntary_cancel")])
    t = base.with_tables(subscriptions=subs)
    rows = survival_curve(t).collect()
    assert [(r["duration_months"], r["at_risk"], r["churned"], r["survival"]) for r in rows] == [(0, 2, 2, 0.0)]


def test_zero_denominator_rates_are_null(spark, base):
    subs = _subs(spark, [("S1", "C1", "PLN003", D0(2023, 1, 1), D0(2023, 1, 20), "voluntary_cancel")])
    t = base.with_tables(subscriptions=subs)
    r = {row["month"]: row["churn_rate"] for row in K.churn_rate(t).collect()}
    assert r[D0(2023, 1, 1)] is None            # nobody active at the start of January


def test_two_load_rules(spark, base):
    from pyspark.sql import functions as F

    from subledger.operators import rules
    old = base.payments
    new = old.withColumn("payment_status", F.when(F.col("payment_status") == "failed", "successful")
                         .otherwise(F.col("payment_status")))
    rewritten = rules.payment_status_rewritten(old, new).count()
    assert rewritten == old.filter("payment_status = 'failed'").count() and rewritten > 0
    assert rules.payment_status_rewritten(old, old).count() == 0
    fewer = base.plans.filter("plan_id <> 'PLN001'")
    assert [r["plan_id"] for r in rules.deleted_reference_rows(base.plans, fewer, "plan_id").collect()] == ["PLN001"]

"""Steps that several columns or fitted stages share are worked out once, with the same rows."""

import datetime as dt
from collections import Counter

import pytest

from subledger.operators import derive as D
from subledger.operators import diagnostics as X
from subledger.operators import predict as P
from subledger.operators import reports as RP
from subledger.operators import rules as RU
from subledger.sources.schemas import TABLES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    from subledger.sources.fixtures import tables

    return tables(spark, SMALL)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _exchanges(df) -> int:
    spark = df.sparkSession
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_status_of_two_loads_takes_one_exchange(spark):
    rows = lambda pairs: spark.createDataFrame(pairs, "payment_id string, payment_status string")
    old = rows([("a", "pending"), ("b", "failed"), ("c", "pending"), ("c", "failed"), (None, "failed"), ("d", None)])
    new = rows([("a", "failed"), ("b", "failed"), ("c", "successful"), (None, "pending"), ("d", "failed"), ("e", "x")])
    got = RU.payment_status_rewritten(old, new)
    assert {tuple(r) for r in got.collect()} == {("a", 2), ("c", 3), (None, 2)}
    assert _exchanges(got) == 1


@pytest.mark.parametrize("report", [RP.report_executive, RP.report_customer])
def test_report_joins_payments_to_subscriptions_once(small, monkeypatch, report):
    calls, facts, months, made = [], D.revenue_facts, D.active_owner_months, []
    monkeypatch.setattr(D, "revenue_facts", lambda t: calls.append(1) or facts(t))
    monkeypatch.setattr(D, "active_owner_months", lambda *a, **k: made.append(1) or months(*a, **k))
    report(small)
    assert len(calls) == 1 and len(made) <= 1


def test_kmeans_reads_stored_features(small):
    assert "Join" not in _plan(P.kmeans_segments(small))


def test_shared_amounts_equal_the_operators_own(small):
    day = "2023-07-01"  # payments lie before and after
    paid = D.owner_payments(small, day)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(P.rfm(small, day, paid)) == rows(P.rfm(small, day)) != []
    assert rows(D.customer_ltv(small, paid)) == rows(D.customer_ltv(small))
    cells = D.revenue_cells(small, day)
    assert rows(P._series_revenue(small, day, cells)) == rows(P._series_revenue(small, day)) != []


def _hand(spark, small):
    day = lambda n: dt.date(2023, 1, 1) + dt.timedelta(days=n)
    at = lambda n: dt.datetime.combine(day(n), dt.time(9))
    sub = lambda i, who, lo, hi: (i, who, None, "PLN003", day(lo), day(lo), day(hi or lo), hi and day(hi),
                                  "ended" if hi else "active", True, None, hi and "non_renewal", None, at(lo))
    subs = [sub("S1", "A", 0, 100), sub("S2", "B", 0, 120), sub("S2", "B", 0, 120), sub("S3", "C", 10, None)]
    pay = lambda i, s, n, st="failed": (i, s, at(n), None, "KES", st, "card", None, None, at(n))
    pays = [pay("P1", "S1", 70), pay("P2", "S1", 69), pay("P3", "S1", 100), pay("P4", "S2", 119),
            pay("P5", "S3", 395), pay("P6", "S3", 390, "successful"), pay("P7", "S3", 310)]
    eng = [("E1", "A", day(99), 5), ("E2", "A", day(100), 7), ("E3", "B", day(90), 2), ("E4", "C", day(385), 4),
           ("E5", "C", day(340), 3), ("E6", None, day(99), 50)]
    def pad(rows, names, schema):
        return [tuple(dict(zip(names, r)).get(f.name) for f in schema) for r in rows]
    def make(rows, name, names=None):
        s = TABLES[name].schema
        for f in s:
            f.nullable = True
        return spark.createDataFrame(pad(rows, names, s) if names else rows, s)
    sup = [("U1", "A", at(80)), ("U2", "C", at(394))]
    ev = [("V1", "S3", "cancellation_requested", at(320)), ("V2", "S1", "cancellation_requested", at(99))]
    return small.with_tables(
        subscriptions=make(subs, "subscriptions"), payments=make(pays, "payments"),
        customer_engagement=make(eng, "customer_engagement", ("engagement_id", "customer_id", "engagement_date", "sessions_count")),
        support_interactions=make(sup, "support_interactions", ("interaction_id", "customer_id", "interaction_at")),
        subscription_events=make(ev, "subscription_events", ("event_id", "subscription_id", "event_type", "event_at")))


def test_behaviour_before_churn_is_one_sweep(spark, small):
    t = _hand(spark, small)
    got = X.pre_churn_behaviour(t, "2024-02-01")
    assert _plan(got).count("Join LeftOuter") == 1  # the churn rule's own; windows are not joined back
    rows = {r["cohort"]: tuple(r)[1:] for r in got.collect()}
    # S2 stands twice: four windows; its failed payment meets both of its rows
    assert rows == {"churned": (5, round((5 + 4 * 2) / 5, 4), round((1 + 4 * 2) / 5, 4), 0.2),
                    "retained": (1, 4.0, 1.0, 1.0)}


def test_features_of_all_windows_come_from_one_aggregate(spark, small):
    t = _hand(spark, small)
    f = P.churn_features(t, "2024-02-01")
    assert "r30|" not in _plan(f) and Counter(_plan(f).split())["Window"] <= 2  # tenure's islands
    r = {x["owner_id"]: x for x in f.collect()}
    assert set(r) == {"C"}
    assert [r["C"][x] for x in ("days_since_active", "sessions_30d", "sessions_prev_30d", "failed_payments_90d",
                                "support_cases_90d", "cancel_intent")] == [11, 4, 3, 2, 1, 1]

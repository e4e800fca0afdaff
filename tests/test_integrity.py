"""Mutation tests: corrupt one row, expect exactly that rule to fire."""

import pytest
from pyspark.sql import functions as F

from subledger.operators import integrity as I

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    from subledger.sources.fixtures import Tables

    return Tables(spark, SMALL)


def _fired(report):
    return {r["rule"]: r["violations"] for r in report.filter("violations > 0").collect()}


def _one(df, key, value):
    return F.col(key) == value


def test_clean_fixture_has_no_violations(small):
    assert _fired(I.integrity_report(small)) == {}


def test_check_fires_once(small):
    sid = small.subscriptions.first()["subscription_id"]
    bad = small.subscriptions.withColumn(
        "status", F.when(F.col("subscription_id") == sid, "bogus").otherwise(F.col("status")))
    t = small.with_tables(subscriptions=bad)
    assert _fired(I.check_violations(t, tables=["subscriptions"])) == {"chk_subscription_status": 1}


def test_null_seats_lenient_vs_strict(small):
    org = small.subscriptions.filter("organisation_id is not null").first()["subscription_id"]
    bad = small.subscriptions.withColumn(
        "seats_purchased", F.when(F.col("subscription_id") == org, F.lit(None)).otherwise(F.col("seats_purchased")))
    t = small.with_tables(subscriptions=bad)
    assert _fired(I.check_violations(t, "lenient", ["subscriptions"])) == {}
    assert _fired(I.check_violations(t, "strict", ["subscriptions"])) == {"chk_subscription_seats": 1}


def test_duplicate_unique_key_and_null_ignored(small):
    p = small.payments
    refs = p.filter("transaction_reference is not null").limit(2).collect()
    bad = p.withColumn("transaction_reference",
                       F.when(F.col("payment_id") == refs[1]["payment_id"], F.lit(refs[0]["transaction_reference"]))
                       .otherwise(F.col("transaction_reference")))
    t = small.with_tables(payments=bad)
    assert _fired(I.unique_violations(t, ["payments"])) == {"uq_payments_transaction_reference": 2}


def test_orphan_foreign_key(small):
    sid = small.payments.first()["payment_id"]
    bad = small.payments.withColumn(
        "subscription_id", F.when(F.col("payment_id") == sid, "SUB_MISSING").otherwise(F.col("subscription_id")))
    t = small.with_tables(payments=bad)
    assert _fired(I.fk_violations(t, ["payments"])) == {"fk_payments_subscription_id": 1}


def test_not_null_and_length(small):
    cid = small.customers.first()["customer_id"]
    bad = small.customers.withColumn(
        "country", F.when(F.col("customer_id") == cid, F.lit(None)).otherwise(F.col("country"))
    ).withColumn("first_name", F.when(F.col("customer_id") == cid, F.lit("x" * 101)).otherwise(F.col("first_name")))
    t = small.with_tables(customers=bad)
    fired = _fired(I.integrity_report(t, tables=["customers"]))
    assert fired == {"nn_customers_country": 1, "len_customers_first_name": 1}


def test_quarantine_splits_rows(small):
    pid = small.payments.first()["payment_id"]
    bad = small.payments.withColumn("amount", F.when(F.col("payment_id") == pid, F.lit(0)).otherwise(F.col("amount")))
    q = I.quarantine(bad, "payments")
    rejected = q.filter(F.size("violated_rules") > 0).collect()
    assert [r["payment_id"] for r in rejected] == [pid]
    assert rejected[0]["violated_rules"] == ["chk_payment_amount"]


def test_defaults_only_when_absent(small):
    df = small.payments.drop("currency")
    out = I.apply_defaults(df, "payments", "2024-02-01 00:00:00")
    assert out.filter("currency <> 'KES'").count() == 0
    kept_null = I.apply_defaults(small.payments.withColumn("currency", F.lit(None).cast("string")), "payments",
                                 "2024-02-01 00:00:00")
    assert kept_null.filter("currency is null").count() == small.payments.count()

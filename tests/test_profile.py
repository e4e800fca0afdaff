"""Validation, shares, counts and the numeric summary over given tables."""

import random
import statistics

from subledger.operators import profile as P


def test_summary_interpolates_quartiles(spark):
    rng = random.Random(3)
    for n in (1, 2, 7, 400):
        xs = [rng.randint(1, 5000) for _ in range(n)]
        r = P.numeric_summary(spark.createDataFrame([(x,) for x in xs] + [(None,)], "size int"), "size").first()
        assert (r["count"], r["min"], r["max"]) == (n, min(xs), max(xs))
        xs.sort()
        for p in (25, 50, 75):
            h = (n - 1) * p / 100
            lo, hi = xs[int(h)], xs[min(n - 1, int(h) + 1)]
            assert r[f"p{p}"] == round(lo + (hi - lo) * (h - int(h)))
        if n > 1:
            assert abs(r["std"] - statistics.stdev(xs)) <= 0.5


def test_validation_counts_each_fault(spark):
    from datetime import date

    d = date(2024, 1, 1)
    customers = spark.createDataFrame(
        [("C1", "a@x", d, "active"), ("C1", "a@x", d, "gone"), ("C2", "b@x", None, "closed")],
        "customer_id string, email string, signup_date date, account_status string")
    orgs = spark.createDataFrame([("O1", "N", 0, "active"), ("O2", "N", 5, "bad")],
                                 "organisation_id string, organisation_name string, organisation_size int, "
                                 "account_status string")
    got = {r["check_name"]: r["failures"] for r in P.entity_validation(customers, orgs).collect()}
    assert got == {"customers_unique_id": 1, "customers_unique_email": 1, "customers_not_null": 1,
                   "customers_status_domain": 1, "organisations_unique_id": 0, "organisations_unique_name": 1,
                   "organisations_size_positive": 1, "organisations_status_domain": 1}

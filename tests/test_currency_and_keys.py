"""Two currencies through the money operators, and identifiers of long keys."""

import pytest
from pyspark.sql import functions as F

from subledger.operators import diagnostics as X
from subledger.operators import kpi as K
from subledger.operators import migration as G
from subledger.operators import predict as P
from subledger.operators import reports as RP
from subledger.sources import fixtures as FX

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def one(spark):
    return FX.tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def two(one):
    """The payments of every subscription whose number ends in 3, once more in USD."""
    again = (one.payments.where(F.col("subscription_id").endswith("3"))
             .withColumn("currency", F.lit("USD")).withColumn("amount", (F.col("amount") * 7).cast("decimal(12,2)"))
             .withColumn("payment_id", F.concat("payment_id", F.lit("-u"))))
    return one.with_tables(payments=one.payments.unionByName(again))


def total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_owners_are_counted_once(one, two):
    for op, col in ((X.campaign_performance, "customers"), (X.promotion_retention, "eligible")):
        assert total(op(two), col) == total(op(one), col)
    assert RP.report_customer(two).count() == one.customers.count()
    assert G.journeys(two).select("path", "owners").collect() == G.journeys(one).select("path", "owners").collect()
    risky = P.retention_offers(two)
    assert risky.count() == risky.select("owner_id").distinct().count()
    assert P.rfm_segments(two).count() == P.rfm_segments(one).count()
    assert total(P.value_risk_segments(two), "owners") == total(P.value_risk_segments(one), "owners")


def test_one_row_per_channel_and_currency(two):
    for op in (X.channel_comparison, P.channel_investment):
        rows = op(two).select("channel", "currency").collect()
        assert len(rows) == len(set(rows))
        assert {r["currency"] for r in rows if r["currency"]} == {"KES", "USD"}


@pytest.mark.parametrize("op", [
    K.revenue_by_billing_frequency, P.revenue_forecast, P.expected_ltv, X.revenue_change_drivers, X.churned_revenue,
    G.upgrade_revenue_impact, P.next_best_plan, P.retention_scenarios, K.gross_subscription_revenue])
def test_first_currency_is_untouched_by_a_second(op, one, two):
    def kes(t):
        df = op(t)
        col = "currency" if "currency" in df.columns else "from_currency"
        return sorted(map(str, df.where(F.col(col) == "KES").collect()))

    assert kes(one) == kes(two)


def test_executive_report_has_every_currency(two):
    rows = RP.report_executive(two).collect()
    assert {r["currency"] for r in rows} >= {"KES", "USD"}
    keys = [(r["month"], r["currency"]) for r in rows]
    assert len(keys) == len(set(keys))


def test_money_lists_name_each_currency(two):
    texts = [r["ltv"] for r in RP.report_customer(two).collect() if r["ltv"]]
    assert any("; " in x for x in texts) and all(p[:4] in ("KES ", "USD ") for x in texts for p in x.split("; "))


def test_long_keys_stay_apart(spark):
    keys = [k for d in range(4, 11) for k in (10**d - 2, 10**d - 1, 10**d, 10**d + 1, 99 * 10 ** (d - 2) + 9)]
    df = spark.createDataFrame([(k,) for k in set(keys)], "k long")
    for n in (3, 4, 6, 7, 8):
        ids = [r[0] for r in df.select(FX._pad(F.col("k"), n)).collect()]
        assert len(set(ids)) == len(set(keys)) and all(len(x) >= n for x in ids)
        assert {int(x) for x in ids} == set(keys)


def test_auc_equals_the_pairwise_share(one):
    scores = {r["owner_id"]: r["probability"] for r in P._churn_scores(one, *P._snapshots(one, None, None), 30).collect()}
    labels = {r["owner_id"]: r["label"] for r in P.churn_labels(one, P._snapshots(one, None, None)[1], 30).collect()}
    assert set(scores) == set(labels) and all(0 <= p <= 1 for p in scores.values())
    pos = [scores[o] for o in labels if labels[o]]
    neg = [scores[o] for o in labels if not labels[o]]
    got = P.churn_model_auc(one).first()
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))
    if pos and neg:
        share = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
        assert abs(got["auc"] - share) < 6e-5


def test_an_earlier_day_shows_nothing_later(one):
    t = one.before("2022-07-01")
    for op in (K.gross_subscription_revenue, K.monthly_recurring_revenue, K.new_subscribers, K.renewal_rate,
               K.average_revenue_per_user, K.trial_registrations, K.churn_rate):
        months = [str(r["month"]) for r in op(t).select("month").collect()]
        assert months and max(months) < "2022-07-01", op.__name__
    whole = {(r["month"], r["currency"]): r["gross_revenue"] for r in K.gross_subscription_revenue(one).collect()}
    assert all(whole[(r["month"], r["currency"])] == r["gross_revenue"]
               for r in K.gross_subscription_revenue(t).collect())
    assert t.subscriptions.where("subscription_end_date >= '2022-07-01'").count() == 0

"""Report tables (REP-*): the three report views, the corporate account table and the
recommendation list, each one DataFrame built from the KPI / diagnostic operators.
All joins here are between month- or entity-level aggregates.

A report with ``as_of`` is the report on the tables as they stood before that day (``t.before``): every column
sees the same cut. Without it, it reads the tables as given."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c, ratio
from ..session import scratch_table
from . import derive as D
from . import diagnostics as X
from . import kpi as K
from . import predict as P
from .migration import plan_moves


def seen(t, as_of: str | None):
    return t if as_of is None else t.before(as_of)


def with_every_month(report: DataFrame) -> DataFrame:
    """``report`` and, for each month between its first and its last that has no row, a row of the month alone.

    One pass: the last row before a gap yields the gap's months. The window runs over the report's rows
    (months by currency)."""
    following = F.lead("month").over(Window.orderBy("month", "currency"))
    gap = F.coalesce(F.months_between(following, "month").cast("int") - 1, F.lit(0))
    steps = (report.withColumn("gap", F.greatest(gap, F.lit(0)))
             .withColumn("gap", F.explode(F.sequence(F.lit(0), "gap"))))
    return steps.select(*[F.add_months("month", c("gap")).alias(n) if n == "month"
                          else F.when(c("gap") == 0, c(n)).alias(n) for n in report.columns])


def report_executive(t, as_of: str | None = None) -> DataFrame:
    """REP-1: month and currency x revenue, growth, ARPU, MRR and the 3-month total revenue forecast on the
    months after the history, next to the month's subscribers, new subscribers, churn and retention (owners,
    the same on each currency's row). No month between the first and the last is left out."""
    t = seen(t, as_of)
    cells = scratch_table(D.revenue_cells(t), "cells")  # payments meet their subscriptions once for all columns
    live = scratch_table(D.active_owner_months(t), "live")  # and subscriptions make owner months once
    owners = [
        K.active_subscribers(t, live=live),
        K.new_subscribers(t).groupBy("month").agg(F.sum("new_subscribers").cast("bigint").alias("new_subscribers")),
        K.churn_rate(t, live=live).select("month", "churn_rate"),
        K.retention_rate(t, live=live).select("month", "retention_rate"),
    ]
    money = [
        K.revenue_growth(t, cells=cells).select("month", "currency", "revenue", c("growth_rate").alias("revenue_growth")),
        K.average_revenue_per_user(t, cells=cells).select("month", "currency", "arpu"),
        K.monthly_recurring_revenue(t).select("month", "currency", "mrr"),
        P.revenue_forecast(t, cells=cells).filter(c("product_name") == "ALL")
        .select("month", "currency", "forecast_revenue"),
    ]
    return with_every_month(
        reduce(lambda a, b: a.join(b, "month", "full"), owners)
        .join(reduce(lambda a, b: a.join(b, ["month", "currency"], "full"), money), "month", "full"))


def report_subscription(t, as_of: str | None = None) -> DataFrame:
    """REP-2: product x frequency x month (with product and month subtotals): new subscriptions,
    renewals, moves away from the plan (upgrades, downgrades, lateral, billing cycle), churned
    subscriptions, and of the month's start cohort those still running at ``as_of``."""
    t = seen(t, as_of)
    s = D.subscription_facts(t)
    keys = ["month", "product_name", "billing_frequency"]

    def rows(df, metric):
        return df.select(*keys, *[F.lit(1 if m == metric else 0).alias(m) for m in METRICS])

    METRICS = ["new_subscriptions", "renewals", "upgrades", "downgrades", "lateral_moves", "cycle_moves", "churned",
               "cohort_active"]
    starts = s.select(F.trunc("start_date", "month").alias("month"), "product_name", "billing_frequency")
    ren = (t.subscription_events.filter(c("event_type") == "renewed").join(s, "subscription_id")
           .select(F.trunc(F.to_date("event_at"), "month").alias("month"), "product_name", "billing_frequency"))
    mv = plan_moves(t).select(c("move_month").alias("month"), c("from_product").alias("product_name"),
                              c("from_frequency").alias("billing_frequency"), "product_move", "cycle_move")
    ch = D.churn_events(t).select(c("churn_month").alias("month"), "product_name", "billing_frequency")
    a = F.lit(t.as_of).cast("date")
    cohort = (s.filter((c("start_date") < a) & (c("end_date").isNull() | (c("end_date") >= a)))
              .select(F.trunc("start_date", "month").alias("month"), "product_name", "billing_frequency"))
    u = reduce(DataFrame.unionByName, [
        rows(starts, "new_subscriptions"), rows(ren, "renewals"),
        rows(mv.filter(c("product_move") == "upgrade"), "upgrades"),
        rows(mv.filter(c("product_move") == "downgrade"), "downgrades"),
        rows(mv.filter(c("product_move") == "lateral"), "lateral_moves"),
        rows(mv.filter(c("cycle_move") != "same"), "cycle_moves"), rows(ch, "churned"),
        rows(cohort, "cohort_active")])
    leaf = u.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in METRICS])  # the rollup copies cells, not rows
    return (leaf.rollup(*keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in METRICS],
                                F.grouping_id().cast("int").alias("grouping_level"))
            .filter(c("grouping_level") < 4))


def report_customer(t, as_of: str | None = None) -> DataFrame:
    """REP-3: one row per customer: RFM segment, acquisition channel, tenure, value per currency, churn risk,
    reactivation and engagement level."""
    t = seen(t, as_of)
    cust = t.customers.select("customer_id", "country", "account_status")
    key = lambda df, col="owner_id": df.withColumnRenamed(col, "customer_id")
    paid = scratch_table(D.owner_payments(t), "paid")  # payments meet their subscriptions once for value and segment
    seg = key(P.rfm_segments(t, paid=paid).select("owner_id", "segment"))
    ch = D.attribution(t).select("customer_id", "channel")
    ten = key(D.owner_tenure(t).select("owner_id", "tenure_days"))
    ltv = key(D.owner_value(t, paid))
    risk = key(P.churn_risk_score(t).select("owner_id", "risk_score", "risk_band"))
    react = key(K.reactivations(t).filter(c("next_start").isNotNull()).select("owner_id").distinct()
                .withColumn("reactivated", F.lit(True)))
    eng = D.engagement_level(t).select("customer_id", "engagement_level")
    j = reduce(lambda a, b: a.join(b, "customer_id", "left"), [seg, ch, ten, ltv, risk, react, eng], cust)
    return j.withColumn("reactivated", F.coalesce(c("reactivated"), F.lit(False)))


def report_corporate(t, as_of: str | None = None) -> DataFrame:
    """REP-4: the corporate account table (it holds the renewal rates by billing term)."""
    return X.corporate_accounts(seen(t, as_of))


def report_recommendations(t, as_of: str | None = None) -> DataFrame:
    """REP-5: what / who / why / action rows from the retention-offer list, the next-best-plan
    table and all channels by investment rank."""
    t = seen(t, as_of)
    offers = P.retention_offers(t).select(
        F.lit("retention_offer").alias("recommendation"), c("owner_id").alias("subject"),
        F.concat(F.lit("risk "), c("risk_score").cast("string"), F.lit(", value "), c("ltv"))
        .alias("reason"), F.lit("offer a retention discount").alias("action"),
        c("risk_score").alias("priority"))
    plans = P.next_best_plan(t).select(
        F.lit("promote_plan").alias("recommendation"),
        F.concat_ws(" ", "from_product", "from_frequency").alias("subject"),
        F.concat(F.lit("moves "), c("moves").cast("string"), F.lit(", retained "),
                 F.round(c("retention") * 100).cast("bigint").cast("string"), F.lit("%")).alias("reason"),
        F.concat(F.lit("promote "), F.concat_ws(" ", "to_product", "to_frequency")).alias("action"),
        F.lit(50).alias("priority"))
    chans = P.channel_investment(t).select(
        F.lit("invest_channel").alias("recommendation"), c("channel").alias("subject"),
        F.concat(F.lit("investment rank "), c("investment_rank").cast("string"),
                 F.coalesce(F.concat(F.lit(" in "), c("currency")), F.lit(""))).alias("reason"),
        F.lit("increase acquisition budget").alias("action"), (40 - c("investment_rank")).alias("priority"))
    return reduce(DataFrame.unionByName, [offers, plans, chans]).select(
        "recommendation", "subject", "reason", "action", c("priority").cast("int").alias("priority"))

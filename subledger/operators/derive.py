"""Base derivations (DER-*) that every KPI builds on.

Conventions
-----------
* Owner = ``coalesce(customer_id, organisation_id)``.
* A subscription is active on day *d* when ``start <= d`` and
  (``end`` is NULL or ``end > d``): end-exclusive, so a plan change on day
  *d* is never counted twice.
* Months are DATEs on the first of the month; "active at month end" is
  evaluated on ``last_day(month)``; only months whose last day is before
  ``as_of`` are reported.

Scale notes
-----------
Only the fixed reference tables (products: 6 rows, plans: 18 rows) are
broadcast explicitly; everything else is left to Catalyst/AQE. Fact-to-fact
relations are keyed by owner or subscription. The interval lookups that a
naive plan would write as an equi + range join (churn continuation, next start
after churn, activity on a day, merged tenure) are sweeps over *day-level
aggregates*: rows are first reduced to one per (owner, day) by a partial
aggregate, the window runs over those (bounded by the calendar span, even for
an owner holding a third of all rows), and answers are joined back by
(owner, day). No owner's rows are ever paired with each other. Calendars are
``sequence`` explosions of each row (narrow, no join), deduplicated by a
partial aggregate before any shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import Ordered, ordered_neighbours
from ..session import path_exists, scratch_path, scratch_scope
from ..functions.columns import (
    money_list,
    DEFAULT_GRACE_DAYS, c, churn_type, dbl, money, month, organisation_band, owner_id, owner_type, ratio,
)

FAR_FUTURE = "9999-12-31"


def _as_of(t, as_of: str | None) -> Column:
    return F.lit(as_of or t.as_of).cast("date")


# --------------------------------------------------------------------------- DER-1
def subscription_facts(t) -> DataFrame:
    """DER-1: subscription + plan + product + owner id/type (two broadcast joins)."""
    plans = t.plans.select("plan_id", "product_id", "billing_frequency", "billing_period_days", "unit_price",
                           "currency")
    products = t.products.select("product_id", "product_name", "product_family")
    return (
        t.subscriptions
        .join(F.broadcast(plans), "plan_id")
        .join(F.broadcast(products), "product_id")
        .select(
            "subscription_id", owner_id().alias("owner_id"), owner_type().alias("owner_type"),
            "customer_id", "organisation_id", "plan_id", "product_id", "product_name", "product_family",
            "billing_frequency", "billing_period_days", "unit_price", "currency",
            c("subscription_start_date").alias("start_date"), c("subscription_end_date").alias("end_date"),
            "status", "end_reason", "seats_purchased", "auto_renew", "cancellation_requested_at",
        )
    )


# --------------------------------------------------------------------------- DER-2
def owner_neighbours(t) -> DataFrame:
    """Position and previous / next subscription of each subscription in its owner's (start_date, subscription_id)
    order, however many an owner starts on one day (``functions.ordering.ordered_neighbours``). Computed once per
    ``t``."""
    kept = t.__dict__.get("_owner_neighbours")
    if kept is None or not path_exists(t.spark, kept[0]):
        path = scratch_path(t.spark, "neighbours")
        with scratch_scope():
            ordered_neighbours(subscription_facts(t), "owner_id", "start_date", "subscription_id").select(
                "subscription_id", "seq", F.col("prev_id").alias("prev_subscription_id"),
                F.col("next_id").alias("next_subscription_id")).write.parquet(path)
        kept = t.__dict__["_owner_neighbours"] = (path, t.spark.read.parquet(path))
    return kept[1]


def owner_timeline(t) -> DataFrame:
    """DER-2: previous / next subscription of the same owner and the gap between them."""
    s = subscription_facts(t)
    nb = owner_neighbours(t)
    prev = s.select(c("subscription_id").alias("prev_subscription_id"), c("end_date").alias("prev_end_date"),
                    c("end_reason").alias("prev_end_reason"))
    nxt = s.select(c("subscription_id").alias("next_subscription_id"), c("start_date").alias("next_start_date"))
    return (s.select("subscription_id", "owner_id", "owner_type", "plan_id", "product_name", "billing_frequency",
                     "start_date", "end_date", "end_reason")
            .join(nb, "subscription_id")
            .join(prev, "prev_subscription_id", "left")
            .join(nxt, "next_subscription_id", "left")
            .withColumn("gap_days", F.datediff("start_date", "prev_end_date").cast("int")))


# --------------------------------------------------------------------------- DER-3
def _continues(subs: DataFrame, probes: DataFrame) -> DataFrame:
    """For each probe (owner_id, probe_id, at, after) tell whether any subscription of the
    owner starts on or before ``at`` and ends after ``after`` (open = never ends).

    Skew-safe sweep: subscriptions are first reduced to one row per (owner, start day) with the
    latest end (a partial aggregate, so a hot owner costs one row per day, not per subscription),
    probe days likewise; one running max per owner over those day rows gives the latest end
    among subscriptions started by each probe day, joined back to the probes by (owner, day).
    Per-owner window state is bounded by the calendar span, not by the owner's row count.
    """
    far = F.lit(FAR_FUTURE).cast("date")
    sub_days = subs.groupBy("owner_id", c("start_date").alias("day")).agg(
        F.max(F.coalesce(c("end_date"), far)).alias("reach"))
    probe_days = probes.select("owner_id", c("at").alias("day")).distinct()
    rows = (sub_days.select("owner_id", "day", F.lit(0).alias("kind"), "reach")
            .unionByName(probe_days.select("owner_id", "day", F.lit(1).alias("kind"),
                                           F.lit(None).cast("date").alias("reach"))))
    w = (Window.partitionBy("owner_id").orderBy("day", "kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reach_at = (rows.withColumn("max_reach", F.max("reach").over(w)).filter(c("kind") == 1)
                .select("owner_id", c("day").alias("at"), "max_reach"))
    return (probes.join(reach_at, ["owner_id", "at"], "left")
            .select("probe_id", F.coalesce(c("max_reach") > c("after"), F.lit(False)).alias("continued")))


def churn_events(t, as_of: str | None = None, grace_days: int = DEFAULT_GRACE_DAYS) -> DataFrame:
    """DER-3: ended subscriptions (not plan changes) after which the owner had no
    subscription continuing within ``grace_days``. Only decided cases
    (``end + grace < as_of``) are reported; churn date = the subscription end."""
    s = subscription_facts(t)
    ended = s.filter((c("status") == "ended") & (c("end_reason") != "plan_change")
                     & (F.date_add(c("end_date"), grace_days) < _as_of(t, as_of)))
    probes = ended.select("owner_id", c("subscription_id").alias("probe_id"),
                          F.date_add(c("end_date"), grace_days).alias("at"), c("end_date").alias("after"))
    cont = _continues(s.select("owner_id", "start_date", "end_date"), probes)
    return (
        ended.join(cont.filter(~c("continued")), ended.subscription_id == cont.probe_id, "left_semi")
        .select("subscription_id", "owner_id", "owner_type", "product_name", "billing_frequency",
                "plan_id", "start_date", c("end_date").alias("churn_date"), month(c("end_date")).alias("churn_month"),
                "end_reason", churn_type(c("end_reason")).alias("churn_type"))
    )


def next_start_after(t, probes: DataFrame) -> DataFrame:
    """For probes (owner_id, probe_id, at): the first subscription start of the owner strictly after
    ``at``. Same skew-safe shape as ``_continues``: distinct (owner, day) rows, one running min
    per owner from the right, joined back by (owner, day)."""
    s = subscription_facts(t)
    start_days = s.select("owner_id", c("start_date").alias("day")).distinct()
    probe_days = probes.select("owner_id", c("at").alias("day")).distinct()
    rows = (start_days.select("owner_id", "day", F.lit(0).alias("kind"), c("day").alias("st"))
            .unionByName(probe_days.select("owner_id", "day", F.lit(1).alias("kind"),
                                           F.lit(None).cast("date").alias("st"))))
    w = (Window.partitionBy("owner_id").orderBy("day", "kind")
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nxt = (rows.withColumn("next_start", F.min("st").over(w)).filter(c("kind") == 1)
           .select("owner_id", c("day").alias("at"), "next_start"))
    return probes.join(nxt, ["owner_id", "at"], "left").select("probe_id", "next_start")


# --------------------------------------------------------------------------- DER-4 / DER-5 as tables
def churn_type_summary(t, as_of: str | None = None, grace_days: int = DEFAULT_GRACE_DAYS) -> DataFrame:
    """DER-4 applied: churned subscriptions by end reason and churn type."""
    return (churn_events(t, as_of, grace_days).groupBy("end_reason", "churn_type")
            .agg(F.count("*").alias("churned")))


def organisation_bands(t) -> DataFrame:
    """DER-5 applied: every organisation with its size band."""
    return t.organisations.select("organisation_id", "organisation_type", "organisation_size",
                                  organisation_band(c("organisation_size")).alias("size_band"))


# --------------------------------------------------------------------------- DER-6
def seat_utilisation(t) -> DataFrame:
    """DER-6: seats purchased vs active users per organisation subscription (0 when no users)."""
    users = (t.organisation_users.groupBy("subscription_id")
             .agg(F.count_if(c("user_status") == "active").alias("seats_activated")))
    s = t.subscriptions.filter(c("organisation_id").isNotNull())
    return (
        s.join(users, "subscription_id", "left")
        .select("subscription_id", "organisation_id", "status",
                c("seats_purchased").cast("int").alias("seats_purchased"),
                F.coalesce(c("seats_activated"), F.lit(0)).cast("bigint").alias("seats_activated"))
        .withColumn("utilisation", ratio(c("seats_activated"), c("seats_purchased")))
    )


# --------------------------------------------------------------------------- DER-7
def revenue_facts(t) -> DataFrame:
    """DER-7: successful payments with their subscription's owner, product and plan."""
    s = subscription_facts(t).select("subscription_id", "owner_id", "owner_type", "product_name", "product_id",
                                     "billing_frequency", "plan_id")
    p = t.payments.filter(c("payment_status") == "successful").select(
        "payment_id", "subscription_id", "amount", "currency", c("payment_attempted_at").alias("paid_at"))
    return p.join(s, "subscription_id").withColumn("month", month(c("paid_at")))


def owner_payments(t, as_of: str | None = None) -> DataFrame:
    """Per paying owner and currency: ``revenue`` of all its successful payments, and of those before ``as_of`` the
    last one's time, their number and sum (no such payment: NULL, 0, NULL)."""
    before = c("paid_at") < _as_of(t, as_of).cast("timestamp_ntz")
    return revenue_facts(t).groupBy("owner_id", "owner_type", "currency").agg(
        F.sum("amount").alias("revenue"), F.max(F.when(before, c("paid_at"))).alias("last_paid_at"),
        F.count_if(before).cast("bigint").alias("payments"), money(F.sum(F.when(before, c("amount")))).alias("monetary"))


def revenue_cells(t, as_of: str | None = None) -> DataFrame:
    """Per month, currency, product and frequency: ``all_revenue`` of successful payments, and the number and sum of
    those before ``as_of``."""
    before = c("paid_at") < _as_of(t, as_of).cast("timestamp_ntz")
    return revenue_facts(t).groupBy("month", "currency", "product_name", "billing_frequency").agg(
        F.sum("amount").alias("all_revenue"), F.count_if(before).alias("payments"),
        F.sum(F.when(before, c("amount"))).alias("revenue"))


# --------------------------------------------------------------------------- DER-8
def billing_schedule(t, as_of: str | None = None) -> DataFrame:
    """DER-8: expected billing periods of each subscription up to its end (or ``as_of``).

    Calendar logic: Monthly/Annual periods use ``add_months`` from the original
    start (Jan 31 -> Feb 29 -> Mar 31), Daily/Weekly add days."""
    s = subscription_facts(t)
    cap = F.least(F.coalesce(c("end_date"), _as_of(t, as_of)), _as_of(t, as_of))
    months = F.months_between(cap, c("start_date"))
    upper = (F.when(c("billing_frequency") == "Daily", F.datediff(cap, c("start_date")))
             .when(c("billing_frequency") == "Weekly", F.floor(F.datediff(cap, c("start_date")) / 7))
             .when(c("billing_frequency") == "Monthly", F.ceil(months))
             .otherwise(F.ceil(months / 12))).cast("int")

    def period_start(k: Column) -> Column:
        f = c("billing_frequency")
        return (F.when(f == "Daily", F.date_add(c("start_date"), k))
                .when(f == "Weekly", F.date_add(c("start_date"), k * 7))
                .when(f == "Monthly", F.add_months(c("start_date"), k))
                .otherwise(F.add_months(c("start_date"), k * 12)))

    return (
        s.select("subscription_id", "billing_frequency", "start_date", cap.alias("cap"),
                 F.explode(F.sequence(F.lit(0), F.greatest(upper, F.lit(0)))).alias("period_no"))
        .withColumn("period_start", period_start(c("period_no")))
        .withColumn("period_end", period_start(c("period_no") + 1))
        .filter((c("period_no") == 0) | (c("period_start") < c("cap")))
        .select("subscription_id", "billing_frequency", c("period_no").cast("int").alias("period_no"),
                "period_start", "period_end")
    )


# --------------------------------------------------------------------------- DER-9
STATE_OF_EVENT = {
    "subscription_started": "active", "reactivated": "active", "renewed": "active", "past_due_resolved": "active",
    "cancellation_reversed": "active", "past_due_started": "past_due", "cancellation_requested": "cancel_pending",
    "subscription_ended": "ended", "plan_changed": "ended",
}


def subscription_state_asof(t, at: str | None = None) -> DataFrame:
    """DER-9: state of every subscription on a date, rebuilt from its event history
    (latest state-changing event by ``(event_at, event_id)``; argmax aggregate, no sort)."""
    at_ts = (F.lit(at or t.as_of).cast("date").cast("timestamp_ntz"))
    e = t.subscription_events.filter((c("event_type") != "seats_changed") & (c("event_at") < at_ts))
    last = e.groupBy("subscription_id").agg(
        F.max_by("event_type", F.struct("event_at", "event_id")).alias("last_event_type"),
        F.max("event_at").alias("last_event_at"))
    state = F.lit(None).cast("string")
    for ev, st in STATE_OF_EVENT.items():
        state = F.when(c("last_event_type") == ev, st).otherwise(state)
    return last.select("subscription_id", "last_event_type", "last_event_at", state.alias("state"))


# --------------------------------------------------------------------------- DER-10
def seats_asof(t, at: str | None = None) -> DataFrame:
    """DER-10: seats of each organisation subscription on a date from the seat-change history."""
    at_ts = F.lit(at or t.as_of).cast("date").cast("timestamp_ntz")
    s = t.subscriptions.filter(c("organisation_id").isNotNull() & (c("subscription_start_date") < F.lit(at or t.as_of).cast("date")))
    e = t.subscription_events.filter(c("event_type") == "seats_changed")
    key = F.struct("event_at", "event_id")
    before = (e.filter(c("event_at") < at_ts).groupBy("subscription_id")
              .agg(F.max_by("new_seat_count", key).alias("last_new")))
    after = (e.filter(c("event_at") >= at_ts).groupBy("subscription_id")
             .agg(F.min_by("previous_seat_count", key).alias("next_prev")))
    h = before.join(after, "subscription_id", "full")
    return (s.join(h, "subscription_id", "left")
            .select("subscription_id", "organisation_id",
                    F.coalesce(c("last_new"), c("next_prev"), c("seats_purchased")).cast("int").alias("seats")))


# --------------------------------------------------------------------------- DER-11
def first_subscription(t) -> DataFrame:
    """Each owner's first subscription start (one row per owner)."""
    return subscription_facts(t).groupBy("owner_id", "owner_type").agg(F.min("start_date").alias("first_start"))


def attribution(t, model: str = "first") -> DataFrame:
    """DER-11: acquisition channel per customer from touches up to the first subscription start.

    ``first`` / ``last``: one row per customer (``Unattributed`` when no touch);
    ties at one instant are broken by ``touchpoint_id``.
    ``linear``: one row per customer x channel with weight = touches / all touches."""
    firsts = first_subscription(t).filter(c("owner_type") == "customer").select(
        c("owner_id").alias("customer_id"), "first_start")
    tp = t.marketing_touchpoints.select("touchpoint_id", "customer_id", "touchpoint_at", "channel", "campaign_name",
                                        "attributed_cost")
    before = tp.join(firsts, "customer_id").filter(c("touchpoint_at") <= c("first_start").cast("timestamp_ntz"))
    if model == "linear":
        n = Window.partitionBy("customer_id")
        g = before.groupBy("customer_id", "channel").agg(F.count("*").alias("touches"))
        return g.select("customer_id", "channel",
                        dbl(c("touches") / F.sum("touches").over(n)).alias("weight"))
    key = F.struct("touchpoint_at", "touchpoint_id")
    pick = F.min_by if model == "first" else F.max_by
    chosen = before.groupBy("customer_id").agg(
        pick("channel", key).alias("channel"), pick("campaign_name", key).alias("campaign_name"),
        pick("touchpoint_at", key).alias("touchpoint_at"))
    return (firsts.join(chosen, "customer_id", "left")
            .select("customer_id", "first_start", F.coalesce(c("channel"), F.lit("Unattributed")).alias("channel"),
                    "campaign_name", "touchpoint_at"))


# --------------------------------------------------------------------------- DER-12..14
def engagement_recency(t, as_of: str | None = None) -> DataFrame:
    """DER-12: days since last active day per customer (NULL when never active)."""
    last = t.customer_engagement.groupBy("customer_id").agg(F.max("engagement_date").alias("last_active"))
    return (t.customers.select("customer_id").join(last, "customer_id", "left")
            .select("customer_id", "last_active",
                    F.datediff(_as_of(t, as_of), c("last_active")).cast("int").alias("days_since_active")))


def engagement_window(t, as_of: str | None = None, days: int = 30) -> DataFrame:
    """DER-13: engagement in the last ``days`` days vs the ``days`` before (missing days count 0)."""
    a = _as_of(t, as_of)
    e = t.customer_engagement
    recent = (e.engagement_date >= F.date_sub(a, days)) & (e.engagement_date < a)
    prior = (e.engagement_date >= F.date_sub(a, 2 * days)) & (e.engagement_date < F.date_sub(a, days))
    g = e.filter(prior | recent).groupBy("customer_id").agg(
        F.sum(F.when(recent, c("sessions_count")).otherwise(0)).cast("bigint").alias("sessions_recent"),
        F.sum(F.when(prior, c("sessions_count")).otherwise(0)).cast("bigint").alias("sessions_prior"),
        F.sum(F.when(recent, c("articles_viewed")).otherwise(0)).cast("bigint").alias("articles_recent"),
        money(F.sum(F.when(recent, c("reading_minutes")).otherwise(0))).alias("minutes_recent"),
        F.count_if(recent).cast("bigint").alias("active_days_recent"),
    )
    return (t.customers.select("customer_id").join(g, "customer_id", "left").na.fill(0, [
        "sessions_recent", "sessions_prior", "articles_recent", "active_days_recent"])
        .withColumn("minutes_recent", F.coalesce(c("minutes_recent"), F.lit(0).cast("decimal(18,2)")))
        .withColumn("session_change", ratio(c("sessions_recent") - c("sessions_prior"), c("sessions_prior"))))


# Fixed thresholds on 30-day sessions (our choice; the docs name the levels only).
ENGAGEMENT_LEVELS = [(1, "low"), (3, "medium"), (6, "high")]


def engagement_level(t, as_of: str | None = None) -> DataFrame:
    """DER-14: none / low / medium / high from sessions in the last 30 days."""
    w = engagement_window(t, as_of)
    lvl = F.lit("none")
    for lower, name in ENGAGEMENT_LEVELS:
        lvl = F.when(c("sessions_recent") >= lower, name).otherwise(lvl)
    return w.select("customer_id", "sessions_recent", lvl.alias("engagement_level"))


# --------------------------------------------------------------------------- DER-15
def active_calendar(t, as_of: str | None = None) -> DataFrame:
    """DER-15: one row per subscription and month in which it is active at month end
    (months whose last day is before ``as_of``). A ``sequence`` explosion per row: no calendar join."""
    s = subscription_facts(t)
    a = _as_of(t, as_of)
    cap = F.least(F.coalesce(c("end_date"), a), a)
    lo = month(c("start_date"))
    hi = F.add_months(month(cap), -1)
    return (s.filter(lo <= hi)
            .select("*", F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias("month")))


def active_any_day(t, as_of: str | None = None) -> DataFrame:
    """Subscription x month for every month in which it is active on at least one day before ``as_of``."""
    s = subscription_facts(t)
    a = _as_of(t, as_of)
    cap = F.least(F.coalesce(c("end_date"), a), a)
    lo = month(c("start_date"))
    hi = month(F.date_sub(cap, 1))
    return (s.filter(c("start_date") < cap)
            .select("*", F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias("month")))


def active_owner_months(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (owner, month[, by...]) active at month end (a partial aggregate dedups before the
    shuffle). ``by`` takes subscription attributes (product_name, billing_frequency, plan_id, ...):
    an owner active in two products in a month counts once in each."""
    return active_calendar(t, as_of).select(*dict.fromkeys(["owner_id", "owner_type", "month", *by])).distinct()


# --------------------------------------------------------------------------- DER-16
def payment_retries(t) -> DataFrame:
    """DER-16: retry chains: consecutive attempts of a subscription up to and including a success.

    ``outcome``: ``first_time`` (success, no failure), ``recovered`` (failures then
    success), ``lost`` (failures, no success, subscription ended for payment
    failure), ``open`` otherwise."""
    # chain number = successful attempts before this one
    succ = F.when(c("payment_status") == "successful", 1).otherwise(0)
    numbered = Ordered(t.payments, "subscription_id", ("payment_attempted_at", "payment_id"),
                       ("payment_status",)).sum_before(succ, "chain_no")
    chains = numbered.groupBy("subscription_id", "chain_no").agg(
        F.count("*").alias("attempts"),
        F.count_if(c("payment_status") == "failed").alias("failures"),
        F.min(F.when(c("payment_status") == "failed", c("payment_attempted_at"))).alias("first_failure_at"),
        F.max(F.when(c("payment_status") == "successful", c("payment_attempted_at"))).alias("success_at"),
    )
    s = t.subscriptions.select("subscription_id", "end_reason")
    return (
        chains.join(s, "subscription_id")
        .select("subscription_id", c("chain_no").cast("int").alias("chain_no"),
                c("attempts").cast("bigint").alias("attempts"), c("failures").cast("bigint").alias("failures"),
                F.when(c("success_at").isNotNull() & (c("failures") == 0), "first_time")
                .when(c("success_at").isNotNull(), "recovered")
                .when((c("failures") > 0) & (c("end_reason") == "payment_failure"), "lost")
                .otherwise("open").alias("outcome"),
                F.when(c("success_at").isNotNull() & c("first_failure_at").isNotNull(),
                       F.datediff(c("success_at"), c("first_failure_at"))).cast("int").alias("days_to_recover"))
    )


# --------------------------------------------------------------------------- DER-17
def cancellation_outcomes(t) -> DataFrame:
    """DER-17: each cancellation request -> reversed / completed / pending.

    Reversed when a ``cancellation_reversed`` follows it before any other
    request; completed when the subscription then ended; pending otherwise."""
    e = t.subscription_events.filter(c("event_type").isin(
        "cancellation_requested", "cancellation_reversed", "subscription_ended"))
    nxt = Ordered(e, "subscription_id", ("event_at", "event_id"), ("event_type",)).neighbours(
        "event_type", "event_at").select("subscription_id", "event_id", "event_type", "event_at",
                                         c("next.event_type").alias("next_type"), c("next.event_at").alias("next_at"))
    r = nxt.filter(c("event_type") == "cancellation_requested")
    return r.select(
        "subscription_id", c("event_id").alias("request_event_id"), c("event_at").alias("requested_at"),
        F.when(c("next_type") == "cancellation_reversed", "reversed")
        .when(c("next_type") == "subscription_ended", "completed").otherwise("pending").alias("outcome"),
        F.when(c("next_type").isin("cancellation_reversed", "subscription_ended"), c("next_at")).alias("resolved_at"),
    )


# --------------------------------------------------------------------------- DER-18
def customer_ltv(t, paid: DataFrame | None = None) -> DataFrame:
    """DER-18: historical revenue per owner and currency (every owner that ever subscribed; 0 in the
    currency of its first plan when there is none). ``paid``: ``owner_payments`` where already at hand."""
    owners = subscription_facts(t).groupBy("owner_id", "owner_type").agg(
        F.min("start_date").alias("first_start"),
        F.min_by("currency", F.struct("start_date", "subscription_id")).alias("plan_currency"))
    rev = (revenue_facts(t).groupBy("owner_id", "currency").agg(F.sum("amount").alias("revenue")) if paid is None
           else paid.groupBy("owner_id", "currency").agg(F.sum("revenue").alias("revenue")))
    return (owners.join(rev, "owner_id", "left")
            .select("owner_id", "owner_type", "first_start", F.coalesce(c("currency"), c("plan_currency")).alias("currency"),
                    money(F.coalesce(c("revenue"), F.lit(0))).alias("ltv")))


def owner_value(t, paid: DataFrame | None = None) -> DataFrame:
    """One row per owner: its historical revenue as text, one amount per currency."""
    return customer_ltv(t, paid).groupBy("owner_id").agg(money_list(c("currency"), c("ltv")).alias("ltv"))


def mean_value(members: DataFrame, keys: list[str], t) -> DataFrame:
    """Per group of ``members`` (owner_id, keys): historical revenue per member, one amount per currency."""
    n = members.groupBy(*keys).agg(F.count("*").alias("members"))
    total = members.join(customer_ltv(t).select("owner_id", "currency", "ltv"), "owner_id").groupBy(
        *keys, "currency").agg(F.sum("ltv").alias("total"))
    same = [total[k].eqNullSafe(n[k]) for k in keys]
    return (total.join(n, reduce(lambda a, b: a & b, same)).select(*[total[k] for k in keys], "currency",
                                                                 (c("total").cast("double") / c("members")).alias("mean"))
            .groupBy(*keys).agg(money_list(c("currency"), c("mean")).alias("avg_ltv")))


# --------------------------------------------------------------------------- DER-19
def owner_islands(t, as_of: str | None = None) -> DataFrame:
    """Merged activity intervals per owner (overlapping / touching subscriptions joined).

    Subscriptions starting on the same day are first merged into one interval per (owner, start
    day) by a partial aggregate; the island sweep then runs over at most one row per owner and
    calendar day, so a hot owner's window is bounded by the date span, not its row count."""
    s = subscription_facts(t)
    a = _as_of(t, as_of)
    iv = (s.filter(c("start_date") < a)
          .groupBy("owner_id", "owner_type", "start_date")
          .agg(F.max(F.least(F.coalesce(c("end_date"), a), a)).alias("stop")))
    w = Window.partitionBy("owner_id").orderBy("start_date")
    prev_reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = iv.select("*", F.when(prev_reach.isNull() | (c("start_date") > prev_reach), 1).otherwise(0).alias("new"))
    islands = marked.select("*", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("island"))
    return islands.groupBy("owner_id", "owner_type", "island").agg(
        F.min("start_date").alias("island_start"), F.max("stop").alias("island_stop"))


def owner_tenure(t, as_of: str | None = None) -> DataFrame:
    """DER-19: days subscribed per owner with overlapping subscriptions merged."""
    return owner_islands(t, as_of).groupBy("owner_id", "owner_type").agg(
        F.sum(F.datediff("island_stop", "island_start")).cast("bigint").alias("tenure_days"),
        F.count("*").cast("bigint").alias("islands"),
        F.min("island_start").alias("first_start"))

"""Diagnostics (DIA-*): churn concentration, revenue drivers, survival, behaviour before churn,
support, promotions, campaigns, reactivation, engagement, payment failures, channels, accounts.

``range_sums`` is the shared interval aggregate: for probe windows
``[start, end)`` per key it sums fact values whose day falls inside, as two
look-ups into one running sum per key over day-level aggregates, so a key
with many facts and many windows never produces facts x windows pairs and its
window state is bounded by the calendar span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c, dbl, epoch_seconds, money, money_list, month, monthly_factor, organisation_band, ratio
from ..functions.ordering import descending_rank
from . import derive as D


def _as_of(t, as_of):
    return F.lit(as_of or t.as_of).cast("date")


def range_sums(facts: DataFrame, probes: DataFrame, key: str, values: list[str]) -> DataFrame:
    """facts (key, day, values...) and probes (key, probe_id, start, end) ->
    probe_id + sum of each value over facts with ``start <= day < end``.

    Facts are summed per (key, day) first (partial aggregate) and probe bounds reduced to distinct
    (key, day) rows, so the running sum per key runs over at most two rows per calendar day;
    each probe then reads its two bounds back by (key, day) equi-joins."""
    daily = facts.groupBy(c(key).alias("k"), c("day").alias("pos")).agg(
        *[F.sum(c(v).cast("double")).alias(v) for v in values])
    bounds = (probes.select(c(key).alias("k"), c("start").alias("pos"))
              .unionByName(probes.select(c(key).alias("k"), c("end").alias("pos"))).distinct())
    rows = (daily.select("k", "pos", F.lit(1).alias("kind"), *values)
            .unionByName(bounds.select("k", "pos", F.lit(0).alias("kind"),
                                       *[F.lit(None).cast("double").alias(v) for v in values])))
    w = Window.partitionBy("k").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (rows.select("k", "pos", "kind", *[F.coalesce(F.sum(v).over(w), F.lit(0.0)).alias(v) for v in values])
           .filter(c("kind") == 0).drop("kind"))
    lo = cum.select(c("k").alias("lk"), c("pos").alias("start"), *[c(v).alias(f"lo_{v}") for v in values])
    hi = cum.select(c("k").alias("hk"), c("pos").alias("end"), *[c(v).alias(f"hi_{v}") for v in values])
    p = probes.select(c(key).alias("pk"), "probe_id", "start", "end")
    j = (p.join(lo, (p.pk == lo.lk) & (p.start == lo.start)).drop(lo.start)
         .join(hi, (p.pk == hi.hk) & (p.end == hi.end)))
    return j.select("probe_id", *[(c(f"hi_{v}") - c(f"lo_{v}")).alias(v) for v in values])


# ----------------------------------------------------------------------- DIA-1
def _tenure_band(days):
    return F.when(days < 90, "0-3m").when(days < 365, "3-12m").otherwise("12m+")


def churn_concentration(t, as_of=None, min_size: int = 50, k: int = 20) -> DataFrame:
    """DIA-1: segments (cube of product x frequency x channel x tenure band x campaign) whose share of
    churn exceeds their share of subscriptions most (lift), top-k among segments >= min_size."""
    a = _as_of(t, as_of)
    s = D.subscription_facts(t).filter(c("start_date") < a)
    ch = D.churn_events(t, as_of).select("subscription_id", F.lit(1).alias("churned"))
    at = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel", "campaign_name")
    base = (s.join(ch, "subscription_id", "left").join(at, "owner_id", "left")
            .select("product_name", "billing_frequency",
                    F.coalesce(c("channel"), F.lit("Organisation")).alias("channel"),
                    _tenure_band(F.datediff(F.coalesce(c("end_date"), a), c("start_date"))).alias("tenure_band"),
                    F.coalesce(c("campaign_name"), F.lit("none")).alias("campaign"),
                    F.coalesce(c("churned"), F.lit(0)).alias("churned")))
    # leaf cells first: the cube copies some hundred cells, not subscriptions
    dims = ["product_name", "billing_frequency", "channel", "tenure_band", "campaign"]
    leaf = base.groupBy(*dims).agg(F.count("*").alias("n"), F.sum("churned").alias("churned"))
    all_subs, all_churned = leaf.agg(F.sum("n")).scalar(), leaf.agg(F.sum("churned")).scalar()
    cube = (leaf.cube(*dims)
            .agg(F.sum("n").alias("subscriptions"), F.sum("churned").cast("bigint").alias("churned"),
                 F.grouping_id().cast("int").alias("grouping_level"))
            .filter((c("grouping_level") < 31) & (c("subscriptions") >= min_size)))
    out = (cube.withColumn("churn_share", ratio(c("churned"), all_churned))
           .withColumn("base_share", ratio(c("subscriptions"), all_subs))
           .withColumn("lift", ratio(c("churned") * all_subs, c("subscriptions") * all_churned)))
    return out.orderBy(F.desc_nulls_last("lift"), "grouping_level", F.asc_nulls_first("product_name"),
                       F.asc_nulls_first("billing_frequency"), F.asc_nulls_first("channel"),
                       F.asc_nulls_first("tenure_band"), F.asc_nulls_first("campaign")).limit(k)


# ----------------------------------------------------------------------- DIA-2
def revenue_change_drivers(t, month_start: str | None = None, as_of: str | None = None) -> DataFrame:
    """DIA-2: revenue change from the previous month to ``month_start``'s month (unless given, the last
    complete month before ``as_of``) by currency, acquisition channel, product and frequency."""
    last = F.add_months(F.trunc(_as_of(t, as_of), "month"), -1)
    cur = last if month_start is None else F.lit(month_start).cast("date")
    prev = F.add_months(cur, -1)
    at = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel")
    r = (D.revenue_facts(t).filter(c("month").isin(cur, prev)).join(at, "owner_id", "left")
         .withColumn("channel", F.coalesce(c("channel"), F.lit("Organisation"))))
    g = r.groupBy("currency", "channel", "product_name", "billing_frequency").agg(
        money(F.sum(F.when(c("month") == prev, c("amount")).otherwise(0))).alias("previous_revenue"),
        money(F.sum(F.when(c("month") == cur, c("amount")).otherwise(0))).alias("current_revenue"))
    g = g.withColumn("change", money(c("current_revenue") - c("previous_revenue")))
    return g.withColumn("share_of_change", ratio(c("change"), F.sum("change").over(Window.partitionBy("currency"))))


# ----------------------------------------------------------------------- DIA-3
def churned_revenue(t, as_of=None) -> DataFrame:
    """DIA-3: monthly recurring revenue lost through churn, by churn month, type and currency."""
    ch = D.churn_events(t, as_of).select("subscription_id", "churn_month", "churn_type")
    s = D.subscription_facts(t).select("subscription_id", "unit_price", "seats_purchased", "billing_frequency",
                                         "currency")
    per = (ch.join(s, "subscription_id").groupBy("churn_month", "churn_type", "currency", "billing_frequency")
           .agg(F.count("*").alias("n"),
                F.sum(c("unit_price") * F.coalesce(c("seats_purchased"), F.lit(1))).alias("recurring")))
    return (per.groupBy("churn_month", "churn_type", "currency")
            .agg(F.sum("n").cast("bigint").alias("churned_subscriptions"),
                 dbl(F.sum(c("recurring").cast("double") * monthly_factor(c("billing_frequency"))), 2)
                 .alias("mrr_lost")))


# ----------------------------------------------------------------------- DIA-4
def survival_curve(t, as_of=None) -> DataFrame:
    """DIA-4: Kaplan-Meier survival of subscriptions by tenure month (30-day months); ends other
    than churn (plan changes, still open) are censored."""
    a = _as_of(t, as_of)
    s = D.subscription_facts(t).filter(c("start_date") < a)
    ch = D.churn_events(t, as_of).select("subscription_id", F.lit(1).alias("event"))
    d = (s.join(ch, "subscription_id", "left")
         .select(F.floor(F.datediff(F.coalesce(c("end_date"), a), c("start_date")) / 30).cast("int")
                 .alias("duration_months"), F.coalesce(c("event"), F.lit(0)).alias("event")))
    g = d.groupBy("duration_months").agg(F.count("*").alias("n"), F.sum("event").cast("bigint").alias("churned"))
    after = Window.orderBy(F.desc("duration_months")).rowsBetween(Window.unboundedPreceding, 0)  # one row per duration
    upto = Window.orderBy("duration_months").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("at_risk", F.sum("n").over(after).cast("bigint"))
    g = g.withColumn("censored", (c("n") - c("churned")).cast("bigint"))
    step = F.when(c("churned") >= c("at_risk"), F.lit(None)).otherwise(F.log(1 - c("churned") / c("at_risk")))
    wiped = F.max(F.when(c("churned") >= c("at_risk"), 1).otherwise(0)).over(upto)
    return g.select("duration_months", "at_risk", "churned", "censored",
                    ratio(c("churned"), c("at_risk")).alias("hazard"),
                    F.when(wiped == 1, F.lit(0.0)).otherwise(dbl(F.exp(F.sum(step).over(upto)))).alias("survival"))


# ----------------------------------------------------------------------- DIA-5
def pre_churn_behaviour(t, as_of=None, days: int = 30) -> DataFrame:
    """DIA-5: engagement, failed payments and support cases in the ``days`` before a customer's
    churn, against customers still subscribed at ``as_of`` (window = the ``days`` before it)."""
    a = _as_of(t, as_of)
    values = ("sessions", "failed", "cases", "churned", "retained")

    def rows(df, day, **has):
        return df.select("customer_id", day.alias("day"), *[has.get(v, F.lit(0)).cast("bigint").alias(v) for v in values])

    # windows of one subscription_id are each other's when it repeats: a row counts as often as the id stands there
    same = Window.partitionBy("subscription_id")
    known = F.count("owner_id").over(same)
    churned = (D.churn_events(t, as_of).filter(c("owner_type") == "customer")
               .select(c("owner_id").alias("customer_id"), "churn_date",
                       F.when(c("owner_id").isNotNull(), F.count("*").over(same)).when(known == 0, 1).otherwise(0)
                       .alias("windows")))
    live = (D.subscription_facts(t).filter((c("owner_type") == "customer") & (c("start_date") < a)
                                           & (c("end_date").isNull() | (c("end_date") >= a)))
            .select(c("owner_id").alias("customer_id")).distinct())
    subs = D.subscription_facts(t).select("subscription_id", c("customer_id"))
    fails = t.payments.filter(c("payment_status") == "failed").join(subs, "subscription_id")
    theirs = c("customer_id").isNotNull()
    # facts and window ends of a customer's day in one row; the days before it are a range of one sweep per customer
    daily = reduce(DataFrame.unionByName, [
        rows(t.customer_engagement.filter(theirs), c("engagement_date"), sessions=c("sessions_count")),
        rows(fails.filter(theirs), F.to_date("payment_attempted_at"), failed=F.lit(1)),
        rows(t.support_interactions.filter(theirs), F.to_date("interaction_at"), cases=F.lit(1)),
        rows(churned, c("churn_date"), churned=c("windows")),
        rows(live, a, retained=F.lit(1)),
    ]).groupBy("customer_id", "day").agg(*[F.sum(v).alias(v) for v in values])
    past = Window.partitionBy("customer_id").orderBy(F.unix_date("day")).rangeBetween(-days, -1)
    seen = (daily.select(*[F.coalesce(F.sum(v).over(past), F.lit(0)).alias(v) for v in values[:3]], "churned", "retained")
            .select(*values[:3], F.explode(F.array(*[F.struct(F.lit(x).alias("cohort"), c(x).alias("n"))
                                                     for x in values[3:]])).alias("w"))
            .select("w.*", *values[:3]).filter(c("n") > 0))
    mean = lambda v: dbl(F.sum(c(v) * c("n")).cast("double") / F.sum("n"), 4)
    return seen.groupBy("cohort").agg(
        F.sum("n").alias("windows"), mean("sessions").alias("avg_sessions"),
        mean("failed").alias("avg_failed_payments"), mean("cases").alias("avg_support_cases"))


# ----------------------------------------------------------------------- DIA-6
def support_vs_churn(t, as_of=None) -> DataFrame:
    """DIA-6: per issue category: cases, customers, their churn rate, resolution hours, open cases."""
    churned = D.churn_events(t, as_of).select(c("owner_id").alias("customer_id")).distinct() \
        .withColumn("churned", F.lit(1))
    s = t.support_interactions
    per_cust = (s.groupBy("issue_category", "customer_id").agg(F.count("*").alias("cases"))
                .join(churned, "customer_id", "left"))
    cust = per_cust.groupBy("issue_category").agg(
        F.sum("cases").cast("bigint").alias("cases"), F.count("*").alias("customers"),
        F.count("churned").alias("churned_customers"))
    hours = (epoch_seconds(c("resolved_at")) - epoch_seconds(c("interaction_at"))) / 3600.0
    res = s.groupBy("issue_category").agg(dbl(F.avg(hours), 4).alias("avg_resolution_hours"),
                                          F.count_if(c("resolution_status") != "resolved").alias("open_cases"))
    return (cust.join(res, "issue_category")
            .withColumn("churn_rate", ratio(c("churned_customers"), c("customers"))))


# ----------------------------------------------------------------------- DIA-7
PROMO_CHANNEL = "Promotional Campaign"
PROMO_DAYS = (30, 60, 90, 180)


def promotion_retention(t, as_of=None) -> DataFrame:
    """DIA-7: promotional vs other acquisition: share still active N days after the first start
    (right-censored) and mean value per currency. Promotional = first-touch channel 'Promotional Campaign';
    ``with_campaign`` = the first touch carried a campaign name."""
    a = _as_of(t, as_of)
    at = D.attribution(t).select(c("customer_id").alias("owner_id"), "first_start",
                                 (c("channel") == PROMO_CHANNEL).alias("promotional"),
                                 c("campaign_name").isNotNull().alias("with_campaign"))
    ns = F.explode(F.array(*[F.lit(n) for n in PROMO_DAYS])).alias("days")
    probes = (at.select("*", ns).withColumn("day", F.date_add(c("first_start"), c("days"))).filter(c("day") < a)
              .withColumn("probe_id", F.concat_ws("|", "owner_id", c("days").cast("string"))))
    s = D.subscription_facts(t).select("owner_id", "start_date", "end_date")
    act = D._continues(s, probes.select("owner_id", "probe_id", c("day").alias("at"), c("day").alias("after")))
    keys = ["promotional", "with_campaign", "days"]
    kept = (probes.join(act, "probe_id").groupBy(*keys)
            .agg(F.count("*").alias("eligible"), F.count_if("continued").alias("retained"))
            .withColumn("retention_rate", ratio(c("retained"), c("eligible"))))
    return kept.join(D.mean_value(probes.select("owner_id", *keys), keys, t), keys, "left")


# ----------------------------------------------------------------------- DIA-8
def campaign_performance(t, as_of=None) -> DataFrame:
    """DIA-8: per first-touch campaign: customers acquired, campaign cost, their revenue per currency and the
    share still subscribed at ``as_of``."""
    a = _as_of(t, as_of)
    at = D.attribution(t).filter(c("campaign_name").isNotNull()).select(c("customer_id").alias("owner_id"),
                                                                        "campaign_name")
    cost = (t.marketing_touchpoints.filter(c("campaign_name").isNotNull()).groupBy("campaign_name")
            .agg(money(F.coalesce(F.sum("attributed_cost"), F.lit(0))).alias("cost")))
    revenue = (at.join(D.customer_ltv(t).select("owner_id", "currency", "ltv"), "owner_id")
               .groupBy("campaign_name", "currency").agg(money(F.sum("ltv")).alias("total"))
               .groupBy("campaign_name").agg(money_list(c("currency"), c("total")).alias("revenue")))
    live = (D.subscription_facts(t).filter((c("start_date") < a) & (c("end_date").isNull() | (c("end_date") >= a)))
            .select("owner_id").distinct().withColumn("live", F.lit(1)))
    per = (at.join(live, "owner_id", "left").groupBy("campaign_name")
           .agg(F.count("*").alias("customers"), ratio(F.count("live"), F.count("*")).alias("still_active_share")))
    return per.join(revenue, "campaign_name", "left").join(cost, "campaign_name", "left").withColumn("cost_per_customer", ratio(c("cost"), c("customers"), 2))


# ----------------------------------------------------------------------- DIA-9
def reactivation_factors(t, as_of=None) -> DataFrame:
    """DIA-9: churns that came back vs were lost, by churn type, the churned plan (product and frequency)
    and the acquisition channel, with the mean gap before coming back."""
    from .kpi import reactivations
    at = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel")
    r = (reactivations(t, as_of).join(at, "owner_id", "left")
         .withColumn("channel", F.coalesce(c("channel"), F.lit("Organisation"))))
    return (r.groupBy("churn_type", "product_name", "billing_frequency", "channel").agg(
        F.count("*").alias("churns"), F.count("next_start").alias("reactivated"),
        dbl(F.avg(F.datediff("next_start", "churn_date")), 2).alias("avg_gap_days"))
        .withColumn("reactivation_rate", ratio(c("reactivated"), c("churns"))))


# ----------------------------------------------------------------------- DIA-10
def engagement_trend(t) -> DataFrame:
    """DIA-10: daily engagement totals with a 7-day moving average over calendar days
    (``rangeBetween`` on the day number, so missing days are not counted as rows)."""
    g = t.customer_engagement.groupBy("engagement_date").agg(
        F.count("*").alias("active_customers"), F.sum("sessions_count").cast("bigint").alias("sessions"),
        F.sum("articles_viewed").cast("bigint").alias("articles"), money(F.sum("reading_minutes")).alias("minutes"))
    day = F.datediff(c("engagement_date"), F.lit("1970-01-01").cast("date"))
    w = Window.orderBy(day).rangeBetween(-6, 0)  # one row per calendar day
    return g.withColumn("sessions_7d_avg", dbl(F.sum("sessions").over(w) / 7.0, 4))


def top_readers(t, k: int = 20, as_of=None, days: int = 30) -> DataFrame:
    """DIA-10: the k customers with most reading minutes in the last ``days`` days (ties by id)."""
    a = _as_of(t, as_of)
    e = t.customer_engagement.filter((c("engagement_date") >= F.date_sub(a, days)) & (c("engagement_date") < a))
    return (e.groupBy("customer_id").agg(money(F.sum("reading_minutes")).alias("minutes"),
                                         F.sum("sessions_count").cast("bigint").alias("sessions"))
            .orderBy(F.desc("minutes"), "customer_id").limit(k))


# ----------------------------------------------------------------------- DIA-11
def payment_failure_rates(t) -> DataFrame:
    """DIA-11: failure rate by payment method."""
    return (t.payments.groupBy("payment_method").agg(
        F.count("*").alias("attempts"), F.count_if(c("payment_status") == "failed").alias("failures"))
        .withColumn("failure_rate", ratio(c("failures"), c("attempts"))))


def payment_failure_reasons(t) -> DataFrame:
    """DIA-11: failed attempts by reason with their share."""
    g = (t.payments.filter(c("payment_status") == "failed").groupBy("failure_reason")
         .agg(F.count("*").alias("failures")))
    return g.withColumn("share", ratio(c("failures"), F.sum("failures").over(Window.partitionBy())))


def payment_recovery(t) -> DataFrame:
    """DIA-11: retry-chain outcomes (DER-16): how many recover and how fast."""
    r = D.payment_retries(t).filter(c("failures") > 0)
    return (r.groupBy("outcome").agg(F.count("*").alias("chains"),
                                     dbl(F.avg("days_to_recover"), 4).alias("avg_days_to_recover"))
            .withColumn("share", ratio(c("chains"), F.sum("chains").over(Window.partitionBy()))))


# ----------------------------------------------------------------------- DIA-12
FUNNEL_TOUCHES = ["impression", "click", "visit"]


def acquisition_funnel(t) -> DataFrame:
    """DIA-12: impression -> click -> visit -> registered -> trial -> paid (distinct customers)."""
    tp = t.marketing_touchpoints
    counts = tp.agg(*[F.countDistinct(F.when(c("touchpoint_type") == x, c("customer_id"))).alias(x)
                      for x in FUNNEL_TOUCHES])
    reg = t.customers.agg(F.count("*")).scalar()
    tri = t.trials.agg(F.countDistinct("customer_id")).scalar()
    paid = D.revenue_facts(t).filter(c("owner_type") == "customer").agg(F.countDistinct("owner_id")).scalar()
    row = counts.select(*FUNNEL_TOUCHES, reg.alias("registered"), tri.alias("trial"), paid.alias("paid"))
    stages = FUNNEL_TOUCHES + ["registered", "trial", "paid"]
    stack = ", ".join(f"{i}, '{s}', {s}" for i, s in enumerate(stages))
    long = row.selectExpr(f"stack({len(stages)}, {stack}) as (stage_no, stage, customers)")
    w = Window.orderBy("stage_no")  # six rows
    return (long.select(c("stage_no").cast("int").alias("stage_no"), "stage",
                        c("customers").cast("bigint").alias("customers"))
            .withColumn("step_conversion", ratio(c("customers"), F.lag("customers").over(w))))


# ----------------------------------------------------------------------- DIA-13
def channel_comparison(t, as_of=None) -> DataFrame:
    """DIA-13: one row per channel and currency: acquired customers, conversion, CAC, retention (of the
    channel), revenue and value (in the currency)."""
    from . import kpi as K
    a = _as_of(t, as_of)
    at = D.attribution(t)
    live = (D.subscription_facts(t).filter((c("start_date") < a) & (c("end_date").isNull() | (c("end_date") >= a)))
            .select(c("owner_id").alias("customer_id")).distinct().withColumn("live", F.lit(1)))
    acq = (at.join(live, "customer_id", "left").groupBy("channel")
           .agg(F.count("*").alias("acquired"), ratio(F.count("live"), F.count("*")).alias("retained_share")))
    conv = K.conversion_rate(t).select("channel", "conversion_rate")
    cac = K.customer_acquisition_cost(t).select("channel", "cac")
    rev = K.revenue_by_acquisition_channel(t).select("channel", "currency", "revenue")
    ltv = K.customer_lifetime_value_by_acquisition_channel(t).select("channel", "currency", "avg_ltv")
    value = ltv.join(rev, ["channel", "currency"], "full")
    return reduce(lambda x, y: x.join(y, "channel", "left"), [conv, cac, value], acq)


# ----------------------------------------------------------------------- DIA-14
TERMS = ("Monthly", "Annual")


def _renewal_by_term(t) -> DataFrame:
    """Renewal rate of each organisation's subscriptions by billing term."""
    s = D.subscription_facts(t).filter(c("owner_type") == "organisation").select(
        "subscription_id", c("owner_id").alias("organisation_id"), "billing_frequency")
    e = t.subscription_events.filter(c("event_type").isin("renewed", "subscription_ended")).join(s, "subscription_id")
    lapsed = (c("event_type") == "subscription_ended") & (c("event_reason") != "plan_change")
    return e.groupBy("organisation_id").agg(*[
        ratio(F.count_if((c("event_type") == "renewed") & (c("billing_frequency") == f)),
              F.count_if(((c("event_type") == "renewed") | lapsed) & (c("billing_frequency") == f)))
        .alias(f"renewal_rate_{f.lower()}") for f in TERMS])


def corporate_accounts(t, as_of=None) -> DataFrame:
    """DIA-14: organisation account table, a row per organisation and currency it paid in (one row with a
    NULL currency when it never paid): revenue and its rank in the currency, current seats and use, seat
    expansion / reduction, renewal rate by term, revenue per seat."""
    from .migration import seat_changes
    a = _as_of(t, as_of)
    orgs = t.organisations.select("organisation_id", "organisation_type",
                                  organisation_band(c("organisation_size")).alias("size_band"))
    rev = (D.revenue_facts(t).filter(c("owner_type") == "organisation")
           .groupBy(c("owner_id").alias("organisation_id"), "currency").agg(F.sum("amount").alias("revenue")))
    util = (D.seat_utilisation(t).filter(c("status") != "ended").groupBy("organisation_id")
            .agg(F.count("*").alias("open_subscriptions"), F.sum("seats_purchased").cast("bigint").alias("seats_purchased"),
                 F.sum("seats_activated").cast("bigint").alias("seats_activated")))
    ch = seat_changes(t).groupBy("organisation_id").agg(F.sum("seats_added").cast("bigint").alias("seats_added"),
                                                        F.sum("seats_removed").cast("bigint").alias("seats_removed"))
    j = reduce(lambda x, y: x.join(y, "organisation_id", "left"), [rev, util, ch, _renewal_by_term(t)], orgs)
    j = j.select("organisation_id", "organisation_type", "size_band", "currency",
                 *[c(f"renewal_rate_{f.lower()}") for f in TERMS],
                 money(F.coalesce(c("revenue"), F.lit(0))).alias("revenue"),
                 F.coalesce(c("open_subscriptions"), F.lit(0)).cast("bigint").alias("open_subscriptions"),
                 F.coalesce(c("seats_purchased"), F.lit(0)).cast("bigint").alias("seats_purchased"),
                 F.coalesce(c("seats_activated"), F.lit(0)).cast("bigint").alias("seats_activated"),
                 F.coalesce(c("seats_added"), F.lit(0)).cast("bigint").alias("seats_added"),
                 F.coalesce(c("seats_removed"), F.lit(0)).cast("bigint").alias("seats_removed"))
    # distributed exact rank (ties collapsed, range-partitioned) instead of a one-partition window
    return (descending_rank(j, "revenue", "revenue_rank", by=("currency",))
            .withColumn("utilisation", ratio(c("seats_activated"), c("seats_purchased")))
            .withColumn("revenue_per_seat", ratio(c("revenue"), c("seats_purchased"), 2)))

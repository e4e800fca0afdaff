"""KPI framework (KPI-*): monthly growth, revenue, retention, value, marketing and corporate KPIs.

Every KPI is a DataFrame keyed by ``month`` (first day of the month) unless it
is an "as of" figure. Money is grouped by ``currency`` and never converted.
Rates are doubles rounded to 6 places, NULL when the denominator is 0.

Scale notes: all KPIs aggregate the base derivations in ``derive``; each
aggregate is partial (map side) before its shuffle, and the month-level
results are tiny (one row per month and dimension), so the month-over-month
``lag`` windows run on already-aggregated data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import DEFAULT_GRACE_DAYS, c, dbl, money, month, monthly_factor, ratio
from ..functions.ordering import quantiles
from ..functions.sketches import LG_K, distinct_sketches, error_bound, rollup_estimates
from . import derive as D


def _prev_month(col: str = "month"):
    """Shift a month key forward, so a row about month m-1 lines up with month m."""
    return F.add_months(c(col), 1)


def _last_open_month(t, as_of):
    """First month not yet finished at ``as_of``: reported months are strictly before it."""
    return F.trunc(F.lit(as_of or t.as_of).cast("date"), "month")


# ----------------------------------------------------------------------- growth
def new_subscribers(t) -> DataFrame:
    """KPI-1: owners whose first subscription starts in the month."""
    return (D.first_subscription(t).groupBy(month(c("first_start")).alias("month"), "owner_type")
            .agg(F.count("*").alias("new_subscribers")))


def active_subscribers(t, as_of: str | None = None, by: tuple[str, ...] = (), live: DataFrame | None = None) -> DataFrame:
    """KPI-2: distinct owners active at month end (per ``by`` group when given). ``live``: the owner months of the
    same ``as_of`` and ``by`` (``derive.active_owner_months``) where already at hand."""
    return ((D.active_owner_months(t, as_of, by) if live is None else live).groupBy("month", *by)
            .agg(F.count("*").alias("active_subscribers")))


ACTIVE_LEAF = ("month", "product_name", "billing_frequency")


MASK_BITS = 62  # bits used of one long


def _rollup_cells(t) -> tuple[DataFrame, DataFrame, list[str]]:
    """(plan kinds, cells, mask columns): every product and billing frequency on sale has a bit of its own. A kind has
    its bit, a cell of the rollup (product_name, billing_frequency, grouping_level) those of its kinds. As many rows
    as there are plans, at most."""
    kinds = (t.plans.join(F.broadcast(t.products), "product_id").select(*ACTIVE_LEAF[1:]).distinct()
             .orderBy(*ACTIVE_LEAF[1:]).collect())
    masks = [f"mask_{i}" for i in range(max(1, -(-len(kinds) // MASK_BITS)))]
    names = "product_name string, billing_frequency string"
    bits = ", ".join(f"{m} long" for m in masks)
    bit = lambda n: [1 << n % MASK_BITS if i == n // MASK_BITS else 0 for i in range(len(masks))]
    cells = {}
    for n, (product, frequency) in enumerate(kinds):
        for cell in ((product, frequency, 0), (product, None, 1), (None, None, 3)):
            cells[cell] = [a | b for a, b in zip(cells.get(cell, [0] * len(masks)), bit(n))]
    return (t.spark.createDataFrame([(*k, *bit(n)) for n, k in enumerate(kinds)], f"{names}, {bits}"),
            t.spark.createDataFrame([(*k, *m) for k, m in cells.items()], f"{names}, grouping_level int, {bits}"), masks)


def active_subscribers_rollup(t, as_of: str | None = None) -> DataFrame:
    """KPI-2 per month, product and billing frequency with subtotals; an owner counts once in each cell and in
    each subtotal (``grouping_level`` 0 leaf, 1 product, 3 month).

    What an owner holds in a month is a set of plan kinds, kept as bits: one partial aggregate per (owner, month)
    finds it, equal sets of a month collapse, and only those few rows meet the cells. No row is copied per level."""
    kinds, cells, masks = _rollup_cells(t)
    kinds = kinds.withColumnsRenamed({k: f"kind_{k}" for k in ACTIVE_LEAF[1:]})
    same = reduce(lambda a, b: a & b, [c(k).eqNullSafe(c(f"kind_{k}")) for k in ACTIVE_LEAF[1:]])
    held = (D.active_calendar(t, as_of).select("owner_id", *ACTIVE_LEAF)
            .join(F.broadcast(kinds), same)
            .groupBy("owner_id", "month").agg(*[F.bit_or(m).alias(m) for m in masks]))
    sets = held.groupBy("month", *masks).agg(F.count("owner_id").alias("n"))  # owners known by NULL only count 0
    cells = cells.withColumnsRenamed({m: f"cell_{m}" for m in masks})
    meets = reduce(lambda a, b: a | b, [c(m).bitwiseAND(c(f"cell_{m}")) != 0 for m in masks])
    return (sets.join(F.broadcast(cells), meets).groupBy(*ACTIVE_LEAF, "grouping_level").agg(F.sum("n").alias("n"))
            .select(*ACTIVE_LEAF, F.coalesce("n", F.lit(0)).alias("active_subscribers"), "grouping_level"))


def active_subscriber_sketches(t, as_of: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """KPI-2, leaf table of the approximate option: one distinct sketch per month, product and billing frequency,
    to be stored and united (``functions.sketches``) into any coarser cell or longer period."""
    return distinct_sketches(D.active_calendar(t, as_of), "owner_id", ACTIVE_LEAF, lg_k)


def active_subscribers_approx(t, as_of: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """KPI-2, approximate distinct: every cell of ``active_subscribers_rollup`` from the leaf sketches, within
    ``error_bound(lg_k)`` of the exact count."""
    return rollup_estimates(active_subscriber_sketches(t, as_of, lg_k), ACTIVE_LEAF)


def active_subscribers_sketch(t, as_of: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """KPI-2: the exact rollup with a flag whether the approximate count of the cell keeps its bound."""
    exact = active_subscribers_rollup(t, as_of)
    near = active_subscribers_approx(t, as_of, lg_k).select(*[c(k).alias(f"near_{k}") for k in ACTIVE_LEAF],
                                                            "estimate", c("grouping_level").alias("near_level"))
    same = c("grouping_level") == c("near_level")
    for k in ACTIVE_LEAF:
        same &= c(k).eqNullSafe(c(f"near_{k}"))
    return exact.join(near, same, "left").select(
        *ACTIVE_LEAF, "active_subscribers", "grouping_level",
        F.coalesce(F.abs(c("estimate") - c("active_subscribers")) <= F.lit(error_bound(lg_k)) * c("active_subscribers"),
                   F.lit(False)).alias("within_bound"))


def new_subscribers_by_channel(t) -> DataFrame:
    """KPI-1 by acquisition channel (first touch, DER-11); organisations as 'Organisation'."""
    ch = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel")
    return (D.first_subscription(t).join(ch, "owner_id", "left")
            .groupBy(month(c("first_start")).alias("month"),
                     F.coalesce(c("channel"), F.lit("Organisation")).alias("channel"))
            .agg(F.count("*").alias("new_subscribers")))


def paid_subscribers(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-3: owners active at month end with at least one successful payment by then (with ``by``: active in the
    group, and paid for a subscription of the group)."""
    keys = list(dict.fromkeys(["owner_id", *by]))
    first_paid = D.revenue_facts(t).groupBy(*keys).agg(F.min("paid_at").alias("first_paid_at"))
    am = D.active_owner_months(t, as_of, by)
    return (am.join(first_paid, keys)
            .filter(c("first_paid_at") < F.date_add(F.last_day("month"), 1).cast("timestamp_ntz"))
            .groupBy("month", *by).agg(F.count("*").alias("paid_subscribers")))


def subscriber_growth_rate(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-4: (active - active previous month) / active previous month."""
    a = active_subscribers(t, as_of, by)
    prev = a.select(_prev_month().alias("month"), *by, c("active_subscribers").alias("previous_active"))
    return (a.join(prev, ["month", *by], "left")
            .withColumn("growth_rate", ratio(c("active_subscribers") - c("previous_active"), c("previous_active"))))


def trial_registrations(t) -> DataFrame:
    """KPI-5: trials by start month and product."""
    return (t.trials.groupBy(month(c("trial_started_at")).alias("month"), "product_id")
            .agg(F.count("*").alias("trials")))


def trial_to_paid_conversion_rate(t, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-6: converted / started by trial start month (and ``by``: a column of the trials); the decided rate leaves
    out still-active trials."""
    g = t.trials.groupBy(month(c("trial_started_at")).alias("month"), *by).agg(
        F.count("*").alias("trials"),
        F.count_if(c("trial_status") == "converted").alias("converted"),
        F.count_if(c("trial_status") != "active").alias("decided"))
    return (g.withColumn("conversion_rate", ratio(c("converted"), c("trials")))
            .withColumn("decided_conversion_rate", ratio(c("converted"), c("decided"))))


def reactivations(t, as_of: str | None = None, grace_days: int = DEFAULT_GRACE_DAYS) -> DataFrame:
    """Each churn with the owner's first subscription start after it (NULL if none yet)."""
    ch = D.churn_events(t, as_of, grace_days)
    probes = ch.select("owner_id", c("subscription_id").alias("probe_id"), c("churn_date").alias("at"))
    nxt = D.next_start_after(t, probes)
    return (ch.join(nxt, ch.subscription_id == nxt.probe_id, "left").drop("probe_id")
            .withColumn("reactivated_month", month(c("next_start"))))


def reactivated_subscribers(t, as_of: str | None = None) -> DataFrame:
    """KPI-7: owners starting again after a churn, by month of the restart, next to the
    count of stored ``reactivated`` events in that month (full outer reconciliation)."""
    r = (reactivations(t, as_of).filter(c("next_start").isNotNull())
         .groupBy(c("reactivated_month").alias("month"))
         .agg(F.countDistinct("owner_id").alias("reactivated_owners")))
    ev = (t.subscription_events.filter(c("event_type") == "reactivated")
          .groupBy(month(c("event_at")).alias("month")).agg(F.count("*").alias("reactivated_events")))
    return (r.join(ev, "month", "full")
            .select("month", F.coalesce(c("reactivated_owners"), F.lit(0)).alias("reactivated_owners"),
                    F.coalesce(c("reactivated_events"), F.lit(0)).alias("reactivated_events")))


# ----------------------------------------------------------------------- revenue
def gross_subscription_revenue(t, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-8: successful payment amounts by attempt month (and ``by``: owner_type, product_name, ...)."""
    return (D.revenue_facts(t).groupBy("month", "currency", *by)
            .agg(money(F.sum("amount")).alias("gross_revenue"), F.count("*").alias("payments")))


def net_subscription_revenue(t, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-9: gross - refunds (no refund data in v1, so 0), plus failed and pending amounts; ``by`` names
    attributes of the paid subscription."""
    p = t.payments.select("subscription_id", "currency", "payment_attempted_at", "payment_status", "amount")
    if by:
        p = p.join(D.subscription_facts(t).select("subscription_id", *by), "subscription_id")
    return (p.groupBy(month(c("payment_attempted_at")).alias("month"), "currency", *by).agg(
        money(F.sum(F.when(c("payment_status") == "successful", c("amount")).otherwise(0))).alias("gross_revenue"),
        money(F.sum(F.when(c("payment_status") == "failed", c("amount")).otherwise(0))).alias("failed_amount"),
        money(F.sum(F.when(c("payment_status") == "pending", c("amount")).otherwise(0))).alias("pending_amount"))
        .withColumn("refunds", F.lit(0).cast("decimal(18,2)"))
        .withColumn("net_revenue", money(c("gross_revenue") - c("refunds"))))


def revenue_growth(t, by: tuple[str, ...] = (), cells: DataFrame | None = None) -> DataFrame:
    """KPI-10: month-over-month change of gross revenue (from ``derive.revenue_cells`` where given)."""
    if cells is not None:
        g = cells.groupBy("month", "currency", *by).agg(money(F.sum("all_revenue")).alias("revenue"))
    else:
        g = gross_subscription_revenue(t, by).select("month", "currency", *by, c("gross_revenue").alias("revenue"))
    prev = g.select(_prev_month().alias("month"), "currency", *by, c("revenue").alias("previous_revenue"))
    return (g.join(prev, ["month", "currency", *by], "left")
            .withColumn("growth_rate", ratio(c("revenue") - c("previous_revenue"), c("previous_revenue"))))


def revenue_by_product(t) -> DataFrame:
    """KPI-11: revenue by month, currency and product, with the product's share of the month."""
    g = (D.revenue_facts(t).groupBy("month", "currency", "product_name")
         .agg(money(F.sum("amount")).alias("revenue"), F.count("*").alias("payments")))
    w = Window.partitionBy("month", "currency")
    return g.withColumn("share", ratio(c("revenue"), F.sum("revenue").over(w)))


def revenue_by_billing_frequency(t) -> DataFrame:
    """KPI-12: revenue by month x currency x product x frequency with product and month subtotals
    (a rollup of the leaf cells, so payment rows are aggregated once)."""
    leaf = D.revenue_facts(t).groupBy("month", "currency", "product_name", "billing_frequency").agg(
        F.sum("amount").alias("amount"))
    return (leaf.rollup("month", "currency", "product_name", "billing_frequency")
            .agg(money(F.sum("amount")).alias("revenue"), F.grouping_id().alias("grouping_level"))
            .filter(c("grouping_level") < 7)
            .select("month", "currency", "product_name", "billing_frequency", "revenue",
                    c("grouping_level").cast("int").alias("grouping_level")))


def _mrr_by(t, keys: list[str], as_of: str | None = None) -> DataFrame:
    """Sum exact decimals per billing frequency first, apply the monthly factor last."""
    cal = D.active_calendar(t, as_of)
    per_freq = cal.groupBy(*dict.fromkeys([*keys, "billing_frequency"])).agg(
        F.sum(c("unit_price") * F.coalesce(c("seats_purchased"), F.lit(1))).alias("recurring"))
    return (per_freq.groupBy(*keys)
            .agg(F.sum(c("recurring").cast("double") * monthly_factor(c("billing_frequency"))).alias("mrr_raw")))


def monthly_recurring_revenue(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-13: recurring revenue of subscriptions active at month end, normalised to a month."""
    keys = ["month", "currency", *by]
    return _mrr_by(t, keys, as_of).select(*keys, dbl(c("mrr_raw"), 2).alias("mrr"))


def annual_recurring_revenue(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-14: 12 x MRR."""
    keys = ["month", "currency", *by]
    return _mrr_by(t, keys, as_of).select(*keys, dbl(c("mrr_raw") * 12, 2).alias("arr"))


def average_revenue_per_user(t, as_of: str | None = None, by: tuple[str, ...] = (),
                             cells: DataFrame | None = None) -> DataFrame:
    """KPI-15: revenue / owners active on any day of the month (both of the ``by`` group when given). ``cells``:
    ``derive.revenue_cells`` where already at hand."""
    keys = ["month", "currency", *by]
    act = (D.active_any_day(t, as_of).select("owner_id", *keys).distinct()
           .groupBy(*keys).agg(F.count("*").alias("active_owners")))
    rev = (D.revenue_facts(t).groupBy(*keys).agg(F.sum("amount").alias("revenue")) if cells is None
           else cells.groupBy(*keys).agg(F.sum("all_revenue").alias("revenue")))
    return (act.join(rev, keys, "left")
            .select(*keys, "active_owners", money(F.coalesce(c("revenue"), F.lit(0))).alias("revenue"))
            .withColumn("arpu", ratio(c("revenue"), c("active_owners"))))


def average_revenue_per_paying_user(t, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-16: revenue / owners with a successful payment in the month."""
    return (D.revenue_facts(t).groupBy("month", "currency", *by)
            .agg(money(F.sum("amount")).alias("revenue"), F.countDistinct("owner_id").alias("paying_owners"))
            .withColumn("arppu", ratio(c("revenue"), c("paying_owners"))))


# ----------------------------------------------------------------------- retention
def _renewals(events: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return (events.groupBy(month(c("event_at")).alias("month"), *by).agg(
        F.count_if(c("event_type") == "renewed").alias("renewed"),
        F.count_if((c("event_type") == "subscription_ended") & (c("event_reason") != "plan_change")).alias("lapsed"))
        .filter((c("renewed") + c("lapsed")) > 0)
        .withColumn("renewal_rate", ratio(c("renewed"), c("renewed") + c("lapsed"))))


def renewal_rate(t, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-17: renewed / (renewed + ended other than by plan change), by event month."""
    events = t.subscription_events.filter(c("event_type").isin("renewed", "subscription_ended"))
    if by:
        events = events.join(D.subscription_facts(t).select("subscription_id", *by), "subscription_id")
    return _renewals(events, by)


def _retention(am: DataFrame, live: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Owners active at the end of m-1 (in each ``by`` group) that are still active at the end of m."""
    start = am.select("owner_id", _prev_month().alias("month"), *by)  # active at end of previous month
    kept = start.join(live.select("owner_id", "month", F.lit(1).alias("still")), ["owner_id", "month"], "left")
    return (kept.groupBy("month", *by).agg(F.count("*").alias("active_at_start"),
                                           F.count("still").alias("retained"))
            .withColumn("retention_rate", ratio(c("retained"), c("active_at_start"))))


def retention_rate(t, as_of: str | None = None, by: tuple[str, ...] = (), live: DataFrame | None = None) -> DataFrame:
    """KPI-18: owners active at month start and at month end / active at month start.

    Month start = end of the previous month; only months whose end is before ``as_of``. With
    ``by`` (e.g. product_name) the cohort is split by what the owner held at month start and an
    owner counts as retained when still active at month end in any product. ``live``: the owner months of the same
    ``as_of`` without ``by``, where already at hand."""
    live = D.active_owner_months(t, as_of) if live is None else live
    am = D.active_owner_months(t, as_of, by) if by else live
    return _retention(am, live, by).filter(c("month") < _last_open_month(t, as_of))


def _churn_rate(t, as_of, churn_filter=None, owner_filter=None, by: tuple[str, ...] = (), live=None) -> DataFrame:
    am = D.active_owner_months(t, as_of, by) if live is None else live
    ch = D.churn_events(t, as_of)
    if owner_filter is not None:
        am, ch = am.filter(owner_filter), ch.filter(owner_filter)
    if churn_filter is not None:
        ch = ch.filter(churn_filter)
    keys = ["month", *by]
    base = am.groupBy(_prev_month().alias("month"), *by).agg(F.count("*").alias("active_at_start"))
    churned = ch.groupBy(c("churn_month").alias("month"), *by).agg(F.countDistinct("owner_id").alias("churned"))
    return (base.join(churned, keys, "full")
            .filter(c("month") < _last_open_month(t, as_of))
            .select(*keys, F.coalesce(c("active_at_start"), F.lit(0)).alias("active_at_start"),
                    F.coalesce(c("churned"), F.lit(0)).alias("churned"))
            .withColumn("churn_rate", ratio(c("churned"), c("active_at_start"))))


def churn_rate(t, as_of: str | None = None, by: tuple[str, ...] = (), live: DataFrame | None = None) -> DataFrame:
    """KPI-19: owners churned (DER-3) in the month / active at month start; with ``by`` (product,
    billing frequency) the churned subscription's and the month-start subscriptions' attributes. ``live``: as for
    ``active_subscribers``."""
    return _churn_rate(t, as_of, by=by, live=live)


def voluntary_churn_rate(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-20: churn rate counting voluntary churn only."""
    return _churn_rate(t, as_of, c("churn_type") == "Voluntary", by=by)


def involuntary_churn_rate(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-21: involuntary (payment failure) churn rate, with expiry churn reported beside it."""
    keys = ["month", *by]
    inv = _churn_rate(t, as_of, c("churn_type") == "Involuntary", by=by)
    exp = _churn_rate(t, as_of, c("churn_type") == "Expiry / Non-renewal", by=by).select(
        *keys, c("churned").alias("expiry_churned"), c("churn_rate").alias("expiry_churn_rate"))
    return inv.join(exp, keys, "full").select(
        *keys, "active_at_start", "churned", "churn_rate", "expiry_churned", "expiry_churn_rate")


def cohort_retention(t, as_of: str | None = None) -> DataFrame:
    """KPI-22: by first-start month (cohort) and months since: share of the cohort active at month end."""
    first = D.first_subscription(t).select("owner_id", month(c("first_start")).alias("cohort_month"))
    size = first.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    act = (D.active_owner_months(t, as_of).join(first, "owner_id")
           .withColumn("months_since", F.months_between(c("month"), c("cohort_month")).cast("int"))
           .groupBy("cohort_month", "months_since").agg(F.count("*").alias("active_owners")))
    return (act.join(F.broadcast(size), "cohort_month")
            .withColumn("retention", ratio(c("active_owners"), c("cohort_size"))))


def average_customer_tenure(t, as_of: str | None = None) -> DataFrame:
    """KPI-23: mean merged tenure (DER-19) in days, by owner type."""
    return (D.owner_tenure(t, as_of).groupBy("owner_type")
            .agg(F.count("*").alias("owners"), dbl(F.avg("tenure_days"), 4).alias("avg_tenure_days")))


# ----------------------------------------------------------------------- value
def customer_lifetime_value(t) -> DataFrame:
    """KPI-24: mean / median / p90 historical value per owner type and currency. The percentiles are the
    smallest value with at least ``p * n`` values at or below it, exact at every size."""
    ltv = D.customer_ltv(t)
    keys = ("owner_type", "currency")
    cuts = quantiles(ltv, "ltv", (0.5, 0.9), keys)
    return (ltv.groupBy(*keys).agg(F.count("*").alias("owners"), dbl(F.avg("ltv"), 2).alias("avg_ltv"))
            .join(cuts, list(keys))
            .select(*keys, "owners", "avg_ltv", money(c("cuts")[0]).alias("median_ltv"),
                    money(c("cuts")[1]).alias("p90_ltv")))


def revenue_per_customer(t) -> DataFrame:
    """KPI-25: total revenue / owners that ever subscribed."""
    return (D.customer_ltv(t).groupBy("currency")
            .agg(F.count("*").alias("owners"), money(F.sum("ltv")).alias("revenue"))
            .withColumn("revenue_per_customer", ratio(c("revenue"), c("owners"), 2)))


def average_subscription_duration(t, as_of: str | None = None,
                                  by: tuple[str, ...] = ("billing_frequency",)) -> DataFrame:
    """KPI-26: mean duration in days of ended subscriptions, and of all (open ones end at ``as_of``)."""
    a = F.lit(as_of or t.as_of).cast("date")
    s = D.subscription_facts(t).filter(c("start_date") < a)
    days = F.datediff(F.coalesce(c("end_date"), a), c("start_date"))
    return s.groupBy(*by).agg(
        F.count("end_date").alias("ended_subscriptions"),
        dbl(F.avg(F.when(c("end_date").isNotNull(), days)), 4).alias("avg_ended_days"),
        F.count("*").alias("all_subscriptions"), dbl(F.avg(days), 4).alias("avg_all_days"))


def _move_rate(t, kind: str, as_of: str | None = None) -> DataFrame:
    from .migration import plan_moves
    am = D.active_owner_months(t, as_of)
    base = am.groupBy(_prev_month().alias("month")).agg(F.count("*").alias("active_at_start"))
    mv = (plan_moves(t).filter(c("product_move") == kind)
          .groupBy(c("move_month").alias("month")).agg(F.countDistinct("owner_id").alias("movers")))
    return (base.join(mv, "month", "full").filter(c("month") < _last_open_month(t, as_of))
            .select("month", F.coalesce(c("active_at_start"), F.lit(0)).alias("active_at_start"),
                    F.coalesce(c("movers"), F.lit(0)).alias(f"{kind}s"))
            .withColumn(f"{kind}_rate", ratio(c(f"{kind}s"), c("active_at_start"))))


def upgrade_rate(t, as_of: str | None = None) -> DataFrame:
    """KPI-27: owners with an upgrade in the month / active at month start."""
    return _move_rate(t, "upgrade", as_of)


def downgrade_rate(t, as_of: str | None = None) -> DataFrame:
    """KPI-28: owners with a downgrade in the month / active at month start."""
    return _move_rate(t, "downgrade", as_of)


def reactivation_rate(t, as_of: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """KPI-29: by churn month (and attributes of the churned subscription), churned owners that later started
    again / churned owners."""
    r = reactivations(t, as_of)
    return (r.groupBy("churn_month", *by).agg(
        F.countDistinct("owner_id").alias("churned_owners"),
        F.countDistinct(F.when(c("next_start").isNotNull(), c("owner_id"))).alias("reactivated_owners"))
        .withColumn("reactivation_rate", ratio(c("reactivated_owners"), c("churned_owners"))))


# ----------------------------------------------------------------------- marketing
def _first_paid(t) -> DataFrame:
    return (D.revenue_facts(t).filter(c("owner_type") == "customer")
            .groupBy(c("owner_id").alias("customer_id")).agg(F.min("paid_at").alias("first_paid_at")))


def customer_acquisition_cost(t) -> DataFrame:
    """KPI-30: cost of touches up to each paying customer's first payment, per touch channel,
    / new paying customers attributed (first touch) to the channel. NULL cost = unknown, so the
    share of touches with a known cost is reported too."""
    fp = _first_paid(t)
    touches = (t.marketing_touchpoints.join(fp, "customer_id")
               .filter(c("touchpoint_at") <= c("first_paid_at")))
    cost = touches.groupBy("channel").agg(
        money(F.coalesce(F.sum("attributed_cost"), F.lit(0))).alias("cost"),
        F.count("*").alias("touches"), F.count("attributed_cost").alias("costed_touches"))
    acq = (D.attribution(t).join(fp, "customer_id", "left_semi")
           .groupBy("channel").agg(F.count("*").alias("new_paying")))
    return (cost.join(acq, "channel", "full")
            .select("channel", F.coalesce(c("cost"), F.lit(0).cast("decimal(18,2)")).alias("cost"),
                    F.coalesce(c("touches"), F.lit(0)).alias("touches"),
                    F.coalesce(c("costed_touches"), F.lit(0)).alias("costed_touches"),
                    F.coalesce(c("new_paying"), F.lit(0)).alias("new_paying"))
            .withColumn("cost_coverage", ratio(c("costed_touches"), c("touches")))
            .withColumn("cac", ratio(c("cost"), c("new_paying"), 2)))


def conversion_rate(t) -> DataFrame:
    """KPI-31: customers touched by the channel who paid at or after their first touch there / touched."""
    first_touch = t.marketing_touchpoints.groupBy("customer_id", "channel").agg(
        F.min("touchpoint_at").alias("first_touch_at"))
    last_paid = (D.revenue_facts(t).filter(c("owner_type") == "customer")
                 .groupBy(c("owner_id").alias("customer_id")).agg(F.max("paid_at").alias("last_paid_at")))
    j = first_touch.join(last_paid, "customer_id", "left")
    return (j.groupBy("channel").agg(
        F.count("*").alias("touched"),
        F.count_if(c("last_paid_at") >= c("first_touch_at")).alias("converted"))
        .withColumn("conversion_rate", ratio(c("converted"), c("touched"))))


def cost_per_acquisition(t) -> DataFrame:
    """KPI-32: all cost spent in the channel / customers acquired through it: first touch before their
    first subscription or first trial, whichever came first (trial-only customers count too)."""
    cost = t.marketing_touchpoints.groupBy("channel").agg(
        money(F.coalesce(F.sum("attributed_cost"), F.lit(0))).alias("cost"))
    first = (D.first_subscription(t).filter(c("owner_type") == "customer")
             .select(c("owner_id").alias("customer_id"), c("first_start").cast("timestamp_ntz").alias("at"))
             .unionByName(t.trials.select("customer_id", c("trial_started_at").cast("timestamp_ntz").alias("at")))
             .groupBy("customer_id").agg(F.min("at").alias("at")))
    touch = (t.marketing_touchpoints.join(first, "customer_id").filter(c("touchpoint_at") <= c("at"))
             .groupBy("customer_id").agg(F.min_by("channel", F.struct("touchpoint_at", "touchpoint_id"))
                                         .alias("channel")))
    acq = (first.join(touch, "customer_id", "left")
           .groupBy(F.coalesce(c("channel"), F.lit("Unattributed")).alias("channel"))
           .agg(F.count("*").alias("acquisitions")))
    return (cost.join(acq, "channel", "full")
            .select("channel", F.coalesce(c("cost"), F.lit(0).cast("decimal(18,2)")).alias("cost"),
                    F.coalesce(c("acquisitions"), F.lit(0)).alias("acquisitions"))
            .withColumn("cpa", ratio(c("cost"), c("acquisitions"), 2)))


def trial_conversion_rate_by_channel(t) -> DataFrame:
    """KPI-33: trial conversion by the customer's acquisition channel."""
    a = D.attribution(t).select("customer_id", "channel")
    tr = t.trials.join(a, "customer_id", "left").withColumn("channel", F.coalesce(c("channel"), F.lit("Unattributed")))
    return (tr.groupBy("channel").agg(F.count("*").alias("trials"),
                                      F.count_if(c("trial_status") == "converted").alias("converted"))
            .withColumn("conversion_rate", ratio(c("converted"), c("trials"))))


def revenue_by_acquisition_channel(t) -> DataFrame:
    """KPI-34: revenue of customers by their first-touch channel."""
    a = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel")
    return (D.revenue_facts(t).join(a, "owner_id").groupBy("channel", "currency")
            .agg(money(F.sum("amount")).alias("revenue"), F.countDistinct("owner_id").alias("paying_customers")))


def customer_lifetime_value_by_acquisition_channel(t) -> DataFrame:
    """KPI-35: mean historical value of customers by acquisition channel."""
    a = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel")
    return (D.customer_ltv(t).join(a, "owner_id").groupBy("channel", "currency")
            .agg(F.count("*").alias("customers"), dbl(F.avg("ltv"), 2).alias("avg_ltv")))


def ltv_to_cac_ratio(t) -> DataFrame:
    """KPI-36: KPI-35 average value / KPI-30 acquisition cost, by channel."""
    ltv = customer_lifetime_value_by_acquisition_channel(t).select("channel", "currency", "avg_ltv")
    cac = customer_acquisition_cost(t).select("channel", "cac")
    return ltv.join(cac, "channel", "left").withColumn("ltv_to_cac", ratio(c("avg_ltv"), c("cac"), 4))


# ----------------------------------------------------------------------- corporate
def active_corporate_accounts(t, as_of: str | None = None) -> DataFrame:
    """KPI-37: organisations active at month end, by type and size band."""
    from ..functions.columns import organisation_band
    orgs = t.organisations.select(c("organisation_id").alias("owner_id"), "organisation_type",
                                  organisation_band(c("organisation_size")).alias("size_band"))
    return (D.active_owner_months(t, as_of).filter(c("owner_type") == "organisation").join(orgs, "owner_id")
            .groupBy("month", "organisation_type", "size_band").agg(F.count("*").alias("active_accounts")))


def corporate_revenue(t) -> DataFrame:
    """KPI-38: revenue from organisation owners."""
    return (D.revenue_facts(t).filter(c("owner_type") == "organisation").groupBy("month", "currency")
            .agg(money(F.sum("amount")).alias("revenue"), F.countDistinct("owner_id").alias("paying_accounts")))


def average_contract_value(t) -> DataFrame:
    """KPI-39: mean of unit price x seats per billing term, and annualised (Monthly x 12)."""
    s = D.subscription_facts(t).filter(c("owner_type") == "organisation")
    value = c("unit_price") * F.coalesce(c("seats_purchased"), F.lit(1))
    per_year = F.when(c("billing_frequency") == "Monthly", 12).when(c("billing_frequency") == "Annual", 1)
    return s.groupBy("billing_frequency", "currency").agg(
        F.count("*").alias("contracts"), dbl(F.avg(value), 2).alias("avg_contract_value"),
        dbl(F.avg(value * per_year), 2).alias("avg_annual_contract_value"))


def org_seats_by_month(t, as_of: str | None = None) -> DataFrame:
    """Seats of each organisation subscription at each month end it is active (DER-10 per month).

    Month ends are probed at midnight after the last day, so an event counts as "before" exactly
    when its day is before the probe day. Seat events are therefore first reduced to one row per
    (subscription, day) (the day's last new count and first previous count), and one sweep per
    subscription runs over those day rows and the month-end probes: bounded by the calendar span
    whatever the number of seat events."""
    cal = D.active_calendar(t, as_of).filter(c("owner_type") == "organisation").select(
        "subscription_id", "owner_id", "month", "seats_purchased", "currency")
    key = F.struct("event_at", "event_id")
    ev = (t.subscription_events.filter(c("event_type") == "seats_changed")
          .groupBy("subscription_id", F.to_date("event_at").alias("day"))
          .agg(F.max_by("new_seat_count", key).alias("new_n"), F.min_by("previous_seat_count", key).alias("prev_n")))
    probe_day = F.date_add(F.last_day("month"), 1)
    rows = (cal.select("subscription_id", probe_day.alias("day"), F.lit(0).alias("kind"), "month", "owner_id",
                       "seats_purchased", "currency", F.lit(None).cast("int").alias("new_n"),
                       F.lit(None).cast("int").alias("prev_n"))
            .unionByName(ev.select("subscription_id", "day", F.lit(1).alias("kind"),
                                   F.lit(None).cast("date").alias("month"), F.lit(None).cast("string").alias("owner_id"),
                                   F.lit(None).cast("int").alias("seats_purchased"),
                                   F.lit(None).cast("string").alias("currency"), "new_n", "prev_n")))
    # probes sort before the events of their own day: those happen at or after the probe instant
    w = Window.partitionBy("subscription_id").orderBy("day", "kind")
    before = F.last("new_n", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("prev_n", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return (rows.select("*", before.alias("last_new"), after.alias("next_prev")).filter(c("kind") == 0)
            .select("subscription_id", "owner_id", "month", "currency",
                    F.coalesce(c("last_new"), c("next_prev"), c("seats_purchased")).cast("bigint").alias("seats")))


def seats_purchased(t, as_of: str | None = None) -> DataFrame:
    """KPI-40: seats of organisation subscriptions active at month end (history-aware)."""
    return (org_seats_by_month(t, as_of).groupBy("month")
            .agg(F.sum("seats").alias("seats_purchased"), F.count("*").alias("subscriptions")))


def org_users_by_month(t, as_of: str | None = None) -> DataFrame:
    """Active seat users at each month end, only on subscriptions active then."""
    a = F.lit(as_of or t.as_of).cast("date")
    u = t.organisation_users
    cap = F.least(F.coalesce(c("deactivation_date"), a), a)
    months = u.filter(month(c("activation_date")) <= F.add_months(month(cap), -1)).select(
        "subscription_id", F.explode(F.sequence(month(c("activation_date")), F.add_months(month(cap), -1),
                                                F.expr("interval 1 month"))).alias("month"))
    live = D.active_calendar(t, as_of).select("subscription_id", "month")
    return months.join(live, ["subscription_id", "month"], "left_semi")


def seats_activated(t, as_of: str | None = None) -> DataFrame:
    """KPI-41: active seat users at month end."""
    return org_users_by_month(t, as_of).groupBy("month").agg(F.count("*").alias("seats_activated"))


def seat_utilisation_monthly(t, as_of: str | None = None) -> DataFrame:
    """KPI-42: seats activated / seats purchased at month end."""
    return (seats_purchased(t, as_of).join(seats_activated(t, as_of), "month", "left")
            .select("month", "seats_purchased", F.coalesce(c("seats_activated"), F.lit(0)).alias("seats_activated"))
            .withColumn("seat_utilisation", ratio(c("seats_activated"), c("seats_purchased"))))


def revenue_per_seat(t, as_of: str | None = None) -> DataFrame:
    """KPI-43: corporate revenue in the month / seats purchased at its end."""
    seats = org_seats_by_month(t, as_of).groupBy("month", "currency").agg(F.sum("seats").alias("seats_purchased"))
    rev = corporate_revenue(t).select("month", "currency", "revenue")
    return (seats.join(rev, ["month", "currency"], "left")
            .select("month", "currency", "seats_purchased",
                    F.coalesce(c("revenue"), F.lit(0).cast("decimal(18,2)")).alias("revenue"))
            .withColumn("revenue_per_seat", ratio(c("revenue"), c("seats_purchased"), 4)))


def corporate_renewal_rate(t) -> DataFrame:
    """KPI-44: renewal rate of organisation subscriptions, Monthly vs Annual."""
    s = D.subscription_facts(t).filter(c("owner_type") == "organisation").select("subscription_id",
                                                                                   "billing_frequency")
    e = t.subscription_events.filter(c("event_type").isin("renewed", "subscription_ended")).join(s, "subscription_id")
    return (e.groupBy(month(c("event_at")).alias("month"), "billing_frequency").agg(
        F.count_if(c("event_type") == "renewed").alias("renewed"),
        F.count_if((c("event_type") == "subscription_ended") & (c("event_reason") != "plan_change")).alias("lapsed"))
        .filter((c("renewed") + c("lapsed")) > 0)
        .withColumn("renewal_rate", ratio(c("renewed"), c("renewed") + c("lapsed"))))


def corporate_churn_rate(t, as_of: str | None = None) -> DataFrame:
    """KPI-45: churn rate over organisation owners."""
    return _churn_rate(t, as_of, owner_filter=c("owner_type") == "organisation")

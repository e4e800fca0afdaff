"""Plan migration, lifecycle journeys and seat changes (MIG-*).

A plan move is a subscription that ended with ``plan_change`` followed by
the owner's next subscription. Product moves compare the products' tier
(the product's Monthly unit price); cycle moves compare billing period days.
Both "same" = ``no_move`` (a renewal onto the same plan), left out of rates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c, dbl, month, monthly_factor, ratio
from ..functions.ordering import Ordered, sequence_ranks
from ..session import scratch_result
from . import derive as D


def product_tiers(t) -> DataFrame:
    """Tier value of each product = its Monthly plan's unit price (every product sells Monthly)."""
    return (t.plans.filter(c("billing_frequency") == "Monthly")
            .select("product_id", c("unit_price").alias("tier_price")))


def plan_moves(t) -> DataFrame:
    """MIG-1: classify every plan change as upgrade / downgrade / lateral / same product and
    longer / shorter / same cycle, with the recurring revenue before and after."""
    s = D.subscription_facts(t)
    nb = D.owner_neighbours(t).select("subscription_id", c("next_subscription_id").alias("next_id"))
    seq = s.filter(c("end_reason") == "plan_change").join(nb, "subscription_id")
    tiers = F.broadcast(product_tiers(t))
    a = seq.join(tiers, "product_id")
    b = s.join(tiers, "product_id").select(*[c(x).alias(f"to_{x}") for x in (
        "subscription_id", "product_id", "product_name", "billing_frequency", "billing_period_days", "unit_price",
        "currency", "seats_purchased", "tier_price")])
    m = a.join(b, a.next_id == b.to_subscription_id)
    mrr = lambda price, seats, freq: price.cast("double") * F.coalesce(seats, F.lit(1)) * monthly_factor(freq)
    return m.select(
        "owner_id", "owner_type", c("subscription_id").alias("from_subscription_id"), "to_subscription_id",
        c("end_date").alias("move_date"), month(c("end_date")).alias("move_month"),
        c("product_name").alias("from_product"), "to_product_name",
        c("billing_frequency").alias("from_frequency"), "to_billing_frequency",
        F.when(c("to_tier_price") > c("tier_price"), "upgrade").when(c("to_tier_price") < c("tier_price"), "downgrade")
        .when(c("to_product_id") != c("product_id"), "lateral").otherwise("same").alias("product_move"),
        F.when(c("to_billing_period_days") > c("billing_period_days"), "longer")
        .when(c("to_billing_period_days") < c("billing_period_days"), "shorter").otherwise("same").alias("cycle_move"),
        dbl(mrr(c("unit_price"), c("seats_purchased"), c("billing_frequency")), 2).alias("from_mrr"),
        dbl(mrr(c("to_unit_price"), c("to_seats_purchased"), c("to_billing_frequency")), 2).alias("to_mrr"),
        c("currency").alias("from_currency"), "to_currency",
    ).withColumnRenamed("to_product_name", "to_product").withColumnRenamed("to_billing_frequency", "to_frequency")


def migration_matrix(t, dim: str = "product") -> DataFrame:
    """MIG-2: transition counts from -> to and the share of each ``from`` row."""
    f, to = (("from_product", "to_product") if dim == "product" else ("from_frequency", "to_frequency"))
    g = plan_moves(t).groupBy(c(f).alias("from_value"), c(to).alias("to_value")).agg(F.count("*").alias("moves"))
    return g.withColumn("row_share", ratio(c("moves"), F.sum("moves").over(Window.partitionBy("from_value"))))


def _active_on(t, probes: DataFrame) -> DataFrame:
    """probes (owner_id, probe_id, day) -> owner active on that day (any subscription covering it)."""
    s = D.subscription_facts(t).select("owner_id", "start_date", "end_date")
    return D._continues(s, probes.select("owner_id", "probe_id", c("day").alias("at"), c("day").alias("after")))


RETENTION_DAYS = (30, 60, 90)


def post_migration_retention(t, as_of: str | None = None, days=RETENTION_DAYS) -> DataFrame:
    """MIG-3: share of owners still active N days after a plan move, vs non-movers N days after
    a fresh start. Rows without N days of history before ``as_of`` are left out (right-censoring)."""
    a = F.lit(as_of or t.as_of).cast("date")
    ns = F.explode(F.array(*[F.lit(n) for n in days])).alias("days")
    movers = (plan_moves(t).filter((c("product_move") != "same") | (c("cycle_move") != "same"))
              .select("owner_id", F.lit("mover").alias("cohort"), c("from_subscription_id").alias("sid"),
                      c("move_date").alias("day0"), ns))
    fresh = (D.owner_timeline(t).filter(c("prev_end_reason").isNull() | (c("prev_end_reason") != "plan_change"))
             .select("owner_id", F.lit("non_mover").alias("cohort"), c("subscription_id").alias("sid"),
                     c("start_date").alias("day0"), ns))
    probes = (movers.unionByName(fresh).withColumn("day", F.date_add(c("day0"), c("days")))
              .filter(c("day") < a)
              .withColumn("probe_id", F.concat_ws("|", "cohort", "sid", c("days").cast("string"))))
    act = _active_on(t, probes)
    return (probes.join(act, "probe_id").groupBy("cohort", "days")
            .agg(F.count("*").alias("eligible"), F.count_if("continued").alias("retained"))
            .withColumn("retention_rate", ratio(c("retained"), c("eligible"))))


def _revenue_impact(t, kind: str) -> DataFrame:
    """Per month and currency; a move between currencies counts as a move but has no change in money."""
    change = F.when(c("from_currency") == c("to_currency"), c("to_mrr") - c("from_mrr"))
    return (plan_moves(t).filter(c("product_move") == kind).groupBy("move_month", "from_currency", "to_currency")
            .agg(F.count("*").alias("moves"), dbl(F.sum(change), 2).alias("mrr_change")))


def upgrade_revenue_impact(t) -> DataFrame:
    """MIG-4: monthly recurring revenue gained through upgrades, by month."""
    return _revenue_impact(t, "upgrade")


def downgrade_revenue_impact(t) -> DataFrame:
    """MIG-5: monthly recurring revenue change through downgrades, by month."""
    return _revenue_impact(t, "downgrade")


def journey_steps(t, as_of: str | None = None) -> DataFrame:
    """Lifecycle steps per owner: Free Trial, each subscription's billing frequency,
    Churn, and Reactivation before the first start after a churn."""
    s = D.subscription_facts(t)
    trials = t.trials.select(c("customer_id").alias("owner_id"), c("trial_started_at").alias("at"),
                             F.lit(0).alias("seq"), F.lit("Free Trial").alias("label"))
    starts = s.select("owner_id", c("start_date").cast("timestamp_ntz").alias("at"), F.lit(2).alias("seq"),
                      c("billing_frequency").alias("label"))
    from .kpi import reactivations
    r = reactivations(t, as_of)
    churns = r.select("owner_id", c("churn_date").cast("timestamp_ntz").alias("at"), F.lit(3).alias("seq"),
                      F.lit("Churn").alias("label"))
    react = (r.filter(c("next_start").isNotNull())
             .select("owner_id", c("next_start").cast("timestamp_ntz").alias("at"), F.lit(1).alias("seq"),
                     F.lit("Reactivation").alias("label")).distinct())
    return reduce(DataFrame.unionByName, [trials, starts, churns, react])


def numbered_steps(t, as_of: str | None = None) -> DataFrame:
    """Journey steps (owner_id, pos, label) with their 1-based position in the owner's (at, seq, label) order,
    however many steps an owner has on one day. Equal steps are numbered in any order."""
    steps = journey_steps(t, as_of).withColumn("nth", F.monotonically_increasing_id())
    return Ordered(steps, "owner_id", ("at", "seq", "label", "nth")).neighbours("label").select(
        "owner_id", c("place").alias("pos"), "label")


def _top_journeys(t, k: int, as_of: str | None) -> tuple[DataFrame, DataFrame]:
    """(the k best paths: journey, owners, steps, still_active_share, rank, rep; the numbered steps).

    Owners are grouped by the rank of their path (``functions.ordering.sequence_ranks``): equal rank means equal
    path, and ranks stand in the order of the paths' labels, so groups tied by owners and steps are settled by
    comparing numbers. No path is assembled."""
    a = F.lit(as_of or t.as_of).cast("date")
    num = scratch_result(t.spark, "steps", lambda: numbered_steps(t, as_of))
    paths = scratch_result(t.spark, "paths", lambda: sequence_ranks(num, "owner_id", "pos", "label"))
    live = (D.subscription_facts(t).filter((c("start_date") < a) & (c("end_date").isNull() | (c("end_date") >= a)))
            .select("owner_id").distinct().withColumn("live", F.lit(1)))
    groups = (paths.join(live, "owner_id", "left").groupBy("rank", "steps")
              .agg(F.count("*").alias("owners"), ratio(F.count("live"), F.count("*")).alias("still_active_share"),
                   F.min("owner_id").alias("rep")))
    order = (F.desc("owners"), "steps", "rank")
    best = scratch_result(t.spark, "top", lambda: groups.orderBy(*order).limit(k).withColumn(
        "journey", F.row_number().over(Window.orderBy(*order))))  # k rows
    members = paths.join(F.broadcast(best.select("rank", "journey")), "rank").select("owner_id", "journey")
    value = D.mean_value(members, ["journey"], t)
    return best.join(value, "journey", "left"), num


def journeys(t, k: int = 10, as_of: str | None = None) -> DataFrame:
    """MIG-6: top-k journey paths (e.g. ``Free Trial → Daily → Churn → Reactivation → Annual``)
    with owners, steps, mean historical value and the share still active at ``as_of``; ordered by
    owners (desc), then steps, then the path's labels.

    The text of a path is as long as the path: ``journey_paths`` gives the same paths step by step."""
    best, num = _top_journeys(t, k, as_of)
    steps = num.join(F.broadcast(best.select(c("rep").alias("owner_id"))), "owner_id", "left_semi")
    text = steps.groupBy(c("owner_id").alias("rep")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"]),
                     " → ").alias("path"))
    return (best.join(text, "rep")
            .select("path", c("owners").cast("bigint").alias("owners"), c("steps").cast("bigint").alias("steps"),
                    "avg_ltv", "still_active_share")
            .orderBy(F.desc("owners"), "steps", "path"))


def journey_paths(t, k: int = 10, as_of: str | None = None) -> DataFrame:
    """MIG-6 as rows: (journey, owners, position, label) of the top-k paths; journey 1 is the most frequent. No row
    holds a path, however long."""
    best, num = _top_journeys(t, k, as_of)
    top = best.select(c("rep").alias("owner_id"), "journey", "owners")
    return num.join(F.broadcast(top), "owner_id").select(
        "journey", c("owners").cast("bigint").alias("owners"), c("pos").alias("position"), "label")


# ---------------------------------------------------------------------------
# The BRD's lifecycle event vocabulary and how it maps onto data.
BRD_EVENTS = [
    "trial_started", "trial_converted", "subscription_started", "renewed", "upgraded", "downgraded",
    "billing_cycle_changed", "payment_successful", "payment_failed", "grace_period_started", "cancelled",
    "expired", "churned", "reactivated",
]
# ---------------------------------------------------------------------------


def lifecycle_events(t, as_of: str | None = None) -> DataFrame:
    """MIG-7: the BRD's 14-event log derived from the stored tables; each table is read once and its rows
    mapped to their event names."""
    s = D.subscription_facts(t).select("subscription_id", "owner_id")
    cols = ["owner_id", "subscription_id", "event_name", "event_at"]

    def named(ladder):  # NULL where no condition holds
        out = F.lit(None).cast("string")
        for name, condition in reversed(ladder):
            out = F.when(condition, name).otherwise(out)
        return out.alias("event_name")

    def each(df, owner, events):
        """Up to one row per (name, condition, time, subscription) of ``events``."""
        found = F.array_compact(F.array(*[F.when(condition, F.struct(
            F.lit(name).alias("event_name"), at.cast("timestamp_ntz").alias("event_at"),
            sub.cast("string").alias("subscription_id"))) for name, condition, at, sub in events]))
        return df.select(c(owner).alias("owner_id"), F.explode(found).alias("e")).select("owner_id", "e.*").select(*cols)

    kind = c("event_type")
    stored = t.subscription_events.select("subscription_id", c("event_at").cast("timestamp_ntz").alias("event_at"), named([
        ("subscription_started", kind == "subscription_started"), ("renewed", kind == "renewed"),
        ("grace_period_started", kind == "past_due_started"), ("cancelled", kind == "cancellation_requested"),
        ("expired", (kind == "subscription_ended") & (c("event_reason") == "non_renewal")),
        ("reactivated", kind == "reactivated")]))
    paid = t.payments.select(
        "subscription_id", c("payment_attempted_at").cast("timestamp_ntz").alias("event_at"),
        named([("payment_successful", c("payment_status") == "successful"),
               ("payment_failed", c("payment_status") == "failed")]))
    of_subscriptions = (stored.unionByName(paid).filter(c("event_name").isNotNull())
                        .join(s, "subscription_id").select(*cols))
    of_trials = each(t.trials, "customer_id", [
        ("trial_started", F.lit(True), c("trial_started_at"), F.lit(None)),
        ("trial_converted", c("trial_status") == "converted", F.coalesce(c("actual_end_at"), c("scheduled_end_at")),
         c("converted_subscription_id"))])
    of_moves = each(plan_moves(t), "owner_id", [
        ("upgraded", c("product_move") == "upgrade", c("move_date"), c("to_subscription_id")),
        ("downgraded", c("product_move") == "downgrade", c("move_date"), c("to_subscription_id")),
        ("billing_cycle_changed", c("cycle_move") != "same", c("move_date"), c("to_subscription_id"))])
    churned = D.churn_events(t, as_of).select("owner_id", "subscription_id", F.lit("churned").alias("event_name"),
                                              c("churn_date").cast("timestamp_ntz").alias("event_at"))
    return reduce(DataFrame.unionByName, [of_trials, of_subscriptions, of_moves, churned])


FUNNEL_STEPS = ["registered", "trial", "paid", "renewed", "upgraded", "churned", "reactivated"]


def lifecycle_funnel(t, as_of: str | None = None) -> DataFrame:
    """MIG-8: customers reaching each lifecycle step, with conversion from the previous step."""
    from .kpi import reactivations
    cust = t.customers.select(c("customer_id").alias("owner_id"))
    flag = lambda df, name: df.select("owner_id").distinct().withColumn(name, F.lit(True))
    s = D.subscription_facts(t).select("subscription_id", "owner_id")
    flags = [
        flag(t.trials.select(c("customer_id").alias("owner_id")), "trial"),
        flag(D.revenue_facts(t), "paid"),
        flag(t.subscription_events.filter(c("event_type") == "renewed").join(s, "subscription_id"), "renewed"),
        flag(plan_moves(t).filter(c("product_move") == "upgrade"), "upgraded"),
        flag(D.churn_events(t, as_of), "churned"),
        flag(reactivations(t, as_of).filter(c("next_start").isNotNull()), "reactivated"),
    ]
    per = reduce(lambda a, b: a.join(b, "owner_id", "left"), flags, cust)
    counts = per.agg(F.count("*").alias("registered"),
                     *[F.count(x).alias(x) for x in FUNNEL_STEPS[1:]])
    stack = ", ".join(f"{i}, '{s_}', {s_}" for i, s_ in enumerate(FUNNEL_STEPS))
    long = counts.selectExpr(f"stack({len(FUNNEL_STEPS)}, {stack}) as (step_no, step, customers)")
    w = Window.orderBy("step_no")  # 7 rows after aggregation
    return (long.select(c("step_no").cast("int").alias("step_no"), "step", c("customers").cast("bigint").alias("customers"))
            .withColumn("step_conversion", ratio(c("customers"), F.lag("customers").over(w))))


def seat_changes(t) -> DataFrame:
    """MIG-9: seat expansion and reduction by organisation and month."""
    s = t.subscriptions.select("subscription_id", "organisation_id")
    e = t.subscription_events.filter(c("event_type") == "seats_changed").join(s, "subscription_id")
    d = c("new_seat_count") - c("previous_seat_count")
    return e.groupBy("organisation_id", month(c("event_at")).alias("month")).agg(
        F.count("*").alias("changes"),
        F.sum(F.when(d > 0, d).otherwise(0)).cast("bigint").alias("seats_added"),
        F.sum(F.when(d < 0, -d).otherwise(0)).cast("bigint").alias("seats_removed"),
        F.count_if(d == 0).alias("no_change_events"))


def migration_net_flow(t) -> DataFrame:
    """MIG-10: per product, subscriptions gained from and lost to other products."""
    m = plan_moves(t).filter(c("from_product") != c("to_product"))
    flows = (m.select(c("to_product").alias("product_name"), F.lit(1).alias("gained"), F.lit(0).alias("lost"))
             .unionByName(m.select(c("from_product").alias("product_name"), F.lit(0).alias("gained"),
                                   F.lit(1).alias("lost"))))
    return (flows.groupBy("product_name").agg(F.sum("gained").cast("bigint").alias("gained"),
                                              F.sum("lost").cast("bigint").alias("lost"))
            .withColumn("net_flow", c("gained") - c("lost")))

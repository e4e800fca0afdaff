"""Business rules stated in the data dictionary but not enforced by the schema (DOC-*).

Each rule is a function returning the violating rows; ``document_rule_report``
counts them all (``kind = 'document'``, never blocking). Rules that compare two
loads of a table take both snapshots.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c
from . import derive as D

# Fixed values from the data dictionary.
PERIOD_DAYS = {"Daily": 1, "Weekly": 7, "Monthly": 30, "Annual": 365}
TRIAL_FAMILY = "Digital News"
CORPORATE_PRODUCT = "Corporate ePaper"


def _as_of(t, as_of):
    return F.lit(as_of or t.as_of).cast("date")


def trial_product_not_digital(t):
    """DOC-1: trials only on Digital News products."""
    p = F.broadcast(t.products.select("product_id", "product_family"))
    return t.trials.join(p, "product_id").filter(c("product_family") != TRIAL_FAMILY)


def trial_by_organisation(t):
    """DOC-2: organisations are not trial eligible."""
    orgs = t.organisations.select(c("organisation_id").alias("customer_id"))
    return t.trials.join(orgs, "customer_id", "left_semi")


def organisation_without_seats(t):
    """DOC-3: an organisation subscription must have seats (NULL slips through the CHECK)."""
    return t.subscriptions.filter(c("organisation_id").isNotNull() & c("seats_purchased").isNull())


def wrong_owner_for_product(t):
    """DOC-4: organisations buy Corporate ePaper only; individuals never do."""
    s = D.subscription_facts(t)
    return s.filter((c("product_name") == CORPORATE_PRODUCT) != c("organisation_id").isNotNull())


def cancellation_state_mismatch(t):
    """DOC-5: an outstanding cancellation request needs status 'active' and auto_renew FALSE."""
    return t.subscriptions.filter(c("cancellation_requested_at").isNotNull()
                                  & ((c("status") != "active") | c("auto_renew")))


def reversed_cancellation_not_cleared(t):
    """DOC-6: after a reversal (latest cancel event) the request timestamp must be NULL again."""
    e = t.subscription_events.filter(c("event_type").isin("cancellation_requested", "cancellation_reversed"))
    last = e.groupBy("subscription_id").agg(F.max_by("event_type", F.struct("event_at", "event_id")).alias("last"))
    return (t.subscriptions.join(last.filter(c("last") == "cancellation_reversed"), "subscription_id")
            .filter(c("cancellation_requested_at").isNotNull()))


def conversion_without_converted_status(t):
    """DOC-7: converted_subscription_id only on converted trials."""
    return t.trials.filter(c("converted_subscription_id").isNotNull() & (c("trial_status") != "converted"))


def conversion_owner_or_date_mismatch(t):
    """DOC-8: the converted subscription belongs to the trial's customer and starts no earlier."""
    s = t.subscriptions.select(c("subscription_id").alias("converted_subscription_id"),
                               c("customer_id").alias("sub_customer_id"), "subscription_start_date")
    j = t.trials.join(s, "converted_subscription_id")
    return j.filter(~F.coalesce(c("sub_customer_id") == c("customer_id"), F.lit(False))
                    | (c("subscription_start_date") < F.to_date("trial_started_at")))


def active_user_deactivated(t):
    """DOC-9: an active organisation user has no deactivation date."""
    return t.organisation_users.filter((c("user_status") == "active") & c("deactivation_date").isNotNull())


def user_subscription_other_org(t):
    """DOC-10: a seat user's subscription belongs to the same organisation."""
    s = t.subscriptions.select("subscription_id", c("organisation_id").alias("sub_org"))
    return t.organisation_users.join(s, "subscription_id").filter(~c("sub_org").eqNullSafe(c("organisation_id")))


def resolved_at_without_resolution(t):
    """DOC-11: resolved_at only when resolved."""
    return t.support_interactions.filter(c("resolved_at").isNotNull() & (c("resolution_status") != "resolved"))


def period_days_mismatch(t):
    """DOC-12: billing_period_days agrees with billing_frequency."""
    expected = F.create_map(*[x for k, v in PERIOD_DAYS.items() for x in (F.lit(k), F.lit(v))])
    return t.plans.filter(~F.coalesce(expected[c("billing_frequency")] == c("billing_period_days"), F.lit(False)))


def payment_amount_mismatch(t):
    """DOC-13: amount = unit price x seats (organisations) or unit price."""
    s = D.subscription_facts(t).select("subscription_id", "unit_price", "seats_purchased", "organisation_id")
    p = t.payments.join(s, "subscription_id")
    expected = c("unit_price") * F.when(c("organisation_id").isNotNull(), c("seats_purchased")).otherwise(1)
    return p.filter(~F.coalesce(c("amount") == expected, F.lit(False)))


def plan_change_without_related(t):
    """DOC-14: plan_changed events point at a related subscription of the same owner."""
    s = D.subscription_facts(t).select("subscription_id", "owner_id")
    r = s.select(c("subscription_id").alias("related_subscription_id"), c("owner_id").alias("related_owner"))
    e = t.subscription_events.filter(c("event_type") == "plan_changed").join(s, "subscription_id")
    j = e.join(r, "related_subscription_id", "left")
    return j.filter(c("related_subscription_id").isNull() | ~c("related_owner").eqNullSafe(c("owner_id")))


def renewal_without_period(t):
    """DOC-15: renewal events carry their billing period."""
    return t.subscription_events.filter((c("event_type") == "renewed")
                                        & (c("period_start").isNull() | c("period_end").isNull()))


def seat_event_without_change(t):
    """DOC-16: a seat event carries both counts and a real change."""
    return t.subscription_events.filter(
        (c("event_type") == "seats_changed")
        & (c("previous_seat_count").isNull() | c("new_seat_count").isNull()
           | (c("previous_seat_count") == c("new_seat_count"))))


def seats_over_allocated(t):
    """DOC-17: active users never exceed seats purchased."""
    return D.seat_utilisation(t).filter(c("seats_activated") > c("seats_purchased"))


def plan_change_gap(t):
    """DOC-18: a plan change leaves no gap: the next subscription starts on the old end date,
    and the old row ended with ``plan_change`` whenever a ``plan_changed`` event exists."""
    tl = D.owner_timeline(t)
    gap = tl.filter((c("prev_end_reason") == "plan_change") & ~c("start_date").eqNullSafe(c("prev_end_date")))
    ev = t.subscription_events.filter(c("event_type") == "plan_changed").select("subscription_id").distinct()
    wrong_reason = (t.subscriptions.join(ev, "subscription_id", "left_semi")
                    .filter(~c("end_reason").eqNullSafe(F.lit("plan_change"))).select("subscription_id"))
    return gap.select("subscription_id").unionByName(wrong_reason)


def payment_status_rewritten(old_payments: DataFrame, new_payments: DataFrame):
    """DOC-19: a payment attempt never changes status between loads (failures are not overwritten)."""
    both = old_payments.select("payment_id", "payment_status").unionByName(
        new_payments.select("payment_id", "payment_status"))
    # one exchange by attempt serves both levels of the distinct count
    return (both.repartition("payment_id").groupBy("payment_id")
            .agg(F.countDistinct("payment_status").alias("statuses")).filter("statuses > 1"))


def duplicate_organisation_name(t):
    """DOC-20: organisation names are unique."""
    return (t.organisations.groupBy("organisation_name").count().filter("count > 1")
            .select("organisation_name", c("count").alias("rows")))


def deleted_reference_rows(old: DataFrame, new: DataFrame, key: str):
    """DOC-21: discontinued products / plans are kept with is_active = FALSE, not deleted."""
    return old.select(key).join(new.select(key), key, "left_anti")


def overdue_active_trial(t, as_of=None):
    """DOC-22: a trial still 'active' after its scheduled end."""
    return t.trials.filter((c("trial_status") == "active")
                           & (c("scheduled_end_at") < _as_of(t, as_of).cast("timestamp_ntz")))


def before_signup(t):
    """DOC-23: subscriptions, trials and touchpoints do not precede the customer's signup."""
    cu = t.customers.select("customer_id", "signup_date")
    subs = (t.subscriptions.join(cu, "customer_id").filter(c("subscription_start_date") < c("signup_date"))
            .select(F.lit("subscriptions").alias("table_name"), c("subscription_id").alias("row_id")))
    trials = (t.trials.join(cu, "customer_id").filter(F.to_date("trial_started_at") < c("signup_date"))
              .select(F.lit("trials").alias("table_name"), c("trial_id").alias("row_id")))
    tps = (t.marketing_touchpoints.join(cu, "customer_id").filter(F.to_date("touchpoint_at") < c("signup_date"))
           .select(F.lit("marketing_touchpoints").alias("table_name"), c("touchpoint_id").alias("row_id")))
    return subs.unionByName(trials).unionByName(tps)


def rewritten_between(store, earlier: str, later: str) -> DataFrame:
    """DOC-19 over two stored loads (``sources.loads.LoadStore``): only months that differ are read."""
    return payment_status_rewritten(*store.differing(earlier, later, "payments"))


def deleted_between(store, earlier: str, later: str) -> DataFrame:
    """DOC-21 over two stored loads: (table_name, row_id) of products and plans that the later load lacks."""
    return reduce(DataFrame.unionByName, [
        deleted_reference_rows(*store.differing(earlier, later, name), key)
        .select(F.lit(name).alias("table_name"), c(key).alias("row_id"))
        for name, key in (("products", "product_id"), ("plans", "plan_id"))])


def payment_status_transitions(store, earlier: str, later: str) -> DataFrame:
    """Payments by status in the earlier load (NULL: not there yet) and in the later one (NULL: gone).

    Months in which both loads agree are counted from the later load alone."""
    old, new = store.differing(earlier, later, "payments")
    status = old.select("payment_status").unionByName(new.select("payment_status")).distinct()
    # the few statuses by number, in their order: largest numbers need no sort, largest texts would
    known = status.agg(F.sort_array(F.collect_list("payment_status"))).scalar()
    none = F.lit(None).cast("long")
    number = F.array_position(known, c("payment_status"))
    both = (old.select("payment_id", number.alias("o"), none.alias("n"))
            .unionByName(new.select("payment_id", none.alias("o"), number.alias("n"))))
    read = both.groupBy("payment_id").agg(F.max("o").alias("o"), F.max("n").alias("n")).groupBy("o", "n").agg(
        F.count("*").alias("payments"))
    text = lambda n: F.when(c(n) > 0, F.get(known, (c(n) - 1).cast("int")))
    kept = (store.unchanged(earlier, later, "payments").groupBy("payment_status").agg(F.count("*").alias("payments"))
            .select(c("payment_status").alias("earlier_status"), c("payment_status").alias("later_status"), "payments"))
    return (read.select(text("o").alias("earlier_status"), text("n").alias("later_status"), "payments").unionByName(kept)
            .groupBy("earlier_status", "later_status").agg(F.sum("payments").alias("payments")))


def two_payment_loads(t, as_of=None, days: int = 30):
    """(earlier, later) load of payments: the earlier one holds the attempts up to ``days`` before ``as_of``,
    those of its last two days still pending; the later one is the stored table."""
    cutoff = F.date_sub(_as_of(t, as_of), days)
    day = F.to_date("payment_attempted_at")
    earlier = t.payments.filter(day < cutoff).withColumn(
        "payment_status", F.when(day >= F.date_sub(cutoff, 2), "pending").otherwise(c("payment_status")))
    return earlier, t.payments


def two_plan_loads(t, as_of=None, days: int = 365):
    """(earlier, later) load of plans: the later one holds only plans sold in the ``days`` before ``as_of``."""
    a = _as_of(t, as_of)
    sold = t.subscriptions.filter((c("subscription_start_date") >= F.date_sub(a, days))
                                  & (c("subscription_start_date") < a)).select("plan_id").distinct()
    return t.plans, t.plans.join(sold, "plan_id", "left_semi")


RULES = [
    ("doc_trial_product_family", "trials", trial_product_not_digital),
    ("doc_trial_not_organisation", "trials", trial_by_organisation),
    ("doc_organisation_seats_required", "subscriptions", organisation_without_seats),
    ("doc_product_owner_type", "subscriptions", wrong_owner_for_product),
    ("doc_pending_cancellation_state", "subscriptions", cancellation_state_mismatch),
    ("doc_reversal_clears_request", "subscriptions", reversed_cancellation_not_cleared),
    ("doc_conversion_only_when_converted", "trials", conversion_without_converted_status),
    ("doc_conversion_same_customer", "trials", conversion_owner_or_date_mismatch),
    ("doc_active_user_not_deactivated", "organisation_users", active_user_deactivated),
    ("doc_user_same_organisation", "organisation_users", user_subscription_other_org),
    ("doc_resolved_at_only_when_resolved", "support_interactions", resolved_at_without_resolution),
    ("doc_period_days_match_frequency", "plans", period_days_mismatch),
    ("doc_payment_amount_matches_price", "payments", payment_amount_mismatch),
    ("doc_plan_change_related", "subscription_events", plan_change_without_related),
    ("doc_renewal_period", "subscription_events", renewal_without_period),
    ("doc_seat_event_change", "subscription_events", seat_event_without_change),
    ("doc_seats_not_over_allocated", "subscriptions", seats_over_allocated),
    ("doc_plan_change_no_gap", "subscriptions", plan_change_gap),
    ("doc_organisation_name_unique", "organisations", duplicate_organisation_name),
    ("doc_trial_overdue", "trials", overdue_active_trial),
    ("doc_not_before_signup", "customers", before_signup),
]


def document_rule_report(t) -> DataFrame:
    """All document rules as ``(rule, table_name, kind, violations)``."""
    parts = [fn(t).agg(F.count("*").cast("bigint").alias("violations"))
             .select(F.lit(name).alias("rule"), F.lit(table).alias("table_name"), F.lit("document").alias("kind"),
                     "violations")
             for name, table, fn in RULES]
    return reduce(DataFrame.unionByName, parts)

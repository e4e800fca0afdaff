"""Reference-data (SRC-7..9) and base-derivation (DER-*) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive as D
from ..sources import reference_data as R
from .catalog import register
from .oracle_fixtures import AS_OF

USAGE = "(select plan_id, count(*) as n from subscriptions group by plan_id)"

register("rate_card", "SRC-7", R.rate_card, f"""
select pl.product_id, pr.product_name,
       cast(max(case when billing_frequency = 'Daily' then unit_price end) as decimal(18,2)) as daily,
       cast(max(case when billing_frequency = 'Weekly' then unit_price end) as decimal(18,2)) as weekly,
       cast(max(case when billing_frequency = 'Monthly' then unit_price end) as decimal(18,2)) as monthly,
       cast(max(case when billing_frequency = 'Annual' then unit_price end) as decimal(18,2)) as annual,
       cast(coalesce(sum(u.n) filter (where billing_frequency = 'Daily'), 0) as bigint) as daily_sold,
       cast(coalesce(sum(u.n) filter (where billing_frequency = 'Weekly'), 0) as bigint) as weekly_sold,
       cast(coalesce(sum(u.n) filter (where billing_frequency = 'Monthly'), 0) as bigint) as monthly_sold,
       cast(coalesce(sum(u.n) filter (where billing_frequency = 'Annual'), 0) as bigint) as annual_sold
from plans pl join products pr on pl.product_id = pr.product_id left join {USAGE} u on u.plan_id = pl.plan_id
group by pl.product_id, pr.product_name""")

register("plan_availability", "SRC-8", R.plan_availability, f"""
select p.product_id, p.product_name, f.billing_frequency,
       exists (select 1 from plans x where x.product_id = p.product_id
                                      and x.billing_frequency = f.billing_frequency) as available,
       cast(coalesce((select sum(u.n) from plans x join {USAGE} u on u.plan_id = x.plan_id
                      where x.product_id = p.product_id and x.billing_frequency = f.billing_frequency), 0)
            as bigint) as subscriptions
from products p cross join (select distinct billing_frequency from plans) f""")

register("effective_discount", "SRC-9", R.effective_discount, f"""
select m.product_id, pr.product_name,
       cast(m.unit_price as decimal(18,2)) as monthly_price, cast(a.unit_price as decimal(18,2)) as annual_price,
       cast(m.unit_price * 12 as decimal(18,2)) as twelve_monthly,
       round(1 - cast(a.unit_price as double) / (cast(m.unit_price as double) * 12), 6) as discount,
       round(cast(coalesce(ua.n, 0) as double)
             / nullif(cast(coalesce(ua.n, 0) + coalesce(um.n, 0) as double), 0), 6) as annual_take_up
from plans m join plans a on a.product_id = m.product_id and a.billing_frequency = 'Annual'
join products pr on pr.product_id = m.product_id
left join {USAGE} um on um.plan_id = m.plan_id left join {USAGE} ua on ua.plan_id = a.plan_id
where m.billing_frequency = 'Monthly'""")

register("subscription_facts", "DER-1", D.subscription_facts, "select * from sf_subs")

register("owner_timeline", "DER-2", D.owner_timeline, """
select subscription_id, owner_id, owner_type, plan_id, product_name, billing_frequency, start_date, end_date,
       end_reason,
       cast(row_number() over w as integer) as seq,
       lag(subscription_id) over w as prev_subscription_id,
       lag(end_date) over w as prev_end_date,
       lag(end_reason) over w as prev_end_reason,
       lead(subscription_id) over w as next_subscription_id,
       lead(start_date) over w as next_start_date,
       cast(datediff('day', lag(end_date) over w, start_date) as integer) as gap_days
from sf_subs
window w as (partition by owner_id order by start_date, subscription_id)""")

register("churn_events", "DER-3", D.churn_events, "select * from sf_churn")

register("churn_type_summary", "DER-4", D.churn_type_summary, """
select end_reason, churn_type, count(*) as churned from sf_churn group by end_reason, churn_type""")

register("organisation_bands", "DER-5", D.organisation_bands, """
select organisation_id, organisation_type, organisation_size,
       case when organisation_size >= 5000 then 'Enterprise' when organisation_size >= 1000 then 'Large'
            when organisation_size >= 250 then 'Medium' when organisation_size >= 50 then 'Small'
            when organisation_size >= 1 then 'Micro' end as size_band
from organisations""")

register("seat_utilisation_by_subscription", "DER-6", D.seat_utilisation, """
select s.subscription_id, s.organisation_id, s.status, s.seats_purchased,
       cast(coalesce(u.n, 0) as bigint) as seats_activated,
       round(cast(coalesce(u.n, 0) as double) / nullif(cast(s.seats_purchased as double), 0), 6) as utilisation
from subscriptions s
left join (select subscription_id, count(*) filter (where user_status = 'active') as n
           from organisation_users group by subscription_id) u on u.subscription_id = s.subscription_id
where s.organisation_id is not null""")

register("revenue_facts", "DER-7", D.revenue_facts, "select * from sf_rev")

register("billing_schedule", "DER-8", D.billing_schedule, f"""
with sched as (
    select subscription_id, billing_frequency, start_date, cap,
           unnest(generate_series(0, greatest(datediff('day', start_date, cap), 0))) as k
    from (select *, least(coalesce(end_date, {AS_OF}), {AS_OF}) as cap from sf_subs) x
), dated as (
    select *,
           case billing_frequency when 'Daily' then start_date + cast(k as integer)
                when 'Weekly' then start_date + cast(7 * k as integer)
                when 'Monthly' then cast(start_date + to_months(cast(k as integer)) as date)
                else cast(start_date + to_months(cast(12 * k as integer)) as date) end as period_start,
           case billing_frequency when 'Daily' then start_date + cast(k + 1 as integer)
                when 'Weekly' then start_date + cast(7 * (k + 1) as integer)
                when 'Monthly' then cast(start_date + to_months(cast(k + 1 as integer)) as date)
                else cast(start_date + to_months(cast(12 * (k + 1) as integer)) as date) end as period_end
    from sched
)
select subscription_id, billing_frequency, cast(k as integer) as period_no, period_start, period_end
from dated where k = 0 or period_start < cap""")

register("subscription_state_asof", "DER-9", D.subscription_state_asof, f"""
select subscription_id, event_type as last_event_type, event_at as last_event_at,
       case event_type when 'subscription_started' then 'active' when 'reactivated' then 'active'
            when 'renewed' then 'active' when 'past_due_resolved' then 'active'
            when 'cancellation_reversed' then 'active' when 'past_due_started' then 'past_due'
            when 'cancellation_requested' then 'cancel_pending' when 'subscription_ended' then 'ended'
            when 'plan_changed' then 'ended' end as state
from (select *, row_number() over (partition by subscription_id order by event_at desc, event_id desc) as rk
      from subscription_events
      where event_type <> 'seats_changed' and event_at < cast({AS_OF} as timestamp)) e
where rk = 1""")

SEATS_AT = "2021-06-01"
register("seats_asof", "DER-10", lambda t: D.seats_asof(t, SEATS_AT), f"""
select s.subscription_id, s.organisation_id,
       cast(coalesce(
           (select e.new_seat_count from subscription_events e
             where e.subscription_id = s.subscription_id and e.event_type = 'seats_changed'
               and e.event_at < timestamp '{SEATS_AT}' order by e.event_at desc, e.event_id desc limit 1),
           (select e.previous_seat_count from subscription_events e
             where e.subscription_id = s.subscription_id and e.event_type = 'seats_changed'
               and e.event_at >= timestamp '{SEATS_AT}' order by e.event_at, e.event_id limit 1),
           s.seats_purchased) as integer) as seats
from subscriptions s
where s.organisation_id is not null and s.subscription_start_date < date '{SEATS_AT}'""")

register("attribution_first_touch", "DER-11", D.attribution, "select * from sf_attr")

register("attribution_last_touch", "DER-11", lambda t: D.attribution(t, "last"), """
select f.owner_id as customer_id, f.first_start, coalesce(t.channel, 'Unattributed') as channel,
       t.campaign_name, t.touchpoint_at
from sf_first f
left join (
    select tp.*, row_number() over (partition by tp.customer_id order by tp.touchpoint_at desc, tp.touchpoint_id desc) as rk
    from marketing_touchpoints tp join sf_first f2 on tp.customer_id = f2.owner_id
    where tp.touchpoint_at <= cast(f2.first_start as timestamp)
) t on t.customer_id = f.owner_id and t.rk = 1
where f.owner_type = 'customer'""")

register("attribution_linear", "DER-11", lambda t: D.attribution(t, "linear"), """
select customer_id, channel, round(cast(n as double) / sum(n) over (partition by customer_id), 6) as weight
from (select tp.customer_id, tp.channel, count(*) as n
      from marketing_touchpoints tp join sf_first f on tp.customer_id = f.owner_id
      where f.owner_type = 'customer' and tp.touchpoint_at <= cast(f.first_start as timestamp)
      group by 1, 2) x""")

register("engagement_recency", "DER-12", D.engagement_recency, f"""
select c.customer_id, e.last_active, cast(datediff('day', e.last_active, {AS_OF}) as integer) as days_since_active
from customers c left join (select customer_id, max(engagement_date) as last_active
                            from customer_engagement group by 1) e on e.customer_id = c.customer_id""")

_WINDOW_SQL = f"""
select c.customer_id,
       cast(coalesce(sum(e.sessions_count) filter (where e.engagement_date >= {AS_OF} - 30), 0) as bigint) as sessions_recent,
       cast(coalesce(sum(e.sessions_count) filter (where e.engagement_date < {AS_OF} - 30), 0) as bigint) as sessions_prior,
       cast(coalesce(sum(e.articles_viewed) filter (where e.engagement_date >= {AS_OF} - 30), 0) as bigint) as articles_recent,
       cast(coalesce(sum(e.reading_minutes) filter (where e.engagement_date >= {AS_OF} - 30), 0) as decimal(18,2)) as minutes_recent,
       cast(count(e.customer_id) filter (where e.engagement_date >= {AS_OF} - 30) as bigint) as active_days_recent
from customers c
left join customer_engagement e
  on e.customer_id = c.customer_id and e.engagement_date >= {AS_OF} - 60 and e.engagement_date < {AS_OF}
group by c.customer_id"""

register("engagement_window", "DER-13", D.engagement_window, f"""
select *, round(cast(sessions_recent - sessions_prior as double) / nullif(cast(sessions_prior as double), 0), 6)
          as session_change
from ({_WINDOW_SQL}) w""")

register("engagement_level", "DER-14", D.engagement_level, f"""
select customer_id, sessions_recent,
       case when sessions_recent >= 6 then 'high' when sessions_recent >= 3 then 'medium'
            when sessions_recent >= 1 then 'low' else 'none' end as engagement_level
from ({_WINDOW_SQL}) w""")

register("active_calendar", "DER-15",
         lambda t: D.active_calendar(t).select("subscription_id", "owner_id", "month"),
         "select subscription_id, owner_id, month from sf_cal")

register("payment_retries", "DER-16", D.payment_retries, """
with ch as (
    select *, coalesce(sum(case when payment_status = 'successful' then 1 else 0 end)
                  over (partition by subscription_id order by payment_attempted_at, payment_id
                        rows between unbounded preceding and 1 preceding), 0) as chain_no
    from payments
), g as (
    select ch.subscription_id, ch.chain_no, count(*) as attempts,
           count(*) filter (where payment_status = 'failed') as failures,
           min(payment_attempted_at) filter (where payment_status = 'failed') as first_failure_at,
           max(payment_attempted_at) filter (where payment_status = 'successful') as success_at,
           any_value(s.end_reason) as end_reason
    from ch join subscriptions s on s.subscription_id = ch.subscription_id
    group by ch.subscription_id, ch.chain_no
)
select subscription_id, cast(chain_no as integer) as chain_no, cast(attempts as bigint) as attempts,
       cast(failures as bigint) as failures,
       case when success_at is not null and failures = 0 then 'first_time'
            when success_at is not null then 'recovered'
            when failures > 0 and end_reason = 'payment_failure' then 'lost' else 'open' end as outcome,
       cast(datediff('day', first_failure_at, success_at) as integer) as days_to_recover
from g""")

register("cancellation_outcomes", "DER-17", D.cancellation_outcomes, """
select subscription_id, event_id as request_event_id, event_at as requested_at,
       case nt when 'cancellation_reversed' then 'reversed' when 'subscription_ended' then 'completed'
            else 'pending' end as outcome,
       case when nt in ('cancellation_reversed', 'subscription_ended') then na end as resolved_at
from (select *, lead(event_type) over w as nt, lead(event_at) over w as na
      from subscription_events
      where event_type in ('cancellation_requested', 'cancellation_reversed', 'subscription_ended')
      window w as (partition by subscription_id order by event_at, event_id)) x
where event_type = 'cancellation_requested'""")

register("customer_ltv", "DER-18", D.customer_ltv, "select * from sf_ltv")

register("owner_tenure", "DER-19", D.owner_tenure, "select * from sf_tenure")


def _csv_roundtrip(t):
    """SRC-4/6: payments written as CSV (header, overwrite) to the shared checkpoint folder and
    read back with the declared schema."""
    from ..session import scratch_path
    from ..sources import io

    path = scratch_path(t.spark, "csv-roundtrip")
    io.write_table(t.payments, "payments", path, "csv")
    return io.read_table(t.spark, "payments", path, "csv")


register("csv_roundtrip_payments", "SRC-4..6", _csv_roundtrip, "select * from payments")

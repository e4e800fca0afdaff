"""KPI-24..45 (value, marketing, corporate) and migration/journey (MIG-*) queries."""

from __future__ import annotations

from ..operators import kpi as K
from ..operators import migration as G
from .catalog import register
from .oracle_fixtures import AS_OF
from .q_kpi import M, OPEN_MONTH, REACT, churn_rate_sql, rate

FACTOR = ("case {f} when 'Daily' then cast(30 as double) when 'Weekly' then cast(52 as double) / 12 "
          "when 'Monthly' then cast(1 as double) when 'Annual' then cast(1 as double) / 12 end")


def pct(p: float) -> str:
    return f"cast(min(ltv) filter (where rn >= ceil({p} * n)) as decimal(18,2))"


register("customer_lifetime_value", "KPI-24", K.customer_lifetime_value, f"""
select owner_type, currency, count(*) as owners, round(avg(ltv), 2) as avg_ltv,
       {pct(0.5)} as median_ltv, {pct(0.9)} as p90_ltv
from (select *, row_number() over (partition by owner_type, currency order by ltv) as rn,
             count(*) over (partition by owner_type, currency) as n
      from sf_ltv) r
group by owner_type, currency""")

register("revenue_per_customer", "KPI-25", K.revenue_per_customer, """
select currency, count(*) as owners, cast(sum(ltv) as decimal(18,2)) as revenue,
       round(cast(sum(ltv) as double) / nullif(count(*), 0), 2) as revenue_per_customer
from sf_ltv group by currency""")

register("average_subscription_duration", "KPI-26", K.average_subscription_duration, f"""
select billing_frequency, count(end_date) as ended_subscriptions,
       round(avg(case when end_date is not null then datediff('day', start_date, end_date) end), 4) as avg_ended_days,
       count(*) as all_subscriptions,
       round(avg(datediff('day', start_date, coalesce(end_date, {AS_OF}))), 4) as avg_all_days
from sf_subs where start_date < {AS_OF} group by billing_frequency""")


def move_rate_sql(kind: str) -> str:
    return f"""
select coalesce(b.month, m.month) as month, coalesce(b.n, 0) as active_at_start, coalesce(m.n, 0) as {kind}s,
       {rate('coalesce(m.n, 0)', 'coalesce(b.n, 0)')} as {kind}_rate
from (select cast(month + interval 1 month as date) as month, count(*) as n from sf_owner_months group by 1) b
full join (select move_month as month, count(distinct owner_id) as n from sf_moves
           where product_move = '{kind}' group by 1) m on b.month = m.month
where coalesce(b.month, m.month) < {OPEN_MONTH}"""


register("upgrade_rate", "KPI-27", K.upgrade_rate, move_rate_sql("upgrade"))
register("downgrade_rate", "KPI-28", K.downgrade_rate, move_rate_sql("downgrade"))

register("reactivation_rate", "KPI-29", K.reactivation_rate, f"""
select churn_month, count(distinct owner_id) as churned_owners,
       count(distinct case when next_start is not null then owner_id end) as reactivated_owners,
       {rate('count(distinct case when next_start is not null then owner_id end)', 'count(distinct owner_id)')}
           as reactivation_rate
from ({REACT}) x group by churn_month""")

def mean_value_sql(members: str, *keys: str) -> str:
    """Per group of ``members`` (owner_id, keys): revenue per member, one amount per currency."""
    k = ", ".join(keys)
    return f"""
select {', '.join('tot.' + x for x in keys)},
       string_agg(currency || ' ' || cast(cast(round(cast(total as double) / members, 2) as decimal(18,2)) as varchar), '; '
                  order by currency) as avg_ltv
from (select {', '.join('m.' + x for x in keys)}, l.currency, sum(l.ltv) as total
      from {members} m join sf_ltv l on l.owner_id = m.owner_id group by all) tot
join (select {k}, count(*) as members from {members} group by all) num
  on {' and '.join(f'num.{x} is not distinct from tot.{x}' for x in keys)}
group by {', '.join('tot.' + x for x in keys)}"""


OWNER_VALUE = """
select owner_id, string_agg(currency || ' ' || cast(ltv as varchar), '; ' order by currency) as ltv
from sf_ltv group by owner_id"""

CAC = f"""
with fp as (select owner_id as customer_id, min(paid_at) as first_paid_at from sf_rev
            where owner_type = 'customer' group by 1),
     cost as (select tp.channel, cast(coalesce(sum(tp.attributed_cost), 0) as decimal(18,2)) as cost,
                     count(*) as touches, count(tp.attributed_cost) as costed_touches
              from marketing_touchpoints tp join fp on fp.customer_id = tp.customer_id
              where tp.touchpoint_at <= fp.first_paid_at group by 1),
     acq as (select channel, count(*) as new_paying from sf_attr
             where customer_id in (select customer_id from fp) group by 1),
     j as (select coalesce(cost.channel, acq.channel) as channel,
                  coalesce(cost.cost, cast(0 as decimal(18,2))) as cost, coalesce(cost.touches, 0) as touches,
                  coalesce(cost.costed_touches, 0) as costed_touches, coalesce(acq.new_paying, 0) as new_paying
           from cost full join acq on cost.channel = acq.channel)
select *, {rate('costed_touches', 'touches')} as cost_coverage,
       round(cast(cost as double) / nullif(cast(new_paying as double), 0), 2) as cac
from j"""

register("customer_acquisition_cost", "KPI-30", K.customer_acquisition_cost, CAC)

register("conversion_rate", "KPI-31", K.conversion_rate, f"""
select ft.channel, count(*) as touched, count(*) filter (where lp.last_paid_at >= ft.first_touch_at) as converted,
       {rate('count(*) filter (where lp.last_paid_at >= ft.first_touch_at)', 'count(*)')} as conversion_rate
from (select customer_id, channel, min(touchpoint_at) as first_touch_at from marketing_touchpoints group by 1, 2) ft
left join (select owner_id as customer_id, max(paid_at) as last_paid_at from sf_rev
           where owner_type = 'customer' group by 1) lp on lp.customer_id = ft.customer_id
group by ft.channel""")

register("cost_per_acquisition", "KPI-32", K.cost_per_acquisition, """
with cost as (select channel, cast(coalesce(sum(attributed_cost), 0) as decimal(18,2)) as cost
              from marketing_touchpoints group by 1),
     ft as (select customer_id, min(first_at) as first_at
            from (select owner_id as customer_id, cast(first_start as timestamp) as first_at from sf_first
                  where owner_type = 'customer'
                  union all select customer_id, cast(trial_started_at as timestamp) from trials) z group by 1),
     acq as (select coalesce(tp.channel, 'Unattributed') as channel, count(*) as acquisitions
             from ft left join (select m.customer_id, m.channel, row_number() over (partition by m.customer_id
                                       order by m.touchpoint_at, m.touchpoint_id) as rk
                                from marketing_touchpoints m join ft f on f.customer_id = m.customer_id
                                where m.touchpoint_at <= f.first_at) tp on tp.customer_id = ft.customer_id and tp.rk = 1
             group by 1),
     j as (select coalesce(cost.channel, acq.channel) as channel, coalesce(cost.cost, cast(0 as decimal(18,2))) as cost,
                  coalesce(acq.acquisitions, 0) as acquisitions
           from cost full join acq on cost.channel = acq.channel)
select *, round(cast(cost as double) / nullif(cast(acquisitions as double), 0), 2) as cpa from j""")

register("trial_conversion_rate_by_channel", "KPI-33", K.trial_conversion_rate_by_channel, f"""
select coalesce(a.channel, 'Unattributed') as channel, count(*) as trials,
       count(*) filter (where tr.trial_status = 'converted') as converted,
       {rate("count(*) filter (where tr.trial_status = 'converted')", 'count(*)')} as conversion_rate
from trials tr left join sf_attr a on a.customer_id = tr.customer_id group by 1""")

register("revenue_by_acquisition_channel", "KPI-34", K.revenue_by_acquisition_channel, """
select a.channel, r.currency, cast(sum(r.amount) as decimal(18,2)) as revenue,
       count(distinct r.owner_id) as paying_customers
from sf_rev r join sf_attr a on a.customer_id = r.owner_id group by 1, 2""")

LTV_BY_CHANNEL = """
select a.channel, l.currency, count(*) as customers, round(avg(l.ltv), 2) as avg_ltv
from sf_ltv l join sf_attr a on a.customer_id = l.owner_id group by 1, 2"""

register("customer_lifetime_value_by_acquisition_channel", "KPI-35",
         K.customer_lifetime_value_by_acquisition_channel, LTV_BY_CHANNEL)

register("ltv_to_cac_ratio", "KPI-36", K.ltv_to_cac_ratio, f"""
with l as ({LTV_BY_CHANNEL}), c as ({CAC})
select l.channel, l.currency, l.avg_ltv, c.cac, round(l.avg_ltv / nullif(c.cac, 0), 4) as ltv_to_cac
from l left join c on c.channel = l.channel""")

BAND = ("case when {s} >= 5000 then 'Enterprise' when {s} >= 1000 then 'Large' when {s} >= 250 then 'Medium' "
        "when {s} >= 50 then 'Small' when {s} >= 1 then 'Micro' end")

register("active_corporate_accounts", "KPI-37", K.active_corporate_accounts, f"""
select m.month, o.organisation_type, {BAND.format(s='o.organisation_size')} as size_band, count(*) as active_accounts
from sf_owner_months m join organisations o on o.organisation_id = m.owner_id
where m.owner_type = 'organisation' group by 1, 2, 3""")

register("corporate_revenue", "KPI-38", K.corporate_revenue, """
select month, currency, cast(sum(amount) as decimal(18,2)) as revenue, count(distinct owner_id) as paying_accounts
from sf_rev where owner_type = 'organisation' group by 1, 2""")

register("average_contract_value", "KPI-39", K.average_contract_value, """
select billing_frequency, currency, count(*) as contracts,
       round(avg(unit_price * coalesce(seats_purchased, 1)), 2) as avg_contract_value,
       round(avg(unit_price * coalesce(seats_purchased, 1)
                 * case billing_frequency when 'Monthly' then 12 when 'Annual' then 1 end), 2) as avg_annual_contract_value
from sf_subs where owner_type = 'organisation' group by 1, 2""")

ORG_SEATS = """
select oc.*, cast(coalesce(
         (select e.new_seat_count from subscription_events e
           where e.subscription_id = oc.subscription_id and e.event_type = 'seats_changed' and e.event_at < oc.probe
           order by e.event_at desc, e.event_id desc limit 1),
         (select e.previous_seat_count from subscription_events e
           where e.subscription_id = oc.subscription_id and e.event_type = 'seats_changed' and e.event_at >= oc.probe
           order by e.event_at, e.event_id limit 1),
         oc.seats_purchased) as bigint) as seats
from (select subscription_id, owner_id, month, currency, seats_purchased,
             cast(last_day(month) + 1 as timestamp) as probe
      from sf_cal where owner_type = 'organisation') oc"""

SEATS = f"select month, cast(sum(seats) as bigint) as seats_purchased, count(*) as subscriptions from ({ORG_SEATS}) s group by 1"
ACTIVATED = """
select c.month, count(*) as seats_activated
from organisation_users u join sf_cal c on c.subscription_id = u.subscription_id
where u.activation_date <= last_day(c.month)
  and (u.deactivation_date is null or u.deactivation_date > last_day(c.month))
group by c.month"""

register("seats_purchased", "KPI-40", K.seats_purchased, SEATS)
register("seats_activated", "KPI-41", K.seats_activated, ACTIVATED)
register("seat_utilisation", "KPI-42", K.seat_utilisation_monthly, f"""
select s.month, s.seats_purchased, coalesce(a.seats_activated, 0) as seats_activated,
       {rate('coalesce(a.seats_activated, 0)', 's.seats_purchased')} as seat_utilisation
from ({SEATS}) s left join ({ACTIVATED}) a on a.month = s.month""")

register("revenue_per_seat", "KPI-43", K.revenue_per_seat, f"""
select s.month, s.currency, s.seats_purchased, coalesce(r.revenue, cast(0 as decimal(18,2))) as revenue,
       round(cast(coalesce(r.revenue, 0) as double) / nullif(cast(s.seats_purchased as double), 0), 4) as revenue_per_seat
from (select month, currency, cast(sum(seats) as bigint) as seats_purchased from ({ORG_SEATS}) x group by 1, 2) s
left join (select month, currency, cast(sum(amount) as decimal(18,2)) as revenue from sf_rev
           where owner_type = 'organisation' group by 1, 2) r on r.month = s.month and r.currency = s.currency""")

register("corporate_renewal_rate", "KPI-44", K.corporate_renewal_rate, f"""
select *, {rate('renewed', 'renewed + lapsed')} as renewal_rate
from (select {M.format('e.event_at')} as month, s.billing_frequency,
             count(*) filter (where e.event_type = 'renewed') as renewed,
             count(*) filter (where e.event_type = 'subscription_ended' and e.event_reason <> 'plan_change') as lapsed
      from subscription_events e join sf_subs s on s.subscription_id = e.subscription_id
      where s.owner_type = 'organisation' and e.event_type in ('renewed', 'subscription_ended')
      group by 1, 2) g
where renewed + lapsed > 0""")

register("corporate_churn_rate", "KPI-45", K.corporate_churn_rate,
         churn_rate_sql(owner_where="owner_type = 'organisation'"))

# ----------------------------------------------------------------------- migration
MOVES = f"""
select owner_id, owner_type, from_subscription_id, to_subscription_id, move_date, move_month, from_product, to_product,
       from_frequency, to_frequency, product_move, cycle_move,
       round(cast(from_unit_price as double) * from_seats * {FACTOR.format(f='from_frequency')}, 2) as from_mrr,
       round(cast(to_unit_price as double) * to_seats * {FACTOR.format(f='to_frequency')}, 2) as to_mrr,
       from_currency, to_currency
from sf_moves"""

register("plan_moves", "MIG-1", G.plan_moves, MOVES)

for dim, (f, to) in {"product": ("from_product", "to_product"), "cycle": ("from_frequency", "to_frequency")}.items():
    register(f"migration_matrix_{dim}", "MIG-2", (lambda d: lambda t: G.migration_matrix(t, d))(dim), f"""
select from_value, to_value, moves, {rate('moves', 'sum(moves) over (partition by from_value)')} as row_share
from (select {f} as from_value, {to} as to_value, count(*) as moves from sf_moves group by 1, 2) g""")

register("post_migration_retention", "MIG-3", G.post_migration_retention, f"""
with n(days) as (values (30), (60), (90)),
     movers as (select 'mover' as cohort, owner_id, move_date as day0 from sf_moves
                where product_move <> 'same' or cycle_move <> 'same'),
     fresh as (select 'non_mover' as cohort, owner_id, start_date as day0
               from (select *, lag(end_reason) over (partition by owner_id order by start_date, subscription_id) as per
                     from sf_subs) x
               where per is null or per <> 'plan_change'),
     p as (select c.*, n.days, c.day0 + n.days as day from (select * from movers union all select * from fresh) c, n
           where c.day0 + n.days < {AS_OF})
select cohort, days, count(*) as eligible,
       count(*) filter (where exists (select 1 from sf_subs s where s.owner_id = p.owner_id and s.start_date <= p.day
                                        and (s.end_date is null or s.end_date > p.day))) as retained,
       {rate('''count(*) filter (where exists (select 1 from sf_subs s where s.owner_id = p.owner_id
                 and s.start_date <= p.day and (s.end_date is null or s.end_date > p.day)))''', 'count(*)')}
           as retention_rate
from p group by cohort, days""")

for kind in ("upgrade", "downgrade"):
    register(f"{kind}_revenue_impact", "MIG-4" if kind == "upgrade" else "MIG-5",
             G.upgrade_revenue_impact if kind == "upgrade" else G.downgrade_revenue_impact, f"""
select move_month, from_currency, to_currency, count(*) as moves,
       round(sum(case when from_currency = to_currency then to_mrr - from_mrr end), 2) as mrr_change
from ({MOVES}) m where product_move = '{kind}' group by move_month, from_currency, to_currency""")

STEPS = f"""
select customer_id as owner_id, trial_started_at as step_at, 0 as seq, 'Free Trial' as label from trials
union all
select owner_id, cast(start_date as timestamp), 2, billing_frequency from sf_subs
union all
select owner_id, cast(churn_date as timestamp), 3, 'Churn' from sf_churn
union all
select distinct owner_id, cast(next_start as timestamp), 1, 'Reactivation' from ({REACT}) r where next_start is not null"""

register("journeys", "MIG-6", G.journeys, f"""
with paths as (select owner_id, string_agg(label, ' → ' order by step_at, seq, label) as path, count(*) as steps
               from ({STEPS}) s group by owner_id),
     live as (select distinct owner_id from sf_subs
              where start_date < {AS_OF} and (end_date is null or end_date >= {AS_OF}))
select p.path, count(*) as owners, cast(min(p.steps) as bigint) as steps, any_value(val.avg_ltv) as avg_ltv,
       {rate('count(v.owner_id)', 'count(*)')} as still_active_share
from paths p left join live v on v.owner_id = p.owner_id
left join ({mean_value_sql('paths', 'path')}) val on val.path = p.path
group by p.path order by owners desc, steps, p.path limit 10""")

register("journey_paths", "MIG-6", G.journey_paths, f"""
with numbered as (select owner_id, label, row_number() over (partition by owner_id order by step_at, seq, label) as position
            from ({STEPS}) s),
     paths as (select owner_id, string_agg(label, ' → ' order by position) as path, count(*) as steps from numbered group by 1),
     top as (select path, count(*) as owners, min(owner_id) as rep,
                    row_number() over (order by count(*) desc, min(steps), path) as journey
             from paths group by path order by journey limit 10)
select cast(journey as integer) as journey, owners, position, label from top join numbered on numbered.owner_id = top.rep""")

register("lifecycle_events", "MIG-7", G.lifecycle_events, """
with e as (select e.*, s.owner_id from subscription_events e join sf_subs s on s.subscription_id = e.subscription_id),
     pay as (select p.*, s.owner_id from payments p join sf_subs s on s.subscription_id = p.subscription_id)
select customer_id as owner_id, cast(null as varchar) as subscription_id, 'trial_started' as event_name,
       trial_started_at as event_at from trials
union all select customer_id, converted_subscription_id, 'trial_converted', coalesce(actual_end_at, scheduled_end_at)
       from trials where trial_status = 'converted'
union all select owner_id, subscription_id, 'subscription_started', event_at from e where event_type = 'subscription_started'
union all select owner_id, subscription_id, 'renewed', event_at from e where event_type = 'renewed'
union all select owner_id, to_subscription_id, 'upgraded', cast(move_date as timestamp) from sf_moves where product_move = 'upgrade'
union all select owner_id, to_subscription_id, 'downgraded', cast(move_date as timestamp) from sf_moves where product_move = 'downgrade'
union all select owner_id, to_subscription_id, 'billing_cycle_changed', cast(move_date as timestamp) from sf_moves where cycle_move <> 'same'
union all select owner_id, subscription_id, 'payment_successful', payment_attempted_at from pay where payment_status = 'successful'
union all select owner_id, subscription_id, 'payment_failed', payment_attempted_at from pay where payment_status = 'failed'
union all select owner_id, subscription_id, 'grace_period_started', event_at from e where event_type = 'past_due_started'
union all select owner_id, subscription_id, 'cancelled', event_at from e where event_type = 'cancellation_requested'
union all select owner_id, subscription_id, 'expired', event_at from e
       where event_type = 'subscription_ended' and event_reason = 'non_renewal'
union all select owner_id, subscription_id, 'churned', cast(churn_date as timestamp) from sf_churn
union all select owner_id, subscription_id, 'reactivated', event_at from e where event_type = 'reactivated'""")

register("lifecycle_funnel", "MIG-8", G.lifecycle_funnel, f"""
with s as (select c.customer_id,
                  exists (select 1 from trials t where t.customer_id = c.customer_id) as trial,
                  exists (select 1 from sf_rev r where r.owner_id = c.customer_id) as paid,
                  exists (select 1 from subscription_events e join sf_subs x on x.subscription_id = e.subscription_id
                          where x.owner_id = c.customer_id and e.event_type = 'renewed') as renewed,
                  exists (select 1 from sf_moves m where m.owner_id = c.customer_id and m.product_move = 'upgrade') as upgraded,
                  exists (select 1 from sf_churn h where h.owner_id = c.customer_id) as churned,
                  exists (select 1 from ({REACT}) r where r.owner_id = c.customer_id and r.next_start is not null) as reactivated
           from customers c),
     k as (select 0 as step_no, 'registered' as step, count(*) as customers from s
           union all select 1, 'trial', count(*) filter (where trial) from s
           union all select 2, 'paid', count(*) filter (where paid) from s
           union all select 3, 'renewed', count(*) filter (where renewed) from s
           union all select 4, 'upgraded', count(*) filter (where upgraded) from s
           union all select 5, 'churned', count(*) filter (where churned) from s
           union all select 6, 'reactivated', count(*) filter (where reactivated) from s)
select cast(step_no as integer) as step_no, step, cast(customers as bigint) as customers,
       {rate('customers', 'lag(customers) over (order by step_no)')} as step_conversion
from k""")

register("seat_changes", "MIG-9", G.seat_changes, f"""
select s.organisation_id, {M.format('e.event_at')} as month, count(*) as changes,
       cast(sum(case when e.new_seat_count > e.previous_seat_count then e.new_seat_count - e.previous_seat_count else 0 end) as bigint) as seats_added,
       cast(sum(case when e.new_seat_count < e.previous_seat_count then e.previous_seat_count - e.new_seat_count else 0 end) as bigint) as seats_removed,
       count(*) filter (where e.new_seat_count = e.previous_seat_count) as no_change_events
from subscription_events e join subscriptions s on s.subscription_id = e.subscription_id
where e.event_type = 'seats_changed' group by 1, 2""")

register("migration_net_flow", "MIG-10", G.migration_net_flow, """
select product_name, cast(sum(gained) as bigint) as gained, cast(sum(lost) as bigint) as lost,
       cast(sum(gained) - sum(lost) as bigint) as net_flow
from (select to_product as product_name, 1 as gained, 0 as lost from sf_moves where from_product <> to_product
      union all
      select from_product, 0, 1 from sf_moves where from_product <> to_product) f
group by product_name""")

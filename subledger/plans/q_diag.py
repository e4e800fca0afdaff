"""Diagnostics queries (DIA-*)."""

from __future__ import annotations

from ..operators import diagnostics as X
from .catalog import register
from .oracle_fixtures import AS_OF
from .q_kpi import REACT, rate
from .q_more import BAND, CAC, FACTOR, LTV_BY_CHANNEL, mean_value_sql

TENURE = ("case when {d} < 90 then '0-3m' when {d} < 365 then '3-12m' else '12m+' end")

register("churn_concentration", "DIA-1", X.churn_concentration, f"""
with base as (
    select s.product_name, s.billing_frequency, coalesce(a.channel, 'Organisation') as channel,
           {TENURE.format(d=f"datediff('day', s.start_date, coalesce(s.end_date, {AS_OF}))")} as tenure_band,
           coalesce(a.campaign_name, 'none') as campaign,
           case when c.subscription_id is not null then 1 else 0 end as churned
    from sf_subs s left join sf_churn c on c.subscription_id = s.subscription_id
    left join sf_attr a on a.customer_id = s.owner_id
    where s.start_date < {AS_OF}),
tot as (select count(*) as all_subs, sum(churned) as all_churned from base),
cb as (select product_name, billing_frequency, channel, tenure_band, campaign, count(*) as subscriptions,
              cast(sum(churned) as bigint) as churned,
              cast(grouping(product_name, billing_frequency, channel, tenure_band, campaign) as integer) as grouping_level
       from base group by cube (product_name, billing_frequency, channel, tenure_band, campaign))
select cb.*, {rate('churned', 'all_churned')} as churn_share, {rate('subscriptions', 'all_subs')} as base_share,
       {rate('churned * all_subs', 'subscriptions * all_churned')} as lift
from cb, tot
where grouping_level < 31 and subscriptions >= 50
order by lift desc nulls last, grouping_level, product_name nulls first, billing_frequency nulls first,
         channel nulls first, tenure_band nulls first, campaign nulls first
limit 20""")

register("revenue_change_drivers", "DIA-2", X.revenue_change_drivers, f"""
with g as (select r.currency, coalesce(a.channel, 'Organisation') as channel, r.product_name, r.billing_frequency,
                  cast(coalesce(sum(amount) filter (where month = date '2023-12-01'), 0) as decimal(18,2)) as previous_revenue,
                  cast(coalesce(sum(amount) filter (where month = date '2024-01-01'), 0) as decimal(18,2)) as current_revenue
           from sf_rev r left join sf_attr a on a.customer_id = r.owner_id
           where month in (date '2023-12-01', date '2024-01-01') group by 1, 2, 3, 4),
     h as (select *, cast(current_revenue - previous_revenue as decimal(18,2)) as change from g)
select *, {rate('change', 'sum(change) over (partition by currency)')} as share_of_change from h""")

register("churned_revenue", "DIA-3", X.churned_revenue, f"""
select churn_month, churn_type, currency, cast(sum(n) as bigint) as churned_subscriptions,
       round(sum(cast(rec as double) * {FACTOR.format(f='billing_frequency')}), 2) as mrr_lost
from (select c.churn_month, c.churn_type, s.currency, s.billing_frequency, count(*) as n,
             sum(s.unit_price * coalesce(s.seats_purchased, 1)) as rec
      from sf_churn c join sf_subs s on s.subscription_id = c.subscription_id group by 1, 2, 3, 4) x
group by 1, 2, 3""")

register("survival_curve", "DIA-4", X.survival_curve, f"""
with d as (select cast(floor(datediff('day', s.start_date, coalesce(s.end_date, {AS_OF})) / 30) as integer) as duration_months,
                  case when c.subscription_id is not null then 1 else 0 end as event
           from sf_subs s left join sf_churn c on c.subscription_id = s.subscription_id
           where s.start_date < {AS_OF}),
     g as (select duration_months, count(*) as n, cast(sum(event) as bigint) as churned from d group by 1),
     r as (select *, cast(sum(n) over (order by duration_months desc rows between unbounded preceding and current row)
                          as bigint) as at_risk from g)
select duration_months, at_risk, churned, cast(n - churned as bigint) as censored,
       {rate('churned', 'at_risk')} as hazard,
       case when max(case when churned >= at_risk then 1 else 0 end)
                 over (order by duration_months rows between unbounded preceding and current row) = 1 then 0.0
            else round(exp(sum(case when churned >= at_risk then null
                                    else ln(1 - cast(churned as double) / at_risk) end)
                           over (order by duration_months rows between unbounded preceding and current row)), 6)
       end as survival
from r""")

register("pre_churn_behaviour", "DIA-5", X.pre_churn_behaviour, f"""
with pr as (select owner_id as customer_id, 'churned' as cohort, churn_date as w_end, subscription_id as probe_id
            from sf_churn where owner_type = 'customer'
            union all
            select distinct owner_id, 'retained', {AS_OF}, 'live|' || owner_id from sf_subs
            where owner_type = 'customer' and start_date < {AS_OF} and (end_date is null or end_date >= {AS_OF})),
     p as (select *, w_end - 30 as w_start from pr),
     s as (select p.cohort,
                  coalesce((select sum(e.sessions_count) from customer_engagement e where e.customer_id = p.customer_id
                              and e.engagement_date >= p.w_start and e.engagement_date < p.w_end), 0) as sessions,
                  (select count(*) from payments y join subscriptions x on x.subscription_id = y.subscription_id
                    where x.customer_id = p.customer_id and y.payment_status = 'failed'
                      and cast(y.payment_attempted_at as date) >= p.w_start
                      and cast(y.payment_attempted_at as date) < p.w_end) as failed,
                  (select count(*) from support_interactions u where u.customer_id = p.customer_id
                      and cast(u.interaction_at as date) >= p.w_start and cast(u.interaction_at as date) < p.w_end) as support
           from p)
select cohort, count(*) as windows, round(avg(sessions), 4) as avg_sessions, round(avg(failed), 4) as avg_failed_payments,
       round(avg(support), 4) as avg_support_cases
from s group by cohort""")

register("support_vs_churn", "DIA-6", X.support_vs_churn, f"""
with ch as (select distinct owner_id as customer_id from sf_churn),
     pc as (select issue_category, customer_id, count(*) as cases from support_interactions group by 1, 2),
     cu as (select pc.issue_category, cast(sum(pc.cases) as bigint) as cases, count(*) as customers,
                   count(ch.customer_id) as churned_customers
            from pc left join ch on ch.customer_id = pc.customer_id group by 1),
     rs as (select issue_category,
                   round(avg(datediff('second', interaction_at, resolved_at) / cast(3600 as double)), 4) as avg_resolution_hours,
                   count(*) filter (where resolution_status <> 'resolved') as open_cases
            from support_interactions group by 1)
select cu.*, rs.avg_resolution_hours, rs.open_cases, {rate('churned_customers', 'customers')} as churn_rate
from cu join rs on rs.issue_category = cu.issue_category""")

register("promotion_retention", "DIA-7", X.promotion_retention, f"""
with a as (select customer_id as owner_id, first_start, channel = 'Promotional Campaign' as promotional,
                  campaign_name is not null as with_campaign from sf_attr),
     n(days) as (values (30), (60), (90), (180)),
     p as (select a.*, n.days, a.first_start + n.days as day from a, n where a.first_start + n.days < {AS_OF}),
     q as (select p.*, exists (select 1 from sf_subs s where s.owner_id = p.owner_id and s.start_date <= p.day
                               and (s.end_date is null or s.end_date > p.day)) as kept
           from p),
     g as (select promotional, with_campaign, days, count(*) as eligible, count(*) filter (where kept) as retained,
                  {rate('count(*) filter (where kept)', 'count(*)')} as retention_rate from q group by 1, 2, 3)
select g.*, val.avg_ltv
from g left join ({mean_value_sql('p', 'promotional', 'with_campaign', 'days')}) val
  on val.promotional = g.promotional and val.with_campaign = g.with_campaign and val.days = g.days""")

register("campaign_performance", "DIA-8", X.campaign_performance, f"""
with att as (select customer_id as owner_id, campaign_name from sf_attr where campaign_name is not null),
     live as (select distinct owner_id from sf_subs where start_date < {AS_OF} and (end_date is null or end_date >= {AS_OF})),
     per as (select att.campaign_name, count(*) as customers, {rate('count(v.owner_id)', 'count(*)')} as still_active_share
             from att left join live v on v.owner_id = att.owner_id group by 1),
     rev as (select campaign_name, string_agg(currency || ' ' || cast(total as varchar), '; ' order by currency) as revenue
             from (select att.campaign_name, l.currency, cast(sum(l.ltv) as decimal(18,2)) as total
                   from att join sf_ltv l on l.owner_id = att.owner_id group by 1, 2) z group by 1),
     cost as (select campaign_name, cast(coalesce(sum(attributed_cost), 0) as decimal(18,2)) as cost
              from marketing_touchpoints where campaign_name is not null group by 1)
select per.*, rev.revenue, cost.cost, round(cast(cost.cost as double) / nullif(cast(per.customers as double), 0), 2) as cost_per_customer
from per left join cost on cost.campaign_name = per.campaign_name
left join rev on rev.campaign_name = per.campaign_name""")

register("reactivation_factors", "DIA-9", X.reactivation_factors, f"""
select r.churn_type, r.product_name, r.billing_frequency, coalesce(a.channel, 'Organisation') as channel, count(*) as churns, count(next_start) as reactivated,
       round(avg(datediff('day', churn_date, next_start)), 2) as avg_gap_days,
       {rate('count(next_start)', 'count(*)')} as reactivation_rate
from ({REACT}) r left join sf_attr a on a.customer_id = r.owner_id group by 1, 2, 3, 4""")

register("engagement_trend", "DIA-10", X.engagement_trend, """
select *, round(cast(sum(sessions) over (order by engagement_date
                     range between interval 6 days preceding and current row) as double) / 7, 4) as sessions_7d_avg
from (select engagement_date, count(*) as active_customers, cast(sum(sessions_count) as bigint) as sessions,
             cast(sum(articles_viewed) as bigint) as articles, cast(sum(reading_minutes) as decimal(18,2)) as minutes
      from customer_engagement group by 1) g""")

register("top_readers", "DIA-10", X.top_readers, f"""
select customer_id, cast(sum(reading_minutes) as decimal(18,2)) as minutes, cast(sum(sessions_count) as bigint) as sessions
from customer_engagement where engagement_date >= {AS_OF} - 30 and engagement_date < {AS_OF}
group by customer_id order by minutes desc, customer_id limit 20""")

register("payment_failure_rates", "DIA-11", X.payment_failure_rates, f"""
select payment_method, count(*) as attempts, count(*) filter (where payment_status = 'failed') as failures,
       {rate("count(*) filter (where payment_status = 'failed')", 'count(*)')} as failure_rate
from payments group by 1""")

register("payment_failure_reasons", "DIA-11", X.payment_failure_reasons, f"""
select failure_reason, count(*) as failures, {rate('count(*)', 'sum(count(*)) over ()')} as share
from payments where payment_status = 'failed' group by 1""")

register("payment_recovery", "DIA-11", X.payment_recovery, f"""
with ch as (
    select *, coalesce(sum(case when payment_status = 'successful' then 1 else 0 end)
                  over (partition by subscription_id order by payment_attempted_at, payment_id
                        rows between unbounded preceding and 1 preceding), 0) as chain_no
    from payments),
g as (select ch.subscription_id, ch.chain_no,
             count(*) filter (where payment_status = 'failed') as failures,
             min(payment_attempted_at) filter (where payment_status = 'failed') as ff,
             max(payment_attempted_at) filter (where payment_status = 'successful') as sa,
             any_value(s.end_reason) as end_reason
      from ch join subscriptions s on s.subscription_id = ch.subscription_id group by 1, 2),
o as (select case when sa is not null then 'recovered' when end_reason = 'payment_failure' then 'lost'
                  else 'open' end as outcome, datediff('day', ff, sa) as days
      from g where failures > 0)
select outcome, count(*) as chains, round(avg(days), 4) as avg_days_to_recover,
       {rate('count(*)', 'sum(count(*)) over ()')} as share
from o group by outcome""")

register("acquisition_funnel", "DIA-12", X.acquisition_funnel, f"""
with k as (
    select 0 as stage_no, 'impression' as stage,
           (select count(distinct customer_id) from marketing_touchpoints where touchpoint_type = 'impression') as customers
    union all select 1, 'click', (select count(distinct customer_id) from marketing_touchpoints where touchpoint_type = 'click')
    union all select 2, 'visit', (select count(distinct customer_id) from marketing_touchpoints where touchpoint_type = 'visit')
    union all select 3, 'registered', (select count(*) from customers)
    union all select 4, 'trial', (select count(distinct customer_id) from trials)
    union all select 5, 'paid', (select count(distinct owner_id) from sf_rev where owner_type = 'customer'))
select cast(stage_no as integer) as stage_no, stage, cast(customers as bigint) as customers,
       {rate('customers', 'lag(customers) over (order by stage_no)')} as step_conversion
from k""")

CONV = f"""
select ft.channel, {rate('count(*) filter (where lp.last_paid_at >= ft.first_touch_at)', 'count(*)')} as conversion_rate
from (select customer_id, channel, min(touchpoint_at) as first_touch_at from marketing_touchpoints group by 1, 2) ft
left join (select owner_id as customer_id, max(paid_at) as last_paid_at from sf_rev
           where owner_type = 'customer' group by 1) lp on lp.customer_id = ft.customer_id
group by ft.channel"""

register("channel_comparison", "DIA-13", X.channel_comparison, f"""
with live as (select distinct owner_id as customer_id from sf_subs
              where start_date < {AS_OF} and (end_date is null or end_date >= {AS_OF})),
     acq as (select a.channel, count(*) as acquired, {rate('count(v.customer_id)', 'count(*)')} as retained_share
             from sf_attr a left join live v on v.customer_id = a.customer_id group by 1),
     conv as ({CONV}),
     cac as ({CAC}),
     rev as (select a.channel, r.currency, cast(sum(r.amount) as decimal(18,2)) as revenue
             from sf_rev r join sf_attr a on a.customer_id = r.owner_id group by 1, 2),
     ltv as ({LTV_BY_CHANNEL}),
     val as (select coalesce(rev.channel, ltv.channel) as channel, coalesce(rev.currency, ltv.currency) as currency,
                    rev.revenue, ltv.avg_ltv
             from rev full join ltv on rev.channel = ltv.channel and rev.currency = ltv.currency)
select acq.*, conv.conversion_rate, cac.cac, val.currency, val.revenue, val.avg_ltv
from acq left join conv on conv.channel = acq.channel left join cac on cac.channel = acq.channel
left join val on val.channel = acq.channel""")

def _renewal(freq: str) -> str:
    ren = f"count(*) filter (where e.event_type = 'renewed' and s.billing_frequency = '{freq}')"
    den = (f"count(*) filter (where (e.event_type = 'renewed' or (e.event_type = 'subscription_ended' "
           f"and e.event_reason <> 'plan_change')) and s.billing_frequency = '{freq}')")
    return f"{rate(ren, den)} as renewal_rate_{freq.lower()}"


register("corporate_accounts", "DIA-14", X.corporate_accounts, f"""
with rev as (select owner_id as organisation_id, currency, sum(amount) as revenue from sf_rev
             where owner_type = 'organisation' group by 1, 2),
     ren as (select s.owner_id as organisation_id, {_renewal('Monthly')}, {_renewal('Annual')}
             from subscription_events e join sf_subs s on s.subscription_id = e.subscription_id
             where s.owner_type = 'organisation' and e.event_type in ('renewed', 'subscription_ended') group by 1),
     util as (select s.organisation_id, count(*) as open_subscriptions, sum(s.seats_purchased) as seats_purchased,
                     sum(coalesce(u.n, 0)) as seats_activated
              from subscriptions s
              left join (select subscription_id, count(*) filter (where user_status = 'active') as n
                         from organisation_users group by 1) u on u.subscription_id = s.subscription_id
              where s.organisation_id is not null and s.status <> 'ended' group by 1),
     ch as (select s.organisation_id,
                   sum(case when e.new_seat_count > e.previous_seat_count then e.new_seat_count - e.previous_seat_count else 0 end) as seats_added,
                   sum(case when e.new_seat_count < e.previous_seat_count then e.previous_seat_count - e.new_seat_count else 0 end) as seats_removed
            from subscription_events e join subscriptions s on s.subscription_id = e.subscription_id
            where e.event_type = 'seats_changed' group by 1),
     j as (select o.organisation_id, o.organisation_type, {BAND.format(s='o.organisation_size')} as size_band,
                  rev.currency, ren.renewal_rate_monthly, ren.renewal_rate_annual,
                  cast(coalesce(rev.revenue, 0) as decimal(18,2)) as revenue,
                  cast(coalesce(util.open_subscriptions, 0) as bigint) as open_subscriptions,
                  cast(coalesce(util.seats_purchased, 0) as bigint) as seats_purchased,
                  cast(coalesce(util.seats_activated, 0) as bigint) as seats_activated,
                  cast(coalesce(ch.seats_added, 0) as bigint) as seats_added,
                  cast(coalesce(ch.seats_removed, 0) as bigint) as seats_removed
           from organisations o left join rev on rev.organisation_id = o.organisation_id
           left join ren on ren.organisation_id = o.organisation_id
           left join util on util.organisation_id = o.organisation_id left join ch on ch.organisation_id = o.organisation_id)
select *, cast(rank() over (partition by currency order by revenue desc) as integer) as revenue_rank,
       {rate('seats_activated', 'seats_purchased')} as utilisation,
       round(cast(revenue as double) / nullif(cast(seats_purchased as double), 0), 2) as revenue_per_seat
from j""")

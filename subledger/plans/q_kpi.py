"""KPI queries (KPI-1..23): growth, revenue, retention."""

from __future__ import annotations

from ..operators import kpi as K
from .catalog import register
from .oracle_fixtures import AS_OF

M = "cast(date_trunc('month', {}) as date)"
PREV = "cast({} - interval 1 month as date)"
OPEN_MONTH = f"cast(date_trunc('month', {AS_OF}) as date)"


def rate(num: str, den: str) -> str:
    return f"round(cast({num} as double) / nullif(cast({den} as double), 0), 6)"


register("new_subscribers", "KPI-1", K.new_subscribers, f"""
select {M.format('first_start')} as month, owner_type, count(*) as new_subscribers
from sf_first group by 1, 2""")

register("active_subscribers", "KPI-2", K.active_subscribers, """
select month, count(*) as active_subscribers from sf_owner_months group by month""")

register("paid_subscribers", "KPI-3", K.paid_subscribers, """
select m.month, count(*) as paid_subscribers
from sf_owner_months m join (select owner_id, min(paid_at) as fp from sf_rev group by owner_id) p
  on p.owner_id = m.owner_id
where p.fp < cast(last_day(m.month) + 1 as timestamp)
group by m.month""")

register("subscriber_growth_rate", "KPI-4", K.subscriber_growth_rate, f"""
with a as (select month, count(*) as active_subscribers from sf_owner_months group by month)
select a.month, a.active_subscribers, p.active_subscribers as previous_active,
       {rate('a.active_subscribers - p.active_subscribers', 'p.active_subscribers')} as growth_rate
from a left join a p on p.month = {PREV.format('a.month')}""")

register("trial_registrations", "KPI-5", K.trial_registrations, f"""
select {M.format('trial_started_at')} as month, product_id, count(*) as trials from trials group by 1, 2""")

register("trial_to_paid_conversion_rate", "KPI-6", K.trial_to_paid_conversion_rate, f"""
select *, {rate('converted', 'trials')} as conversion_rate, {rate('converted', 'decided')} as decided_conversion_rate
from (select {M.format('trial_started_at')} as month, count(*) as trials,
             count(*) filter (where trial_status = 'converted') as converted,
             count(*) filter (where trial_status <> 'active') as decided
      from trials group by 1) g""")

REACT = """
select c.*, (select min(o.start_date) from sf_subs o where o.owner_id = c.owner_id and o.start_date > c.churn_date)
            as next_start
from sf_churn c"""

register("reactivated_subscribers", "KPI-7", K.reactivated_subscribers, f"""
with r as (select {M.format('next_start')} as month, count(distinct owner_id) as n
           from ({REACT}) x where next_start is not null group by 1),
     e as (select {M.format('event_at')} as month, count(*) as n
           from subscription_events where event_type = 'reactivated' group by 1)
select coalesce(r.month, e.month) as month, coalesce(r.n, 0) as reactivated_owners,
       coalesce(e.n, 0) as reactivated_events
from r full join e on r.month = e.month""")

register("gross_subscription_revenue", "KPI-8", K.gross_subscription_revenue, """
select month, currency, cast(sum(amount) as decimal(18,2)) as gross_revenue, count(*) as payments
from sf_rev group by 1, 2""")

register("net_subscription_revenue", "KPI-9", K.net_subscription_revenue, f"""
select {M.format('payment_attempted_at')} as month, currency,
       cast(coalesce(sum(amount) filter (where payment_status = 'successful'), 0) as decimal(18,2)) as gross_revenue,
       cast(coalesce(sum(amount) filter (where payment_status = 'failed'), 0) as decimal(18,2)) as failed_amount,
       cast(coalesce(sum(amount) filter (where payment_status = 'pending'), 0) as decimal(18,2)) as pending_amount,
       cast(0 as decimal(18,2)) as refunds,
       cast(coalesce(sum(amount) filter (where payment_status = 'successful'), 0) as decimal(18,2)) as net_revenue
from payments group by 1, 2""")

register("revenue_growth", "KPI-10", K.revenue_growth, f"""
with g as (select month, currency, cast(sum(amount) as decimal(18,2)) as revenue from sf_rev group by 1, 2)
select g.month, g.currency, g.revenue, p.revenue as previous_revenue,
       {rate('g.revenue - p.revenue', 'p.revenue')} as growth_rate
from g left join g p on p.currency = g.currency and p.month = {PREV.format('g.month')}""")

register("revenue_by_product", "KPI-11", K.revenue_by_product, f"""
select month, currency, product_name, revenue, payments,
       {rate('revenue', 'sum(revenue) over (partition by month, currency)')} as share
from (select month, currency, product_name, cast(sum(amount) as decimal(18,2)) as revenue, count(*) as payments
      from sf_rev group by 1, 2, 3) g""")

register("revenue_by_billing_frequency", "KPI-12", K.revenue_by_billing_frequency, """
select month, currency, product_name, billing_frequency, cast(sum(amount) as decimal(18,2)) as revenue,
       cast(grouping(month, currency, product_name, billing_frequency) as integer) as grouping_level
from sf_rev
group by grouping sets ((month, currency, product_name, billing_frequency), (month, currency, product_name),
                        (month, currency))""")

MRR = """
select month, currency,
       sum(cast(rec as double) * case billing_frequency when 'Daily' then cast(30 as double)
                                    when 'Weekly' then cast(52 as double) / 12 when 'Monthly' then cast(1 as double)
                                    when 'Annual' then cast(1 as double) / 12 end) as mrr_raw
from (select month, currency, billing_frequency, sum(unit_price * coalesce(seats_purchased, 1)) as rec
      from sf_cal group by 1, 2, 3) x
group by 1, 2"""

register("monthly_recurring_revenue", "KPI-13", K.monthly_recurring_revenue,
         f"select month, currency, round(mrr_raw, 2) as mrr from ({MRR}) m")

register("annual_recurring_revenue", "KPI-14", K.annual_recurring_revenue,
         f"select month, currency, round(mrr_raw * 12, 2) as arr from ({MRR}) m")

register("average_revenue_per_user", "KPI-15", K.average_revenue_per_user, f"""
select a.month, a.currency, a.active_owners, cast(coalesce(r.revenue, 0) as decimal(18,2)) as revenue,
       {rate('coalesce(r.revenue, 0)', 'a.active_owners')} as arpu
from (select month, currency, count(distinct owner_id) as active_owners from sf_cal_any group by 1, 2) a
left join (select month, currency, sum(amount) as revenue from sf_rev group by 1, 2) r
  on r.month = a.month and r.currency = a.currency""")

register("average_revenue_per_paying_user", "KPI-16", K.average_revenue_per_paying_user, f"""
select month, currency, revenue, paying_owners, {rate('revenue', 'paying_owners')} as arppu
from (select month, currency, cast(sum(amount) as decimal(18,2)) as revenue, count(distinct owner_id) as paying_owners
      from sf_rev group by 1, 2) g""")

RENEWAL = """
select *, {rate} as renewal_rate
from (select cast(date_trunc('month', event_at) as date) as month,
             count(*) filter (where event_type = 'renewed') as renewed,
             count(*) filter (where event_type = 'subscription_ended' and event_reason <> 'plan_change') as lapsed
      from {src} where event_type in ('renewed', 'subscription_ended') group by 1) g
where renewed + lapsed > 0"""

register("renewal_rate", "KPI-17", K.renewal_rate,
         RENEWAL.format(rate=rate("renewed", "renewed + lapsed"), src="subscription_events"))

register("retention_rate", "KPI-18", K.retention_rate, f"""
select s.month, count(*) as active_at_start, count(e.owner_id) as retained,
       {rate('count(e.owner_id)', 'count(*)')} as retention_rate
from (select owner_id, cast(month + interval 1 month as date) as month from sf_owner_months) s
left join sf_owner_months e on e.owner_id = s.owner_id and e.month = s.month
where s.month < {OPEN_MONTH}
group by s.month""")


def churn_rate_sql(churn_where: str = "true", owner_where: str = "true") -> str:
    return f"""
select coalesce(b.month, c.month) as month, coalesce(b.n, 0) as active_at_start, coalesce(c.n, 0) as churned,
       {rate('coalesce(c.n, 0)', 'coalesce(b.n, 0)')} as churn_rate
from (select cast(month + interval 1 month as date) as month, count(*) as n
      from sf_owner_months where {owner_where} group by 1) b
full join (select churn_month as month, count(distinct owner_id) as n
           from sf_churn where {churn_where} and {owner_where} group by 1) c on b.month = c.month
where coalesce(b.month, c.month) < {OPEN_MONTH}"""


register("churn_rate", "KPI-19", K.churn_rate, churn_rate_sql())
register("voluntary_churn_rate", "KPI-20", K.voluntary_churn_rate, churn_rate_sql("churn_type = 'Voluntary'"))
register("involuntary_churn_rate", "KPI-21", K.involuntary_churn_rate, f"""
select coalesce(i.month, x.month) as month, i.active_at_start, i.churned, i.churn_rate,
       x.churned as expiry_churned, x.churn_rate as expiry_churn_rate
from ({churn_rate_sql("churn_type = 'Involuntary'")}) i
full join ({churn_rate_sql("churn_type = 'Expiry / Non-renewal'")}) x on i.month = x.month""")

register("cohort_retention", "KPI-22", K.cohort_retention, f"""
with f as (select owner_id, {M.format('first_start')} as cohort_month from sf_first),
     s as (select cohort_month, count(*) as cohort_size from f group by 1)
select a.cohort_month, a.months_since, a.active_owners, s.cohort_size,
       {rate('a.active_owners', 's.cohort_size')} as retention
from (select f.cohort_month, cast(datediff('month', f.cohort_month, m.month) as integer) as months_since,
             count(*) as active_owners
      from sf_owner_months m join f on f.owner_id = m.owner_id group by 1, 2) a
join s on s.cohort_month = a.cohort_month""")

register("average_customer_tenure", "KPI-23", K.average_customer_tenure, """
select owner_type, count(*) as owners, round(avg(tenure_days), 4) as avg_tenure_days
from sf_tenure group by owner_type""")


# ----------------------------------------------------------------------- "by ..." questions
register("new_subscribers_by_channel", "KPI-1", K.new_subscribers_by_channel, f"""
select {M.format('f.first_start')} as month, coalesce(a.channel, 'Organisation') as channel, count(*) as new_subscribers
from sf_first f left join sf_attr a on a.customer_id = f.owner_id group by 1, 2""")

register("active_subscribers_by_product", "KPI-2", lambda t: K.active_subscribers(t, by=("product_name",)), """
select month, product_name, count(*) as active_subscribers
from (select distinct owner_id, month, product_name from sf_cal) x group by 1, 2""")

register("retention_rate_by_product", "KPI-18", lambda t: K.retention_rate(t, by=("product_name",)), f"""
select s.month, s.product_name, count(*) as active_at_start, count(e.owner_id) as retained,
       {rate('count(e.owner_id)', 'count(*)')} as retention_rate
from (select distinct owner_id, product_name, cast(month + interval 1 month as date) as month from sf_cal) s
left join sf_owner_months e on e.owner_id = s.owner_id and e.month = s.month
where s.month < {OPEN_MONTH}
group by s.month, s.product_name""")


def churn_by_sql(dim: str) -> str:
    return f"""
select coalesce(b.month, c.month) as month, coalesce(b.{dim}, c.{dim}) as {dim},
       coalesce(b.n, 0) as active_at_start, coalesce(c.n, 0) as churned,
       {rate('coalesce(c.n, 0)', 'coalesce(b.n, 0)')} as churn_rate
from (select cast(month + interval 1 month as date) as month, {dim}, count(*) as n
      from (select distinct owner_id, month, {dim} from sf_cal) x group by 1, 2) b
full join (select churn_month as month, {dim}, count(distinct owner_id) as n from sf_churn group by 1, 2) c
  on b.month = c.month and b.{dim} = c.{dim}
where coalesce(b.month, c.month) < {OPEN_MONTH}"""


register("churn_rate_by_frequency", "KPI-19", lambda t: K.churn_rate(t, by=("billing_frequency",)),
         churn_by_sql("billing_frequency"))
register("churn_rate_by_product", "KPI-19", lambda t: K.churn_rate(t, by=("product_name",)),
         churn_by_sql("product_name"))

register("revenue_by_owner_type", "KPI-8", lambda t: K.gross_subscription_revenue(t, by=("owner_type",)), """
select month, currency, owner_type, cast(sum(amount) as decimal(18,2)) as gross_revenue, count(*) as payments
from sf_rev group by 1, 2, 3""")

register("mrr_by_product", "KPI-13", lambda t: K.monthly_recurring_revenue(t, by=("product_name",)),
         "select month, currency, product_name, round(mrr_raw, 2) as mrr from ("
         + MRR.replace("select month, currency,", "select month, currency, product_name,")
         .replace("from sf_cal group by 1, 2, 3)", "from sf_cal group by 1, 2, 3, 4)").replace("x\ngroup by 1, 2", "x\ngroup by 1, 2, 3")
         + ") m")

register("arppu_by_frequency", "KPI-16",
         lambda t: K.average_revenue_per_paying_user(t, by=("billing_frequency",)), f"""
select month, currency, billing_frequency, cast(sum(amount) as decimal(18,2)) as revenue,
       count(distinct owner_id) as paying_owners, {rate('sum(amount)', 'count(distinct owner_id)')} as arppu
from sf_rev group by 1, 2, 3""")

register("renewal_rate_by_frequency", "KPI-17", lambda t: K.renewal_rate(t, by=("billing_frequency",)), f"""
select * from (
  select cast(date_trunc('month', e.event_at) as date) as month, s.billing_frequency,
         count(*) filter (where e.event_type = 'renewed') as renewed,
         count(*) filter (where e.event_type = 'subscription_ended' and e.event_reason <> 'plan_change') as lapsed,
         {rate("count(*) filter (where e.event_type = 'renewed')",
               "count(*) filter (where e.event_type = 'renewed' or (e.event_type = 'subscription_ended' and e.event_reason <> 'plan_change'))")} as renewal_rate
  from subscription_events e join sf_subs s on s.subscription_id = e.subscription_id
  where e.event_type in ('renewed', 'subscription_ended') group by 1, 2) x
where renewed + lapsed > 0""")

register("gross_revenue_as_of_2023_07", "KPI-8",
         lambda t: K.gross_subscription_revenue(t.before("2023-07-01")), """
select month, currency, cast(sum(amount) as decimal(18,2)) as gross_revenue, count(*) as payments
from sf_rev where paid_at < timestamp '2023-07-01' group by 1, 2""")

ACTIVE_ROLLUP = """
select month, product_name, billing_frequency, count(distinct owner_id) as active_subscribers,
       cast(grouping(month, product_name, billing_frequency) as integer) as grouping_level
from sf_cal
group by grouping sets ((month, product_name, billing_frequency), (month, product_name), (month))"""

register("active_subscribers_rollup", "KPI-2", K.active_subscribers_rollup, ACTIVE_ROLLUP)
register("active_subscribers_sketch", "KPI-2", K.active_subscribers_sketch,
         f"select *, true as within_bound from ({ACTIVE_ROLLUP}) g")

register("paid_subscribers_by_product", "KPI-3", lambda t: K.paid_subscribers(t, by=("product_name",)), """
select m.month, m.product_name, count(distinct m.owner_id) as paid_subscribers
from sf_cal m
where exists (select 1 from sf_rev p where p.owner_id = m.owner_id and p.product_name = m.product_name
                and p.paid_at < cast(last_day(m.month) + 1 as timestamp))
group by 1, 2""")

register("subscriber_growth_by_owner_type", "KPI-4", lambda t: K.subscriber_growth_rate(t, by=("owner_type",)), f"""
with a as (select month, owner_type, count(*) as active_subscribers from sf_owner_months group by 1, 2)
select a.month, a.owner_type, a.active_subscribers, p.active_subscribers as previous_active,
       {rate('a.active_subscribers - p.active_subscribers', 'p.active_subscribers')} as growth_rate
from a left join a p on p.owner_type = a.owner_type and p.month = {PREV.format('a.month')}""")

register("trial_conversion_by_product", "KPI-6",
         lambda t: K.trial_to_paid_conversion_rate(t, by=("product_id",)), f"""
select *, {rate('converted', 'trials')} as conversion_rate, {rate('converted', 'decided')} as decided_conversion_rate
from (select {M.format('trial_started_at')} as month, product_id, count(*) as trials,
             sum(case when trial_status = 'converted' then 1 else 0 end)::bigint as converted,
             sum(case when trial_status = 'active' then 0 else 1 end)::bigint as decided
      from trials group by 1, 2) g""")

register("net_revenue_by_product", "KPI-9", lambda t: K.net_subscription_revenue(t, by=("product_name",)), f"""
select month, currency, product_name, gross_revenue, failed_amount, pending_amount,
       cast(0 as decimal(18,2)) as refunds, gross_revenue as net_revenue
from (select {M.format('p.payment_attempted_at')} as month, p.currency, s.product_name,
             cast(sum(case p.payment_status when 'successful' then p.amount else 0 end) as decimal(18,2)) as gross_revenue,
             cast(sum(case p.payment_status when 'failed' then p.amount else 0 end) as decimal(18,2)) as failed_amount,
             cast(sum(case p.payment_status when 'pending' then p.amount else 0 end) as decimal(18,2)) as pending_amount
      from payments p join sf_subs s on s.subscription_id = p.subscription_id group by 1, 2, 3) g""")

register("arpu_by_product", "KPI-15", lambda t: K.average_revenue_per_user(t, by=("product_name",)), f"""
select a.month, a.currency, a.product_name, a.active_owners,
       cast(coalesce(r.revenue, 0) as decimal(18,2)) as revenue,
       {rate('coalesce(r.revenue, 0)', 'a.active_owners')} as arpu
from (select month, currency, product_name, count(distinct owner_id) as active_owners from sf_cal_any group by 1, 2, 3) a
left join (select month, currency, product_name, sum(amount) as revenue from sf_rev group by 1, 2, 3) r
  on r.month = a.month and r.currency = a.currency and r.product_name = a.product_name""")


def typed_churn_by_sql(key: str, churn_type: str) -> str:
    """Churn of one type per month and ``key``: cells with owners at month start or with a churn."""
    return f"""
select coalesce(b.month, c.month) as month, coalesce(b.{key}, c.{key}) as {key}, coalesce(b.n, 0) as active_at_start,
       coalesce(c.n, 0) as churned, {rate('coalesce(c.n, 0)', 'coalesce(b.n, 0)')} as churn_rate
from (select cast(month + interval 1 month as date) as month, {key}, count(distinct owner_id) as n
      from sf_cal group by 1, 2) b
full join (select churn_month as month, {key}, count(distinct owner_id) as n
           from sf_churn where churn_type = '{churn_type}' group by 1, 2) c on b.month = c.month and b.{key} = c.{key}
where coalesce(b.month, c.month) < {OPEN_MONTH}"""


register("voluntary_churn_by_frequency", "KPI-20", lambda t: K.voluntary_churn_rate(t, by=("billing_frequency",)),
         typed_churn_by_sql("billing_frequency", "Voluntary"))
register("involuntary_churn_by_product", "KPI-21", lambda t: K.involuntary_churn_rate(t, by=("product_name",)), f"""
select coalesce(i.month, x.month) as month, coalesce(i.product_name, x.product_name) as product_name,
       i.active_at_start, i.churned, i.churn_rate, x.churned as expiry_churned, x.churn_rate as expiry_churn_rate
from ({typed_churn_by_sql("product_name", "Involuntary")}) i
full join ({typed_churn_by_sql("product_name", "Expiry / Non-renewal")}) x
  on i.month = x.month and i.product_name = x.product_name""")

register("subscription_duration_by_product", "KPI-26",
         lambda t: K.average_subscription_duration(t, by=("product_name",)), f"""
select product_name, count(end_date) as ended_subscriptions,
       round(avg(case when end_date is not null then end_date - start_date end), 4) as avg_ended_days,
       count(*) as all_subscriptions, round(avg(coalesce(end_date, {AS_OF}) - start_date), 4) as avg_all_days
from sf_subs where start_date < {AS_OF} group by product_name""")

register("reactivation_rate_by_product", "KPI-29", lambda t: K.reactivation_rate(t, by=("product_name",)), f"""
select *, {rate('reactivated_owners', 'churned_owners')} as reactivation_rate
from (select churn_month, product_name, count(distinct owner_id) as churned_owners,
             count(distinct case when next_start is not null then owner_id end) as reactivated_owners
      from ({REACT}) x group by 1, 2) g""")

"""DuckDB text of the shared derived views used by the oracle queries.

Written independently of the Spark operators (correlated ``not exists``,
calendar joins against a month spine) so the oracle checks semantics, not
a transcription of the same plan.
"""

from __future__ import annotations

from .oracle_fixtures import AS_OF, _cte

GRACE = 30

_cte("sf_subs", ["subscriptions", "plans", "products"], """
select s.subscription_id, coalesce(s.customer_id, s.organisation_id) as owner_id,
       case when s.organisation_id is not null then 'organisation' else 'customer' end as owner_type,
       s.customer_id, s.organisation_id, s.plan_id, p.product_id, pr.product_name, pr.product_family,
       p.billing_frequency, p.billing_period_days, p.unit_price, p.currency,
       s.subscription_start_date as start_date, s.subscription_end_date as end_date, s.status, s.end_reason,
       s.seats_purchased, s.auto_renew, s.cancellation_requested_at
from subscriptions s join plans p on s.plan_id = p.plan_id join products pr on pr.product_id = p.product_id""")

_cte("sf_months", [], f"""
select cast(range as date) as month from range(timestamp '2015-01-01', cast({AS_OF} as timestamp), interval 1 month)""")

# active at month end
_cte("sf_cal", ["sf_subs", "sf_months"], f"""
select s.*, m.month
from sf_subs s join sf_months m
  on s.start_date <= last_day(m.month)
 and (s.end_date is null or s.end_date > last_day(m.month))
 and last_day(m.month) < {AS_OF}""")

# active on at least one day of the month (before as_of)
_cte("sf_cal_any", ["sf_subs", "sf_months"], f"""
select s.*, m.month
from sf_subs s join sf_months m
  on greatest(s.start_date, m.month) < least(coalesce(s.end_date, date '9999-12-31'), last_day(m.month) + 1, {AS_OF})""")

_cte("sf_owner_months", ["sf_cal"], "select distinct owner_id, owner_type, month from sf_cal")

_cte("sf_churn", ["sf_subs"], f"""
select e.subscription_id, e.owner_id, e.owner_type, e.product_name, e.billing_frequency, e.plan_id, e.start_date,
       e.end_date as churn_date, cast(date_trunc('month', e.end_date) as date) as churn_month, e.end_reason,
       case e.end_reason when 'voluntary_cancel' then 'Voluntary' when 'payment_failure' then 'Involuntary'
            when 'non_renewal' then 'Expiry / Non-renewal' when 'plan_change' then 'Not churn' end as churn_type
from sf_subs e
where e.status = 'ended' and e.end_reason <> 'plan_change' and e.end_date + {GRACE} < {AS_OF}
  and not exists (select 1 from sf_subs o
                  where o.owner_id = e.owner_id and o.start_date <= e.end_date + {GRACE}
                    and (o.end_date is null or o.end_date > e.end_date))""")

_cte("sf_rev", ["payments", "sf_subs"], """
select p.payment_id, p.subscription_id, p.amount, p.currency, p.payment_attempted_at as paid_at,
       s.owner_id, s.owner_type, s.product_name, s.product_id, s.billing_frequency, s.plan_id,
       cast(date_trunc('month', p.payment_attempted_at) as date) as month
from payments p join sf_subs s on p.subscription_id = s.subscription_id
where p.payment_status = 'successful'""")

_cte("sf_first", ["sf_subs"], """
select owner_id, owner_type, min(start_date) as first_start from sf_subs group by owner_id, owner_type""")

_cte("sf_attr", ["sf_first", "marketing_touchpoints"], """
select f.owner_id as customer_id, f.first_start,
       coalesce(t.channel, 'Unattributed') as channel, t.campaign_name, t.touchpoint_at
from sf_first f
left join (
    select tp.*, row_number() over (partition by tp.customer_id order by tp.touchpoint_at, tp.touchpoint_id) as rk
    from marketing_touchpoints tp join sf_first f2 on tp.customer_id = f2.owner_id
    where tp.touchpoint_at <= cast(f2.first_start as timestamp)
) t on t.customer_id = f.owner_id and t.rk = 1
where f.owner_type = 'customer'""")

_cte("sf_ltv", ["sf_first", "sf_rev", "sf_subs"], """
select f.owner_id, f.owner_type, f.first_start,
       coalesce(r.currency, (select s.currency from sf_subs s where s.owner_id = f.owner_id
                             order by s.start_date, s.subscription_id limit 1)) as currency,
       cast(coalesce(r.revenue, 0) as decimal(18,2)) as ltv
from sf_first f left join (select owner_id, currency, sum(amount) as revenue from sf_rev group by 1, 2) r
  on r.owner_id = f.owner_id""")

_cte("sf_islands", ["sf_subs"], f"""
select owner_id, owner_type, isl, min(start_date) as island_start, max(stop) as island_stop
from (
    select *, sum(case when prev_reach is null or start_date > prev_reach then 1 else 0 end)
                over (partition by owner_id order by start_date, subscription_id rows between unbounded preceding and current row) as isl
    from (
        select owner_id, owner_type, subscription_id, start_date,
               least(coalesce(end_date, {AS_OF}), {AS_OF}) as stop,
               max(least(coalesce(end_date, {AS_OF}), {AS_OF})) over (partition by owner_id order by start_date, subscription_id
                   rows between unbounded preceding and 1 preceding) as prev_reach
        from sf_subs where start_date < {AS_OF}
    ) a
) b
group by owner_id, owner_type, isl""")

_cte("sf_tenure", ["sf_islands"], """
select owner_id, owner_type, cast(sum(datediff('day', island_start, island_stop)) as bigint) as tenure_days,
       cast(count(*) as bigint) as islands, min(island_start) as first_start
from sf_islands group by owner_id, owner_type""")

# plan moves: old subscription ended by plan change -> the owner's next subscription
_cte("sf_moves", ["sf_subs", "plans", "products"], """
select a.owner_id, a.owner_type, a.subscription_id as from_subscription_id, b.subscription_id as to_subscription_id,
       a.end_date as move_date, cast(date_trunc('month', a.end_date) as date) as move_month,
       a.product_name as from_product, b.product_name as to_product,
       a.billing_frequency as from_frequency, b.billing_frequency as to_frequency,
       ta.tier_price as from_tier, tb.tier_price as to_tier,
       a.billing_period_days as from_period_days, b.billing_period_days as to_period_days,
       a.unit_price * coalesce(a.seats_purchased, 1) as from_price, b.unit_price * coalesce(b.seats_purchased, 1) as to_price,
       a.billing_frequency as from_freq_key, b.billing_frequency as to_freq_key,
       coalesce(a.seats_purchased, 1) as from_seats, coalesce(b.seats_purchased, 1) as to_seats,
       a.unit_price as from_unit_price, b.unit_price as to_unit_price,
       a.currency as from_currency, b.currency as to_currency,
       case when tb.tier_price > ta.tier_price then 'upgrade' when tb.tier_price < ta.tier_price then 'downgrade'
            when a.product_id <> b.product_id then 'lateral' else 'same' end as product_move,
       case when b.billing_period_days > a.billing_period_days then 'longer'
            when b.billing_period_days < a.billing_period_days then 'shorter' else 'same' end as cycle_move
from (select *, lead(subscription_id) over (partition by owner_id order by start_date, subscription_id) as nxt
      from sf_subs) a
join sf_subs b on b.subscription_id = a.nxt
join (select p.product_id, p.unit_price as tier_price from plans p where p.billing_frequency = 'Monthly') ta
  on ta.product_id = a.product_id
join (select p.product_id, p.unit_price as tier_price from plans p where p.billing_frequency = 'Monthly') tb
  on tb.product_id = b.product_id
where a.end_reason = 'plan_change'""")

"""Predictive / prescriptive queries (PRD-*). MLlib models are rows-only checks."""

from __future__ import annotations

from ..operators import predict as P
from .catalog import register
from .oracle_fixtures import AS_OF
from .q_kpi import MRR, rate
from .q_more import CAC, LTV_BY_CHANNEL, MOVES, OWNER_VALUE

LABEL_AT = "2023-11-01"


def features_sql(s: str = AS_OF) -> str:
    return f"""
select o.owner_id, o.owner_type,
       cast(datediff('day', (select max(e.engagement_date) from customer_engagement e
                             where e.customer_id = o.owner_id and e.engagement_date < {s}), {s}) as integer) as days_since_active,
       cast(coalesce((select sum(e.sessions_count) from customer_engagement e where e.customer_id = o.owner_id
                      and e.engagement_date >= {s} - 30 and e.engagement_date < {s}), 0) as bigint) as sessions_30d,
       cast(coalesce((select sum(e.sessions_count) from customer_engagement e where e.customer_id = o.owner_id
                      and e.engagement_date >= {s} - 60 and e.engagement_date < {s} - 30), 0) as bigint) as sessions_prev_30d,
       cast((select count(*) from payments p join sf_subs x on x.subscription_id = p.subscription_id
             where x.owner_id = o.owner_id and p.payment_status = 'failed'
               and cast(p.payment_attempted_at as date) >= {s} - 90 and cast(p.payment_attempted_at as date) < {s})
            as bigint) as failed_payments_90d,
       cast((select count(*) from support_interactions u where u.customer_id = o.owner_id
             and cast(u.interaction_at as date) >= {s} - 90 and cast(u.interaction_at as date) < {s}) as bigint)
           as support_cases_90d,
       case when exists (select 1 from subscription_events e join sf_subs x on x.subscription_id = e.subscription_id
                         where x.owner_id = o.owner_id and e.event_type = 'cancellation_requested'
                           and e.event_at < cast({s} as timestamp) and e.event_at >= cast({s} - 90 as timestamp))
            then 1 else 0 end as cancel_intent,
       cast(coalesce(tn.tenure_days, 0) as bigint) as tenure_days,
       lp.billing_frequency, lp.product_name,
       coalesce(atr.channel, case when o.owner_type = 'organisation' then 'Organisation' else 'Unattributed' end) as channel
from (select distinct owner_id, owner_type from sf_subs
      where start_date < {s} and (end_date is null or end_date >= {s})) o
left join sf_tenure tn on tn.owner_id = o.owner_id
left join (select owner_id, billing_frequency, product_name,
                  row_number() over (partition by owner_id order by start_date desc, subscription_id desc) as rk
           from sf_subs where start_date < {s}) lp on lp.owner_id = o.owner_id and lp.rk = 1
left join sf_attr atr on atr.customer_id = o.owner_id"""


RISK = f"""
select owner_id, owner_type, cast(least(
         case when days_since_active is null or days_since_active > 14 then 20 else 0 end
       + case when sessions_30d * 2 < sessions_prev_30d then 15 else 0 end
       + least(failed_payments_90d * 10, 30) + least(support_cases_90d * 5, 15)
       + cancel_intent * 25 + case when tenure_days < 90 then 10 else 0 end, 100) as integer) as risk_score
from ({features_sql()}) f"""
RISK_BANDED = f"""
select *, case when risk_score >= 60 then 'high' when risk_score >= 30 then 'medium' else 'low' end as risk_band
from ({RISK}) r"""

register("churn_features", "PRD-1", lambda t: P.churn_features(t, t.as_of), features_sql())

register("churn_labels", "PRD-2", lambda t: P.churn_labels(t, LABEL_AT), f"""
select o.owner_id, o.owner_type,
       cast(case when exists (select 1 from sf_churn c where c.owner_id = o.owner_id
                               and c.churn_date > date '{LABEL_AT}' and c.churn_date <= date '{LABEL_AT}' + 30)
                 then 1 else 0 end as integer) as label
from (select distinct owner_id, owner_type from sf_subs
      where start_date < date '{LABEL_AT}' and (end_date is null or end_date >= date '{LABEL_AT}')) o""")

register("churn_model", "PRD-3", P.churn_model)
register("churn_model_auc", "PRD-3", P.churn_model_auc)
register("upgrade_propensity", "PRD-6", P.upgrade_propensity)
SCORED_OWNERS = """
select count(*) as rows, count(*) as owners, count(*) as in_range
from (select distinct owner_id from sf_subs where start_date < date '2023-12-01'
      and (end_date is null or end_date >= date '2023-12-01')) o"""
register("churn_model_summary", "PRD-3", lambda t: P.score_summary(P.churn_model(t), "probability", 0.0, 1.0),
         SCORED_OWNERS)
register("upgrade_propensity_summary", "PRD-6",
         lambda t: P.score_summary(P.upgrade_propensity(t), "probability", 0.0, 1.0), SCORED_OWNERS)
register("kmeans_segments_summary", "PRD-7", lambda t: P.score_summary(P.kmeans_segments(t), "cluster", 0, 3), f"""
select count(*) as rows, count(*) as owners, count(*) as in_range
from (select distinct owner_id from sf_rev where paid_at < cast({AS_OF} as timestamp)) o""")
register("churn_risk_score", "PRD-4", P.churn_risk_score, RISK_BANDED)

register("revenue_forecast", "PRD-5", P.revenue_forecast, """
with r as (select * from sf_rev where paid_at < cast(date '2024-02-01' as timestamp)),
     s as (select month, currency, product_name, billing_frequency, sum(amount) as revenue from r group by 1, 2, 3, 4
           union all
           select month, currency, 'ALL', 'ALL', sum(amount) from r group by 1, 2),
     x as (select *, cast(year(month) * 12 + month(month) as double) as x from s),
     fit as (select currency, product_name, billing_frequency, regr_slope(cast(revenue as double), x) as slope,
                    regr_intercept(cast(revenue as double), x) as intercept, count(*) as points
             from x group by 1, 2, 3),
     h(h) as (values (1), (2), (3)),
     f as (select fit.*, h.h, cast((select max(month) from s) + to_months(h.h) as date) as month from fit, h)
select currency, product_name, billing_frequency, month, cast(h as integer) as horizon, cast(points as bigint) as points,
       round(greatest(intercept + slope * cast(year(month) * 12 + month(month) as double), 0.0), 2) as forecast_revenue
from f""")

_LAST = f"(year({AS_OF} - interval 1 month) * 12 + month({AS_OF} - interval 1 month))"
_K = "currency, product_name, billing_frequency"


def _models(origins: str) -> str:
    """Figures of the three models per series, origin and horizon, from the months up to each origin."""
    same = "i.currency = g.currency and i.product_name = g.product_name and i.billing_frequency = g.billing_frequency"
    return f"""
    select g.currency, g.product_name, g.billing_frequency, o.origin, h.h as horizon,
           (select count(*) from sp i where {same} and i.x <= o.origin) as points,
           greatest(coalesce((select regr_intercept(y, x) + regr_slope(y, x) * (o.origin + h.h) from sp i
                              where {same} and i.x <= o.origin),
                             (select avg(y) from sp i where {same} and i.x <= o.origin)), 0.0) as linear,
           (select case when count(*) >= 12 and avg(y) > 0 then
                     avg(y) filter (where x > o.origin - 12)
                     * avg(y) filter (where x % 12 = (o.origin + h.h) % 12) / avg(y) end
            from sp i where {same} and i.x <= o.origin) as index,
           (select case when count(*) >= 12 then max(y) filter (where x = o.origin + h.h - 12) end
            from sp i where {same} and i.x <= o.origin) as naive
    from (select distinct {_K} from sp) g, ({origins}) o(origin), (values (1), (2), (3)) h(h)
    where exists (select 1 from sp i where {same} and i.x <= o.origin)"""


SEASONAL = f"""
with r as (select * from sf_rev where paid_at < cast({AS_OF} as timestamp) and month < date_trunc('month', {AS_OF})),
     s as (select month, {_K}, sum(amount) as revenue from r group by all
           union all select month, currency, 'ALL', 'ALL', sum(amount) from r group by 1, 2),
     f as (select {_K}, min(month) as first from s group by all),
     m as (select f.*, cast(unnest(generate_series(cast(first as timestamp), cast({AS_OF} - interval 1 month as timestamp),
                                                   interval 1 month)) as date) as month from f),
     sp as (select m.currency, m.product_name, m.billing_frequency, coalesce(cast(s.revenue as double), 0.0) as y,
                   year(m.month) * 12 + month(m.month) as x
            from m left join s on s.currency = m.currency and s.product_name = m.product_name
              and s.billing_frequency = m.billing_frequency and s.month = m.month),
     back as (select b.*, t.y as truth from ({_models(f"select unnest(range({_LAST} - 6, {_LAST}))")}) b
              join sp t on t.currency = b.currency and t.product_name = b.product_name
                and t.billing_frequency = b.billing_frequency and t.x = b.origin + b.horizon),
     fut as ({_models(f"select {_LAST}")}),
     err as (select {_K}, case when count(linear) = count(*) then round(avg(abs(linear - truth)), 2) end as linear_error,
                    case when count(index) = count(*) then round(avg(abs(index - truth)), 2) end as index_error,
                    case when count(naive) = count(*) then round(avg(abs(naive - truth)), 2) end as naive_error
             from back group by all),
     has as (select {_K}, count(index) = count(*) as hi, count(naive) = count(*) as hn from fut group by all),
     e as (select err.*, coalesce(linear_error, 'infinity'::double) as l,
                  case when hi then coalesce(index_error, 'infinity'::double) else 'infinity'::double end as i,
                  case when hn then coalesce(naive_error, 'infinity'::double) else 'infinity'::double end as n
           from err join has using (currency, product_name, billing_frequency)),
     pick as (select *, case when l <= i and l <= n then 'linear' when i <= n then 'index' else 'naive' end as model from e)
select fut.currency, fut.product_name, fut.billing_frequency,
       cast(date_trunc('month', {AS_OF}) + to_months(fut.horizon - 1) as date) as month,
       cast(fut.horizon as integer) as horizon, cast(fut.points as bigint) as points,
       coalesce(model, 'linear') as model, linear_error, index_error, naive_error,
       round(greatest(case coalesce(model, 'linear') when 'linear' then linear when 'index' then index else naive end, 0.0), 2)
           as forecast_revenue
from fut left join pick using (currency, product_name, billing_frequency)"""

register("seasonal_forecast", "PRD-5", P.seasonal_forecast, SEASONAL)
register("quarter_forecast", "PRD-5", P.quarter_forecast, f"""
select {_K}, cast(date_trunc('quarter', month) as date) as quarter, count(*) as months,
       round(sum(forecast_revenue), 2) as forecast_revenue
from ({SEASONAL}) x group by all""")

CUTS = (0.2, 0.4, 0.6, 0.8)


def _cut(col: str, p: float) -> str:
    return (f"(select min({col}) from (select {col}, row_number() over (order by {col}) as rn from b) z "
            f"where rn >= ceil({p} * (select count(*) from b)))")


def _above(col: str) -> str:
    return " + ".join(f"case when {col} > {_cut(col, p)} then 1 else 0 end" for p in CUTS)


RFM = f"""
with b as (select owner_id, owner_type, cast(datediff('day', max(paid_at), {AS_OF}) as integer) as recency_days,
                  cast(count(*) as bigint) as frequency
           from sf_rev where paid_at < cast({AS_OF} as timestamp) group by 1, 2),
     mo as (select owner_id, currency, cast(sum(amount) as decimal(18,2)) as monetary
            from sf_rev where paid_at < cast({AS_OF} as timestamp) group by 1, 2),
     mr as (select *, row_number() over (partition by currency order by monetary) as rn,
                   count(*) over (partition by currency) as n from mo),
     mc as (select currency, {', '.join(f"min(monetary) filter (where rn >= ceil({p} * n)) as c{i}" for i, p in enumerate(CUTS))}
            from mr group by 1),
     mm as (select owner_id, max(1 + {' + '.join(f"case when monetary > c{i} then 1 else 0 end" for i in range(4))}) as m_score,
                   string_agg(mo.currency || ' ' || cast(monetary as varchar), '; ' order by mo.currency) as monetary
            from mo join mc on mc.currency = mo.currency group by 1),
     sc as (select b.*, mm.monetary, cast(5 - ({_above('recency_days')}) as integer) as r_score,
                   cast(1 + ({_above('frequency')}) as integer) as f_score, cast(mm.m_score as integer) as m_score
            from b join mm on mm.owner_id = b.owner_id)
select *, case when r_score >= 4 and f_score >= 4 then 'champions' when r_score <= 2 and f_score >= 3 then 'at_risk'
               when r_score >= 4 and f_score <= 2 then 'new' when r_score <= 2 and f_score <= 2 then 'hibernating'
               else 'regular' end as segment
from sc"""

register("rfm_segments", "PRD-7", P.rfm_segments, RFM)
register("kmeans_segments", "PRD-7", P.kmeans_segments)

LO, HI = "date '2023-02-01'", "date '2024-02-01'"

register("expected_ltv", "PRD-8", P.expected_ltv, f"""
with r as (select owner_type, currency, month, sum(amount) as rev, count(distinct owner_id) as n from sf_rev
           where month >= {LO} and month < {HI} group by 1, 2, 3),
     ap as (select owner_type, currency, {rate('sum(rev)', 'sum(n)').replace(', 6)', ', 4)')} as arppu from r group by 1, 2),
     base as (select owner_type, count(*) as owner_months
              from (select owner_type, cast(month + interval 1 month as date) as m from sf_owner_months) x
              where m >= {LO} and m < {HI} group by 1),
     ch as (select owner_type, count(*) as churns
            from (select distinct owner_type, owner_id, churn_month from sf_churn
                  where churn_month >= {LO} and churn_month < {HI}) y group by 1),
     cr as (select base.owner_type, {rate('coalesce(ch.churns, 0)', 'base.owner_months')} as monthly_churn_rate
            from base left join ch on ch.owner_type = base.owner_type)
select coalesce(ap.owner_type, cr.owner_type) as owner_type, ap.currency, ap.arppu, cr.monthly_churn_rate,
       round(ap.arppu / nullif(cr.monthly_churn_rate, 0), 2) as expected_ltv
from ap full join cr on cr.owner_type = ap.owner_type""")

register("retention_scenarios", "PRD-9", P.retention_scenarios, f"""
with mrr as (select currency, arg_max(round(mrr_raw, 2), month) as mrr from ({MRR}) m group by 1),
     base as (select count(*) as owner_months
              from (select cast(month + interval 1 month as date) as m from sf_owner_months) x
              where m >= {LO} and m < {HI}),
     ch as (select count(*) as churns from (select distinct owner_id, churn_month from sf_churn
                                            where churn_month >= {LO} and churn_month < {HI}) y),
     cr as (select {rate('churns', 'owner_months')} as churn_rate from base, ch),
     sc(points) as (values (1), (2), (5)),
     j as (select sc.points, cr.churn_rate,
                  round(greatest(cr.churn_rate - cast(sc.points as double) / 100, 0.0), 6) as new_churn_rate, mrr.mrr, mrr.currency
           from sc, cr, mrr),
     m(m) as (select * from range(1, 13))
select currency, cast(points as integer) as points, churn_rate, new_churn_rate, mrr,
       round(sum(mrr * (pow(1 - new_churn_rate, m) - pow(1 - churn_rate, m))), 2) as revenue_gain_12m
from j, m group by currency, points, churn_rate, new_churn_rate, mrr""")

register("retention_offers", "PRD-10", P.retention_offers, f"""
select r.*, l.ltv from ({RISK_BANDED}) r join ({OWNER_VALUE}) l on l.owner_id = r.owner_id
where r.risk_band <> 'low'""")

register("next_best_plan", "PRD-11", P.next_best_plan, f"""
with mv as (select *, move_date + 90 as day from ({MOVES}) m
            where (product_move <> 'same' or cycle_move <> 'same') and move_date + 90 < {AS_OF}
              and from_currency = to_currency),
     k as (select mv.*, exists (select 1 from sf_subs s where s.owner_id = mv.owner_id and s.start_date <= mv.day
                                and (s.end_date is null or s.end_date > mv.day)) as kept from mv),
     g as (select from_currency as currency, from_product, from_frequency, to_product, to_frequency, count(*) as moves,
                  {rate('count(*) filter (where kept)', 'count(*)')} as retention,
                  round(avg(to_mrr - from_mrr), 2) as avg_mrr_change
           from k group by 1, 2, 3, 4, 5),
     s as (select *, round(retention * avg_mrr_change, 4) as score from g)
select currency, from_product, from_frequency, to_product, to_frequency, moves, retention, avg_mrr_change, score
from (select *, row_number() over (partition by currency, from_product, from_frequency
                                   order by score desc, to_product, to_frequency) as rk from s) x
where rk = 1""")

register("channel_investment", "PRD-12", P.channel_investment, f"""
with live as (select distinct owner_id as customer_id from sf_subs
              where start_date < {AS_OF} and (end_date is null or end_date >= {AS_OF})),
     acq as (select a.channel, count(*) as acquired, {rate('count(v.customer_id)', 'count(*)')} as retained_share
             from sf_attr a left join live v on v.customer_id = a.customer_id group by 1),
     cac as ({CAC}),
     ltv as ({LTV_BY_CHANNEL}),
     j as (select acq.*, cac.cac, ltv.currency, ltv.avg_ltv, round(ltv.avg_ltv / nullif(cac.cac, 0), 4) as ltv_to_cac
           from acq left join cac on cac.channel = acq.channel left join ltv on ltv.channel = acq.channel)
select *, cast(row_number() over (partition by currency order by ltv_to_cac desc nulls last, retained_share desc nulls last, channel)
               as integer) as investment_rank
from j""")

register("value_risk_segments", "PRD-13", P.value_risk_segments, f"""
with seg as ({RFM}), risk as ({RISK_BANDED}),
     w as (select seg.owner_id, seg.segment, risk.risk_band from seg join risk on risk.owner_id = seg.owner_id),
     n as (select segment, risk_band, count(*) as owners from w group by 1, 2),
     tot as (select w.segment, w.risk_band, r.currency, sum(r.amount) as total
             from w join sf_rev r on r.owner_id = w.owner_id where r.paid_at < cast({AS_OF} as timestamp) group by 1, 2, 3)
select n.segment, n.risk_band, n.owners,
       string_agg(tot.currency || ' ' || cast(cast(round(cast(total as double) / owners, 2) as decimal(18,2)) as varchar), '; '
                  order by tot.currency) as avg_value
from n join tot on tot.segment = n.segment and tot.risk_band = n.risk_band group by 1, 2, 3""")


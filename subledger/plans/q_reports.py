"""Report queries (REP-*). Oracles compose the other queries' oracle bodies."""

from __future__ import annotations

from ..operators import reports as RP
from .catalog import REGISTRY, register
from .oracle_fixtures import AS_OF
from .q_kpi import REACT
from .q_more import OWNER_VALUE
from .q_predict import RFM, RISK_BANDED


def body(name: str) -> str:
    return REGISTRY[name].oracle


register("report_executive", "REP-1", RP.report_executive, f"""
with r as (select * from (
    select * from ({body('active_subscribers')}) a
    full join (select month, cast(sum(new_subscribers) as bigint) as new_subscribers
               from ({body('new_subscribers')}) x group by 1) n using (month)
    full join (select month, churn_rate from ({body('churn_rate')}) x) ch using (month)
    full join (select month, retention_rate from ({body('retention_rate')}) x) rt using (month)) o
full join (
    select * from (select month, currency, revenue, growth_rate as revenue_growth from ({body('revenue_growth')}) x) g
    full join (select month, currency, arpu from ({body('average_revenue_per_user')}) x) ar using (month, currency)
    full join (select month, currency, mrr from ({body('monthly_recurring_revenue')}) x) mr using (month, currency)
    full join (select month, currency, forecast_revenue from ({body('revenue_forecast')}) x
               where product_name = 'ALL') fc using (month, currency)) m using (month)),
spine as (select cast(unnest(generate_series(cast(min(month) as timestamp), cast(max(month) as timestamp),
                                             interval 1 month)) as date) as month from r)
select * from spine left join r using (month)""")

register("report_subscription", "REP-2", RP.report_subscription, f"""
with u as (
    select cast(date_trunc('month', start_date) as date) as month, product_name, billing_frequency, 1 as new_subscriptions, 0 as renewals, 0 as upgrades, 0 as downgrades, 0 as lateral_moves, 0 as cycle_moves, 0 as churned, 0 as cohort_active from sf_subs
    union all
    select cast(date_trunc('month', e.event_at) as date), s.product_name, s.billing_frequency, 0, 1, 0, 0, 0, 0, 0, 0 
    from subscription_events e join sf_subs s on s.subscription_id = e.subscription_id where e.event_type = 'renewed'
    union all
    select move_month, from_product, from_frequency, 0, 0, 1, 0, 0, 0, 0, 0 from sf_moves where product_move = 'upgrade'
    union all
    select move_month, from_product, from_frequency, 0, 0, 0, 1, 0, 0, 0, 0 from sf_moves where product_move = 'downgrade'
    union all
    select move_month, from_product, from_frequency, 0, 0, 0, 0, 1, 0, 0, 0 from sf_moves where product_move = 'lateral'
    union all
    select move_month, from_product, from_frequency, 0, 0, 0, 0, 0, 1, 0, 0 from sf_moves where cycle_move <> 'same'
    union all
    select churn_month, product_name, billing_frequency, 0, 0, 0, 0, 0, 0, 1, 0 from sf_churn
    union all
    select cast(date_trunc('month', start_date) as date), product_name, billing_frequency, 0, 0, 0, 0, 0, 0, 0, 1 from sf_subs
    where start_date < {AS_OF} and (end_date is null or end_date >= {AS_OF}))
select month, product_name, billing_frequency,
       cast(sum(new_subscriptions) as bigint) as new_subscriptions,
       cast(sum(renewals) as bigint) as renewals,
       cast(sum(upgrades) as bigint) as upgrades,
       cast(sum(downgrades) as bigint) as downgrades,
       cast(sum(lateral_moves) as bigint) as lateral_moves,
       cast(sum(cycle_moves) as bigint) as cycle_moves,
       cast(sum(churned) as bigint) as churned,
       cast(sum(cohort_active) as bigint) as cohort_active,
       cast(grouping(month, product_name, billing_frequency) as integer) as grouping_level
from u group by rollup (month, product_name, billing_frequency)
having grouping(month, product_name, billing_frequency) < 4""")

register("report_customer", "REP-3", RP.report_customer, f"""
select c.customer_id, c.country, c.account_status, seg.segment, a.channel, tn.tenure_days, l.ltv,
       r.risk_score, r.risk_band, coalesce(re.reactivated, false) as reactivated, el.engagement_level
from customers c
left join ({RFM}) seg on seg.owner_id = c.customer_id
left join sf_attr a on a.customer_id = c.customer_id
left join sf_tenure tn on tn.owner_id = c.customer_id
left join ({OWNER_VALUE}) l on l.owner_id = c.customer_id
left join ({RISK_BANDED}) r on r.owner_id = c.customer_id
left join (select distinct owner_id, true as reactivated from ({REACT}) x where next_start is not null) re
  on re.owner_id = c.customer_id
left join ({body('engagement_level')}) el on el.customer_id = c.customer_id""")


register("report_corporate", "REP-4", RP.report_corporate, body("corporate_accounts"))

register("report_recommendations", "REP-5", RP.report_recommendations, f"""
select 'retention_offer' as recommendation, owner_id as subject,
       'risk ' || cast(risk_score as varchar) || ', value ' || ltv as reason,
       'offer a retention discount' as action, cast(risk_score as integer) as priority
from ({body('retention_offers')}) o
union all
select 'promote_plan', from_product || ' ' || from_frequency,
       'moves ' || cast(moves as varchar) || ', retained ' || cast(cast(round(retention * 100) as bigint) as varchar) || '%',
       'promote ' || to_product || ' ' || to_frequency, 50
from ({body('next_best_plan')}) p
union all
select 'invest_channel', channel, 'investment rank ' || cast(investment_rank as varchar) || coalesce(' in ' || currency, ''),
       'increase acquisition budget', cast(40 - investment_rank as integer)
from ({body('channel_investment')}) c""")


# The same reports as of an earlier day: Spark sees Tables.before, DuckDB the tables cut by its own text.
EARLIER = "2023-07-01"
for _name, _op, _report in (("report_executive", "REP-1", RP.report_executive),
                            ("report_subscription", "REP-2", RP.report_subscription),
                            ("report_customer", "REP-3", RP.report_customer),
                            ("report_corporate", "REP-4", RP.report_corporate),
                            ("report_recommendations", "REP-5", RP.report_recommendations)):
    register(f"{_name}_as_of_2023_07", _op, lambda t, report=_report: report(t, EARLIER), body(_name), EARLIER)

"""DuckDB text of the driver-table mapping, used to build oracle queries.

``with_tables(body)`` prefixes a query body with the CTEs it needs, so each
oracle query reads only the driver views (``orders``, ``lineitem``, ...).
The mapping is the same as ``subledger.sources.fixtures`` but written as
plain SQL for DuckDB.
"""

from __future__ import annotations

import re

from ..sources.reference_data import PLAN_CURRENCY, PLANS, PRODUCTS

AS_OF = "date '2024-02-01'"


def _values(rows) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    return ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _case(key: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {key} {whens} else '{values[-1]}' end"


CHANNELS = ["Organic Search", "Direct", "Email", "Organic Social", "Paid Social", "Paid Search", "Referral",
            "Affiliate / Partner", "Campus Activation", "Promotional Campaign"]

CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql.strip())


_cte("products", [], f"""
select product_id, product_name, product_family, target_segment, true as is_active
from (values
    {_values(PRODUCTS)}
) v(product_id, product_name, product_family, target_segment)""")

_cte("plans", [], f"""
select plan_id, product_id, plan_name, billing_frequency, cast(billing_period_days as integer) as billing_period_days,
       cast(unit_price as decimal(12,2)) as unit_price, '{PLAN_CURRENCY}' as currency, true as is_active
from (values
    {_values(PLANS)}
) v(plan_id, product_id, plan_name, billing_frequency, billing_period_days, unit_price)""")

_cte("customers", [], """
select concat('CUST', printf('%06d', cast(c_custkey + 1 as bigint))) as customer_id,
       concat('First', cast(c_custkey % 97 as varchar)) as first_name,
       c_name as last_name,
       concat('first', cast(c_custkey % 97 as varchar), '.', lower(replace(c_name, '#', '-')), '@customer.example') as email,
       date '2017-01-01' + cast(c_custkey % 181 as integer) as signup_date,
       n_name as country,
       case when c_custkey % 100 < 95 then 'active' when c_custkey % 100 < 98 then 'suspended' else 'closed' end as account_status
from customer join nation on c_nationkey = n_nationkey""")

_cte("organisations", [], f"""
select concat('ORG', printf('%04d', cast(s_suppkey + 1 as bigint))) as organisation_id,
       s_name as organisation_name,
       {_case('s_suppkey % 6', ['Corporate', 'University', 'Government', 'NGO', 'Professional Association', 'Other'])} as organisation_type,
       {_case('s_suppkey % 6', ['Technology', 'Education', 'Public Sector', 'Development', 'Healthcare', 'Other'])} as industry,
       cast(1 + (s_suppkey * 7919) % 9973 as integer) as organisation_size,
       date '2017-01-01' + cast(s_suppkey % 181 as integer) as signup_date,
       concat('Contact ', s_name) as billing_contact_name,
       concat('billing@', lower(replace(s_name, '#', '-')), '.example') as billing_contact_email,
       case when s_suppkey % 50 < 48 then 'active' when s_suppkey % 50 = 48 then 'suspended' else 'closed' end as account_status,
       cast(date '2017-01-01' + cast(s_suppkey % 181 as integer) as timestamp) + interval '9' hour as created_at
from supplier""")

_cte("sub_base", [], """
select o_orderkey, o_custkey, o_orderkey % 10 = 7 as is_org,
       case when o_orderkey % 10 = 7
            then concat('ORG', printf('%04d', cast(cast(floor(o_custkey / 15) as bigint) + 1 as bigint)))
            else concat('CUST', printf('%06d', cast(o_custkey + 1 as bigint))) end as owner_id,
       case when o_orderkey % 10 = 7
            then concat('PLN', printf('%03d', cast(17 + o_custkey % 2 as bigint)))
            else concat('PLN', printf('%03d', cast(1 + (o_orderkey * 7 + o_custkey) % 16 as bigint))) end as plan_id,
       cast(o_orderdate as date) + 8218 as start_date,
       o_orderstatus
from orders""")

_cte("sub_seq", ["sub_base", "plans"], """
select b.*, p.billing_period_days as bpd, p.unit_price,
       b.start_date + cast(p.billing_period_days * (1 + b.o_orderkey % 6) as integer) as planned_end,
       lead(b.start_date) over (partition by b.owner_id order by b.start_date, b.o_orderkey) as next_start,
       lead(b.o_orderkey) over (partition by b.owner_id order by b.start_date, b.o_orderkey) as next_key,
       lag(b.o_orderkey) over (partition by b.owner_id order by b.start_date, b.o_orderkey) as prev_key
from sub_base b join plans p on b.plan_id = p.plan_id""")

_cte("sub_end0", ["sub_seq"], f"""
select *,
       case when next_start is not null and next_start <= planned_end then next_start
            when planned_end <= {AS_OF} then planned_end end as end_date,
       case when next_start is not null and next_start <= planned_end then 'plan_change'
            when planned_end <= {AS_OF} then
                 case o_orderkey % 3 when 0 then 'voluntary_cancel' when 1 then 'payment_failure' else 'non_renewal' end
       end as end_reason
from sub_seq""")

_cte("sub_end", ["sub_end0"], f"""
select *,
       lag(end_reason) over (partition by owner_id order by start_date, o_orderkey) as prev_end_reason,
       cast(floor(greatest(datediff('day', start_date, coalesce(end_date, {AS_OF})) - 1, 0) / bpd) as integer) as k
from sub_end0""")

_cte("subscriptions", ["sub_end"], """
select concat('SUB', printf('%08d', cast(o_orderkey + 1 as bigint))) as subscription_id,
       case when not is_org then owner_id end as customer_id,
       case when is_org then owner_id end as organisation_id,
       plan_id,
       start_date as subscription_start_date,
       start_date + cast(k * bpd as integer) as current_period_start,
       start_date + cast((k + 1) * bpd as integer) as current_period_end,
       end_date as subscription_end_date,
       case when end_date is not null then 'ended' when o_orderstatus = 'P' then 'past_due' else 'active' end as status,
       not (end_date is null and o_orderkey % 7 = 0) as auto_renew,
       case when end_date is null and o_orderkey % 7 = 0 then cast(start_date as timestamp) + interval '12' hour end
           as cancellation_requested_at,
       end_reason,
       cast(case when is_org then 10 + o_orderkey % 91 end as integer) as seats_purchased,
       cast(start_date as timestamp) + interval '8' hour as created_at
from sub_end""")

_cte("paid", ["sub_end"], f"""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_linestatus, l.rn,
       s.o_orderkey, s.is_org, s.start_date, s.end_date, s.bpd, s.unit_price,
       cast(s.start_date + cast((l.rn - 1) * s.bpd as integer) as timestamp) + interval '10' hour as pay_time,
       concat('PAY', printf('%08d', cast(l.l_orderkey + 1 as bigint)), '-', cast(l.rn as varchar)) as payment_id
from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_shipdate, l_partkey, l_suppkey,
                                   l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) as rn
      from lineitem) l
join sub_end s on l.l_orderkey = s.o_orderkey
where l.rn = 1 or (s.start_date + cast((l.rn - 1) * s.bpd as integer) < coalesce(s.end_date, {AS_OF}))""")

_cte("payments", ["paid"], f"""
select payment_id,
       concat('SUB', printf('%08d', cast(l_orderkey + 1 as bigint))) as subscription_id,
       pay_time as payment_attempted_at,
       cast(unit_price * case when is_org then 10 + o_orderkey % 91 else 1 end as decimal(12,2)) as amount,
       'KES' as currency,
       case when l_returnflag = 'R' then 'failed' when l_linenumber = 7 then 'pending' else 'successful' end as payment_status,
       {_case('l_partkey % 3', ['mobile_money', 'card', 'bank_transfer'])} as payment_method,
       case when l_linestatus = 'F' then concat('TX', cast(l_orderkey as varchar), '-', cast(rn as varchar)) end
           as transaction_reference,
       case when l_returnflag = 'R' then {_case('l_suppkey % 6', ['insufficient_funds', 'expired_card', 'payment_declined', 'invalid_payment_details', 'timeout', 'other'])} end
           as failure_reason,
       pay_time as created_at
from paid""")


def _ev(tag, etype, at, src="sub_end", where="true", rn=False, **extra) -> str:
    eid = f"concat('EV{tag}', printf('%08d', cast(o_orderkey + 1 as bigint))" + (", '-', cast(rn as varchar))" if rn else ")")
    cols = {
        "related_subscription_id": "cast(null as varchar)", "triggering_payment_id": "cast(null as varchar)",
        "period_start": "cast(null as date)", "period_end": "cast(null as date)",
        "previous_seat_count": "cast(null as integer)", "new_seat_count": "cast(null as integer)",
        "event_reason": "cast(null as varchar)",
    }
    cols.update(extra)
    return (f"select {eid} as event_id, concat('SUB', printf('%08d', cast(o_orderkey + 1 as bigint))) as subscription_id, "
            f"{cols['related_subscription_id']} as related_subscription_id, "
            f"{cols['triggering_payment_id']} as triggering_payment_id, '{etype}' as event_type, {at} as event_at, "
            f"{cols['period_start']} as period_start, {cols['period_end']} as period_end, "
            f"{cols['previous_seat_count']} as previous_seat_count, {cols['new_seat_count']} as new_seat_count, "
            f"{cols['event_reason']} as event_reason, {at} as created_at from {src} where {where}")


def _h(col, hours):
    return f"cast({col} as timestamp) + interval '{hours}' hour"


_SUBREF = "concat('SUB', printf('%08d', cast({} + 1 as bigint)))"
_first = "(prev_key is null or prev_end_reason = 'plan_change')"
_cte("subscription_events", ["sub_end", "paid"], "\nunion all\n".join([
    _ev("S", "subscription_started", _h("start_date", 8), where=_first),
    _ev("A", "reactivated", _h("start_date", 8), where=f"not {_first}",
        related_subscription_id=_SUBREF.format("prev_key")),
    _ev("C", "plan_changed", _h("end_date", 8), where="end_reason = 'plan_change'",
        related_subscription_id=_SUBREF.format("next_key")),
    _ev("E", "subscription_ended", _h("end_date", 8), where="end_date is not null", event_reason="end_reason"),
    _ev("Q", "cancellation_requested", _h("start_date", 12),
        where="end_reason = 'voluntary_cancel' or (end_date is null and o_orderkey % 7 = 0) "
              "or (end_reason = 'non_renewal' and o_orderkey % 4 = 1)"),
    _ev("V", "cancellation_reversed", _h("start_date", 13), where="end_reason = 'non_renewal' and o_orderkey % 4 = 1"),
    _ev("R", "renewed", "pay_time", src="paid", rn=True,
        where="rn > 1 and l_returnflag <> 'R' and l_linenumber <> 7", triggering_payment_id="payment_id",
        period_start="start_date + cast((rn - 1) * bpd as integer)", period_end="start_date + cast(rn * bpd as integer)"),
    _ev("P", "past_due_started", "pay_time", src="paid", rn=True, where="l_returnflag = 'R'",
        triggering_payment_id="payment_id"),
    _ev("D", "past_due_resolved", _h("start_date", 36), src="paid",
        where="rn = 1 and l_returnflag = 'R' and end_date > start_date + 2"),
    _ev("X", "seats_changed", _h("start_date", 14), where="is_org and o_orderkey % 4 = 1",
        previous_seat_count="cast(10 + (o_orderkey * 3) % 91 as integer)",
        new_seat_count="cast(10 + o_orderkey % 91 as integer)"),
]))

_cte("organisation_users", ["sub_end"], f"""
select concat('OU', printf('%07d', cast(o_orderkey as bigint)), '-', printf('%07d', cast(c_custkey as bigint)))
           as organisation_user_id,
       owner_id as organisation_id,
       concat('SUB', printf('%08d', cast(o_orderkey + 1 as bigint))) as subscription_id,
       concat('user', cast(c_custkey as varchar), '@org.example') as email,
       start_date as activation_date,
       case when end_date is not null then end_date when c_custkey % 5 = 0 then {AS_OF} end as deactivation_date,
       case when end_date is not null or c_custkey % 5 = 0 then 'inactive' else 'active' end as user_status,
       cast(start_date as timestamp) + interval '9' hour as created_at
from sub_end join customer
  on cast(floor(c_custkey / 15) as bigint) = cast(floor(o_custkey / 15) as bigint)
where is_org""")

_cte("marketing_touchpoints", ["sub_base"], f"""
select concat('TPO', printf('%08d', cast(o_orderkey + 1 as bigint))) as touchpoint_id,
       owner_id as customer_id,
       cast(start_date - cast(1 + o_orderkey % 5 as integer) as timestamp) + interval '11' hour as touchpoint_at,
       {_case('(o_custkey + o_orderkey) % 10', CHANNELS)} as channel,
       case when o_orderkey % 3 <> 0 then concat('CMP', cast(o_orderkey % 12 as varchar)) end as campaign_name,
       {_case('o_orderkey % 7', ['impression', 'click', 'visit', 'email_open', 'email_click', 'referral', 'campaign_response'])} as touchpoint_type,
       cast(case when o_orderkey % 4 = 0 then null when (o_custkey + o_orderkey) % 10 in (0, 1, 3) then 0
                 else 5 + o_orderkey % 200 end as decimal(12,2)) as attributed_cost,
       cast(start_date as timestamp) as created_at
from sub_base where not is_org
union all
select concat('TPE', printf('%08d', cast(event_id + 1 as bigint))) as touchpoint_id,
       concat('CUST', printf('%06d', cast(user_id + 1 as bigint))) as customer_id,
       ts as touchpoint_at,
       {_case('event_id % 10', CHANNELS)} as channel,
       case when event_id % 3 <> 0 then concat('CMP', cast(event_id % 12 as varchar)) end as campaign_name,
       'click' as touchpoint_type,
       cast(value as decimal(12,2)) as attributed_cost,
       ts as created_at
from events where event_type = 'click'""")

_cte("trials", ["sub_end"], """
select concat('TRL', printf('%08d', cast(o_custkey + 1 as bigint))) as trial_id,
       owner_id as customer_id,
       case o_custkey % 3 when 0 then 'PROD001' when 1 then 'PROD002' else 'PROD005' end as product_id,
       cast(start_date - 7 as timestamp) + interval '8' hour as trial_started_at,
       cast(start_date as timestamp) + interval '8' hour as scheduled_end_at,
       case when o_custkey % 10 = 3 then null when o_custkey % 10 = 9 then cast(start_date - 4 as timestamp)
            else cast(start_date as timestamp) + interval '8' hour end as actual_end_at,
       case when o_custkey % 10 = 3 then 'active' when o_custkey % 10 <= 7 then 'converted'
            when o_custkey % 10 = 8 then 'expired' else 'cancelled' end as trial_status,
       case when o_custkey % 10 between 4 and 7 then concat('SUB', printf('%08d', cast(o_orderkey + 1 as bigint))) end
           as converted_subscription_id,
       cast(start_date - 7 as timestamp) + interval '8' hour as created_at
from sub_end where not is_org and prev_key is null and o_custkey % 10 >= 3""")

_cte("customer_engagement", [], """
select concat('ENG', printf('%07d', cast(user_id as bigint)), '-',
              cast(datediff('day', date '2024-01-01', cast(ts as date)) as varchar)) as engagement_id,
       concat('CUST', printf('%06d', cast(user_id + 1 as bigint))) as customer_id,
       cast(ts as date) as engagement_date,
       cast(count(*) as integer) as sessions_count,
       cast(sum(1 + event_id % 9) as integer) as articles_viewed,
       cast(sum((event_id % 9) % 4) as integer) as premium_articles_viewed,
       cast(sum(event_id % 3) as integer) as epaper_opens,
       cast(sum(cast(value as decimal(10,2))) as decimal(10,2)) as reading_minutes,
       max(ts) as created_at
from events where event_type = 'view'
group by user_id, cast(ts as date)""")

_cte("support_interactions", [], f"""
select concat('SUP', printf('%08d', cast(event_id + 1 as bigint))) as interaction_id,
       concat('CUST', printf('%06d', cast(user_id + 1 as bigint))) as customer_id,
       cast(null as varchar) as subscription_id,
       ts as interaction_at,
       {_case('event_id % 4', ['email', 'phone', 'live_chat', 'web_form'])} as channel,
       {_case('event_id % 8', ['billing', 'payment', 'access_login', 'technical', 'content', 'subscription_change', 'cancellation_enquiry', 'other'])} as issue_category,
       case event_id % 5 when 0 then 'open' when 1 then 'in_progress' else 'resolved' end as resolution_status,
       case when event_id % 5 > 1 then ts + interval '5' hour end as resolved_at,
       ts as created_at
from events where event_type = 'error'""")

TABLE_NAMES = ["customers", "products", "plans", "organisations", "subscriptions", "payments", "subscription_events",
               "organisation_users", "marketing_touchpoints", "trials", "customer_engagement", "support_interactions"]


def _needed(body: str) -> list[str]:
    found = [n for n in CTES if re.search(rf"\b{n}\b", body)]
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in found:
        visit(n)
    return order


def _cut(name: str, day: str) -> str:
    """DuckDB text of a table as it stood before ``day`` (a date literal); the whole table is ``all_<name>``."""
    at = f"cast({day} as timestamp)"
    dated = {"customers": f"signup_date < {day}", "payments": f"payment_attempted_at < {at}",
             "subscription_events": f"event_at < {at}", "marketing_touchpoints": f"touchpoint_at < {at}",
             "customer_engagement": f"engagement_date < {day}"}
    if name in dated:
        return f"select * from all_{name} where {dated[name]}"
    if name == "subscriptions":
        return f"""
select * replace (
    case when subscription_end_date < {day} then subscription_end_date end as subscription_end_date,
    case when subscription_end_date is null or subscription_end_date < {day} then end_reason end as end_reason,
    case when subscription_end_date >= {day} then 'active' else status end as status,
    case when cancellation_requested_at < {at} then cancellation_requested_at end as cancellation_requested_at)
from all_subscriptions where subscription_start_date < {day}"""
    if name == "trials":
        return f"""
select * replace (
    case when actual_end_at < {at} then actual_end_at end as actual_end_at,
    case when actual_end_at is null or actual_end_at < {at} then converted_subscription_id end as converted_subscription_id,
    case when actual_end_at >= {at} then 'active' else trial_status end as trial_status)
from all_trials where trial_started_at < {at}"""
    return f"""
select * replace (
    case when resolved_at < {at} then resolved_at end as resolved_at,
    case when resolved_at >= {at} then 'open' else resolution_status end as resolution_status)
from all_support_interactions where interaction_at < {at}"""


CUT_TABLES = {"customers", "payments", "subscription_events", "marketing_touchpoints", "customer_engagement",
              "subscriptions", "trials", "support_interactions"}


def with_tables(body: str, before: str | None = None) -> str:
    """Prefix ``body`` (``select ...`` or ``with x as (...) select ...``) with the table CTEs it uses; with
    ``before`` (a day) it and the derived views see the tables as they stood before that day."""
    body = body.strip()
    names = _needed(body)
    if not names:
        return body
    ctes, day = [], f"date '{before}'"
    for n in names:
        sql = CTES[n][1]
        if before and n in CUT_TABLES:
            ctes += [f"all_{n} as (\n{sql}\n)", f"{n} as (\n{_cut(n, day)}\n)"]
        else:
            ctes.append(f"{n} as (\n{sql.replace(AS_OF, day) if before and n.startswith('sf_') else sql}\n)")
    ctes, body = ",\n".join(ctes), body.replace(AS_OF, day) if before else body
    if re.match(r"(?is)^with\s", body):
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"

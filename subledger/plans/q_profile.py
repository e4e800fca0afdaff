"""Validation and profile queries (GEN-14..17) over the given customers and organisations."""

from __future__ import annotations

from ..operators import profile as P
from .catalog import register

STATUS = "account_status not in ('active', 'suspended', 'closed')"

register("entity_validation", "GEN-14", lambda t: P.entity_validation(t.customers, t.organisations), f"""
select 'customers_unique_id' as check_name, cast(count(*) - count(distinct customer_id) as bigint) as failures from customers
union all select 'customers_unique_email', cast(count(*) - count(distinct email) as bigint) from customers
union all select 'customers_not_null', cast(count(*) filter (where customer_id is null or email is null
                                                            or signup_date is null) as bigint) from customers
union all select 'customers_status_domain', cast(count(*) filter (where {STATUS}) as bigint) from customers
union all select 'organisations_unique_id', cast(count(*) - count(distinct organisation_id) as bigint) from organisations
union all select 'organisations_unique_name', cast(count(*) - count(distinct organisation_name) as bigint) from organisations
union all select 'organisations_size_positive', cast(count(*) filter (where not (organisation_size > 0)) as bigint)
          from organisations
union all select 'organisations_status_domain', cast(count(*) filter (where {STATUS}) as bigint) from organisations""")

register("customer_country_share", "GEN-15", lambda t: P.category_share(t.customers, "country"), """
select country, round_even(cast(count(*) as double) * 100 / sum(count(*)) over (), 1) as share_pct
from customers where country is not null group by country""")

register("customer_status_counts", "GEN-16", lambda t: P.category_counts(t.customers, "account_status"), """
select account_status, count(*) as n from customers group by 1""")

register("organisation_type_counts", "GEN-16", lambda t: P.category_counts(t.organisations, "organisation_type"), """
select organisation_type, count(*) as n from organisations group by 1""")

QUARTILES = ", ".join(f"round_even(quantile_cont(organisation_size, {p}), 0) as p{int(p * 100)}" for p in (0.25, 0.5, 0.75))

register("organisation_size_summary", "GEN-17", lambda t: P.numeric_summary(t.organisations, "organisation_size"), f"""
select count(organisation_size) as count, round_even(avg(organisation_size), 0) as mean,
       round_even(stddev_samp(organisation_size), 0) as std, cast(min(organisation_size) as bigint) as min,
       {QUARTILES}, cast(max(organisation_size) as bigint) as max
from organisations""")

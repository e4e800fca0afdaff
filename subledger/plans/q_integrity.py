"""Integrity queries (CON-1..7); the oracle text is generated from the same constraint registry."""

from __future__ import annotations

from ..operators import integrity as I
from ..operators.keys import load_rejections
from ..sources.schemas import LOAD_ORDER, TABLES
from .catalog import register


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _row(rule, table, kind, violations, rows="count(*)", src=None) -> str:
    return (f"select {_lit(rule)} as rule, {_lit(table)} as table_name, {_lit(kind)} as kind, "
            f"cast({violations} as bigint) as violations, cast({rows} as bigint) as rows from {src or table}")


def not_null_sql() -> list[str]:
    return [_row(f"nn_{n}_{c.name}", n, "not_null", f"count(*) filter (where {c.name} is null)")
            for n in LOAD_ORDER for c in TABLES[n].columns if not c.nullable]


def length_sql() -> list[str]:
    return [_row(f"len_{n}_{c.name}", n, "length", f"count(*) filter (where length({c.name}) > {c.length})")
            for n in LOAD_ORDER for c in TABLES[n].columns if c.length]


def unique_sql() -> list[str]:
    out = []
    for n in LOAD_ORDER:
        keys = [(f"pk_{n}", (TABLES[n].primary_key,))] + [(f"uq_{n}_{'_'.join(k)}", k) for k in TABLES[n].uniques]
        for rule, key in keys:
            cols = ", ".join(key)
            notnull = " and ".join(f"{k} is not null" for k in key)
            dup = (f"(select coalesce(sum(n), 0) from (select count(*) as n from {n} where {notnull} "
                   f"group by {cols} having count(*) > 1) d)")
            out.append(f"select {_lit(rule)} as rule, {_lit(n)} as table_name, 'unique' as kind, "
                       f"cast({dup} as bigint) as violations, cast((select count(*) from {n}) as bigint) as rows")
    return out


def fk_sql() -> list[str]:
    out = []
    for n in LOAD_ORDER:
        for fk in TABLES[n].foreign_keys:
            orphans = (f"(select count(*) from {n} ch where ch.{fk.column} is not null and not exists "
                       f"(select 1 from {fk.parent} pa where pa.{fk.parent_column} = ch.{fk.column}))")
            out.append(f"select {_lit(f'fk_{n}_{fk.column}')} as rule, {_lit(n)} as table_name, 'foreign_key' as kind, "
                       f"cast({orphans} as bigint) as violations, cast((select count(*) from {n}) as bigint) as rows")
    return out


def check_sql(mode: str) -> list[str]:
    def cond(pred):
        return f"not ({pred})" if mode == "lenient" else f"not coalesce(({pred}), false)"
    return [_row(name, n, f"check_{mode}", f"count(*) filter (where {cond(pred)})")
            for n in LOAD_ORDER for name, pred in TABLES[n].checks]


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


register("not_null_violations", "CON-1", I.not_null_violations, _union(not_null_sql()))
register("length_violations", "CON-2", I.length_violations, _union(length_sql()))
register("unique_violations", "CON-3", I.unique_violations, _union(unique_sql()))
register("fk_violations", "CON-4", I.fk_violations, _union(fk_sql()))
register("check_violations", "CON-5", I.check_violations, _union(check_sql("lenient")))
register("check_violations_strict", "CON-5", lambda t: I.check_violations(t, "strict"), _union(check_sql("strict")))
register("integrity_report", "CON-6", I.integrity_report,
         _union(not_null_sql() + length_sql() + unique_sql() + fk_sql() + check_sql("lenient")))


def _quarantine_sql() -> str:
    parts = []
    for n in LOAD_ORDER:
        spec = TABLES[n]
        bad = [f"{c.name} is null" for c in spec.columns if not c.nullable]
        bad += [f"length({c.name}) > {c.length}" for c in spec.columns if c.length]
        bad += [f"coalesce(not ({pred}), false)" for _, pred in spec.checks]
        any_bad = " or ".join(f"coalesce({b}, false)" for b in bad)
        parts.append(f"select {_lit(n)} as table_name, cast(count(*) filter (where not ({any_bad})) as bigint) as good_rows, "
                     f"cast(count(*) filter (where {any_bad}) as bigint) as rejected_rows from {n}")
    return _union(parts)


register("quarantine_summary", "CON-6", I.quarantine_summary, _quarantine_sql())

LOAD_TIME = "2024-02-01 06:00:00"
register("ingest_defaults_payments", "CON-7",
         lambda t: I.apply_defaults(t.payments.drop("currency", "created_at"), "payments", LOAD_TIME), f"""
select payment_id, subscription_id, payment_attempted_at, amount, 'KES' as currency, payment_status, payment_method,
       transaction_reference, failure_reason, timestamp '{LOAD_TIME}' as created_at
from payments""")


# All payments loaded on top of those stored before a day: the old ones are refused by their keys.
register("load_rejections_payments", "CON-6", lambda t: load_rejections(t, t.before("2023-07-01"), "payments"), """
select 'pk_payments' as rule, count(*) as rows from payments where payment_attempted_at < date '2023-07-01'
having count(*) > 0
union all
select 'uq_payments_transaction_reference', count(*) from payments
where transaction_reference is not null and payment_attempted_at < date '2023-07-01' having count(*) > 0
union all
select null, count(*) from payments where payment_attempted_at >= date '2023-07-01'""")

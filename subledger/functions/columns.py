"""Column helpers shared by the operators (all native Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values from the data dictionary.
CHURN_TYPES = {  # end_reason -> churn type
    "voluntary_cancel": "Voluntary",
    "payment_failure": "Involuntary",
    "non_renewal": "Expiry / Non-renewal",
    "plan_change": "Not churn",
}
ORGANISATION_BANDS = [  # (lower bound inclusive, band)
    (1, "Micro"), (50, "Small"), (250, "Medium"), (1000, "Large"), (5000, "Enterprise"),
]
# Months per billing period, for recurring revenue.
MONTHLY_FACTOR = {"Daily": 30.0, "Weekly": 52.0 / 12.0, "Monthly": 1.0, "Annual": 1.0 / 12.0}
DEFAULT_GRACE_DAYS = 30
# ---------------------------------------------------------------------------


def c(name: str) -> Column:
    return F.col(name)


def owner_id() -> Column:
    return F.coalesce(c("customer_id"), c("organisation_id"))


def owner_type() -> Column:
    return F.when(c("organisation_id").isNotNull(), "organisation").otherwise("customer")


def churn_type(end_reason: Column) -> Column:
    """DER-4: end reason -> churn type."""
    out = F.lit(None).cast("string")
    for reason, kind in reversed(list(CHURN_TYPES.items())):
        out = F.when(end_reason == reason, kind).otherwise(out)
    return out


def organisation_band(size: Column) -> Column:
    """DER-5: organisation size -> band (NULL for sizes below 1)."""
    out = F.lit(None).cast("string")
    for lower, band in ORGANISATION_BANDS:
        out = F.when(size >= lower, band).otherwise(out)
    return out


def month(d: Column) -> Column:
    """First day of the month of a date/timestamp, as a DATE."""
    return F.trunc(d.cast("date"), "month")


def money_list(currency: Column, amount: Column) -> Column:
    """Aggregate of one row per currency: ``KES 12.00; USD 3.50`` (currencies are never added up)."""
    each = F.concat(currency, F.lit(" "), F.round(amount, 2).cast("decimal(18,2)").cast("string"))
    return F.array_join(F.sort_array(F.collect_list(each)), "; ")


def money(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def ratio(num: Column, den: Column, digits: int = 6) -> Column:
    """num / den as a rounded double; NULL when the denominator is 0 or NULL."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), digits)


def dbl(x: Column, digits: int = 6) -> Column:
    return F.round(x.cast("double"), digits)


def monthly_factor(freq: Column) -> Column:
    out = F.lit(None).cast("double")
    for f, v in MONTHLY_FACTOR.items():
        out = F.when(freq == f, F.lit(v)).otherwise(out)
    return out


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("int")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz`` without any time-zone conversion
    (calendar arithmetic on the local fields, so the result never depends on the session zone)."""
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("long")

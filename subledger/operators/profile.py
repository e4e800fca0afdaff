"""Validation and profile of the customer and organisation tables (GEN-14..17): checks as rows, category
shares and counts, numeric summary with interpolated quartiles.

All are partial aggregates over the given tables; the quartiles take exact ranks from range-partitioned
running counts (``functions.ordering``), so no partition holds all values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.ordering import with_rows_before

STATUSES = ("active", "suspended", "closed")


def entity_validation(customers: DataFrame, organisations: DataFrame) -> DataFrame:
    """GEN-14: (check_name, failures) over both tables."""
    bad_status = F.count_if(~c("account_status").isin(*STATUSES)).alias("bad_status")
    cc = customers.agg(
        F.count("*").alias("n"), F.countDistinct("customer_id").alias("ids"), F.countDistinct("email").alias("emails"),
        F.count_if(c("customer_id").isNull() | c("email").isNull() | c("signup_date").isNull()).alias("nulls"),
        bad_status)
    oc = organisations.agg(
        F.count("*").alias("n"), F.countDistinct("organisation_id").alias("ids"),
        F.countDistinct("organisation_name").alias("names"),
        F.count_if(~(c("organisation_size") > 0)).alias("bad_size"), bad_status)
    checks = [
        (cc, "customers_unique_id", c("n") - c("ids")), (cc, "customers_unique_email", c("n") - c("emails")),
        (cc, "customers_not_null", c("nulls")), (cc, "customers_status_domain", c("bad_status")),
        (oc, "organisations_unique_id", c("n") - c("ids")), (oc, "organisations_unique_name", c("n") - c("names")),
        (oc, "organisations_size_positive", c("bad_size")), (oc, "organisations_status_domain", c("bad_status"))]

    def rows(table):
        found = F.array(*[F.struct(F.lit(name).alias("check_name"), failures.cast("bigint").alias("failures"))
                          for source, name, failures in checks if source is table])
        return table.select(F.inline(found))

    return rows(cc).unionByName(rows(oc))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """GEN-15: percentage of rows per category (1 decimal, half-even; NULLs left out)."""
    g = df.filter(c(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return g.select(col, F.bround(c("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 1).alias("share_pct"))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """GEN-16: rows per category."""
    return df.groupBy(col).agg(F.count("*").alias("n"))


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    """GEN-17: count, mean, std, min, quartiles, max, rounded to 0. A quartile p lies at place (n - 1) * p of
    the sorted values, linearly between its two neighbours."""
    counts = df.filter(c(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    ranked = with_rows_before(counts, col, "n")
    total = df.agg(F.count(col)).scalar()

    def at(place):  # the value at a 0-based place
        return F.min(F.when(c("before") + c("n") > place, c(col)))

    spots = {p: (total - 1) * F.lit(p) for p in (0.25, 0.5, 0.75)}
    q = ranked.agg(*[F.struct(at(F.floor(h)).alias("lo"), at(F.ceil(h)).alias("hi")).alias(f"p{int(p * 100)}")
                     for p, h in spots.items()])
    quartiles = q.select(F.struct(*q.columns)).scalar()

    def between(p):
        ends = quartiles[f"p{int(p * 100)}"]
        step = spots[p] - F.floor(spots[p])
        return F.bround(ends["lo"] + (ends["hi"] - ends["lo"]) * step, 0).alias(f"p{int(p * 100)}")

    return df.agg(F.count(col).alias("count"), F.bround(F.avg(col), 0).alias("mean"),
                  F.bround(F.stddev_samp(col), 0).alias("std"), F.min(col).cast("bigint").alias("min"),
                  F.max(col).cast("bigint").alias("max")).select(
        "count", "mean", "std", "min", *[between(p) for p in spots], "max")

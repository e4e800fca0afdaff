"""Reference data: the product catalogue and its plans (seed rows).

Both tables are tiny and fixed (6 and 18 rows), so every join against them
is a broadcast join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import TABLES

# ---------------------------------------------------------------------------
# Seed rows of the product catalogue and the rate card
# (must equal the reference's seed data).
PRODUCTS = [
    # product_id, product_name, product_family, target_segment
    ("PROD001", "Digital Basic", "Digital News", "General"),
    ("PROD002", "Digital Premium", "Digital News", "General"),
    ("PROD003", "ePaper", "ePaper", "General"),
    ("PROD004", "Weekend ePaper", "ePaper", "General"),
    ("PROD005", "Student Digital", "Digital News", "Student"),
    ("PROD006", "Corporate ePaper", "ePaper", "Organisation"),
]

PLANS = [
    # plan_id, product_id, plan_name, billing_frequency, billing_period_days, unit_price
    ("PLN001", "PROD001", "Digital Basic Daily", "Daily", 1, "30.00"),
    ("PLN002", "PROD001", "Digital Basic Weekly", "Weekly", 7, "150.00"),
    ("PLN003", "PROD001", "Digital Basic Monthly", "Monthly", 30, "500.00"),
    ("PLN004", "PROD001", "Digital Basic Annual", "Annual", 365, "5000.00"),
    ("PLN005", "PROD002", "Digital Premium Weekly", "Weekly", 7, "250.00"),
    ("PLN006", "PROD002", "Digital Premium Monthly", "Monthly", 30, "800.00"),
    ("PLN007", "PROD002", "Digital Premium Annual", "Annual", 365, "8000.00"),
    ("PLN008", "PROD003", "ePaper Daily", "Daily", 1, "60.00"),
    ("PLN009", "PROD003", "ePaper Weekly", "Weekly", 7, "300.00"),
    ("PLN010", "PROD003", "ePaper Monthly", "Monthly", 30, "1000.00"),
    ("PLN011", "PROD003", "ePaper Annual", "Annual", 365, "10000.00"),
    ("PLN012", "PROD004", "Weekend ePaper Weekly", "Weekly", 7, "150.00"),
    ("PLN013", "PROD004", "Weekend ePaper Monthly", "Monthly", 30, "500.00"),
    ("PLN014", "PROD005", "Student Digital Weekly", "Weekly", 7, "100.00"),
    ("PLN015", "PROD005", "Student Digital Monthly", "Monthly", 30, "300.00"),
    ("PLN016", "PROD005", "Student Digital Annual", "Annual", 365, "3000.00"),
    ("PLN017", "PROD006", "Corporate ePaper Monthly", "Monthly", 30, "800.00"),
    ("PLN018", "PROD006", "Corporate ePaper Annual", "Annual", 365, "8000.00"),
]
PLAN_CURRENCY = "KES"
# ---------------------------------------------------------------------------


def products(spark: SparkSession) -> DataFrame:
    rows = [(pid, name, fam, seg, True) for pid, name, fam, seg in PRODUCTS]
    return spark.createDataFrame(rows, TABLES["products"].schema)


def plans(spark: SparkSession) -> DataFrame:
    rows = [(pid, prod, name, freq, days, Decimal(price), PLAN_CURRENCY, True)
            for pid, prod, name, freq, days, price in PLANS]
    return spark.createDataFrame(rows, TABLES["plans"].schema)


FREQUENCY_ORDER = ["Daily", "Weekly", "Monthly", "Annual"]


def _plan_usage(t) -> DataFrame:
    """Subscriptions sold per plan (a partial aggregate on the fact, then an 18-row result)."""
    return t.subscriptions.groupBy("plan_id").agg(F.count("*").alias("subscriptions"))


def rate_card(t) -> DataFrame:
    """SRC-7: product x billing-frequency price matrix (NULL where no plan), with the number of
    subscriptions sold in each cell."""
    p = (t.plans.join(F.broadcast(t.products.select("product_id", "product_name")), "product_id")
         .join(F.broadcast(_plan_usage(t)), "plan_id", "left"))
    g = (p.groupBy("product_id", "product_name").pivot("billing_frequency", FREQUENCY_ORDER)
         .agg(F.max("unit_price").alias("price"), F.sum("subscriptions").alias("sold")))
    return g.select("product_id", "product_name",
                    *[F.col(f"{f}_price").cast("decimal(18,2)").alias(f.lower()) for f in FREQUENCY_ORDER],
                    *[F.coalesce(F.col(f"{f}_sold"), F.lit(0)).cast("bigint").alias(f"{f.lower()}_sold")
                      for f in FREQUENCY_ORDER])


def plan_availability(t) -> DataFrame:
    """SRC-8: which billing frequencies each product is sold in (one row per product x frequency),
    with the subscriptions sold there."""
    freqs = t.plans.agg(F.array_sort(F.collect_set("billing_frequency"))).scalar()  # the frequency domain
    offered = (t.plans.join(F.broadcast(_plan_usage(t)), "plan_id", "left")
               .groupBy("product_id", "billing_frequency")
               .agg(F.count("*").alias("n_plans"), F.sum("subscriptions").alias("subscriptions")))
    return (
        t.products.select("product_id", "product_name", F.explode(freqs).alias("billing_frequency"))
        .join(offered, ["product_id", "billing_frequency"], "left")
        .select("product_id", "product_name", "billing_frequency",
                F.coalesce(F.col("n_plans") > 0, F.lit(False)).alias("available"),
                F.coalesce(F.col("subscriptions"), F.lit(0)).cast("bigint").alias("subscriptions"))
    )


def effective_discount(t) -> DataFrame:
    """SRC-9: annual price vs twelve monthly payments, per product that sells both, and the share
    of that product's monthly + annual subscriptions taken on the annual plan."""
    p = t.plans.join(F.broadcast(_plan_usage(t)), "plan_id", "left")
    per = p.groupBy("product_id").agg(
        F.max(F.when(F.col("billing_frequency") == "Monthly", F.col("unit_price"))).alias("monthly_price"),
        F.max(F.when(F.col("billing_frequency") == "Annual", F.col("unit_price"))).alias("annual_price"),
        F.sum(F.when(F.col("billing_frequency") == "Monthly", F.col("subscriptions"))).alias("monthly_subs"),
        F.sum(F.when(F.col("billing_frequency") == "Annual", F.col("subscriptions"))).alias("annual_subs"),
    ).filter(F.col("monthly_price").isNotNull() & F.col("annual_price").isNotNull())
    annual = F.coalesce(F.col("annual_subs"), F.lit(0))
    both = annual + F.coalesce(F.col("monthly_subs"), F.lit(0))
    return (
        per.join(F.broadcast(t.products.select("product_id", "product_name")), "product_id")
        .select(
            "product_id", "product_name",
            F.col("monthly_price").cast("decimal(18,2)").alias("monthly_price"),
            F.col("annual_price").cast("decimal(18,2)").alias("annual_price"),
            (F.col("monthly_price") * 12).cast("decimal(18,2)").alias("twelve_monthly"),
            F.round(1 - F.col("annual_price").cast("double") / (F.col("monthly_price").cast("double") * 12), 6)
            .alias("discount"),
            F.round(F.try_divide(annual.cast("double"), both.cast("double")), 6).alias("annual_take_up"),
        )
    )

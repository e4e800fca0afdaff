"""Cross-query invariants on the sf0.01 tables."""

from pyspark.sql import functions as F

from subledger.operators import derive as D
from subledger.operators import kpi as K
from subledger.operators import migration as G


def test_product_revenue_adds_up_to_total(tables):
    by_product = (K.revenue_by_product(tables).groupBy("month", "currency")
                  .agg(F.sum("revenue").alias("r")))
    total = K.gross_subscription_revenue(tables).select("month", "currency", F.col("gross_revenue").alias("g"))
    assert by_product.join(total, ["month", "currency"], "full").filter("r is null or g is null or r <> g").count() == 0
    shares = K.revenue_by_product(tables).groupBy("month").agg(F.sum("share").alias("s"))
    assert shares.filter(F.abs(F.col("s") - 1) > 1e-4).count() == 0


def test_rollup_levels_add_up(tables):
    r = K.revenue_by_billing_frequency(tables)
    detail = r.filter("grouping_level = 0").groupBy("month").agg(F.sum("revenue").alias("d"))
    month = r.filter("grouping_level = 3").select("month", F.col("revenue").alias("m"))
    assert detail.join(month, "month").filter("d <> m").count() == 0


def test_transition_rows_sum_to_one(tables):
    for dim in ("product", "cycle"):
        m = G.migration_matrix(tables, dim).groupBy("from_value").agg(F.sum("row_share").alias("s"))
        assert m.filter(F.abs(F.col("s") - 1) > 1e-4).count() == 0


def test_churn_types_partition_churn(tables):
    ch = D.churn_events(tables)
    total = ch.count()
    by_type = {r["churn_type"]: r["n"] for r in ch.groupBy("churn_type").agg(F.count("*").alias("n")).collect()}
    assert set(by_type) <= {"Voluntary", "Involuntary", "Expiry / Non-renewal"}
    assert sum(by_type.values()) == total
    assert D.churn_type_summary(tables).agg(F.sum("churned")).first()[0] == total
    # the monthly rates count owners per month, so per type they can only merge, never add
    vol = K.voluntary_churn_rate(tables).agg(F.sum("churned")).first()[0]
    assert vol <= by_type["Voluntary"]


def test_cohort_retention_bounded(tables):
    c = K.cohort_retention(tables)
    assert c.filter("retention < 0 or retention > 1").count() == 0
    assert c.filter("months_since < 0").count() == 0


def test_funnel_starts_at_all_customers(tables):
    f = {r["step"]: r["customers"] for r in G.lifecycle_funnel(tables).collect()}
    assert f["registered"] == tables.customers.count()
    assert f["paid"] <= f["registered"] and f["reactivated"] <= f["churned"]


def test_active_owner_flow(tables):
    """active(m) - active(m-1) = new(m) + came back(m) - left(m), counting owners."""
    am = D.active_owner_months(tables).select("owner_id", "month")
    prev = am.select("owner_id", F.add_months("month", 1).alias("month"), F.lit(1).alias("was"))
    now = am.select("owner_id", "month", F.lit(1).alias("is_"))
    flow = now.join(prev, ["owner_id", "month"], "full").groupBy("month").agg(
        F.count("is_").alias("active"), F.count("was").alias("previous"),
        F.count_if(F.col("is_").isNotNull() & F.col("was").isNull()).alias("entered"),
        F.count_if(F.col("is_").isNull() & F.col("was").isNotNull()).alias("left"))
    bad = flow.filter("active - previous <> entered - left")
    assert bad.count() == 0

"""The exact rollup of active subscribers against a plain distinct count per level."""

from pyspark.sql import functions as F

from subledger.operators import derive as D
from subledger.operators import kpi as K


def plain(t):
    return (D.active_owner_months(t, None, K.ACTIVE_LEAF[1:]).rollup(*K.ACTIVE_LEAF)
            .agg(F.countDistinct("owner_id").alias("active_subscribers"),
                 F.grouping_id().cast("int").alias("grouping_level")).filter("grouping_level < 7"))


def many_kinds(spark, tables):
    """70 products, one without a name, of one plan each (one without a frequency); owners that hold several kinds,
    the same kind twice, or are NULL."""
    products = spark.range(70).select(*[
        F.concat(F.lit("P"), F.col("id").cast("string")).alias(n) if n == "product_id"
        else F.when(F.col("id") != 5, F.concat(F.lit("name "), (F.col("id") % 67).cast("string"))).alias(n)
        if n == "product_name" else F.lit(None).cast(tables.products.schema[n].dataType).alias(n)
        for n in tables.products.columns])
    plans = spark.range(70).select(*[
        F.concat(F.lit(p), F.col("id").cast("string")).alias(n) if p
        else F.when(F.col("id") != 9, F.when(F.col("id") % 2 == 0, "Monthly").otherwise("Annual")).alias(n)
        if n == "billing_frequency" else F.lit(None).cast(tables.plans.schema[n].dataType).alias(n)
        for n in tables.plans.columns for p in [{"plan_id": "L", "product_id": "P"}.get(n)]])
    i = F.col("id")
    made = {"subscription_id": F.concat(F.lit("S"), i.cast("string")),
            "customer_id": F.when(i % 11 != 3, F.concat(F.lit("C"), (i % 13).cast("string"))),
            "plan_id": F.concat(F.lit("L"), (i * 7 % 71).cast("string")),  # L70 is no plan
            "subscription_start_date": F.date_add(F.lit("2023-01-10").cast("date"), (i % 90).cast("int")),
            "subscription_end_date": F.when(i % 3 != 0, F.date_add(F.lit("2023-05-10").cast("date"), (i % 120).cast("int")))}
    subs = spark.range(400).select(*[
        made.get(n, F.lit(None)).cast(tables.subscriptions.schema[n].dataType).alias(n)
        for n in tables.subscriptions.columns])
    return tables.with_tables(products=products, plans=plans, subscriptions=subs)


def test_rollup_counts_sets_of_more_than_62_kinds(spark, tables):
    t = many_kinds(spark, tables)
    got, want = K.active_subscribers_rollup(t), plain(t)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    rows = sorted(map(repr, got.collect()))
    assert rows == sorted(map(repr, want.collect()))
    assert any("active_subscribers=0" in r for r in rows)  # a cell whose only owner is NULL


def test_rollup_copies_no_row_per_level(tables):
    plan = K.active_subscribers_rollup(tables)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan

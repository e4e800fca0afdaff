"""Typed read/write round trips and the constraint-enforcing ingest stream."""

import os
import tempfile

from pyspark.sql import functions as F

from subledger.sources import io
from subledger.streaming.ingest import start_ingest

SMALL = "/root/testdata/sf0.001"


def _small(spark):
    from subledger.sources.fixtures import Tables

    return Tables(spark, SMALL)


def test_parquet_roundtrip_all_tables(spark):
    t = _small(spark)
    d = tempfile.mkdtemp(prefix="subledger-io-", dir="/tmp")
    io.write_tables(t, d)
    back = io.load_tables(spark, d, like=t)
    for name in ("payments", "subscriptions", "customer_engagement"):
        a, b = getattr(t, name), getattr(back, name)
        assert a.schema == b.schema or [f.name for f in a.schema] == [f.name for f in b.schema]
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert os.path.isdir(os.path.join(d, "payments"))
    assert any(p.startswith("part_month=") for p in os.listdir(os.path.join(d, "payments")))


def test_csv_rejects_malformed_rows(spark):
    t = _small(spark)
    d = tempfile.mkdtemp(prefix="subledger-csv-", dir="/tmp")
    io.write_table(t.plans, "plans", d, "csv")
    with open(os.path.join(d, "plans", "extra.csv"), "w") as f:
        f.write("plan_id,product_id,plan_name,billing_frequency,billing_period_days,unit_price,currency,is_active\n")
        f.write("PLN999,PROD001,Broken,Monthly,not_a_number,1.00,KES,true\n")
    good, bad = io.read_table(spark, "plans", d, "csv", with_rejects=True)
    assert good.count() == 18
    assert bad.count() == 1


def test_ingest_stream_quarantines_bad_rows(spark):
    t = _small(spark)
    root = tempfile.mkdtemp(prefix="subledger-stream-", dir="/tmp")
    src, tgt, qdir = (os.path.join(root, x) for x in ("in", "out", "quarantine"))
    pay = t.payments
    first = pay.first()["payment_id"]
    bad = pay.withColumn("amount", F.when(F.col("payment_id") == first, F.lit(0)).otherwise(F.col("amount")))
    orphan = pay.limit(1).withColumn("payment_id", F.lit("PAY_ORPHAN")).withColumn("subscription_id", F.lit("SUB_NONE"))
    bad.unionByName(orphan).write.parquet(src)
    q = start_ingest(spark, "payments", src, tgt, qdir, parents={"subscriptions": t.subscriptions},
                     checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    good = spark.read.parquet(tgt)
    rejected = spark.read.parquet(qdir)
    assert good.count() == pay.count() - 1
    rules = {r["payment_id"]: r["violated_rules"] for r in rejected.collect()}
    assert rules == {first: ["chk_payment_amount"], "PAY_ORPHAN": ["fk_payments_subscription_id"]}


def test_bucketed_tables_join_without_shuffle(spark):
    from subledger.operators import derive as D

    t = _small(spark)
    d = tempfile.mkdtemp(prefix="subledger-bucket-", dir="/tmp")
    names = io.write_bucketed_tables(t, d, 4, prefix="bucket_test")
    bt = io.load_bucketed_tables(spark, names, t)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = D.revenue_facts(bt)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning(subscription_id" not in plan
        assert df.count() == D.revenue_facts(t).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

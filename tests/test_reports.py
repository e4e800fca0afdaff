import datetime as dt

import pytest
from pyspark.sql import functions as F

from subledger.operators import reports as RP
from subledger.plans.compare import compare
from subledger.plans.oracle_fixtures import CUT_TABLES, with_tables

DAY = "2023-07-01"


@pytest.mark.parametrize("name", sorted(CUT_TABLES))
def test_tables_before_a_day(name, tables, duck):
    for day in (DAY, "2024-01-15"):  # engagement and support begin in January 2024
        r = compare(getattr(tables.before(day), name), with_tables(f"select * from {name}", day), duck)
        assert r["match"], r
    assert r["spark_rows"] > 0


def test_nothing_after_the_day_reaches_a_report(tables):
    """Rows dated later may change in any way without a change in the report of an earlier day."""
    cut = tables.before(DAY)
    later = tables.payments.filter(F.col("payment_attempted_at") >= F.lit(DAY).cast("date"))
    more = tables.with_tables(payments=tables.payments.unionByName(
        later.withColumn("payment_id", F.concat("payment_id", F.lit("x"))).withColumn("amount", F.col("amount") * 3)))
    want = sorted(map(str, RP.report_subscription(cut).collect()))
    assert sorted(map(str, RP.report_subscription(more, DAY).collect())) == want
    last = [r["month"] for r in RP.report_subscription(more, DAY).select("month").distinct().collect() if r["month"]]
    assert max(last) < dt.date.fromisoformat(DAY)


def test_every_month_between_the_first_and_the_last(spark):
    d = dt.date
    rows = [(d(2023, 1, 1), "KES", 1), (d(2023, 1, 1), "USD", 2), (d(2023, 4, 1), None, 3), (d(2023, 5, 1), "KES", None)]
    got = RP.with_every_month(spark.createDataFrame(rows, "month date, currency string, n int")).collect()
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(
        rows + [(d(2023, 2, 1), None, None), (d(2023, 3, 1), None, None)], "month date, currency string, n int")
        .collect()))
    assert RP.with_every_month(spark.createDataFrame([], "month date, currency string, n int")).count() == 0

"""The load store: manifests, change sets between any two loads, and the rules that compare loads."""

import tempfile

import pytest
from pyspark.sql import functions as F

from subledger.operators import rules as RU
from subledger.sources.loads import LoadStore, changed_keys
from subledger.sources.schemas import LOAD_ORDER


@pytest.fixture(scope="module")
def small(spark):
    from subledger.sources.fixtures import Tables

    return Tables(spark, "/root/testdata/sf0.001").materialized(tempfile.mkdtemp(prefix="loads-", dir="/tmp") + "/t")


@pytest.fixture(scope="module")
def store(spark, small):
    """a: the tables; b: the same again, in other files; c: planted changes."""
    s = LoadStore(spark, tempfile.mkdtemp(prefix="loads-", dir="/tmp"))
    s.write(small, "a", "2024-01-01 00:00:00")
    s.write(small.with_tables(payments=small.payments.repartition(5)), "b", "2024-01-02 00:00:00")
    pay = small.payments
    ids = [r[0] for r in pay.where("payment_status = 'failed'").orderBy("payment_id").select("payment_id").limit(3).collect()]
    moved = F.col("payment_id") == ids[1]
    pay = (pay.where(F.col("payment_id") != ids[2])
           .withColumn("payment_status", F.when(F.col("payment_id") == ids[0], "successful").otherwise(F.col("payment_status")))
           .withColumn("payment_attempted_at", F.when(moved, F.col("payment_attempted_at") + F.expr("interval 40 days"))
                       .otherwise(F.col("payment_attempted_at"))))
    new = pay.where(F.col("payment_id") == ids[0]).withColumn("payment_id", F.lit("PAYNEW"))
    s.write(small.with_tables(payments=pay.unionByName(new), plans=small.plans.where("plan_id <> 'PLN003'")), "c",
            "2024-01-03 00:00:00")
    s.ids = ids
    return s


def test_loads_are_listed_and_read_back(store, small):
    assert [(r["load_id"], r["tables"]) for r in store.loads().collect()] == [(x, len(LOAD_ORDER)) for x in "abc"]
    back = store.tables("a", small)
    assert back.payments.exceptAll(small.payments).count() == 0 == small.payments.exceptAll(back.payments).count()


def test_same_load_in_other_files_has_no_change(store):
    counts = {r["table_name"]: r for r in store.change_counts("a", "b").collect()}
    assert len(counts) == len(LOAD_ORDER)
    assert all(r["inserted"] == r["changed"] == r["deleted"] == 0 for r in counts.values())
    assert sum(r["unchanged"] for r in counts.values()) == sum(r["rows"] for r in store.manifest("b").collect())
    assert all(store.changes("a", "b", n).count() == 0 for n in ("payments", "plans", "subscriptions"))
    assert RU.rewritten_between(store, "a", "b").count() == RU.deleted_between(store, "a", "b").count() == 0


def test_unchanged_months_are_not_read(store):
    old, new = store.differing("a", "b", "payments")
    assert old.count() == new.count() == 0
    old, new = store.differing("a", "c", "payments")
    months = {r[0] for r in old.select(F.date_format("payment_attempted_at", "yyyy-MM")).distinct().collect()}
    assert 1 <= len(months) <= 4  # of the planted rows only
    assert "PartitionFilters: [part_month" in old._jdf.queryExecution().executedPlan().toString()


def test_planted_changes_are_found_exactly(store):
    got = {r["payment_id"]: (r["change"], r["changed_columns"]) for r in store.changes("a", "c", "payments").collect()}
    a, b, c = store.ids
    assert got == {a: ("change", ["payment_status"]), b: ("change", ["payment_attempted_at"]), c: ("delete", None),
                   "PAYNEW": ("insert", None)}
    back = {r["payment_id"]: r["change"] for r in store.changes("c", "a", "payments").collect()}
    assert back == {a: "change", b: "change", c: "insert", "PAYNEW": "delete"}
    assert [tuple(r) for r in RU.rewritten_between(store, "a", "c").collect()] == [(a, 2)]
    assert [tuple(r) for r in RU.deleted_between(store, "a", "c").collect()] == [("plans", "PLN003")]
    moves = {(r["earlier_status"], r["later_status"]): r["payments"]
             for r in RU.payment_status_transitions(store, "a", "c").collect()}
    assert moves[("failed", "successful")] == moves[(None, "successful")] == moves[("failed", None)] == 1
    assert sum(moves.values()) == store.tables("a", store_like(store)).payments.count() + 1


def store_like(store):
    from subledger.sources.fixtures import Tables

    return Tables(store.spark, "/root/testdata/sf0.001")


def test_a_broken_load_is_not_listed_and_can_be_repeated(spark, small):
    from subledger.sources import io

    s = LoadStore(spark, tempfile.mkdtemp(prefix="loads-", dir="/tmp"))
    assert s.loads().count() == 0
    io.write_tables(small.with_tables(payments=small.payments.limit(3)), f"{s.path}/x")  # no manifest was written
    assert s.loads().count() == 0
    with pytest.raises(ValueError, match="no load"):
        s.changes("x", "x", "payments")
    s.write(small, "x", "2024-01-01 00:00:00")
    assert s.tables("x", small).payments.count() == small.payments.count()
    with pytest.raises(ValueError, match="exists"):
        s.write(small, "x", "2024-01-01 00:00:00")


def test_nulls_repeated_keys_and_moved_values(spark):
    kind = "k string, x string, y string"
    old = spark.createDataFrame([("a", None, "v"), ("b", "1", "1"), ("b", "2", "2"), (None, "n", "n"), ("c", "p", "q"),
                                 ("d", "1", "1"), ("d", "1", "1"), ("e", "z", "z")], kind)
    new = spark.createDataFrame([("a", "v", None), ("b", "2", "2"), ("b", "1", "1"), (None, "n", "m"), ("c", "p", "q"),
                                 ("d", "1", "1"), ("e", "z", "z"), ("e", "z", "z")], kind)
    got = {r["k"]: (r["change"], r["earlier_rows"], r["later_rows"], r["changed_columns"])
           for r in changed_keys(old, new, "k").collect()}
    assert got == {"a": ("change", 1, 1, ["x", "y"]), None: ("change", 1, 1, ["y"]), "d": ("change", 2, 1, None),
                   "e": ("change", 1, 2, None)}
    assert changed_keys(old, old.repartition(3), "k").count() == 0
    assert changed_keys(old.limit(0), new.limit(0), "k").count() == 0


def test_registered_rewritten_rule_compares_two_different_loads(spark, small):
    from datetime import datetime

    from subledger.plans.catalog import load_all

    day = small.as_of  # 2024-02-01: the earlier load ends on 2024-01-02, its last two days are pending
    rows = small.payments.limit(4).collect()
    assert day == "2024-02-01" and len(rows) == 4
    times = [datetime(2023, 12, 31, 9), datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9), datetime(2023, 12, 30, 9)]
    state = ["successful", "pending", "failed", "failed"]
    made = [{**r.asDict(), "payment_id": f"P{i}", "payment_attempted_at": times[i], "payment_status": state[i]}
            for i, r in enumerate(rows)]
    t = small.with_tables(payments=spark.createDataFrame([tuple(m[c] for c in small.payments.columns) for m in made],
                                                         small.payments.schema))
    got = load_all()["payment_status_rewritten"].build(t).collect()
    assert [tuple(r) for r in got] == [("P0", 2)]


def test_registered_deleted_plans_rule_finds_plans_no_longer_sold(spark, small):
    from subledger.plans.catalog import load_all

    day = F.when(F.col("plan_id") == "PLN004", F.lit("2022-01-01")).otherwise(F.lit("2023-12-01")).cast("date")
    subs = small.subscriptions.where("plan_id <> 'PLN003'").withColumn("subscription_start_date", day)
    got = load_all()["deleted_plans"].build(small.with_tables(subscriptions=subs)).collect()
    sold = {r[0] for r in subs.where("plan_id <> 'PLN004'").select("plan_id").distinct().collect()}
    assert {r["plan_id"] for r in got} == {r[0] for r in small.plans.select("plan_id").collect()} - sold
    assert {"PLN003", "PLN004"} <= {r["plan_id"] for r in got}


def test_tables_are_written_when_first_read(spark):
    from subledger.sources import fixtures as X

    X._CACHE.clear()
    t = X.tables(spark, "/root/testdata/sf0.001")
    (_, store), = X._CACHE.values()
    earlier = t.before("2023-07-01")
    assert store.written == []
    assert earlier.subscriptions.count() < t.subscriptions.count()
    assert {p.rsplit("/", 1)[1] for p in store.written} == {"_helper_sub_end", "subscriptions"}
    assert X.tables(spark, "/root/testdata/sf0.001") is t


def test_two_loads_hold_the_named_tables_only(spark, small):
    from subledger.plans.q_rules import two_loads

    s = two_loads(small, "payments")
    for load in ("earlier", "later"):
        assert {r["table_name"] for r in s.manifest(load).collect()} == {"payments"}
    moves = {(r["earlier_status"], r["later_status"]): r["payments"]
             for r in RU.payment_status_transitions(s, "earlier", "later").collect()}
    assert sum(moves.values()) == small.payments.count() and (None, "successful") in moves


@pytest.mark.parametrize("again", [False, True])
def test_ends_of_subscriptions_with_unique_and_repeated_order_keys(spark, again):
    """Two orders of one owner; with a repeated key each of its two rows meets both neighbours of the key."""
    from subledger.sources.fixtures import Tables

    rows = [(3, 1, "O", "1995-01-01"), (4, 1, "O", "1995-01-02")] + ([(4, 1, "O", "1995-01-02")] if again else [])
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string")
    t = Tables(spark, "/nowhere")
    t.raw = lambda name: orders
    got = sorted((r["o_orderkey"], r["prev_key"], r["prev_end_reason"], r["next_key"]) for r in t.sub_end.select(
        "o_orderkey", "prev_key", "prev_end_reason", "next_key").na.fill(-1).na.fill("").collect())
    assert got[0] == (3, -1, "", 4)
    if again:
        assert len(got) > 3
    else:
        plan = t.sub_end._jdf.queryExecution().optimizedPlan().toString()
        assert got[1][:2] == (4, 3) and got[1][3] == -1 and len(got) == 2
        assert plan.count("Join") == 2  # both of the partition edges; rows meet no other rows

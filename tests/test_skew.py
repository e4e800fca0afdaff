"""One owner holding a third of all subscriptions: the owner sweeps must stay exact.

Results of churn, tenure, owner order and post-move activity are compared with a brute-force
Python computation over the same small hand table."""

import datetime as dt
import random

import pytest

from subledger.operators import derive as D
from subledger.sources.schemas import TABLES

AS_OF = dt.date(2024, 2, 1)
GRACE = 30


def _table(spark):
    rnd = random.Random(7)
    rows = []
    n = 0
    owners = ["HOT"] * 600 + [f"C{i:03d}" for i in range(300) for _ in range(4)]
    for owner in owners:
        n += 1
        start = dt.date(2018, 1, 1) + dt.timedelta(days=rnd.randrange(0, 2000))
        length = rnd.choice([0, 1, 7, 30, 90, 365, 800])
        end = start + dt.timedelta(days=length)
        if end >= AS_OF:
            end = None
        reason = None if end is None else rnd.choice(["voluntary_cancel", "payment_failure", "non_renewal", "plan_change"])
        rows.append((f"S{n:05d}", owner, None, "PLN003", start, start, end or start, end,
                     "ended" if end else "active", True, None, reason, None, dt.datetime(2020, 1, 1)))
    return spark.createDataFrame(rows, TABLES["subscriptions"].schema), rows


@pytest.fixture(scope="module")
def skewed(spark):
    from subledger.sources.fixtures import Tables

    df, rows = _table(spark)
    return Tables(spark, "/root/testdata/sf0.001").with_tables(subscriptions=df), rows


def _brute_churn(rows):
    by_owner = {}
    for r in rows:
        by_owner.setdefault(r[1], []).append(r)
    out = set()
    for r in rows:
        sid, owner, end, reason = r[0], r[1], r[7], r[11]
        if end is None or reason == "plan_change" or not end + dt.timedelta(days=GRACE) < AS_OF:
            continue
        cont = any(o[4] <= end + dt.timedelta(days=GRACE) and (o[7] is None or o[7] > end) for o in by_owner[owner])
        if not cont:
            out.add(sid)
    return out


def test_churn_exact_under_skew(skewed):
    t, rows = skewed
    got = {r["subscription_id"] for r in D.churn_events(t).collect()}
    assert got == _brute_churn(rows)


def test_tenure_exact_under_skew(skewed):
    t, rows = skewed
    got = {r["owner_id"]: r["tenure_days"] for r in D.owner_tenure(t).collect()}
    hot = sorted((r[4], min(r[7] or AS_OF, AS_OF)) for r in rows if r[1] == "HOT" and r[4] < AS_OF)
    days = set()
    for s, e in hot:
        days.update(s + dt.timedelta(days=i) for i in range((e - s).days))
    assert got["HOT"] == len(days)


def test_owner_order_under_skew(skewed):
    t, rows = skewed
    nb = {r["subscription_id"]: (r["seq"], r["prev_subscription_id"], r["next_subscription_id"])
          for r in D.owner_neighbours(t).collect()}
    hot = sorted((r[4], r[0]) for r in rows if r[1] == "HOT")
    for i, (_, sid) in enumerate(hot):
        prev = hot[i - 1][1] if i > 0 else None
        nxt = hot[i + 1][1] if i + 1 < len(hot) else None
        assert nb[sid] == (i + 1, prev, nxt)


def test_descending_rank_matches_window_rank(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from subledger.functions.ordering import descending_rank
    rnd = random.Random(3)
    vals = [0] * 400 + [rnd.randrange(0, 300) for _ in range(800)]   # one value holds a third
    df = spark.createDataFrame([(f"K{i}", v) for i, v in enumerate(vals)], "k string, v int")
    got = {r["k"]: r["r"] for r in descending_rank(df, "v", "r").collect()}
    want = {r["k"]: r["r"] for r in df.select("k", F.rank().over(Window.orderBy(F.desc("v"))).alias("r")).collect()}
    assert got == want


def test_journeys_of_a_hot_owner(spark):
    """One owner with a third of all steps: paths equal the plain ones, no row holds the long path."""
    from subledger.operators import migration as G
    from subledger.sources.fixtures import Tables

    df, rows = _table(spark)
    rows = [r for r in rows if r[1] != "HOT"][:400] + [r for r in rows if r[1] == "HOT"][:200]
    t = Tables(spark, "/root/testdata/sf0.001").with_tables(
        subscriptions=spark.createDataFrame(rows, TABLES["subscriptions"].schema))
    t = t.with_tables(trials=t.trials.limit(0), payments=t.payments.limit(0))
    steps = {}
    for r in G.numbered_steps(t).collect():
        steps.setdefault(r["owner_id"], {})[r["pos"]] = r["label"]
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in steps.values())
    paths = {o: tuple(p[i] for i in sorted(p)) for o, p in steps.items()}
    count = {}
    for o, p in paths.items():
        count.setdefault(p, []).append(o)
    want = sorted(count, key=lambda p: (-len(count[p]), len(p), p))
    k = len(want)  # all of them, the hot owner's path too
    got = {}
    for r in G.journey_paths(t, k).collect():
        got.setdefault((r["journey"], r["owners"]), {})[r["position"]] = r["label"]
    assert [tuple(p[i] for i in sorted(p)) for _, p in sorted(got.items())] == want
    assert [n for (_, n) in sorted(got)] == [len(count[p]) for p in want] and len(paths["HOT"]) >= 200

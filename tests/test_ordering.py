"""Order, running sums, ranks and quantiles inside hot keys, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subledger.functions import ordering as O
from subledger.session import _SCRATCH, path_exists, scratch_result, scratch_scope


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Small partitions are not merged here, so keys do reach over their edges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def hot(spark):
    """One key with a third of the rows, all on one day; a NULL key; small keys."""
    rnd = random.Random(5)
    rows = [("HOT", dt.date(2022, 1, 1), f"r{i:06d}", rnd.randrange(5)) for i in range(4000)]
    rows += [(None, dt.date(2022, 1, rnd.randrange(1, 9)), f"n{i:06d}", rnd.randrange(5)) for i in range(1500)]
    rows += [(f"K{i % 900}", dt.date(2022, 1, rnd.randrange(1, 28)), f"s{i:06d}", rnd.randrange(5)) for i in range(6500)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, d date, id string, v int")


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def test_a_hot_day_spreads_over_partitions(spark, hot):
    rows = O.Ordered(hot[1], "k", ("d", "id")).rows
    parts = rows.where("k = 'HOT'").groupBy(O.PID).count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 2500


def test_neighbours(hot):
    rows, df = hot
    got = {r["id"]: (r["seq"], r["prev_id"], r["next_id"], r["next_day"])
           for r in O.ordered_neighbours(df, "k", "d", "id").collect()}
    for own in by_key(rows).values():
        for i, r in enumerate(own):
            nxt = own[i + 1] if i + 1 < len(own) else None
            assert got[r[2]] == (i + 1, own[i - 1][2] if i else None, nxt and nxt[2], nxt and nxt[1])
    assert len(got) == len(rows)


def test_sum_before(hot):
    rows, df = hot
    got = {r["id"]: r["s"] for r in O.Ordered(df, "k", ("d", "id"), ("v",)).sum_before(F.col("v"), "s").collect()}
    for own in by_key(rows).values():
        total = 0
        for r in own:
            assert got[r[2]] == total
            total += r[3]


def test_neighbours_of_nothing(spark, hot):
    assert O.ordered_neighbours(hot[1].limit(0), "k", "d", "id").collect() == []


@pytest.mark.parametrize("block", [1, 2, 16])
def test_sequence_ranks(spark, block):
    rnd = random.Random(2)
    paths = {f"o{i}": [rnd.choice("ab") for _ in range(rnd.randrange(1, 9))] for i in range(120)}
    long = [rnd.choice(["x", "yy", "y"]) for _ in range(700)]
    paths |= {"hot": long, "hot2": list(long), "hot3": long[:-1] + ["z"], "hot4": long + ["a"], None: ["a", "b"]}
    df = spark.createDataFrame([(o, i, x) for o, p in paths.items() for i, x in enumerate(p, 1)],
                               "o string, pos long, label string").repartition(5)
    got = {r["o"]: (r["steps"], r["rank"]) for r in O.sequence_ranks(df, "o", "pos", "label", block).collect()}
    assert {o: s for o, (s, _) in got.items()} == {o: len(p) for o, p in paths.items()}
    names = list(paths)
    for a in names:
        for b in names:
            assert (got[a][1] < got[b][1]) == (paths[a] < paths[b]) and (got[a][1] == got[b][1]) == (paths[a] == paths[b])


def test_sequence_ranks_of_nothing(spark):
    assert O.sequence_ranks(spark.createDataFrame([], "o string, pos long, label string"), "o", "pos", "label").collect() == []


def test_quantiles_together(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice("ab"), rnd.randrange(100), 7 if i < 400 else rnd.randrange(1000)) for i in range(1000)]
    rows += [(None, None, 3)]
    df = spark.createDataFrame(rows, "g string, x int, y int")
    got = {(r["metric"], r["part"]): [float(v) for v in r["cuts"]] for r in O.quantiles_together(
        df, (0.2, 0.5, 0.9), {"x": (), "y": ("g",)}).collect()}

    def cuts(values):
        values = sorted(values)
        return [float(values[-(-int(p * 10) * len(values) // 10) - 1]) for p in (0.2, 0.5, 0.9)]

    assert got == {("x", ""): cuts([r[1] for r in rows if r[1] is not None]),
                   **{("y", "\x00" if g is None else g): cuts([r[2] for r in rows if r[0] == g]) for g in ("a", "b", None)}}


def test_scratch_tables_go_with_their_scope(spark, hot):
    before = len(_SCRATCH)
    with scratch_scope():
        O.ordered_neighbours(hot[1], "k", "d", "id").count()
        inside = [p for _, p in _SCRATCH[before:]]
        assert inside and all(path_exists(spark, p) for p in inside)
    assert len(_SCRATCH) == before and not any(path_exists(spark, p) for p in inside)
    kept = scratch_result(spark, "kept", lambda: O.ordered_neighbours(hot[1], "k", "d", "id"))
    assert len(_SCRATCH) == before + 1 and kept.count() == len(hot[0])

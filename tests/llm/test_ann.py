import numpy as np
import pytest

from subledger.llm import ann

from .conftest import SF_MID


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        s = (x * x[ids.index(q)]).sum(axis=1)
        out[q] = [(i, v) for v, i in sorted(((-v, i) for i, v in zip(ids, s) if i != q))][:k]
    return out


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = [len({i for i, _ in want[q]} & {i for _, i, _ in got[q]}) / len(want[q]) for q in want]
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in zip(found, found[1:]))
    return float(np.mean(hits))


@pytest.mark.parametrize("least", [1, 8])
def test_recall_on_embeddings(spark, least):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = ann.usable(e)
    got = ann.nearest(rows, rows.where("vec_id % 20 = 0"), 20, least_shards=least).collect()
    table = [(r["vec_id"], r["v"]) for r in rows.collect()]
    ids, x = [i for i, _ in table], np.array([v for _, v in table])
    want = brute(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert recall(got, want) >= 0.9
    at = {i: v for i, v in zip(ids, x)}
    assert all(abs(r["score"] - float(at[r["query_id"]] @ at[r["vec_id"]])) < 1e-12 for r in got)


def test_larger_graph_recall():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = ann.Graph.build(x)
    found = g.search(x[:200], 128)
    hits = [len(set(np.argsort(-(x @ x[i]))[:20]) & set(found[i])) / 20 for i in range(200)]
    assert np.mean(hits) >= 0.95


def test_many_equal_vectors_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [
        (300 + i, [float(z) for z in rng.normal(size=3) * rng.integers(1, 9)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.op4_hnsw(df).collect()
    table = sorted((r["vec_id"], r["v"]) for r in ann.usable(df).collect())
    ids, x = [i for i, _ in table], np.array([v for _, v in table])
    assert recall(got, brute(ids, x, [i for i in ids if i % 20 == 0], 20)) >= 0.9


def test_odd_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (8, [1.0]), (20, [0.0, 1.0]), (None, [1.0, 1.0]), (40, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.op4_hnsw(df).collect())
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]  # (8, [1.0]) has no query of its dimension
    assert ann.op4_hnsw(df.limit(0)).count() == 0


def found(rows):
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    return got


def test_each_dimension_has_its_own_graphs(spark):
    rows = [(i, [1.0, i / 100]) for i in range(0, 40)] + [(i, [1.0, 2.0, i / 100]) for i in (40, 41, 60)]
    got = found(ann.op4_hnsw(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got[40] == [60, 41] and got[60] == [41, 40]
    assert got[0] == list(range(1, 21)) and got[20] == [i for i in range(39, 18, -1) if i != 20]


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e100, 1.0]), (2, [1e-200, 1e-200]), (3, [-1e100, 5.0]), (4, [1e200, -1e200]),
            (20, [1e-300, 0.0]), (40, [1e200, 1e200])]
    got = ann.op4_hnsw(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    ids = found(got)
    # 0: two infinite products tie, then 1e300, 1, -1e300 ...; 40 with 4 is infinity less infinity: no number, last
    assert ids[0] == [4, 40, 1, 2, 20, 3] and ids[40] == [0, 1, 2, 20, 3, 4]
    assert ids[20] == [0, 4, 40, 1, 2, 3]
    assert [r["score"] for r in got if r["query_id"] == 0 and r["vec_id"] == 4] == [float("inf")]


def test_rows_that_share_an_id(spark):
    rows = [(0, [2.0, 0.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [3.0, 1.0]), (1, [0.5, 9.0]), (2, [1.0, 1.0])]
    got = ann.op4_hnsw(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 2, 1.0), (2, 1, 0.5)]


def test_points_that_coincide_in_single_precision_are_all_found():
    x = np.zeros((400, 3), np.float32)
    x[:, 2] = 1
    x[0] = [1, 0, 0]
    g = ann.Graph.build(x)
    assert all(len(set(row)) == 128 and (row >= 0).all() for row in g.search(x[:50], 128))


def test_shards_grow_with_the_root_and_stay_within_memory(spark):
    sizes = [(10_000, 64), (100_000, 64), (200_000, 64), (10**9, 64), (10**6, 4096)]
    df = spark.createDataFrame(sizes, "n long, dim int")
    got = {(r["n"], r["dim"]): r["s"] for r in df.select("n", "dim", ann.shard_count(df["n"], df["dim"]).alias("s"))
           .collect()}
    assert got[10_000, 64] == got[100_000, 64] == 8 and got[200_000, 64] == 10
    assert all(n / s * d * 8 <= ann.SHARD_BYTES for (n, d), s in got.items())

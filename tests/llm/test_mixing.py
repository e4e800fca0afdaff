import random

import numpy as np
import pytest

from subledger.llm import mixing as M


def test_law_over_a_million_blocks_and_a_thousand_sources():
    """Weights that are no multiple of any period; the drift is measured against the weights themselves."""
    rng = np.random.default_rng(4)
    for weights in ([1 / 3] * 3, [0.5, 0.3, 0.2], [0.9999, 0.0001], (rng.random(1000) ** 3 + 1e-4).tolist()):
        w = np.array(weights) / sum(weights)
        blocks = np.maximum(1, np.floor(w * 1_000_000)).astype(np.int64)
        c = M.course(blocks.tolist(), weights)
        assert (np.sort(c["slot"]) == np.arange(blocks.sum())).all()
        upto = int((blocks / w).min()) - 1  # before the first source has run out
        for k in range(len(w)):
            own = np.sort(c["slot"][c["cls"] == k])
            own = own[own < upto]
            n = np.arange(len(own))
            # after own[n] + 1 slots n + 1 blocks stand, just before it n
            assert np.abs(n + 1 - (own + 1) * w[k]).max(initial=0) < 1 + 1e-6 and np.abs(n - own * w[k]).max(initial=0) < 1 + 1e-6


def test_schedule_against_a_plain_scheduler():
    """Slot by slot over all sources, without heaps or vectors."""
    from fractions import Fraction

    for seed in range(6):
        rng = random.Random(seed)
        shares = [Fraction(rng.randint(1, 9)) for _ in range(rng.randint(1, 7))]
        w = [x / sum(shares) for x in shares]
        blocks = [int(x * 200) + 200 for x in w]
        slots = 60
        got = M.course(blocks, [float(x) for x in shares])
        done, order = [0] * len(w), []
        for t in range(slots):
            ready = [(-(-(d + 1) // x), k) for k, (d, x) in enumerate(zip(done, w)) if d // x <= t]
            _, k = min(ready)
            order.append(k)
            done[k] += 1
        assert [int(c) for _, c in sorted(zip(got["slot"], got["cls"]))][:slots] == order


def test_blocks_grow_with_the_rows_and_stay_bounded():
    size, place = M.schedule([10**9, 3 * 10**8, 5], [1.0, 1.0, 1.0])
    assert size > M.BLOCK_ROWS and len(place["slot"]) <= M.MAX_BLOCKS
    assert place["begin"].max() < 13 * 10**8 + 5 and (np.diff(np.sort(place["begin"])) > 0).all()


def test_documents(docs):
    rows = M.op5_pfair_mix(docs).collect()
    assert sorted(r["position"] for r in rows) == list(range(docs.count()))
    weights = {"src0": 0.5, "src1": 0.25}
    rows = sorted(M.mixed(docs.select("doc_id", "source"), weights, block_rows=1).collect(),
                  key=lambda r: r["mix"]["position"])
    assert [r["mix"]["position"] for r in rows] == list(range(len(rows)))
    first = [r for r in rows if r["mix"]["phase"] == 0]
    for name, share in weights.items():
        done = 0
        for t, r in enumerate(first, 1):
            done += r["source"] == name
            assert abs(done - share * t) < 1 + 1e-6


def test_partitions_do_not_change_the_order(spark, docs):
    whole = {r["doc_id"]: r["position"] for r in M.op5_pfair_mix(docs).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {r["doc_id"]: r["position"] for r in M.op5_pfair_mix(docs.repartition(7)).collect()} == whole
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_repeated_doc_id_takes_places_of_its_own(spark):
    docs = spark.range(3000).selectExpr("if(id < 1000, 7, id) as doc_id", "concat('s', id % 3) as source")
    rows = M.op5_pfair_mix(docs).collect()
    assert sorted(r["position"] for r in rows) == list(range(3000))


def test_mixed_order_keeps_all_columns_and_can_be_read_back(spark, docs, tmp_path):
    from pyspark.sql import functions as F

    with_mix = docs.withColumn("mix", F.col("doc_id") * 2)
    want = {r["doc_id"]: r["position"] for r in M.op5_pfair_mix(docs).collect()}
    out = M.in_mixed_order(with_mix)
    assert out.columns == with_mix.columns
    out.write.parquet(str(tmp_path / "mixed"))
    back, n = M.stored_order(spark.read.parquet(str(tmp_path / "mixed")))
    got = back.collect()
    assert n == len(got) == docs.count() and {r["doc_id"]: r["__place"] for r in got} == want
    assert all(r["mix"] == 2 * r["doc_id"] for r in got)


def test_odd_and_empty(odd_docs, no_docs):
    rows = M.op5_pfair_mix(odd_docs).collect()
    assert sorted(r["position"] for r in rows) == list(range(odd_docs.count()))
    assert M.op5_pfair_mix(no_docs).count() == 0
    whole = M.in_mixed_order(odd_docs)
    assert whole.columns == odd_docs.columns and whole.count() == odd_docs.count()


@pytest.mark.parametrize("seed", range(6))
def test_course_stays_within_one_block(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 90)
    blocks, weights = [rng.randint(0, 40) for _ in range(n)], [rng.random() + 0.01 for _ in range(n)]
    c = M.course(blocks, weights)
    order = sorted(zip(c["slot"].tolist(), c["cls"].tolist(), c["block"].tolist()))
    assert [s for s, _, _ in order] == list(range(sum(blocks)))
    done = [0] * n
    for t, k, block in order:
        assert block == done[k]
        done[k] += 1
        low, high = 0.0, 1e9  # the time at which the ideal course has filled t + 1 slots
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(b, w * mid) for b, w in zip(blocks, weights)) < t + 1 else (low, mid)
        assert all(abs(d - min(b, w * high)) < 1 + 1e-5 for d, b, w in zip(done, blocks, weights))


def test_every_source_is_a_class(spark):
    """200 equal sources and a large one: each has its own share of every stretch of the order."""
    docs = spark.range(200 * 8 + 400).selectExpr(
        "id as doc_id", "if(id < 1600, concat('s', id % 200), 'large') as source")
    rows = sorted(M.mixed(docs, block_rows=1).collect(), key=lambda r: r["mix"]["position"])
    assert [r["mix"]["position"] for r in rows] == list(range(2000))
    assert len({r["mix"]["cls"] for r in rows}) == 201
    total = 200 * 8**0.5 + 400**0.5
    done = {}
    for t, r in enumerate(rows[:1500], 1):
        done[r["source"]] = done.get(r["source"], 0) + 1
        assert all(abs(d - (20 if s == "large" else 8**0.5) / total * t) < 1.001 for s, d in done.items())
    # given weights: those not named share the rest, each for itself
    rows = sorted(M.mixed(docs, {"large": 0.5}, block_rows=1).collect(), key=lambda r: r["mix"]["position"])
    done = {}
    for t, r in enumerate(rows[:700], 1):
        done[r["source"]] = done.get(r["source"], 0) + 1
        assert all(abs(d - (0.5 if s == "large" else 0.5 / 200) * t) < 1.001 for s, d in done.items())

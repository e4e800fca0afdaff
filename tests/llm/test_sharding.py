import random
import zlib

import pytest

from subledger.llm import sharding


def brute_capacity(sizes, shards):
    """Smallest capacity by trying every contiguous sum."""
    def fits(cap):
        n, at = 1, 0
        for s in sizes:
            if s > cap:
                return False
            if at + s > cap:
                n, at = n + 1, 0
            at += s
        return n <= shards

    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    return next(c for c in sums if fits(c))


@pytest.mark.parametrize("seed", range(12))
def test_capacity_is_minimal(seed):
    rng = random.Random(seed)
    groups = sorted((f"{rng.getrandbits(64):016x}", rng.choice([1, 5, 17, rng.randint(1, 90)]))
                    for _ in range(rng.randint(1, 60)))
    shards = rng.randint(1, 9)

    def cells_of(prefixes):
        keys = {""} if prefixes is None else set(prefixes)
        out = {}
        for digest, size in groups:
            if prefixes is None:
                p = digest[:1]
            else:
                mine = next((k for k in keys if digest.startswith(k)), None)
                if mine is None:
                    continue
                p = digest[: len(mine) + 1]
            b, n = out.get(p, (0, 0))
            out[p] = (b + size, n + 1)
        return [(p, b, n) for p, (b, n) in out.items()]

    cap, begins = sharding.plan_cuts(cells_of, shards)
    sizes = [s for _, s in groups]
    if shards > 1:
        assert cap == brute_capacity(sizes, shards)
    load = [0] * shards
    for digest, size in groups:
        load[sum(digest >= b for b in begins)] += size
    assert max(load) <= cap and sum(load) == sum(sizes)


def check(rows, docs, shards=40):
    assert len(rows) == docs.count()
    by_text = {}
    for r in rows:
        by_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    for k in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert slots == list(range(len(slots)))


def test_documents(docs):
    rows = sharding.op1_minimax_shards(docs).collect()
    check(rows, docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
    load = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(40)]
    assert max(load) <= max(max(r["size"] for r in rows), 2 * sum(load) // 40)


def test_hot_group_stays_whole_and_alone(spark):
    rows = [(i, "hot " * 50) for i in range(400)] + [(1000 + i, f"text number {i} " * 3) for i in range(800)]
    got = sharding.op1_minimax_shards(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    hot = {r["shard"] for r in got if r["doc_id"] < 400}
    assert len(hot) == 1 and not any(r["shard"] in hot for r in got if r["doc_id"] >= 1000)
    others = [sum(r["size"] for r in got if r["shard"] == k) for k in range(4) if k not in hot]
    assert max(others) - min(others) <= 200


def test_odd_and_empty(odd_docs, no_docs):
    rows = sharding.op1_minimax_shards(odd_docs).collect()
    check(rows, odd_docs)
    assert {r["size"] for r in rows if r["text_crc32"] is None} == {16}
    assert sharding.op1_minimax_shards(no_docs).count() == 0

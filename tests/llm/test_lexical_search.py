import math
import re
from collections import Counter

import pytest

from subledger.llm import lexical_search as S

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in dict.fromkeys(items):
        scored = []
        for doc_id, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if b[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def search(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, S.op13_bag_search(d, b, **kw).collect()), key=str)


DOCS = [(i, f"alpha beta {'gamma ' * (i % 4)} Ünï w{i % 7} {'x' * (i % 3)}") for i in range(60)]
DOCS += [(100 - i, "Alpha, beta! ALPHA") for i in range(30)] + [(7, "other row of seven"), (7, "other row of seven")]
DOCS += [(200, None), (201, ""), (202, "!?"), (None, "alpha beta"), (203, "Ü ü É"), (204, "a\x00alpha\x7fb")]
ITEMS = [(1, "alpha gamma"), (2, "ünï Alpha alpha w3"), (3, None), (4, "..."), (5, "unseen words"), (1, "other row"),
         (1, "other row"), (None, "w1 w2 xx"), (6, "ü é")]


def test_equals_brute_force(spark):
    assert search(spark, DOCS, ITEMS) == brute(DOCS, [i for i in ITEMS if i[1] is not None])


@pytest.mark.parametrize("rows,tile", [(1, 1), (7, 2)])
def test_small_steps_change_nothing(spark, rows, tile):
    import pyarrow as pa

    whole = list(S.score_classes(*_scoring()))
    old = S.CLASS_ROWS, S.ITEM_ROWS
    try:
        S.CLASS_ROWS, S.ITEM_ROWS = rows, tile
        parted = list(S.score_classes(*_scoring()))
    finally:
        S.CLASS_ROWS, S.ITEM_ROWS = old
    assert pa.Table.from_batches(whole).to_pylist() == pa.Table.from_batches(parted).to_pylist() != []


def _scoring():
    import numpy as np
    import pyarrow as pa

    n = 40
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([75 + i % 3 for i in range(n)]), pa.array([(i * 7) % n for i in range(n)]),
         pa.array([[i % 4, 4 + i % 2] for i in range(n)], pa.list_(pa.int32())),
         pa.array([[1 + i % 2, 2] for i in range(n)], pa.list_(pa.int32()))],
        names=["class_id", "m", "first_doc", "ids", "tfs"])

    class Shared:
        value = [[(0, 1), (5, 2)], [(1, 1)], [(3, 1), (4, 1)]], np.array([100, 200, 0, 50, 10, 70])

    return [rows], Shared, 5


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 20)
    assert search(spark, DOCS, ITEMS) == brute(DOCS, [i for i in ITEMS if i[1] is not None])


def test_k_below_the_members_of_a_class(spark):
    assert search(spark, DOCS, [(1, "alpha")], k=3) == brute(DOCS, [(1, "alpha")], k=3)


def test_hash_matches_are_verified():
    words = S.Vocabulary([b"aa", b"bb", b"ccc"])
    words.flat = words.flat.copy()
    words.flat[words.starts[words.terms.index(b"bb")]] = ord("x")  # as if another term had this hash
    buf = S.Buffer([b"aa bb ccc dd"])
    found = words.find(buf, *buf.spans(S.term_table())[:2])
    assert [words.terms[i] if i >= 0 else None for i in found] == [b"aa", None, b"ccc", None]


def test_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "same text tail"), (2, "w1x1 w2x2 one")], "item_id long, text string")
    from pyspark.sql import functions as F

    odd = odd_docs.withColumns({c: F.lit(1) for c in ("ids", "tfs", "m", "h", "class_id", "item", "seat")})
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, S.op13_bag_search(odd, items).collect()), key=str)
    assert got == brute(rows, [(1, "same text tail"), (2, "w1x1 w2x2 one")])
    assert S.op13_bag_search(no_docs, items).collect() == []
    assert S.op13_bag_search(odd_docs, items.limit(0)).collect() == []
    assert S.op13_bag_search(odd_docs.where("text is null"), items).collect() == []

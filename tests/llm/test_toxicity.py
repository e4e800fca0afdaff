import zlib

import numpy as np
from pyspark.sql import functions as F

from subledger.llm import toxicity as T

from .conftest import SF_MID


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in T.op3_weak_supervision(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    told = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in told]) >= 0.9  # the table has ten toxic rows that are not English to learn from
    assert sum(b for a, b in told if a == 0) <= 0.02 * len(told)


def test_scores_ignore_everything_but_text(spark, docs, labels):
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a, b = (sorted(map(tuple, T.op3_weak_supervision(d, labels).collect())) for d in (docs, other))
    assert a == b


def test_label_model_discounts_repeated_voters():
    rng = np.random.default_rng(0)
    y = (rng.random(4000) < 0.2).astype(float)
    a = ((y == 1) & (rng.random(4000) < 0.7) | (rng.random(4000) < 0.02)).astype(int)
    b = ((y == 1) & (rng.random(4000) < 0.5) | (rng.random(4000) < 0.02)).astype(int)
    votes = np.stack([a, a, a, b, 1 - np.maximum(a, b)], axis=1)
    m = T.LabelModel(votes, y)
    assert (m.weight[:3] < 0.5).all() and m.weight[3] > 0.6
    assert m.accuracy[0] > 0.8 and m.accuracy[3] > 0.7


def test_odd_and_empty(odd_docs, odd_labels, no_docs, labels):
    got = T.op3_weak_supervision(odd_docs, odd_labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert T.op3_weak_supervision(no_docs, labels).count() == 0
    kept = T.keep_clean(odd_docs, odd_labels)
    assert kept.columns == odd_docs.columns
    assert T.op3_weak_supervision(odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_labelled_sample_bounds_rows(spark):
    """Not only doc_ids: one that stands 500 times with different texts, and equal rows of another."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(5, "same")] * 50 + [(3, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (5, 0), (3, 0)], "doc_id long, toxic int")
    known = [r[0] for r in labels.select("doc_id").where(~T.held_out(labels["doc_id"], 4, 2)).collect()]
    assert len(known) >= 2
    for size in (2, 10):
        texts, y = T.labelled_sample(docs, labels, "toxic", (4, 2), size)
        assert len(texts) == len(y) <= size and len(set(texts)) == len(texts)
    texts, _ = T.labelled_sample(docs, labels, "toxic", (4, 2), 10_000)
    assert len(texts) == sum({1: 500, 5: 1, 3: 1}[i] for i in known)

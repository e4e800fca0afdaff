import corpus_pipeline as pipeline
from subledger.llm import mixing, packing, toxicity

from .conftest import SF
from .test_host_quality import blocked_hosts, soft_failures
from .test_host_quality import brute as quality_brute
from .test_near_dedup import brute_components
from .test_packing import check


def test_run_against_brute_force(spark, docs, labels):
    linear = toxicity.toxicity_model(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(texts)
    score = dict(zip(ids, toxicity.score_texts([texts[i] for i in ids], linear)))
    left = {i: texts[i] for i in ids if score[i] < toxicity.CUT}
    host = {r["doc_id"]: r["source"] for r in docs.collect()}
    blocked = blocked_hosts([(host[i], t) for i, t in left.items()])
    left = {i: t for i, t in left.items()
            if not quality_brute(t)[-1] and not (host[i] in blocked and soft_failures(t)[1])}
    groups = brute_components(left, 5, 80)
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    rows = pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(left)
    check(rows, left, packing.Encoder(packing.default_tokenizer()))


def test_stages_keep_the_columns(spark, odd_docs, docs):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality_rules", "near_dedup", "mixing", "packing"]
    clashing = odd_docs
    for name, stage in pipeline.STAGES[:-1]:
        for table in (clashing, docs.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns == table.columns, name
            assert out.count() <= table.count()


def test_the_mix_reaches_the_sequences(spark, docs, tmp_path):
    """Stored in mixed order, the first sequences hold the sources in the target shares; without the mixing stage
    they follow the order given."""
    by_source = docs.orderBy("source", "doc_id").coalesce(1)
    by_source.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    pipeline.STAGES[3][1](spark, plain, SF).write.parquet(str(tmp_path / "mixed"))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    n = len(set(source.values()))

    def first_quarter(folder):
        rows = pipeline.STAGES[4][1](spark, spark.read.parquet(str(tmp_path / folder)), SF).collect()
        first = {}
        for r in rows:
            first.setdefault(r["sequence_id"], []).append(r["doc_id"])
        order = [d for s in sorted(first) for d in first[s]]
        head = order[: len(order) // 4]
        return len({source[d] for d in head}), max(sum(source[d] == s for d in head) for s in set(source.values())) / len(head)

    kinds, most = first_quarter("mixed")
    assert kinds >= 0.9 * n and most < 4 / n
    assert first_quarter("plain") != (kinds, most)


def test_sequence_ids_follow_the_places(spark, docs, tmp_path):
    pipeline.STAGES[3][1](spark, docs, SF).write.parquet(str(tmp_path / "mixed"))
    placed, n = mixing.stored_order(spark.read.parquet(str(tmp_path / "mixed")))
    place = {r["doc_id"]: r["__place"] for r in placed.select("doc_id", "__place").collect()}
    rows = packing.pack_in_order(spark.read.parquet(str(tmp_path / "mixed"))).collect()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, packing.Encoder(packing.default_tokenizer()))
    first = {}
    for r in rows:
        key = (place[r["doc_id"]], r["piece"])
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], key), key)
    order = [first[s] for s in sorted(first)]
    assert order == sorted(order) and n == len(place)

import re
from itertools import combinations

import numpy as np
import pytest

from subledger.llm import near_dedup as N
from subledger.llm.textops import LOWER, shingle_sets


def brute_sets(texts, width):
    out = {}
    for i, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        out[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else (
            frozenset([tuple(w)]) if w else frozenset())
    return out


def brute_components(texts, width, percent):
    sets, parent = brute_sets(texts, width), {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in texts}


def check(df, width=4, percent=80):
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    got = N.near_duplicates(df, width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts, width, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_documents(docs):
    check(docs.select("doc_id", "text"))
    check(docs.select("doc_id", "text"), width=5)


def test_chains_and_mid_similarities(spark):
    """A drifting chain (only neighbours are similar), a star whose members are far from each other, and a family
    that shares half its text without a link."""
    rng = np.random.default_rng(2)
    word = lambda: "w%05d" % rng.integers(0, 90_000)
    rows, base = [], [word() for _ in range(120)]
    for i in range(25):
        rows.append((i, " ".join(base)))
        at = int(rng.integers(0, 110))
        base = base[:at] + [word() for _ in range(2)] + base[at + 2 :]
    centre = [word() for _ in range(100)]
    rows.append((1000, " ".join(centre)))
    for i in range(40):
        w = list(centre)
        w[int(rng.integers(0, 97))] = word()
        w[int(rng.integers(0, 97))] = word()
        rows.append((100 + i, " ".join(w)))
    half = [word() for _ in range(60)]
    rows += [(2000 + i, " ".join(half + [word() for _ in range(30)])) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2**63, 200, dtype=np.uint64)
            k = int(200 * (1 - share) / (1 + share))
            a = np.unique(np.concatenate([both[k:], rng.integers(0, 2**63, k, dtype=np.uint64)]))
            b = np.unique(both)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = N.superminhash([a, b], 252)
            errors.append((s[0] == s[1]).mean() - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_signatures_hold_every_position_once_per_step():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 1, dtype=np.uint64)
    s = N.superminhash([one], 64)[0]
    assert sorted(np.floor(s).astype(int)) == list(range(64))  # one element: each position in its own step


def test_shingles_match_words():
    texts = ["a b c", "", "A  b\tC d\ne", "x", "ü ö ä ß é"]
    want = brute_sets(dict(enumerate(texts)), 4)
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 4)] == [len(want[i]) for i in range(5)]


@pytest.mark.parametrize("run", ["near", "first"])
def test_odd_and_empty(run, odd_docs, no_docs):
    if run == "near":
        got = N.op7_superminhash(odd_docs).collect()
        assert len(got) == odd_docs.count()
        by = {}
        for r in got:
            by.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
        assert by[1] == {(0, 1, True)} and by[2] == {(0, 2, True)} and by[3] == {(0, 3, True)}
        assert by[4] == {(1, 4, True)} and by[6] == {(2, 5, False)}
        assert {c for _, c, _ in by[8]} == {7}
        assert N.op7_superminhash(no_docs).count() == 0
    else:
        kept = N.keep_first(odd_docs)
        assert kept.columns == odd_docs.columns
        ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
        assert ids == [1, 2, 3, 4, 5, 7, 9, 10, 11, 12, None, None]
        assert N.keep_first(no_docs).count() == 0


def test_large_buckets_are_settled_by_blocks(spark, monkeypatch):
    """Every pair shares a passage and many share bands; a few are links that no hub finds."""
    monkeypatch.setattr(N, "BLOCK", 5)
    rng = np.random.default_rng(7)
    word = lambda: "w%05d" % rng.integers(0, 90_000)
    half = [word() for _ in range(70)]
    rows = []
    for i in range(60):
        own = half + [word() for _ in range(25)]
        rows.append((10 * i, " ".join(own)))
        if i % 3 == 0:
            rows.append((10 * i + 1, " ".join(own[:-2] + [word()])))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("block", [2000, 40])
def test_leftover_pairs_are_told_whatever_bytes_agree(spark, monkeypatch, block):
    """Pairs at 0.8 and above whose signature bytes agree by chance in bands of different hashes: against all pairs
    that share a band (two, in a bucket of more than a block)."""
    monkeypatch.setattr(N, "BLOCK", block)
    rng = np.random.default_rng(11)
    pairs, width = 300, N.BANDS * N.ROWS
    first = rng.integers(0, 2**63, (pairs, N.LENGTH), dtype=np.uint64)
    second = np.where(rng.random(first.shape) < 0.85, first, rng.integers(0, 2**63, first.shape, dtype=np.uint64))
    values = np.concatenate([first, second])
    hashes = N.band_hashes(values.view(np.float64), N.BANDS, N.ROWS)
    # every value that differs agrees in its byte, as one in 256 does by chance; all share one crowded bucket
    short = (first >> np.uint64(56)).astype(np.uint8)
    hashes[:, 5] = 77
    rows, want = [], set()
    for i in range(pairs):
        for k, row in ((2 * i, i), (2 * i + 1, pairs + i)):
            rows.append((k, 100, short[i].tobytes(), hashes[row].tolist()))
        want.add((2 * i, 2 * i + 1))
        assert (hashes[i] == hashes[pairs + i]).sum() >= 2 and width == hashes.shape[1] * N.ROWS
    classes = spark.createDataFrame(rows, "id long, n long, sig binary, bands array<long>")
    keyed = classes.selectExpr("id", "n", "posexplode(bands) as (band, bucket)", "id as component")
    got = {(r["a"], r["b"]) for r in N.rest_pairs(keyed, classes, 80).collect()}
    assert want <= got


@pytest.mark.parametrize("block", [2000, 20])
def test_one_shared_band_is_enough_in_a_bucket_of_any_size(spark, monkeypatch, block):
    """Pairs at 0.8 that share one band only, all in one crowded bucket."""
    monkeypatch.setattr(N, "BLOCK", block)
    rng = np.random.default_rng(21)
    pairs, used = 100, N.BANDS * N.ROWS
    first = rng.integers(0, 2**63, (pairs, N.LENGTH), dtype=np.uint64)
    differs = rng.random(first.shape) >= 0.8
    differs[:, :used:N.ROWS] = True                  # every band differs, but for the crowded one
    second = np.where(differs, rng.integers(0, 2**63, first.shape, dtype=np.uint64), first)
    values = np.concatenate([first, second])
    hashes = N.band_hashes(values.view(np.float64), N.BANDS, N.ROWS)
    hashes[:, 5] = 77
    short = (N.mix(values) >> np.uint64(56)).astype(np.uint8)
    rows = [(2 * (k % pairs) + k // pairs, 100, short[k].tobytes(), hashes[k].tolist()) for k in range(2 * pairs)]
    assert ((hashes[:pairs] == hashes[pairs:]).sum(axis=1) == 1).all()
    classes = spark.createDataFrame(rows, "id long, n long, sig binary, bands array<long>")
    keyed = classes.selectExpr("id", "n", "posexplode(bands) as (band, bucket)", "id as component")
    got = [(r["a"], r["b"]) for r in N.rest_pairs(keyed, classes, 60).collect()]
    assert sorted(got) == [(2 * i, 2 * i + 1) for i in range(pairs)]


def test_keep_first_links_rows_that_share_an_id_by_their_texts(spark):
    """Different clean texts under one doc_id all stay; a copy under a reused id goes alone."""
    def text(seed):
        return " ".join(f"w{seed}x{i}" for i in range(40))

    rows = [(7, text(1), "a"), (7, text(2), "b"), (8, text(3), "c"), (9, text(2) + " tail", "d"), (9, text(4), "e"),
            (10, text(4), "f"), (5, text(5), "g"), (11, text(5), "h"), (11, text(6), "i"), (11, text(6), "j"),
            (12, "", "k"), (12, None, "l"), (None, text(1), "m"), (None, text(1), "n")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows],
                               "doc_id long, text string, name string, gone string, id int")
    got = N.keep_first(df)
    assert got.columns == df.columns
    kept = {r["name"] for r in got.collect()}
    assert kept - {"i", "j"} == set("abceg") | set("klmn")  # d is b again, f is e, h is g
    assert len(kept & {"i", "j"}) == 1

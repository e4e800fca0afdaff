import zlib

import numpy as np
import pytest

from subledger.llm import language_id as L

from .conftest import SF_MID


def brute_grams(text: bytes) -> set:
    """Distinct places of a text's 1- to 4-grams, one gram after another."""
    letters = " "
    for c in text.decode("latin-1"):
        c = chr(L._FOLD[ord(c)])
        if c != " " or letters[-1] != " ":
            letters += c
    letters += "" if letters[-1] == " " else " "
    raw = letters.encode("latin-1")
    out = set()
    for n in range(1, 5):
        for i in range(len(raw) - n + 1):
            code = np.array([int.from_bytes(raw[i : i + n], "big")], np.uint32)
            out.add(int(L._places(code, n)[0]))
    return out - {32}


TEXTS = [b"", b"a", b"  Hello, WORLD 12 ", "ñandú über".encode(), b"xy" * 300, b"\x00zero \x00", b"...", b"end"]


def test_presence_equals_brute_force():
    got = L.presence(TEXTS)
    assert [set(np.flatnonzero(g).tolist()) for g in got] == [brute_grams(t) for t in TEXTS]


def test_presence_of_long_texts_does_not_depend_on_windows(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (5000, 1, 0, 3000)]
    whole = L.presence(texts)
    monkeypatch.setattr(L, "WINDOW", 97)
    assert (L.presence(texts) == whole).all()


def test_scores_equal_a_plain_kernel_ridge():
    """The Nystroem map with every row as a landmark is kernel ridge regression on the full kernel."""
    rng = np.random.default_rng(1)
    words = {"x": ["alpha", "beta", "gamma", "delta"], "y": ["uno", "dos", "tres", "quatro"]}
    rows = []
    for i in range(24):
        lang = "xy"[i % 2]
        text = " ".join(rng.choice(words[lang], 5)).encode()
        rows.append((lang, np.packbits(L.presence([text])[0]).tobytes()))
    model = L.Model(rows, n_landmarks=24, ridge=0.05)
    grams = [set(np.flatnonzero(L.Model._unpack(b)).tolist()) for _, b in rows]
    k = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    y = np.array([[float(lang == its) for its in model.langs] for lang, _ in rows])
    middle = np.eye(24) - 1 / 24
    plain = middle @ k @ middle @ np.linalg.solve(middle @ k @ middle + 0.05 * 24 * np.eye(24), y - y.mean(0)) + y.mean(0)
    x = np.stack([L.Model._unpack(b) for _, b in rows])
    assert np.allclose(model.outputs(x), plain, atol=1e-6)


def test_held_out_accuracy_over_whole_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = {r["doc_id"]: r for r in L.op11_string_kernel(docs).collect()}
    truth = docs.select("doc_id", "lang").collect()
    assert len(rows) == len(truth)
    held = [r for r in truth if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in held} == {i for i, r in rows.items() if r["held_out"]}
    assert sum(rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_held_out_labels_are_never_read(spark, docs):
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id"), 4, 2), "wrong").otherwise(F.col("lang")))
    key = lambda df: sorted(map(tuple, L.op11_string_kernel(df).collect()))
    assert key(docs) == key(other)


def test_sample_is_bounded_and_spread_over_languages(spark):
    rows = [(i, f"text {i}", "aa") for i in range(300)] + [(1000 + i, f"other {i}", "bb") for i in range(5)]
    rows += [(2000, "text 1", "aa")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.labelled(docs, 20).collect()
    assert len(got) == 20 and len({(r["lang"], r["digest"]) for r in got}) == 20
    assert sum(r["lang"] == "bb" for r in got) >= 3  # those not held out


def test_odd_rows(spark, odd_docs):
    rows = L.op11_string_kernel(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 10))
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (4, 5, 6, 7, 9, 12))
    assert L.has_letter("日".encode()) and not L.has_letter("12 ① …".encode())


def test_nothing_to_learn_from(spark, docs, no_docs):
    from pyspark.sql import functions as F

    assert L.op11_string_kernel(no_docs).collect() == []
    rows = L.op11_string_kernel(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert rows and all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_places_of_each_length_are_apart(n):
    code = np.arange(256 if n == 1 else 60_000, dtype=np.uint32)
    low, high = [(0, 256), (256, 4352), (4352, 4352 + 8192), (4352 + 8192, L.PLACES)][n - 1]
    got = L._places(code, n)
    assert got.min() >= low and got.max() < high

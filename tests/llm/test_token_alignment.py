import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from subledger.llm import token_alignment as T

SPECIAL = ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "▁ x", "ﬁ ①", "日本 語", "a\x00b", "😀", "\x85 \xa0 x",
           "tab\there", "\n\n  lines \n", "   ", " ", "x" * 300, "é é", "' s 're ll 'LL don't"]


@pytest.fixture(scope="module")
def both():
    words = T.word_table(T.default_tokenizer(), T.default_pieces())
    return words.a_side, words.b_side


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    alphabet = ["a", "the", "tion", " ", "  ", "\n", "é", "ß", "1", "23", "!", "'s", "Ä", "日", "un", "Th", *SPECIAL]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def library_ids(text, both):
    a, b = both
    return a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)


def spans(ids, side):
    out, at = [], 0
    for i in ids:
        out.append((at, at := at + int(side.token_bytes.lengths[i])))
    return out


def brute(all_texts, both):
    """The contract, token pair by token pair."""
    found, count = [], Counter()
    for text in all_texts:
        row = None
        if text:
            a, b = library_ids(text, both)
            raw = (" " + text).encode()
            if all(s.token_bytes.join(np.array(x, np.int64)).tobytes() == raw for s, x in zip(both, (a, b))):
                sa, sb = spans(a, both[0]), spans(b, both[1])
                link = [(x, y) for x, p in zip(a, sa) for y, q in zip(b, sb) if p[0] < q[1] and q[0] < p[1]]
                ends = sorted({e for _, e in sa} & {e for _, e in sb})
                groups = [(",".join(str(x) for x, p in zip(a, sa) if lo < p[1] <= hi)
                           + "|" + ",".join(str(y) for y, q in zip(b, sb) if lo < q[1] <= hi))
                          for lo, hi in zip([0, *ends], ends)]
                row = len(a), len(b), len(groups), link, hashlib.sha256(";".join(groups).encode()).hexdigest()
                count.update(set(link))
        found.append(row)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(count[p] == most[p[0]] for p in r[3]), sum(count[p] for p in r[3]), r[4])
            for r in found]


def got(df):
    return sorted((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"],
                   r["groups_sha256"]) for r in T.op12_token_alignment(df).collect())


def words_of(text):
    buf = T.Buffer([(" " + text).encode()], lower=False)
    begin = T.word_starts(buf).tolist()
    return [buf.bytes.tobytes()[b:e].decode() for b, e in zip(begin, [*begin[1:], int(buf.ends[0])])]


def test_ids_of_words_make_the_ids_of_texts(both, docs):
    blanks = [f"a{chr(c)} b {chr(c)}{chr(c)}  c" for c in (9, 0x1C, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x3000)]
    some = [t for t in texts(5, 3000) if t] + [r["text"] for r in docs.collect()] + blanks
    some = [t for t in some if T.BLANK_PIECE not in t]  # texts with this sign have no tokens
    for side, which in zip(both, (0, 1)):
        for t in some:
            assert [int(i) for w in side.encode(words_of(t)) for i in w] == library_ids(t, both)[which], t


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, both, seed, monkeypatch):
    some = [None, "", *SPECIAL, *texts(seed, 150)]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(3)
    assert got(df) == [(i, *r) for i, r in enumerate(brute(some, both))]


def test_small_chunks_and_parts_change_nothing(both):
    """Parts of 40 characters, one run per part and a chunk per few documents give the rows of whole texts."""
    import pyarrow as pa

    some = [t for t in texts(7, 60)] + ["one two three " * 50, "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some, pa.string())], names=["d", "t"])
    paths = T.default_tokenizer(), T.default_pieces()

    def rows():
        out, chunks = {}, []
        for c in T.align([batch], *paths):
            chunk = c.to_pylist()
            pairs, docs_of = chunk[-1]["pairs"], chunk[-1]["pair_docs"]
            seen = Counter()
            for r in chunk[:-1]:
                at, times = T._widen(r["places"], r["entries"]), T._widen(r["times"], r["entries"])
                seen.update(at.tolist())
                out[r["doc_id"]] = (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"],
                                    sorted(zip([pairs[k] for k in at], times.tolist())))
            assert [seen[k] for k in range(len(pairs))] == docs_of
            chunks.append(len(chunk))
        return out, len(chunks)

    whole, one = rows()
    old = T.RUN_CHARS, T.CHUNK_LINKS, T.parts_of.__defaults__
    try:
        T.RUN_CHARS, T.CHUNK_LINKS, T.parts_of.__defaults__ = 40, 200, (40,)
        parted, many = rows()
    finally:
        T.RUN_CHARS, T.CHUNK_LINKS, T.parts_of.__defaults__ = old
    assert one == 1 and many > 5 and parted == whole


def test_links_of_a_mixed_group():
    ends_a, ends_b = np.array([2, 5, 9, 10]), np.array([3, 4, 9, 10])
    cut_a, cut_b = T.common_cuts(ends_a, ends_b, [4], [4])
    assert (cut_a.tolist(), cut_b.tolist()) == ([3, 4], [3, 4])
    a, b = T.links(cut_a, cut_b, ends_a, ends_b)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 2), (3, 3)]


def test_odd_rows(spark, odd_docs, no_docs, both):
    rows = T.op12_token_alignment(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    zero = [r for r in rows if r["doc_id"] in (1, 2, 10)]
    assert len(zero) == 3 and all(r["n_a"] == r["n_links"] == r["count_sum"] == 0 and r["groups_sha256"] == "" for r in zero)
    long = next(r for r in rows if r["doc_id"] == 8)
    assert long["n_links"] == long["n_a"] + long["n_b"] - long["n_groups"] > 100_000
    assert T.op12_token_alignment(no_docs).collect() == []

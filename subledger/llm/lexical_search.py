"""Operator 13, ranked lexical search with bag deduplication.

1. The items' terms form the vocabulary. Documents are read once: each keeps its number of terms and, of its bag
   of terms, only the vocabulary's part (term numbers and frequencies). Matches of a term's hash are verified on
   the bytes.
2. N, L and df come from these rows. Documents whose restricted bag and length factor m are the same score the same
   for every item, so they form one class: rows are grouped by a hash together with the bag and m themselves,
   which verifies the hash. A class of a third of all rows is one row per task before the shuffle.
3. Each task scores its classes once against all items, term by term through the batch's postings, in 64-bit
   integers, and keeps the best ``k`` per item by (score, smallest doc_id). The k best of all tasks follow: the k
   best documents lie in the k best classes in this order, as each class before them brings a better document.
4. Only the winners' members are read again, ``k`` of each class by ascending doc_id, and ranked.

Items are the query set: their terms go to every executor in blocks of about BLOCK_BYTES of item text (one block
unless the benchmark is larger), and the steps above run per block. Documents are never sent as texts."""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored
from .textops import Buffer, pieces

TOP = 20
BLOCK_BYTES = 16_000_000
CLASS_ROWS, ITEM_ROWS = 4096, 256  # of a scoring step
RESULT = "item_id long, rank int, doc_id long, score long"
BAGS = "doc_id long, n long, ids array<int>, tfs array<int>"


def term_table() -> np.ndarray:
    """Bytes of terms: digits, ASCII letters and every byte of a non-ASCII character."""
    t = np.zeros(256, bool)
    t[48:58] = t[65:91] = t[97:123] = t[128:] = True
    return t


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text in order, only A-Z lower-cased (NULL: none)."""
    buf = Buffer([(text or "").encode("utf-8", "surrogatepass")])
    begin, end, _ = buf.spans(term_table())
    raw = buf.bytes.tobytes()
    return [raw[b:e] for b, e in zip(begin.tolist(), end.tolist())]


class Vocabulary:
    """Sorted term hashes with the terms' bytes, for exact look-ups of spans of a :class:`Buffer`."""

    def __init__(self, terms: list[bytes]):
        hashes = np.array([_hash(t) for t in terms], np.uint64)
        order = np.argsort(hashes)
        self.terms = [terms[i] for i in order.tolist()]
        self.hashes = hashes[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items share a 64-bit hash")
        self.lengths = np.array([len(t) for t in self.terms], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.terms), np.uint8)

    def find(self, buf: Buffer, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The term number of each span, -1 for spans outside the vocabulary."""
        if not len(self.hashes) or not len(begin):
            return np.full(len(begin), -1, np.int64)
        h = buf.hashes(begin, end)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[at] == h) & (self.lengths[at] == end - begin))
        number = at[hit]
        width = self.lengths[number]
        step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        same = buf.bytes[np.repeat(begin[hit], width) + step] == self.flat[np.repeat(self.starts[number], width) + step]
        out = np.full(len(begin), -1, np.int64)
        if len(hit):
            ok = np.logical_and.reduceat(same, np.cumsum(width) - width)
            out[hit[ok]] = number[ok]
        return out


def _hash(term: bytes) -> int:
    buf = Buffer([term])
    return int(buf.hashes(np.array([0]), np.array([len(term)]))[0])


def bags(batches, vocabulary):
    """doc_id, n, ids, tfs of every row of Arrow batches (doc_id, text); ids ascend."""
    words, table = vocabulary.value, term_table()
    size = max(1, len(words.terms))
    for batch in batches:
        doc_id, texts = batch.column(0), batch.column(1)
        for first, run in pieces(texts):
            buf = Buffer(run)
            begin, end, text = buf.spans(table)
            number = words.find(buf, begin, end)
            n = np.bincount(text, minlength=len(run))
            known = number >= 0
            key, tf = np.unique(text[known] * size + number[known], return_counts=True)
            offsets = np.searchsorted(key, np.arange(len(run) + 1) * size).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32)))
                     for x in (key % size, tf)]
            yield pa.RecordBatch.from_arrays([doc_id.slice(first, len(run)), pa.array(n.astype(np.int64)), *lists],
                                             names=["doc_id", "n", "ids", "tfs"])


class _Best:
    """The best ``k`` (score, first_doc, class_id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows = [np.zeros((3, 0), np.int64) for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below this cannot enter

    def add(self, item: int, scores: np.ndarray, first_doc: np.ndarray, class_id: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least[item])
        if len(at) > self.k:
            at = at[scores[at] >= np.partition(scores[at], len(at) - self.k)[len(at) - self.k]]
        if not len(at):
            return
        both = np.concatenate([self.rows[item], np.stack([scores[at], first_doc[at], class_id[at]])], axis=1)
        both = both[:, np.lexsort((both[2], both[1], -both[0]))[: self.k]]
        self.rows[item] = both
        if both.shape[1] == self.k:
            self.least[item] = both[0, -1]


def score_classes(batches, queries, k: int):
    """The best ``k`` classes per item of this task as rows (item, score, first_doc, class_id)."""
    items, weights = queries.value  # per item [(term number, count)], weight of each term
    best = _Best(len(items), k)
    for batch in batches:
        for at in range(0, batch.num_rows, CLASS_ROWS):
            part = batch.slice(at, CLASS_ROWS)
            class_id, m = part.column("class_id").to_numpy(), part.column("m").to_numpy()
            first_doc = part.column("first_doc").fill_null(np.iinfo(np.int64).max).to_numpy()
            ids, tf = part.column("ids"), part.column("tfs").flatten().to_numpy().astype(np.int64)
            sizes = ids.value_lengths().to_numpy()
            row = np.repeat(np.arange(part.num_rows), sizes)
            term = ids.flatten().to_numpy()
            order = np.argsort(term, kind="stable")
            term, row, tf = term[order], row[order], tf[order]
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
            bounds = np.searchsorted(term, np.arange(len(weights) + 1)).tolist()
            for tile in range(0, len(items), ITEM_ROWS):
                some = items[tile : tile + ITEM_ROWS]
                scores = np.zeros((len(some), part.num_rows), np.int64)
                for mine, terms in zip(scores, some):
                    for t, count in terms:
                        b, e = bounds[t], bounds[t + 1]
                        if b < e:
                            mine[row[b:e]] += gain[b:e] * count  # a class stands once in a term's postings
                for j, mine in enumerate(scores):
                    best.add(tile + j, mine, first_doc, class_id)
    for j, found in enumerate(best.rows):
        if found.shape[1]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(found.shape[1], j, np.int32)), *(pa.array(x) for x in found)],
                names=["item", "score", "first_doc", "class_id"])


def search(docs: DataFrame, items: list[tuple[int | None, str]], k: int) -> DataFrame:
    """RESULT rows for the given items (one block) over all ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    bag = [Counter(terms_of(text)) for _, text in items]
    words = Vocabulary(sorted(set().union(*bag)))
    number = {t: i for i, t in enumerate(words.terms)}
    shared = spark.sparkContext.broadcast(words)
    rows = stored(docs.mapInArrow(lambda batches: bags(batches, shared), BAGS), "bags")
    total = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.sum("n").alias("L")).first()
    if not total["N"]:
        return spark.createDataFrame([], RESULT)
    # at most one row per vocabulary term
    df = {r["t"]: r["df"] for r in rows.select(F.explode("ids").alias("t")).groupBy("t")
          .agg(F.count("*").alias("df")).collect()}
    n_docs = total["N"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))
                        for t in range(len(words.terms))], np.int64)
    queries = spark.sparkContext.broadcast(([[(number[t], c) for t, c in b.items()] for b in bag], weights))

    m = F.expr(f"75L + (25L * n * {n_docs}L) div {total['L']}L").alias("m")
    marked = rows.where(F.size("ids") > 0).select("doc_id", "ids", "tfs", m).withColumn(
        "h", F.xxhash64("ids", "tfs", "m"))
    same = ["h", "m", "ids", "tfs"]
    classes = stored(marked.groupBy(*same).agg(F.min("doc_id").alias("first_doc")).withColumn(
        "class_id", F.monotonically_increasing_id()), "classes")  # written once, so the numbers stay
    found = classes.select("class_id", "m", "first_doc", "ids", "tfs").mapInArrow(
        lambda batches: score_classes(batches, queries, k),
        "item int, score long, first_doc long, class_id long")
    by_item = Window.partitionBy("item").orderBy(F.desc("score"), "first_doc", "class_id")
    winners = stored(found.withColumn("place", F.row_number().over(by_item)).where(F.col("place") <= k)
                     .select("item", "score", "class_id"), "winners")
    # at most k * items class numbers, and as many hashes: broadcast
    won = F.broadcast(winners.select("class_id").distinct())
    known = classes.join(won, "class_id", "left_semi")
    # k members of a class leave each task, so a class of a third of all rows stays small in the join
    in_class = Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id"))
    members = (marked.join(F.broadcast(known.select("h").distinct()), "h", "left_semi")
               .withColumn("seat", F.row_number().over(in_class)).where(F.col("seat") <= k)
               .join(known.select("class_id", *same), same).select("class_id", "doc_id"))
    names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(items)], "item int, item_id long")
    ranked = winners.join(members, "class_id").withColumn("rank", F.row_number().over(
        Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))
    out = stored(ranked.where(F.col("rank") <= k).join(F.broadcast(names), "item")
                 .select("item_id", "rank", "doc_id", "score"), "ranked")
    for table in (rows, classes, winners):
        discard(table)
    return out


def op13_bag_search(docs: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents.

    A NULL or empty text has no terms: such a document counts nowhere and such an item returns nothing. Each row
    of ``docs`` is a document, also where rows or doc_ids repeat (a NULL doc_id ranks last among equals). Items
    are the distinct (item_id, text) rows. Other columns are ignored. Empty tables give an empty result."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES)
    found = []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        if block:
            found.append(search(docs, [(r["item_id"], r["text"]) for r in block], k))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], RESULT)


ORACLE = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), total as (
  select count(*) filter (len(terms) > 0) as n_docs, sum(len(terms)) as all_terms from d
), i as (
  select row_number() over () as q, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from (select distinct item_id, text from benchmark where text is not null)
), it as (
  select q, item_id, term, count(*) as c from (select q, item_id, unnest(terms) as term from i) group by all
), tf as (
  select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(terms) as n, unnest(terms) as term from d)
  where term in (select term from it) group by all
), w as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from tf, total group by term, n_docs
), gain as (
  select r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * n_docs) // all_terms)))) as g
  from tf join w using (term), total
), scored as (
  select q, item_id, r, doc_id, cast(sum(c * g) as bigint) as score
  from it join gain using (term) group by q, item_id, r, doc_id having sum(c * g) > 0
), ranked as (
  select *, row_number() over (partition by q order by score desc, doc_id nulls last, r) as rank from scored
)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 20
"""

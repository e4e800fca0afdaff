"""Operator 3, toxicity by weak supervision.

1. Voters. Lexicon voters: a general list of insults, and word stems that the labelled rows (held-out rows
   excepted) tie to the toxic label, one voter per stem. Pattern voters: an insult near a second person, shouted
   insults, insult density. One voter votes "clean" where no lexicon voter fires.
2. Label model. A generative model with a hidden class: each voter that fires is right with its own
   probability, estimated by EM over the votes. Correlations: for each pair of voters the correlation of their
   votes that the hidden class leaves unexplained; a voter's evidence is divided by one plus the sum of its
   positive correlations, so voters that repeat each other do not count twice.
3. End model. A logistic regression on hashed words and word stems, trained on the posterior labels, scores
   every text. Labels are seen by the stem search and as the accuracies' starting point; scores use the text
   alone.

The models are fitted on at most ``SAMPLE`` labelled rows (smallest hashes of their doc_id). Scoring is one
pass over all texts in Arrow batches, in pieces of bounded size."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .textops import Buffer, letter_table, pieces

SAMPLE = 6000                    # labelled rows that the models are fitted on
MINED = 120                      # stem voters at most
STEMS = (3, 4, 5, 6)             # bytes of word beginnings that are stems, besides whole words
BUCKETS = 1 << 20
CUT = 0.3
INSULTS = ("idiot idiots moron morons stupid dumb scum trash garbage loser losers clown clowns pathetic worthless "
           "disgusting filthy vermin imbecile cretin jerk bastard bitch whore slut asshole shit fuck fucking "
           "retard retarded subhuman parasite parasites pig pigs scumbag creep ugly").split()
_LETTERS = r"[a-z'\u0080-\U0010FFFF]+"


def _words(text: str) -> list[str]:
    return re.findall(_LETTERS, (text or "").lower())


def _stems(text: str) -> set[str]:
    """The distinct words of a text and their beginnings (``abc*``)."""
    words = set(_words(text))
    return words.union(w[:n] + "*" for w in words for n in STEMS if len(w) > n)


def mined_stems(texts: list[str], toxic: np.ndarray, most: int = MINED) -> list[str]:
    """Word stems (``abc*``) and whole words tied to the toxic label: in at least 3 toxic texts, with a
    smoothed precision of at least 0.8, strongest first; a stem whose texts a chosen one covers is left out."""
    bad = set(np.flatnonzero(toxic).tolist())
    often: Counter = Counter()
    for i in bad:
        often.update(_stems(texts[i]))
    often = {s for s, n in often.items() if n >= 3}  # no other stem can be chosen: only these are kept track of
    where: dict[str, set] = {}
    for i, t in enumerate(texts):
        for s in _stems(t) & often:
            where.setdefault(s, set()).add(i)
    scored = []
    for s, rows in where.items():
        hits = len(rows & bad)
        if hits >= 3 and (hits + 0.5) / (len(rows) + 1) >= 0.8:
            scored.append((-hits * (hits + 0.5) / (len(rows) + 1), s))
    out, covered = [], set()
    for _, s in sorted(scored):
        hits = where[s] & bad
        if len(hits - covered) * 4 >= len(hits):
            # the longest stem that loses next to none of the texts, as short ones also begin ordinary words
            longer = [t for t in where if t.startswith(s.rstrip("*")) and 33 * len(where[t] & hits) >= 32 * len(hits)]
            out.append(max(longer, key=lambda t: (len(t), t)))
            covered |= hits
        if len(out) == most:
            break
    return out


def votes(texts: list[str], stems: list[str]) -> np.ndarray:
    """0/1 matrix: lexicon voters (general list in eight groups, mined stems), pattern voters, the clean voter."""
    groups = [set(INSULTS[k::8]) for k in range(8)]
    whole = {s: i for i, s in enumerate(stems) if not s.endswith("*")}
    begins = {s[:-1]: i for i, s in enumerate(stems) if s.endswith("*")}
    insult = set(INSULTS) | set(whole)
    out = np.zeros((len(texts), len(groups) + len(stems) + 4), np.int8)
    for r, text in enumerate(texts):
        words = _words(text)
        seen = set(words)
        for k, g in enumerate(groups):
            out[r, k] = bool(seen & g)
        for w in seen:
            if w in whole:
                out[r, 8 + whole[w]] = 1
            for n in STEMS:
                if len(w) > n and w[:n] in begins:
                    out[r, 8 + begins[w[:n]]] = 1
        hits = [i for i, w in enumerate(words) if w in insult]
        at = 8 + len(stems)
        out[r, at] = any({"you", "your", "you're"} & set(words[max(0, i - 4) : i + 4]) for i in hits)
        out[r, at + 1] = any(w.isupper() and w.lower() in insult for w in re.findall(r"[A-Z]{3,}", text or ""))
        out[r, at + 2] = len(hits) * 200 >= max(1, len(words)) and len(hits) > 1
        out[r, at + 3] = not out[r, :at].any()
    return out


class LabelModel:
    """Voter accuracies and correlations under a hidden class.

    A voter that abstains says nothing; one that fires is right with its own probability. The accuracies are
    estimated by EM from the votes; each is tied, with the weight of ``TIE`` firings, to the share of its
    firings that the labelled rows confirm, so that voters of a rare language, which no other voter backs up,
    keep their say."""

    TIE = 20.0

    def __init__(self, v: np.ndarray, known: np.ndarray, rounds: int = 30):
        v = v.astype(float)
        self.sign = np.ones(v.shape[1])
        self.sign[-1] = -1.0                                   # the clean voter
        right = np.where(self.sign > 0, known @ v, (1 - known) @ v)
        fired = v.sum(axis=0)
        told = (right + 1.0) / (fired + 2.0)
        self.accuracy, self.weight = told, np.ones(v.shape[1])
        for _ in range(rounds):
            q = self.posterior(v)
            right = np.where(self.sign > 0, q @ v, (1 - q) @ v)
            self.accuracy = np.clip((right + self.TIE * told) / (fired + self.TIE), 0.02, 0.995)
            # what the hidden class leaves unexplained of each pair of voters
            q = self.posterior(v)
            on = (q @ v) / max(q.sum(), 1e-9)
            off = ((1 - q) @ v) / max((1 - q).sum(), 1e-9)
            rest = v - q[:, None] * on - (1 - q)[:, None] * off
            cov = rest.T @ rest / max(1, len(v))
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            self.correlation = cov / sd[:, None] / sd[None, :]
            np.fill_diagonal(self.correlation, 0.0)
            self.weight = 1.0 / (1.0 + np.where(self.correlation > 0.1, self.correlation, 0.0).sum(axis=1))

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of the toxic class given the votes."""
        z = v @ (self.sign * self.weight * np.log(self.accuracy / (1 - self.accuracy)))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def features(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of the distinct hashed words and stems of each text."""
    buf = Buffer(run)
    begin, end, text = buf.spans(letter_table())
    rows, keys = [text], [buf.hashes(begin, end)]
    for n in STEMS:
        longer = end - begin > n
        b = begin[longer]
        rows.append(text[longer])
        keys.append(buf.hashes(b, b + n) + np.uint64(n))
    packed = (np.concatenate(rows).astype(np.uint64) << np.uint64(20)) | (
        np.concatenate(keys) >> np.uint64(44))
    packed = np.unique(packed)
    return (packed >> np.uint64(20)).astype(np.int64), (packed & np.uint64(BUCKETS - 1)).astype(np.int64)


def train_linear(found: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 200):
    """Logistic regression on the buckets that the posterior labels make telling; (buckets, weights, bias).
    ``found`` are runs of (text index, bucket); only the telling ones of a run are laid together."""
    n = len(y)
    seen, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for rows, cols in found:
        seen += np.bincount(cols, minlength=BUCKETS)
        bad += np.bincount(cols, weights=y[rows], minlength=BUCKETS)
    base = y.mean()
    z = (bad - seen * base) / np.sqrt(np.maximum(seen * base * (1 - base), 1e-9))
    telling = np.flatnonzero((seen >= 3) & (z >= 4.0) & (bad >= 0.6 * seen))
    place = np.full(BUCKETS, -1)
    place[telling] = np.arange(len(telling))
    use = [place[cols] >= 0 for _, cols in found]
    r = np.concatenate([rows[u] for u, (rows, _) in zip(use, found)])
    c = np.concatenate([place[cols[u]] for u, (_, cols) in zip(use, found)])
    w, bias = np.zeros(len(telling)), math.log(max(base, 1e-3) / (1 - base))
    mw, mb, vw, vb = np.zeros_like(w), 0.0, np.zeros_like(w), 0.0
    for t in range(1, rounds + 1):  # Adam
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(r, weights=w[c], minlength=n), -30, 30)))
        g = (p - y) / n
        gw, gb = np.bincount(c, weights=g[r], minlength=len(w)) + 1e-5 * w, g.sum()
        mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
        vw, vb = 0.99 * vw + 0.01 * gw * gw, 0.99 * vb + 0.01 * gb * gb
        a = 0.1 * math.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= a * mw / (np.sqrt(vw) + 1e-8)
        bias -= a * mb / (math.sqrt(vb) + 1e-8)
    return telling, w, bias


def fit(texts: list[str], toxic: np.ndarray):
    """(stems, label model, (buckets, weights, bias)) from labelled texts."""
    stems = mined_stems(texts, toxic)
    v = votes(texts, stems)
    model = LabelModel(v, toxic)
    y = model.posterior(v)
    found = []
    for first, part in pieces(texts):
        r, c = features(part)
        found.append(((r + first).astype(np.int32), c.astype(np.int32)))
    return stems, model, train_linear(found, y)


def score_texts(texts, linear) -> np.ndarray:
    """Probability of toxic for each text of a list or Arrow column (NULL and empty: the bias alone)."""
    buckets, weights, bias = linear
    table = np.zeros(BUCKETS)
    table[buckets] = weights
    out = np.full(len(texts), bias)
    for first, part in pieces(texts):
        rows, cols = features(part)
        out[first : first + len(part)] += np.bincount(rows, weights=table[cols], minlength=len(part))
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, out_of: tuple[int, int], size: int):
    """(texts, labels) of at most ``size`` labelled rows that are not held out, each (doc_id, text) once; smallest
    hashes of doc_id first, then of text."""
    chosen = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
              .where(~held_out(F.col("doc_id"), *out_of))
              .groupBy("doc_id").agg(F.max(column).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `size` rows of chosen
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y"))
    if docs.select("doc_id").join(F.broadcast(chosen), "doc_id").count() > size:  # a doc_id stands more than once
        rows = rows.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(size)
    rows = sorted({(r["doc_id"], r["text"], int(r["y"])) for r in rows.collect()})
    return [text for _, text, _ in rows], np.array([y for _, _, y in rows], float)


def toxicity_model(docs: DataFrame, labels: DataFrame):
    texts, y = labelled_sample(docs, labels, "toxic", (4, 2), SAMPLE)
    if not len(y) or y.min() == y.max():  # nothing to learn stems from: the general lexicon alone
        texts = texts + INSULTS + ["the", "of", "and", "to"] * 40
        y = np.concatenate([np.zeros(len(y)), np.ones(len(INSULTS)), np.zeros(160)])
    return fit(texts, y)[2]


def scored(docs: DataFrame, linear) -> DataFrame:
    """(doc_id, score) of whole texts."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"],
                                              "score": pa.array(score_texts(batch["text"], linear))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def op3_weak_supervision(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract rows doc_id, held_out, score, predicted.

    NULL and empty texts get the bias alone. Repeated rows are scored each. Without labels (or with one class
    only) the general lexicon alone trains the model. An empty table gives an empty result."""
    return scored(docs, toxicity_model(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The rows and columns of ``docs`` whose texts score below the cut."""
    linear = toxicity_model(docs if training is None else training, labels)
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, linear))

    return docs.where(score(F.coalesce("text", F.lit(""))) < CUT)

"""Operator 9, quality: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in overlapping windows of WINDOW bytes that start every STRIDE bytes and cover
the whole text. Each byte has a learned embedding; each window also has LAGS self-match channels: how many of
its last bytes equal the byte that many places before (a filter over them sees repetition that no fixed byte
pattern shows). Learned filters run over each window, a rectifier follows, every filter keeps its largest
response over the text, and a learned combination of these gives one probability.

The network is trained with Adam on at most SAMPLE labelled rows that are not held out (smallest hashes of
their doc_id), with whole texts; the gradient of a maximum touches one window per filter and text. Whole texts
are read in stretches of at most PIECE bytes: a filter's largest response over a text is the largest of its
stretches, each of which sees the bytes before and after it that its windows and lags reach, so the result does not
depend on where a stretch ends and memory does not grow with a text beyond its own bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .textops import pieces
from .toxicity import labelled_sample

SAMPLE = 3000                # labelled rows the network is trained on
STRIDE, WINDOW, CHANNELS, FILTERS = 8, 16, 8, 32
LAGS = tuple(range(1, 25))
PIECE = 400_000              # bytes whose windows are held at once
BEFORE = 5                   # rows before a window that its self-match channels can see (24 bytes, twice over)
EPOCHS, GROUP, RATE = 12, 32, 0.01
CUT = 0.5


def blocks(run: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes as rows of STRIDE, self-match sums per row, first row of each text). Every text is padded with
    zeros to whole rows and parted by LAGS and WINDOW bytes of zeros, so no window sees two texts."""
    gap = -(-max(max(LAGS), WINDOW) // STRIDE)
    rows = np.array([max(1, -(-len(b) // STRIDE)) + gap for b in run])
    first = np.cumsum(rows) - rows + gap
    flat = np.zeros((rows.sum() + gap) * STRIDE, np.uint8)
    for b, r in zip(run, first.tolist()):
        flat[r * STRIDE : r * STRIDE + len(b)] = np.frombuffer(b, np.uint8)
    match = np.zeros((len(flat) // STRIDE, len(LAGS)), np.float32)
    same = np.zeros(len(flat), np.uint8)
    alive = flat != 0
    for k, lag in enumerate(LAGS):
        np.equal(flat[lag:], flat[:-lag], out=same[lag:].view(bool))
        same[:lag] = 0
        same &= alive
        # the sum of eight 0/1 bytes, read as one number
        match[:, k] = (same.view(np.uint64) * np.uint64(0x0101010101010101)) >> np.uint64(56)
    wide = match.copy()
    wide[1:] += match[:-1]
    wide[2:] += match[:-2]       # matches among the last 24 bytes
    return flat.reshape(-1, STRIDE), wide / (3 * STRIDE), first


def stretches(run: list[bytes]):
    """Lists of (text, bytes, first row, row after the last) of about PIECE bytes that cover every row of every text
    once; the bytes reach BEFORE rows back and one row on, where the text does."""
    step = max(1, PIECE // STRIDE)
    part, size = [], 0
    for i, b in enumerate(run):
        rows = max(1, -(-len(b) // STRIDE))
        for a in range(0, rows, step):
            z, lo = min(rows, a + step), max(0, a - BEFORE)
            cut = b[lo * STRIDE : (z + 1) * STRIDE]
            if part and size + len(cut) > PIECE:
                yield part
                part, size = [], 0
            part.append((i, cut, a - lo, z - lo))
            size += len(cut)
    if part:
        yield part


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        depth = STRIDE * CHANNELS
        self.embed = rng.normal(0, 0.3, (256, CHANNELS)).astype(np.float32)
        self.embed[0] = 0
        self.now = rng.normal(0, 0.15, (depth, FILTERS)).astype(np.float32)    # first half of the window
        self.next = rng.normal(0, 0.15, (depth, FILTERS)).astype(np.float32)   # second half
        self.lag = rng.normal(0, 0.3, (len(LAGS), FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    PARTS = ("embed", "now", "next", "lag", "bias", "out", "base")

    def responses(self, run: list[bytes]):
        """(rectified maxima per text; the two byte rows and the match row of the window of each maximum)."""
        best = np.full((len(run), FILTERS), -np.inf, np.float32)
        now, after = (np.zeros((len(run), FILTERS, STRIDE), np.uint8) for _ in range(2))
        lag = np.zeros((len(run), FILTERS, len(LAGS)), np.float32)
        for part in stretches(run):
            rows, match, first = blocks([b for _, b, _, _ in part])
            e = self.embed[rows].reshape(len(rows), -1)
            r = e @ self.now
            r[:-1] += e[1:] @ self.next
            r += match @ self.lag
            r += self.bias
            for (i, _, a, z), f in zip(part, first.tolist()):
                where = r[f + a : f + z].argmax(axis=0) + f + a
                peak = r[where, np.arange(FILTERS)]
                new = peak > best[i]
                where = where[new]
                best[i, new], now[i, new], lag[i, new] = peak[new], rows[where], match[where]
                after[i, new] = rows[np.minimum(where + 1, len(rows) - 1)]
        return np.maximum(best, 0), now, after, lag

    def probability(self, run: list[bytes]) -> np.ndarray:
        z = self.responses(run)[0] @ self.out + self.base[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def gradients(self, run: list[bytes], y: np.ndarray, weight: np.ndarray) -> dict:
        h, now, after, lag = self.responses(run)
        p = 1 / (1 + np.exp(-np.clip(h @ self.out + self.base[0], -30, 30)))
        d = ((p - y) * weight).astype(np.float32) / len(run)
        g = {"out": h.T @ d, "base": np.array([d.sum()], np.float32)}
        back = d[:, None] * self.out * (h > 0)                       # per text and filter
        g["bias"] = back.sum(axis=0)
        x0, x1 = self.embed[now], self.embed[after]                  # (texts, filters, STRIDE, CHANNELS)
        n, f = back.shape
        g["now"] = np.einsum("nf,nfk->kf", back, x0.reshape(n, f, -1))
        g["next"] = np.einsum("nf,nfk->kf", back, x1.reshape(n, f, -1))
        g["lag"] = np.einsum("nf,nfl->lf", back, lag)
        embed = np.zeros_like(self.embed)
        for w, at in ((self.now, now), (self.next, after)):
            per = (back[:, :, None] * w.T[None]).reshape(-1, CHANNELS)
            np.add.at(embed, at.reshape(-1), per)
        embed[0] = 0
        g["embed"] = embed
        return g

    def train(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 9) -> "Network":
        rng = np.random.default_rng(seed)
        rare = min(y.mean(), 1 - y.mean())
        weight = np.where(y == (y.mean() < 0.5), min(4.0, max(1.0, 0.25 / max(rare, 1e-3))), 1.0)
        m = {k: np.zeros_like(getattr(self, k)) for k in self.PARTS}
        v = {k: np.zeros_like(getattr(self, k)) for k in self.PARTS}
        epochs = max(epochs, min(80, -(-2500 * GROUP // max(1, 2 * len(texts)))))  # small tables: more passes
        steps = epochs * -(-len(texts) // GROUP)
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), GROUP):
                part = order[at : at + GROUP]
                g = self.gradients([texts[i] for i in part], y[part], weight[part])
                t += 1
                rate = RATE * (1 - 0.9 * t / steps)
                for k in self.PARTS:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.995 * v[k] + 0.005 * g[k] ** 2
                    step = m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.995**t)) + 1e-6)
                    x = getattr(self, k)
                    x -= (rate * (step + 1e-3 * x)).astype(np.float32)
        return self


def quality_model(docs: DataFrame, labels: DataFrame) -> Network:
    """Trained network; without labels, or with one class only, an untrained one that says 0.5."""
    texts, y = labelled_sample(docs, labels, "quality", (3, 1), SAMPLE)
    net = Network()
    if not len(y) or y.min() == y.max():
        net.out[:] = 0
        return net
    return net.train([t.encode("utf-8", "surrogatepass") for t in texts], y)


def op9_byte_cnn(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract rows doc_id, held_out, score, predicted.

    NULL and empty texts are one window of zeros. Repeated rows are scored each; other columns, whatever their
    names, are ignored. An empty table gives an empty result."""
    net = quality_model(docs, labels)

    def run(batches):
        for batch in batches:
            score = [net.probability(part) for _, part in pieces(batch["text"], PIECE)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "score": pa.array(np.concatenate([*score, np.zeros(0)]))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))

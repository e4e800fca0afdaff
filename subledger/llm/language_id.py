"""Operator 11, language identification by string kernels.

A text's set of byte n-grams, 1 to 4 bytes long, over its letters (ASCII lower-cased, every run of other bytes one
blank) is its presence vector; n-grams of three and four bytes are hashed to BUCKETS places. The blended-spectrum
presence kernel of two texts is the number of shared n-grams over the root of the product of their numbers.

Fitting: up to SAMPLE labelled texts, as even over the languages as they allow, become presence bitmaps on the
executors; only bitmaps come to the driver (SAMPLE x PLACES / 8 bytes, about 13 MB at most). LANDMARKS of them give
the Nystroem map K(x, landmarks) K(landmarks, landmarks)^(-1/2), in which one kernel ridge regression per language
is solved against all others.

Scoring: presence bitmaps of batches of rows times the landmarks' bitmaps, one matrix product, then the product
with the folded coefficients. Texts never leave their task; memory is bounded by ROWS bitmaps and some bytes per
byte of the longest text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out

SAMPLE = 4000             # labelled rows of a fit, at most
LANDMARKS = 192
RIDGE = 1e-3
BUCKETS = 8192            # places of the n-grams of one length above two
PLACES = 256 + 65536 // 16 + 2 * BUCKETS
ROWS = 256                # rows of one matrix product
WINDOW = 1_000_000        # bytes handled at once
UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def folded(texts: list[bytes]) -> np.ndarray:
    """Letters of all texts, one blank for every run of other bytes and at both ends, a zero after each text."""
    joined = b"".join(b" " + t + b" \x00" for t in texts)
    out = _FOLD[np.frombuffer(joined, np.uint8)]
    ends = np.cumsum(np.array([len(t) + 3 for t in texts], np.int64)) - 1
    out[ends] = 0
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    return out[keep]


def _places(code: np.ndarray, n: int) -> np.ndarray:
    """The place of each n-gram, given its bytes as one number."""
    if n == 1:
        return code
    mixed = code * np.uint32(0x9E3779B1)
    if n == 2:
        return np.uint32(256) + (mixed >> np.uint32(20))
    return np.uint32(256 + 4096 + (n - 3) * BUCKETS) + (mixed >> np.uint32(19))


def presence(texts: list[bytes]) -> np.ndarray:
    """One row of PLACES zeros and ones per text."""
    flags = np.zeros((len(texts) + 1) * PLACES, np.uint8)  # the row after the last takes n-grams across texts
    letters = folded(texts)
    row_of = np.cumsum(letters == 0) - (letters == 0)
    for at in range(0, len(letters), WINDOW):
        a = letters[at : at + WINDOW + 3].astype(np.uint32)
        base = row_of[at : at + WINDOW + 3] * PLACES
        code, inside = a, a != 0
        single = inside
        for n in range(1, 5):
            if n > 1:
                code = (code[:-1] << np.uint32(8)) | a[n - 1 :]
                inside = inside[:-1] & single[n - 1 :]
            own = slice(0, min(WINDOW, len(code)))
            flags[np.where(inside[own], base[own] + _places(code[own], n), len(texts) * PLACES)] = 1
    out = flags.reshape(len(texts) + 1, PLACES)[:-1]
    out[:, 32] = 0  # every text has the blank
    return out


def has_letter(text: bytes) -> bool:
    lower = np.frombuffer(text, np.uint8) | 0x20
    if ((lower >= 97) & (lower <= 122)).any():
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace") if c >= "\x80")


def _raw(column, at: int, n: int) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column.slice(at, n)]


def bitmaps(batches):
    """(lang, place in the order of the sample, packed presence bits) of sample rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            texts = _raw(batch.column("text"), at, ROWS)
            packed = np.packbits(presence(texts), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(at, ROWS), batch.column("turn").slice(at, ROWS),
                 batch.column("digest").slice(at, ROWS), pa.array([p.tobytes() for p in packed], pa.binary())],
                names=["lang", "turn", "digest", "bits"])


def labelled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, turn, digest, text): at most ``sample`` rows that may be learned from, each distinct text once.

    Within a language texts stand in the order of a hash; the languages take turns. The choice is made on hashes;
    the texts of the chosen hashes are read afterwards."""
    usable = docs.where(~held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    keyed = usable.select("lang", F.xxhash64("text").alias("digest"), "text")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("digest"))
    chosen = (keyed.select("lang", "digest").distinct().withColumn("turn", turn).where(F.col("turn") <= sample)
              .orderBy("turn", "lang").limit(sample))
    return keyed.join(F.broadcast(chosen), ["lang", "digest"]).dropDuplicates(["lang", "digest"])


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of rows of zeros and ones with landmark rows (both float32)."""
    shared = x @ landmarks.T
    own = np.sqrt(np.maximum(x.sum(axis=1, dtype=np.float64), 1.0))
    theirs = np.sqrt(np.maximum(landmarks.sum(axis=1, dtype=np.float64), 1.0))
    return shared.astype(np.float64) / own[:, None] / theirs


class Model:
    """Languages (sorted), landmark bitmaps and the folded coefficients of all regressions."""

    def __init__(self, rows: list[tuple[str, bytes]], n_landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.langs = sorted({lang for lang, _ in rows})
        self.bits = [b for _, b in rows[:n_landmarks]]
        if not rows:
            return
        marks = np.stack([self._unpack(b) for b in self.bits])
        values, vectors = np.linalg.eigh(kernel(marks, marks))
        good = values > 1e-8 * values[-1]
        root = vectors[:, good] / np.sqrt(values[good])
        features = np.concatenate([kernel(np.stack([self._unpack(b) for _, b in rows[at : at + ROWS]]), marks)
                                   for at in range(0, len(rows), ROWS)]) @ root
        target = np.array([[float(lang == its) for its in self.langs] for lang, _ in rows])
        middle, level = features.mean(axis=0), target.mean(axis=0)
        centred = features - middle
        gram = centred.T @ centred + ridge * len(rows) * np.eye(features.shape[1])
        solved = np.linalg.solve(gram, centred.T @ (target - level))
        self.weights, self.offset = root @ solved, level - middle @ solved

    @staticmethod
    def _unpack(bits: bytes) -> np.ndarray:
        return np.unpackbits(np.frombuffer(bits, np.uint8))[:PLACES].astype(np.float32)

    def outputs(self, x: np.ndarray) -> np.ndarray:
        """One regression output per row and language."""
        if not hasattr(self, "_marks"):
            self._marks = np.stack([self._unpack(b) for b in self.bits])
        return kernel(x.astype(np.float32), self._marks) @ self.weights + self.offset

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_marks"}


def judge(batches, shared):
    """RESULT rows of Arrow batches (doc_id, held_out, text)."""
    model = shared.value
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            texts = _raw(batch.column("text"), at, ROWS)
            known = np.array([bool(model.langs) and has_letter(t) for t in texts])
            names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if known.any():
                out = model.outputs(presence([t for t, k in zip(texts, known) if k]))
                names[known] = np.array(model.langs, object)[out.argmax(axis=1)]
                mass = np.clip(out, 0, None)
                score[known] = mass.max(axis=1) / np.maximum(mass.sum(axis=1), 1e-12)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])


def fit(docs: DataFrame, sample: int = SAMPLE, n_landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The model of the labelled rows of ``docs`` (doc_id, text, lang)."""
    rows = labelled(docs, sample).mapInArrow(bitmaps, "lang string, turn int, digest long, bits binary").collect()
    rows.sort(key=lambda r: (r["turn"], r["lang"], r["digest"]))
    return Model([(r["lang"], bytes(r["bits"])) for r in rows], n_landmarks, ridge)


def op11_string_kernel(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the share of the best regression output in the positive ones).

    ``und`` with score 0: NULL text, a text without a letter, or no labelled row to learn from. Ties go to the
    language that sorts first. Repeated rows are judged each; a NULL doc_id is not held out. Other columns are
    ignored. An empty table gives an empty result."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    return docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text").mapInArrow(
        lambda batches: judge(batches, model), RESULT)

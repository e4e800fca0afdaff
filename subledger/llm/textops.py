"""Vectorised text kernels for Arrow batches: word spans and substring hashes over one byte buffer.

Texts of a batch are laid end to end (one blank between them) and handled in pieces of bounded size, so the
memory of a task does not grow with the number of rows in a batch; a text is never cut."""

from __future__ import annotations

import sys
import types

import numpy as np

PIECE_BYTES = 1_000_000
_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15 | 1
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z, other bytes kept


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker process (tasks reuse workers)."""
    return sys.modules.setdefault("subledger_worker_cache", types.ModuleType("subledger_worker_cache")).__dict__


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers (and more) of the hash base and of its inverse, modulo 2**64."""
    kept = process_cache()
    if len(kept.get("powers", ((), ()))[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        kept["powers"] = (np.cumprod(np.full(n, _BASE, np.uint64)), np.cumprod(np.full(n, inverse, np.uint64)))
    return kept["powers"]


def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def pieces(texts, size: int = PIECE_BYTES):
    """(first row, list of byte strings) runs of about ``size`` bytes; a NULL counts as empty.

    ``texts`` is a list of strings or an Arrow column; of the latter only one run is copied at a time."""
    run, at, first = [], 0, 0
    for i, t in enumerate(texts):
        if hasattr(t, "as_buffer"):
            b = t.as_buffer().to_pybytes() if t.is_valid else b""
        else:
            b = b"" if t is None else t.encode("utf-8", "surrogatepass")
        if run and at + len(b) > size:
            yield first, run
            run, at, first = [], 0, i
        run.append(b)
        at += len(b) + 1
    if run:
        yield first, run


class Buffer:
    """Bytes of a run of texts with O(1) hashes of any span."""

    def __init__(self, run: list[bytes], lower: bool = True):
        joined = b" ".join(run) + b" "
        self.bytes = np.frombuffer(joined.translate(LOWER) if lower else joined, np.uint8)
        lengths = np.fromiter((len(b) for b in run), np.int64, len(run))
        self.ends = np.cumsum(lengths + 1) - 1       # of each text, without its closing blank
        self.starts = self.ends - lengths
        n = 1 << max(16, int(len(self.bytes)).bit_length())
        up, self._down = powers(n)
        self._sums = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum(_byte_codes()[self.bytes] * up[: len(self.bytes)], out=self._sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[begin]) * self._down[begin] + (end - begin).astype(np.uint64))

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, text index) of the runs of bytes for which the 256-entry table ``inside`` is true."""
        flag = np.zeros(len(self.bytes) + 2, np.int8)
        flag[1:-1] = inside[self.bytes]
        step = np.diff(flag)
        begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        return begin, end, np.searchsorted(self.ends, begin, side="right")


def word_table() -> np.ndarray:
    """Bytes of words: all but blank, tab, line feed, vertical tab, form feed and carriage return."""
    t = np.ones(256, bool)
    t[[32, 9, 10, 11, 12, 13]] = False
    return t


def letter_table() -> np.ndarray:
    """ASCII letters, apostrophe and every byte of a non-ASCII character."""
    t = np.zeros(256, bool)
    t[97:123] = t[65:91] = t[39] = t[128:] = True
    return t


def shingle_sets(run: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's ``width``-word shingles (fewer words: the whole sequence as
    one shingle; no words: empty)."""
    buf = Buffer(run)
    begin, end, text = buf.spans(word_table())
    h = buf.hashes(begin, end)
    counts = np.bincount(text, minlength=len(run))
    if len(h) >= width:
        m = len(h) - width + 1
        acc = np.zeros(m, np.uint64)
        for k in range(width):
            acc = mix(acc * np.uint64(_BASE) + h[k : k + m] + np.uint64(k + 1))
    else:
        acc = np.zeros(0, np.uint64)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(acc[at : at + c - width + 1]))
        elif c:
            one = np.array([c], np.uint64)
            for k in range(at, at + c):
                one = mix(one * np.uint64(_BASE) + h[k : k + 1] + np.uint64(101))
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out

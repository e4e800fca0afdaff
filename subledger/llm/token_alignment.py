"""Operator 12, alignment of two tokenizers by their common byte ends.

Tokenizer A (byte-level BPE) reads blank + text, tokenizer B (sentencepiece) adds that blank itself, so both cover the
same bytes. For either one a word begins at a blank that follows a character other than white space, and what stands
before has no say in what follows; so both have a token end there, and a text is the sequence of its words. Each
distinct word of a run is worked out once and remembered:

1. Both id lists and the bytes that each token stands for. A word whose joined bytes differ on either side is unsound,
   and a text that holds one has no tokens.
2. The cumulative byte ends of each list become an end-to-index dictionary. The intersection of the key sets,
   sorted, gives the common ends; the indices found under them cut both lists into groups.
3. Links (pairs of tokens whose byte ranges overlap) are expanded per group.

A document's figures, groups and links are those of its words, one after another.

Links are counted by id pair inside the document. The corpus-wide number of documents of a pair is a join, and no
link leaves its task as a row: rows are gathered in chunks of about CHUNK_LINKS distinct (document, pair) entries, a
document's entries name places in its chunk's list of distinct pairs, and only these lists are exploded, counted
and joined. The counts return to the chunk by a cogroup, bounded by the chunk's size.

Texts longer than RUN_CHARS are worked through in parts, which end where a word begins and nowhere else."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .packing import Encoder, default_tokenizer
from .textops import Buffer, process_cache

RUN_CHARS = 1_000_000
CHUNK_LINKS, CHUNK_DOCS = 2_000_000, 50_000
KEPT_LINKS = 3_000_000    # remembered links of words, before a worker starts anew
BLANK_PIECE = "▁"
CUT = re.compile(r"(?<=\S) ")
ROWS = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "entries int, places binary, times binary, pairs array<long>, pair_docs array<int>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ByteSide(Encoder):
    """Tokenizer A: ids without special tokens (their strings are plain text) and each id's bytes."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte_of = {chr(b): b for b in chain(range(33, 127), range(161, 173), range(174, 256))}
        rest = [b for b in range(256) if b not in byte_of.values()]
        byte_of |= {chr(256 + k): b for k, b in enumerate(rest)}
        self.token_bytes = TokenBytes({i: bytes(byte_of[c] for c in t) for t, i in vocab.items()
                                       if all(c in byte_of for c in t)})


class PieceSide:
    """Tokenizer B: ids of words that begin with a blank, equal to sentencepiece's ids of these words in a text.

    No piece holds a blank after another character, so no piece reaches over the beginning of a word."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(BLANK_PIECE in n.lstrip(BLANK_PIECE) for n in names):
            raise ValueError("a piece of the model reaches over a blank: words cannot be encoded by themselves")
        self.token_bytes = TokenBytes({i: bytes([int(n[3:5], 16)]) if self.model.is_byte(i)
                                       else n.replace(BLANK_PIECE, " ").encode() for i, n in enumerate(names)})
        self.blank = [self.model.piece_to_id(BLANK_PIECE)]

    def encode(self, words: list[str]) -> list[list[int]]:
        made = self.model.encode([w[1:] for w in words], num_threads=1)  # the tokenizer adds the blank
        return [self.blank if w == " " else ids for w, ids in zip(words, made)]


class TokenBytes:
    """The bytes of every id of a vocabulary, as one array."""

    def __init__(self, table: dict[int, bytes]):
        each = [table.get(i, b"") for i in range(max(table) + 1)]
        self.lengths = np.array([len(b) for b in each], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(each), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        size = self.lengths[ids]
        return self.flat[np.repeat(self.starts[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def word_table(a_path: str, b_path: str) -> Words:
    """Both tokenizers and the words met so far, once per worker process."""
    kept = process_cache()
    if (a_path, b_path) not in kept:
        kept[(a_path, b_path)] = Words(ByteSide(a_path), PieceSide(b_path))
    return kept[(a_path, b_path)]


def parts_of(text: str, size: int = RUN_CHARS) -> list[str]:
    """Blank + text in parts of about ``size`` characters, each beginning with a blank."""
    out, at, whole = [], 0, " " + text
    while len(whole) - at > size:
        cut = CUT.search(whole, at + size)
        if not cut:
            break
        out.append(whole[at : cut.start()])
        at = cut.start()
    return [*out, whole[at:]]


def word_starts(buf: Buffer) -> np.ndarray:
    """Where words begin: at each part's start, and at blanks after a character that is surely not white space."""
    raw = buf.bytes
    at = np.flatnonzero(raw == 32)
    at = at[at >= 3]
    one, two, three = raw[at - 1], raw[at - 2], raw[at - 3]
    space = (one <= 32) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))  # and the sets of long blanks, whole
    space |= ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE1) & (two == 0x9A))
    space |= (three == 0xE3) & (two == 0x80)
    flag = np.zeros(len(raw), bool)
    flag[at[~space]] = True
    flag[buf.ends] = False  # the blank between two parts
    flag[buf.starts] = True
    return np.flatnonzero(flag)


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, upto_a: list[int], upto_b: list[int]):
    """Numbers of A and of B tokens up to each common end, in order: the intersection of two end-to-index maps.

    ``upto_a`` and ``upto_b`` are the numbers of tokens up to the end of each text; every text has maps of its own."""
    cut_a: list[int] = []
    cut_b: list[int] = []
    at_a = at_b = 0
    all_a, all_b = ends_a.tolist(), ends_b.tolist()
    for to_a, to_b in zip(upto_a, upto_b):
        index_a = dict(zip(all_a[at_a:to_a], range(at_a + 1, to_a + 1)))
        index_b = dict(zip(all_b[at_b:to_b], range(at_b + 1, to_b + 1)))
        common = sorted(index_a.keys() & index_b.keys())
        cut_a.extend(map(index_a.__getitem__, common))
        cut_b.extend(map(index_b.__getitem__, common))
        at_a, at_b = to_a, to_b
    return np.array(cut_a, np.int64), np.array(cut_b, np.int64)


def links(cut_a: np.ndarray, cut_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of every overlapping token pair, expanded group by group."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    single = (size_a == 1) & (size_b == 1)
    rest = np.flatnonzero(~single)
    of_a = _slices(cut_a[rest] - size_a[rest], size_a[rest])
    begin = ends_a[of_a - 1] * (of_a > 0)
    first = np.searchsorted(ends_b, begin, side="right")      # the B token that holds the A token's first byte
    last = np.searchsorted(ends_b, ends_a[of_a], side="left")  # and the one that holds its last byte
    width = last - first + 1
    return (np.concatenate([cut_a[single] - 1, np.repeat(of_a, width)]),
            np.concatenate([cut_b[single] - 1, _slices(first, width)]))


def _slices(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, .. of every slice, one after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _digits(upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. upto - 1, left-aligned, with room for a sign behind, and their numbers."""
    kept = process_cache()
    if ("digits", upto) not in kept:
        text = [str(i).encode() for i in range(upto)]
        width = max(map(len, text)) + 1
        table = np.frombuffer(b"".join(t.ljust(width) for t in text), np.uint8).reshape(upto, width)
        kept[("digits", upto)] = table, np.array([len(t) for t in text], np.int64)
    return kept[("digits", upto)]


def group_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, upto: int):
    """``a1,a2|b1;a3|b2,b3;`` of all groups as bytes, and where each group's part ends."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    group_a, group_b = (np.repeat(np.arange(len(cut_a)), s) for s in (size_a, size_b))
    ids = np.empty(len(a) + len(b), np.int64)
    sign = np.full(len(ids), ord(","), np.uint8)
    ids[np.arange(len(a)) + (cut_b - size_b)[group_a]] = a
    ids[np.arange(len(b)) + cut_a[group_b]] = b
    sign[cut_a + (cut_b - size_b) - 1] = ord("|")
    sign[cut_a + cut_b - 1] = ord(";")
    table, length = _digits(upto)
    out, size = table[ids], length[ids]
    out[np.arange(len(ids)), size] = sign
    ends = np.cumsum(size + 1)[cut_a + cut_b - 1]
    return out[np.arange(table.shape[1]) <= size[:, None]].tobytes(), ends


class _Doc:
    """A document's figures, filled part by part."""

    def __init__(self, doc_id):
        self.doc_id, self.ok, self.sha = doc_id, True, None
        self.n = np.zeros(4, np.int64)  # A tokens, B tokens, groups, links
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.ok or not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.pairs) == 1:
            return self.pairs[0], self.times[0]
        pairs, which = np.unique(np.concatenate(self.pairs), return_inverse=True)
        return pairs, np.bincount(which, weights=np.concatenate(self.times)).astype(np.int64)


class Words:
    """Figures of distinct words, worked out once: numbers of A tokens, B tokens, groups and links, the groups as
    text, the links as pairs, and whether both tokenizers give the word back."""

    def __init__(self, a_side: ByteSide, b_side: PieceSide):
        self.a_side, self.b_side = a_side, b_side
        self.bits = len(b_side.token_bytes.lengths).bit_length()
        self.pair_bits = len(a_side.token_bytes.lengths).bit_length() + self.bits
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.texts: list[bytes] = []
        self.sound = np.zeros(0, bool)
        self.n = np.zeros((0, 4), np.int64)
        self.first_link = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)

    def find(self, buf: Buffer, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The slot of each word of a buffer; new words are worked out."""
        if len(self.pairs) > KEPT_LINKS:
            self._forget()
        keys, first, which = np.unique(buf.hashes(begin, end), return_index=True, return_inverse=True)
        keys = keys.tolist()
        slot = np.array([self.slots.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            raw, spots = buf.bytes.tobytes(), first[new]
            slot[new] = len(self.texts) + np.arange(len(new))
            self.slots.update((keys[j], int(slot[j])) for j in new.tolist())
            self._add([raw[b:e] for b, e in zip(begin[spots].tolist(), end[spots].tolist())])
        return slot[which]

    def _add(self, words: list[bytes]) -> None:
        plain = [w.decode("utf-8", "surrogatepass") for w in words]
        a_ids, b_ids = self.a_side.encode(plain), self.b_side.encode(plain)
        n_a, n_b = (np.array([len(i) for i in ids], np.int64) for ids in (a_ids, b_ids))
        a = np.concatenate(a_ids).astype(np.int64)
        b = np.fromiter(chain.from_iterable(b_ids), np.int64, int(n_b.sum()))
        a_bytes, b_bytes = self.a_side.token_bytes, self.b_side.token_bytes
        ends_a, ends_b = np.cumsum(a_bytes.lengths[a]), np.cumsum(b_bytes.lengths[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        whole = b"".join(words)
        sound = np.ones(len(words), bool)
        if a_bytes.join(a).tobytes() != whole or b_bytes.join(b).tobytes() != whole:  # rare: find the words
            sound = np.array([a_bytes.join(np.asarray(i, np.int64)).tobytes() == w
                              and b_bytes.join(np.asarray(j, np.int64)).tobytes() == w
                              for w, i, j in zip(words, a_ids, b_ids)])
            if not sound.all():
                good = np.flatnonzero(sound).tolist()
                n, texts, pairs = np.zeros((len(words), 4), np.int64), [b""] * len(words), np.zeros(0, np.int64)
                if good:
                    kept = Words(self.a_side, self.b_side)
                    kept._add([words[k] for k in good])
                    n[sound], pairs = kept.n, kept.pairs
                    for k, text in zip(good, kept.texts):
                        texts[k] = text
                self._append(sound, n, texts, pairs)
                return
        cut_a, cut_b = common_cuts(ends_a, ends_b, last_a.tolist(), last_b.tolist())
        link_a, link_b = links(cut_a, cut_b, ends_a, ends_b)
        of_link = np.searchsorted(last_a, link_a, side="right")
        order = np.argsort(of_link, kind="stable")
        last_group = np.searchsorted(cut_a, last_a) + 1        # every word ends at a common end
        text, ends = group_text(a, b, cut_a, cut_b, max(len(a_bytes.lengths), len(b_bytes.lengths)))
        stop = ends[last_group - 1].tolist()
        n = np.stack([n_a, n_b, np.diff(last_group, prepend=0), np.bincount(of_link, minlength=len(words))], axis=1)
        self._append(sound, n, [text[x:y] for x, y in zip([0, *stop], stop)],
                     (a[link_a[order]] << self.bits) | b[link_b[order]])

    def _append(self, sound: np.ndarray, n: np.ndarray, texts: list[bytes], pairs: np.ndarray) -> None:
        self.first_link = np.append(self.first_link, len(self.pairs) + np.cumsum(n[:, 3]) - n[:, 3])
        self.sound, self.n = np.append(self.sound, sound), np.concatenate([self.n, n])
        self.pairs = np.append(self.pairs, pairs)
        self.texts += texts


def align_run(owners: list[_Doc], parts: list[str], words: Words) -> None:
    """Add the figures of one run of parts to their documents."""
    buf = Buffer([p.encode("utf-8", "surrogatepass") for p in parts], lower=False)
    begin = word_starts(buf)
    of_part = np.searchsorted(buf.ends, begin, side="right")
    slot = words.find(buf, begin, np.minimum(np.append(begin[1:], len(buf.bytes)), buf.ends[of_part]))
    first = np.searchsorted(of_part, np.arange(len(parts)))  # every part has a word
    n = np.add.reduceat(words.n[slot], first, axis=0)
    sound = np.logical_and.reduceat(words.sound[slot], first)
    n_links = words.n[slot, 3]
    pair = words.pairs[_slices(words.first_link[slot], n_links)]
    entry, times = np.unique((np.repeat(of_part, n_links) << words.pair_bits) | pair, return_counts=True)
    bound = np.searchsorted(entry, np.arange(len(parts) + 1) << words.pair_bits)
    low = (1 << words.bits) - 1
    pairs = ((entry & ((1 << words.pair_bits) - 1)) >> words.bits) << 32 | (entry & low)
    slots, stop = slot.tolist(), [*first.tolist()[1:], len(slot)]
    for k, doc in enumerate(owners):
        doc.ok = doc.ok and bool(sound[k])
        doc.n += n[k]
        doc.pairs.append(pairs[bound[k] : bound[k + 1]])
        doc.times.append(times[bound[k] : bound[k + 1]])
        text = b"".join([words.texts[i] for i in slots[first[k] : stop[k]]])
        if doc.sha is None:
            doc.sha = hashlib.sha256(text[:-1])
        else:
            doc.sha.update(b";" + text[:-1])


def _narrow(values: np.ndarray) -> bytes:
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32).tobytes()


def _widen(raw: bytes, entries: int) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(raw) // entries] if entries else np.uint8
    return np.frombuffer(raw, kind).astype(np.int64)


def _chunk_rows(number: int, docs: list[_Doc]) -> pa.RecordBatch:
    """A chunk's document rows and, last, its row of distinct pairs."""
    each = [d.entries() for d in docs]
    pairs, where = np.unique(np.concatenate([p for p, _ in each]), return_inverse=True)
    pair_docs = np.bincount(where, minlength=len(pairs)).astype(np.int32)
    at, rows = 0, []
    for d, (own, times) in zip(docs, each):
        n = d.n.tolist() if d.ok else [0] * 4
        sha = d.sha.hexdigest() if d.ok and d.sha else ""
        rows.append((number, d.doc_id, *n, sha, len(own), _narrow(where[at : at + len(own)]),
                     _narrow(times), None, None))
        at += len(own)
    rows.append((number, None, None, None, None, None, None, None, None, None, pairs, pair_docs))
    types = [pa.int64()] * 6 + [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
                                pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                      names=[f.split()[0] for f in ROWS.split(", ")])


def align(batches, a_path: str, b_path: str):
    """ROWS of Arrow batches (doc_id, text), chunk by chunk."""
    words = word_table(a_path, b_path)
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    done, owners, parts, size, gathered = [], [], [], 0, 0
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for i, doc_id in enumerate(ids):
            doc = _Doc(doc_id)
            done.append(doc)
            text = texts[i].as_py()
            for part in parts_of(text) if text else []:
                owners.append(doc)
                parts.append(part)
                size += len(part)
                if size >= RUN_CHARS:
                    align_run(owners, parts, words)
                    gathered += sum(len(d.pairs[-1]) for d in {id(o): o for o in owners}.values() if d.pairs)
                    owners, parts, size = [], [], 0
            if not parts and (gathered >= CHUNK_LINKS or len(done) >= CHUNK_DOCS):
                yield _chunk_rows(number, done)
                number, done, gathered = number + 1, [], 0
    if parts:
        align_run(owners, parts, words)
    if done:
        yield _chunk_rows(number, done)


def count_links(docs: pa.Table, found: pa.Table) -> pa.Table:
    """RESULT rows of one chunk, from its document rows and its pairs' counts (spot, n, best)."""
    spot = found.column("spot").to_numpy()
    n = np.zeros(len(spot), np.int64)
    best = np.zeros(len(spot), np.int64)
    n[spot], best[spot] = found.column("n").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for entries, places, times in zip(*(docs.column(c).to_pylist() for c in ("entries", "places", "times"))):
        at, t = _widen(places, entries), _widen(times, entries)
        n_best.append(int((best[at] * t).sum()))
        count_sum.append(int((n[at] * t).sum()))
    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(out | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                           "groups_sha256": docs.column("groups_sha256")})


def op12_token_alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    NULL and empty texts, and texts that a tokenizer does not give back byte for byte, have zeros and an empty
    ``groups_sha256``, and count in no pair. Repeated rows count as documents of their own. Other columns are
    ignored. An empty table gives an empty result. The tokenizer files must be readable under the same path on
    the executors."""
    a_path, b_path = a_path or default_tokenizer(), b_path or default_pieces()
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(lambda batches: align(batches, a_path, b_path), ROWS), "aligned")
    lists = rows.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias(
        "spot", "x")).select("chunk", "spot", F.col("x.pairs").alias("pair"), F.col("x.pair_docs").alias("here"))
    stats = lists.groupBy("pair").agg(F.sum("here").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))   # at most one row per B id
    stats = stored(stats.withColumn("best", F.col("n") == F.max("n").over(of_a)), "pairs")
    found = lists.join(stats, "pair").select("chunk", "spot", "n", "best")
    own = rows.where("pairs is null").select(F.col("chunk").alias("of_chunk"), "doc_id", "n_a", "n_b", "n_groups",
                                             "n_links", "groups_sha256", "entries", "places", "times")
    return own.groupBy("of_chunk").cogroup(found.groupBy("chunk")).applyInArrow(count_links, RESULT)


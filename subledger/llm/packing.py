"""Operator 10, best-fit packing with certified bounds.

1. Every text is tokenised whole (``tokenizers``); only id checksums and lengths leave the task. Documents
   longer than a sequence are cut into full pieces behind a first, possibly shorter one.
2. Pieces are hashed into partitions of about PIECES_PER_PARTITION and packed by best-fit decreasing. For each
   partition dual-feasible functions give a lower bound on its number of bins: a valid function maps lengths
   so that no bin can hold more than 1 of the mapped mass; the best of a family of them, rounded up, counts.
3. A partition whose bins equal its bound is certified. Partitions with a gap, and those certified by their
   large pieces that have a bin's worth of room for other partitions' small ones, give up the pieces of all bins
   that are not full; the other certified ones give up only their emptiest bin, as rounding up to whole bins
   leaves at most that much per partition. The given-up pieces are dealt anew over fewer partitions and
   packed again, until one partition is left, or the total equals the bound of the whole corpus, or two
   rounds in a row saved nothing.

Pieces cross the network as (doc_id, piece, length, checksum); texts never do. No step gathers more than
one partition's pieces in a task. Each round's kept bins are written; a lost executor repeats one partition."""

from __future__ import annotations

import unicodedata
import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .mixing import stored_order
from .textops import mix, powers, process_cache

CAPACITY, END_ID = 1024, 2
PIECES_PER_PARTITION = 40_000
CHUNK_CHARS = 1_000_000
KEPT_TOKENS = 400_000     # pre-tokens whose ids a worker remembers before it starts anew
PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
LATIN = 0x250             # code points below this have fixed classes; other texts go to the tokenizer whole
LETTER, NUMBER, SPACE, OTHER, EDGE = range(5)
LONG = 64                 # characters of a pre-token that is not remembered
MULTIPLIER = 0x9E3779B97F4A7C15
PIECES_OF_DOC = 1 << 20   # a text of 2 GB has fewer


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.

    BPE never merges across pre-tokens, so each distinct pre-token is encoded once and its ids are remembered.
    The splits (letters, numbers, other signs, each with one blank before; white space; English contractions)
    are found for a run of texts at once from code point classes. A pre-token's merges run on the same
    vocabulary as byte ranks (tiktoken) where the file's merges stand in rank order, else on the tokenizer
    itself. Texts with code points of LATIN or above, or with a special token, go to the tokenizer whole."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = self._by_ranks(model["vocab"], model["merges"]) or self._plain
        kinds = np.full(LATIN + 1, OTHER, np.uint8)
        for c in range(LATIN):
            kind = unicodedata.category(chr(c))[0]
            kinds[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
        kinds[[*range(9, 14), 32, 0x85, 0xA0]] = SPACE
        kinds[LATIN] = EDGE
        self.kinds = kinds
        self.codes = mix(np.arange(1, LATIN + 2, dtype=np.uint64) * np.uint64(MULTIPLIER))
        self.up, self.down = powers(1 << 21)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}           # pre-token key to its place in the two arrays below
        self.lengths, self.offsets = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def _by_ranks(vocab: dict, merges: list):
        import tiktoken

        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in merges]
        singles = [b for b in range(256) if chr(b).isprintable() and b not in (32, 0xAD)]
        char = {chr(b): b for b in singles}
        char |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in singles)}
        if made != sorted(made) or len(made) + 256 != len(vocab):
            return None
        ranks = {bytes(char[c] for c in word): i for word, i in vocab.items()}
        bpe = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return bpe._core_bpe.encode_ordinary

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        run, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.zeros(0, np.uint32)
            elif any(s in text for s in self.special):
                out[i] = np.array(self._plain(text), np.uint32)
            else:
                run.append(i)
                size += len(text)
                if size >= CHUNK_CHARS:
                    self._run(texts, run, out)
                    run, size = [], 0
        if run:
            self._run(texts, run, out)
        return out

    def _starts(self, code: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin; texts are parted by one EDGE code (a pre-token of its own)."""
        kind = self.kinds[code]
        n = len(code)
        begin = np.ones(n + 1, bool)
        begin[1:n] = kind[1:] != kind[:-1]
        # a run of white space before a sign: its last character stands alone, or is the blank of the next one
        run_ends = np.flatnonzero(begin[1:n] & (kind[:-1] == SPACE) & (kind[1:] != EDGE)) + 1
        begin[run_ends - 1] = True
        begin[run_ends[code[run_ends - 1] == 32]] = False
        # contractions: a lone apostrophe with no blank before it takes the letters after it
        marks = np.flatnonzero((code == 39) & begin[:n])
        padded = np.concatenate([code, np.full(3, LATIN, code.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(marks), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        begin[marks[short | pair] + 1] = False
        begin[marks[short] + 2] = True
        begin[marks[pair] + 3] = True
        return np.flatnonzero(begin[:n])

    def _run(self, texts: list[str], rows: list[int], out: list) -> None:
        edge = chr(0x10FFFF)
        joined = edge.join([texts[i] for i in rows]) + edge
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(texts[i]) + 1 for i in rows])
        inner = code.copy()
        inner[np.cumsum(sizes) - 1] = 0
        high = np.maximum.reduceat(inner, np.cumsum(sizes) - sizes) >= LATIN
        if high.any():
            for i, whole in zip(rows, high.tolist()):
                if whole:
                    out[i] = np.array(self._plain(texts[i]), np.uint32)
            rows = [i for i, whole in zip(rows, high.tolist()) if not whole]
            if rows:
                self._run(texts, rows, out)
            return
        code = np.minimum(code, LATIN)
        begin = self._starts(code)
        end = np.append(begin[1:], len(code))
        width = end - begin
        if len(code) > len(self.up):
            self.up, self.down = powers(2 * len(code))
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(self.codes[code] * self.up[: len(code)], out=sums[1:])
        key = mix((sums[end] - sums[begin]) * self.down[begin] + width.astype(np.uint64))
        long_ = width > LONG
        key[long_] = mix(begin[long_].astype(np.uint64) + np.uint64(1 << 63))  # one key each, not remembered
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.slots) > KEPT_TOKENS:
            self._forget()
        slots, keys = self.slots, distinct.tolist()
        at = [slots.get(k, -1) for k in keys]
        new = [j for j, slot in enumerate(at) if slot < 0]
        if new:
            merge, made, n = self.merge, [], len(self.lengths)
            for j, b, e in zip(new, begin[first[new]].tolist(), end[first[new]].tolist()):
                part = joined[b:e]
                made.append([] if part == edge else merge(part))
                at[j] = slots[keys[j]] = n
                n += 1
            lengths = np.fromiter(map(len, made), np.int64, len(made))
            self.offsets = np.concatenate([self.offsets, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, np.array([x for m in made for x in m], np.uint32)])
            for k in key[long_].tolist():
                slots.pop(k, None)
        slot = np.array(at, np.int64)[which]
        count = self.lengths[slot]
        total = np.cumsum(count)
        stream = self.ids[np.arange(total[-1]) + np.repeat(self.offsets[slot] - (total - count), count)]
        stops = total[self.kinds[code[begin]] == EDGE]
        for i, a, z in zip(rows, np.concatenate([[0], stops[:-1]]).tolist(), stops.tolist()):
            out[i] = stream[a:z]


def encoder(path: str) -> Encoder:
    kept = process_cache()
    if kept.get("encoder_path") != path:
        kept["encoder"], kept["encoder_path"] = Encoder(path), path
    return kept["encoder"]


def cut(doc_id, ids: np.ndarray, capacity: int) -> list[tuple]:
    """(doc_id, piece, start, length, ids_crc32); only the first piece may be shorter than the capacity."""
    n = len(ids)
    head = n % capacity or capacity
    stops = range(min(head, n), n + 1, capacity)
    out, at = [], 0
    for k, stop in enumerate(stops):
        out.append((doc_id, k, at, stop - at, zlib.crc32(ids[at:stop].astype("<u4").tobytes())))
        at = stop
    return out


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    def run(batches):
        enc = encoder(tokenizer)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids = batch["doc_id"].slice(at, 500).to_pylist()
                texts = [t or "" for t in batch["text"].slice(at, 500).to_pylist()]
                places = batch["place"].slice(at, 500).to_pylist()
                rows, place = [], []
                for doc, got, where in zip(ids, enc.encode(texts), places):
                    rows += cut(doc, np.concatenate([got, end]), capacity)
                    place += [where] * (len(rows) - len(place))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), PIECE_TYPES)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(place, pa.int64())],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32", "place"])

    place = F.col("__place") if "__place" in docs.columns else F.lit(None)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", place.cast("long").alias("place")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, place long")


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Best dual-feasible-function bound on the bins for ``counts[l]`` items of each length l.

    Two families: for a threshold e, lengths above capacity - e count as a whole bin, lengths below e as
    nothing, others as they are (with e = 0 the plain mass bound); and for k, a length x counts as
    x / capacity when (k + 1) x / capacity is whole, else floor((k + 1) x / capacity) / k."""
    length = np.arange(len(counts), dtype=np.int64)
    here = counts.astype(np.int64)
    best = -(-int((length * here).sum()) // capacity)
    below = np.concatenate([[0], np.cumsum(length * here)])   # below[x]: mass of lengths < x
    number = np.concatenate([[0], np.cumsum(here)])
    for e in range(1, capacity // 2 + 1):
        whole = number[-1] - number[min(capacity - e + 1, len(counts))]
        mass = below[capacity - e + 1] - below[e]
        best = max(best, int(whole) - (-int(mass) // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * length
        exact = scaled % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(exact, length * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * here).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item by best-fit decreasing, and each bin's fill. Bins are kept by room left; the
    tightest one that fits is found from a bit set of the rooms that exist."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill = 0, []
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins, offsets, np.array(fill, np.int64)


def _packed(items: DataFrame, parts: int, turn: int, capacity: int, rows: int | None) -> DataFrame:
    """Pack each of ``parts`` partitions; a row per piece with its bin, and per bin whether it stays and its first
    piece in the order of places. Partitions are by hash; in the first turn over ``rows`` ordered documents they are
    stretches of the order (full pieces fit nowhere and are spread by hash)."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        lengths = frame["length"].to_numpy()
        bins, offsets, fill = best_fit(lengths, capacity)
        gap = len(fill) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        room = len(fill) > -(-int(lengths.sum()) // capacity)  # a bin's worth of room: other lengths could fill it
        given = fill < capacity if gap or room else np.arange(len(fill)) == np.argmin(fill)
        given &= fill < capacity
        return pd.DataFrame({
            "doc_id": frame["doc_id"], "piece": frame["piece"], "start": frame["start"], "length": lengths,
            "ids_crc32": frame["ids_crc32"], "part": frame["part"], "bin": bins, "offset": offsets,
            "given": given[bins], "gap": gap, "place": frame["place"], "first": first_of(frame, bins, len(fill))})

    def first_of(frame: pd.DataFrame, bins: np.ndarray, n: int) -> np.ndarray:
        first = np.full(n, np.iinfo(np.int64).max)
        if rows is not None:
            np.minimum.at(first, bins, frame["place"].to_numpy(np.int64) * PIECES_OF_DOC + frame["piece"].to_numpy(np.int64))
        return first[bins]

    part = F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts))
    if rows is not None and turn == 0:
        part = F.when(F.col("length") < capacity, F.least(F.lit(parts - 1), F.floor(F.col("place") * parts / rows))).otherwise(part)
    return items.withColumn("part", part.cast("int")).groupBy("part").applyInPandas(
        pack, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, bin long, offset long,"
              " given boolean, gap long, place long, first long")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rows: int | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32, place) with sequence_id and offset.

    With ``rows`` (the number of documents, whose places count from 0) sequences are packed from stretches of the
    order of places and their ids stand in the order of their first pieces."""
    by_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)  # at most `capacity` lengths
    for n, c in by_length.items():
        counts[n] = c
    bound = lower_bound(counts, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    done, total, items, n, turn, idle = [], 0, pieces, int(counts.sum()), 0, 0
    while True:
        parts = max(1, -(-n // PIECES_PER_PARTITION))
        packed = stored(_packed(items, parts, turn, capacity, rows), "packed")
        placed = packed.withColumn("turn", F.lit(turn))
        state = packed.groupBy("part", "bin").agg(F.first("given").alias("given"), F.count("*").alias("n")).agg(
            F.count("*").alias("bins"), F.coalesce(F.sum(F.col("given").cast("int")), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(F.col("given"), F.col("n"))), F.lit(0)).alias("pieces")).first()
        now = total + state["bins"]
        idle = idle + 1 if turn and state["bins"] >= given else 0
        last = (parts == 1 and turn) or now == bound or not state["given"] or idle == 2
        if last:
            done.append(placed)
            break
        done.append(placed.where("not given"))
        total += state["bins"] - state["given"]
        items, n, given = packed.where("given").select(*columns, "place"), state["pieces"], state["given"]
        turn += 1
    number = (F.col("turn").cast("long") * (1 << 56)) + F.col("part").cast("long") * (1 << 32) + F.col("bin")
    number = number if rows is None else F.col("first")  # a piece is in one bin: first pieces differ
    return reduce(DataFrame.unionByName, done).select(*columns, number.alias("sequence_id"), "offset")


def op10_certified_packing(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Contract rows: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL and empty texts are one piece of one id. Repeated rows are packed each. An empty table gives an
    empty result."""
    return pack_pieces(stored(token_pieces(docs, tokenizer or default_tokenizer()), "pieces"))


def pack_in_order(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """As :func:`op10_certified_packing`, with sequence ids that follow the order in which ``docs`` are stored (the
    mix): sequence ids ascend with the place of each sequence's first document."""
    placed, rows = stored_order(docs)
    pieces = stored(token_pieces(placed, tokenizer or default_tokenizer()), "pieces")
    return pack_pieces(pieces, rows=max(1, rows))

"""Operator 7, near-duplicate grouping: SuperMinHash signatures, banding, exact verification, union-find.

1. One pass over the texts gives the size and a digest of each document's shingle set (64-bit hashes) and
   its band hashes. Documents with equal sets form one class; its smallest doc_id stands for it (a partial
   aggregate, so a class of any size is one row per task).
2. SuperMinHash: every element has its own random permutation of the signature positions; at
   step j it offers the value j + u at the position that its permutation has in place j. A step stops
   mattering once every position holds a value below j, so large sets stop after the first steps.
3. Signatures are cut into bands; classes that share a band are candidates. With 42 bands of 6 values a
   pair at the threshold 0.8 misses all bands with a probability of about 3 in a million.
4. Candidates of a band bucket are not expanded into pairs. A hub of each bucket is compared on full sets with
   the members that are not yet in its component (first the same hub order for all bands, so few distinct pairs;
   then a random hub). Groups of copies melt into components this way, and buckets whose members are all in one
   component are finished. When a round no longer links much, the buckets that are left hold texts that share a
   part only: their members are compared by signature inside the task, bucket by bucket, and the few pairs that
   may reach the threshold on full sets. No candidate is dropped. The sets of the classes that share a bucket
   are written once for these comparisons.
5. Components: large-star / small-star over the verified edges, each round written to the shared folder.

Lost executors: every round reads written tables. Skew: only ids, sizes and digests are grouped by a key that
can be hot, with partial aggregates; joins on hub ids are ordinary shuffled joins that AQE can split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, partitions_for, stored
from .textops import mix, pieces, shingle_sets

WIDTH, BANDS, ROWS = 5, 42, 6          # shingle words, bands, signature values per band
LENGTH = 504                           # signature values; the bands take the first BANDS * ROWS
ERRORS = 4.5                           # standard errors below the threshold that a likely pair may show
BLOCK = 2000                           # members of a bucket that are compared with each other in one task
STEP_ELEMENTS = 30_000                # elements whose permutations are held at once in the later steps


def _offers(h: np.ndarray, step: int) -> np.ndarray:
    return mix(h + np.uint64((0x632BE59BD9B4E019 * (step + 1)) & (2**64 - 1)))


def superminhash(sets: list[np.ndarray], length: int) -> np.ndarray:
    """One signature row per set (empty set: all infinite)."""
    sig = np.full((len(sets), length), np.inf)
    sizes = np.array([len(s) for s in sets])
    live = np.flatnonzero(sizes)
    begin = 0
    while begin < len(live):
        total, stop = 0, begin
        while stop < len(live) and (stop == begin or total + sizes[live[stop]] <= STEP_ELEMENTS):
            total += sizes[live[stop]]
            stop += 1
        rows = live[begin:stop]
        begin = stop
        _fill(sig, rows, [sets[r] for r in rows], length)
    return sig


def _fill(sig: np.ndarray, rows: np.ndarray, sets: list[np.ndarray], length: int) -> None:
    elements = np.concatenate(sets)
    owner = np.repeat(rows, [len(s) for s in sets])
    perm = None
    for step in range(length):
        bits = _offers(elements, step)
        u = (bits >> np.uint64(32)).astype(np.float64) / 2.0**32
        swap = step + ((bits & np.uint64(0xFFFFFFFF)) * np.uint64(length - step) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            place, first = swap, swap
        else:
            if perm is None:  # the permutations after step 0: places 0 and its partner exchanged
                perm = np.tile(np.arange(length, dtype=np.int16), (len(elements), 1))
                at = np.arange(len(elements))
                perm[at, first] = 0
                perm[:, 0] = first
            at = np.arange(len(elements))
            place = perm[at, swap].astype(np.int64)
            perm[at, swap] = perm[:, step]
            perm[:, step] = place
        np.minimum.at(sig.reshape(-1), owner * length + place, step + u)
        open_rows = rows[(sig[rows] >= step + 1).any(axis=1)]  # a later offer is at least step + 1
        if not len(open_rows):
            return
        if len(open_rows) < len(rows):
            keep = np.isin(owner, open_rows)
            elements, owner, rows = elements[keep], owner[keep], open_rows
            perm = perm[keep] if perm is not None else None
            first = first[keep] if step == 0 else None


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) 64-bit hash of each band's values; bands are told apart by their number."""
    bits = np.ascontiguousarray(sig[:, : bands * rows]).view(np.uint64).reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    for k in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return h.view(np.int64)


def signed(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, band hashes, a byte of each signature value) of whole texts (no
    words: no bands)."""

    def run(batches):
        for batch in batches:
            for first, part in pieces(batch["text"]):
                sets = shingle_sets(part, width)
                sig = superminhash(sets, max(LENGTH, bands * rows))
                banded = band_hashes(sig, bands, rows)
                short = (mix(sig.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"].slice(first, len(part)),
                    "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                    "digest": pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets],
                                       pa.binary()),
                    "bands": pa.array([b if len(x) else b[:0] for x, b in zip(sets, banded)], pa.list_(pa.int64())),
                    "sig": pa.array([x.tobytes() for x in short], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, bands array<long>, sig binary")


def shingle_rows(docs: DataFrame, width: int) -> DataFrame:
    """(id, shingles): each text's set as the bytes of its sorted 64-bit hashes."""

    def run(batches):
        for batch in batches:
            for first, part in pieces(batch["text"]):
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"].slice(first, len(part)),
                    "shingles": pa.array([x.tobytes() for x in shingle_sets(part, width)], pa.binary())})

    return docs.select(F.col("doc_id").alias("id"), "text").mapInArrow(run, "id long, shingles binary")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets reach ``percent`` of Jaccard similarity."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["sa"], batch["sb"]):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of an edge can reach. Alternates large-star and
    small-star steps on written edge lists until they no longer change."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v")).where("u <> v").distinct()
        nxt = stored(small, "edges")
        key = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        was, now = (x.agg(key.alias("k"), F.count("*").alias("n")).first() for x in (e, nxt))
        discard(e)
        e = nxt
        if was == now:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def likely_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b), each pair once: pairs of different components within a key whose sizes allow the similarity and
    whose signatures agree within ERRORS standard errors of it.

    ``rows`` has key, band, other, side, id, n, component, sig, bands. ``band`` is the band of the key's bucket
    (and ``other`` the second one of a parted bucket, else -1): a pair is told only by the first band (and the
    second) that it shares, so not once per shared bucket. Shared are bands of equal hashes, as in the buckets (the
    bytes of ``sig`` agree by chance too, in bands whose buckets part the pair), and after them the spare bands of equal
    bytes, as in the parts. A key holds at most two blocks of BLOCK rows (sides 0 and 1: compared across only; side
    -1: within). Sorted partitions are read in batches; only the rows of one key are
    held together."""
    t = percent / 100.0

    def compare(band, other, ids, n, comp, side, sig, hashes):
        length = sig.shape[1]
        need = int((t - ERRORS * (t * (1 - t) / length) ** 0.5) * length)
        spare = sig[:, BANDS * ROWS : LENGTH].reshape(len(sig), -1, ROWS)
        out = []
        for i in range(len(ids) - 1):
            r = slice(i + 1, None)
            ok = (comp[r] != comp[i]) & (100 * np.minimum(n[r], n[i]) >= percent * np.maximum(n[r], n[i]))
            ok &= (side[r] != side[i]) | (side[r] < 0)
            at = np.flatnonzero(ok) + i + 1
            if len(at):
                at = at[(sig[at] == sig[i]).sum(axis=1) >= need]
            if len(at):
                shared = np.concatenate([hashes[at] == hashes[i], (spare[at] == spare[i]).all(axis=2)], axis=1)
                first = shared.argmax(axis=1) == band[i]
                if other[i] >= 0:
                    shared[np.arange(len(at)), shared.argmax(axis=1)] = False
                    first &= shared.any(axis=1) & (shared.argmax(axis=1) == other[i])
                out += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in at[first].tolist()]
        return out

    def pairs_of(held):
        key = held["key"].to_numpy()
        columns = [held[c].to_numpy() for c in ("band", "other", "id", "n", "component", "side")]
        sig = np.frombuffer(b"".join(held["sig"].to_pylist()), np.uint8).reshape(len(key), -1)
        hashes = np.concatenate([c.flatten().to_numpy() for c in held["bands"].chunks]).reshape(len(key), -1)
        cuts = np.flatnonzero(np.diff(key)) + 1
        out = []
        for a, z in zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(key)]]).tolist()):
            if z - a > 1:
                out += compare(*(x[a:z] for x in columns), sig[a:z], hashes[a:z])
        return pa.RecordBatch.from_pydict({"a": pa.array([int(x) for x, _ in out], pa.int64()),
                                           "b": pa.array([int(y) for _, y in out], pa.int64())})

    def run(batches):
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * BLOCK):
                table = pa.Table.from_batches([batch.slice(at, 4 * BLOCK)])
                held = table if held is None else pa.concat_tables([held, table])
                key = held["key"].to_numpy()
                whole = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
                if whole:
                    yield pairs_of(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None:
            yield pairs_of(held)

    parts = partitions_for(rows)
    return (rows.select("key", "band", "other", "side", "id", "n", "component", "sig", "bands")
            .repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long"))


def rest_pairs(open_: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of all rows (bucket, band, id, n, component) that hubs have not settled.

    A bucket of more than BLOCK rows is parted by the other bands of its members first, and by spare bands of the
    signature values that make no buckets, as they were stored (a byte each). Texts that only share a passage mostly
    agree in no further band; a pair at the threshold that shares the bucket misses the 41 others and the 42 spare
    ones with a probability of one in 10^11, so a large bucket finds what a small one does. What is still larger is
    compared block against block."""
    def sized(rows):
        return rows.join(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")

    rows = sized(open_.withColumnRenamed("bucket", "key"))
    few = rows.where(F.col("size") <= BLOCK)
    spare = F.transform(F.sequence(F.lit(1), F.lit(LENGTH // ROWS - BANDS)), lambda k: F.xxhash64(
        F.substr("sig", F.lit(BANDS * ROWS + 1) + (k - 1) * ROWS, F.lit(ROWS))))
    many = rows.where(F.col("size") > BLOCK).join(classes.select("id", F.concat("bands", spare).alias("all")), "id")
    parted = sized(many.select("key", "band", "id", "n", "component", F.posexplode("all").alias("other", "sub"))
                   .where("other > band")  # the pair's second band; its first is that of the bucket
                   .select(F.xxhash64("key", "sub").alias("key"), "band", "other", "id", "n", "component"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "key"), blocks).cast("int")
    crossed = (parted.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
               .select(F.xxhash64("key", F.least("own", "with"), F.greatest("own", "with")).alias("key"),
                       "band", "other",
                       F.when(F.col("own") == F.col("with"), -1).when(F.col("own") < F.col("with"), 0).otherwise(1)
                       .alias("side"), "id", "n", "component"))
    both = few.select("key", "band", F.lit(-1).alias("other"), F.lit(-1).alias("side"), "id", "n",
                      "component").unionByName(crossed)
    return likely_pairs(both.join(classes.select("id", "sig", "bands"), "id"), percent).distinct()


def grouped(classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(id, component) of the classes that are linked with another class, or None; ``classes`` has id, n, bands,
    sig."""
    keyed = classes.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    met = keyed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    open_ = stored(keyed.join(met, "bucket"), "buckets")
    sets = stored(shingle_rows(docs.join(open_.select(F.col("id").alias("doc_id")).distinct(), "doc_id",
                                         "left_semi"), width), "candidate-sets")
    edges = placed = None

    def add(found):
        nonlocal edges, placed
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
            placed = components(edges)

    def unsettled(rows):
        """Rows of the buckets that hold more than one component."""
        now = rows.withColumn("component", F.col("id")) if placed is None else (
            rows.join(placed, "id", "left").withColumn("component", F.coalesce("component", "id")))
        spread = now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        return stored(now.join(spread.where("lo <> hi").select("bucket"), "bucket"), "buckets")

    turn, worth = 0, True
    while worth:
        left = unsettled(open_)
        discard(open_)
        # turn 0: the smallest id of every bucket, so that all bands test the same pairs; then a random member
        order = F.lit(0).cast("long") if turn == 0 else F.xxhash64("id", "bucket", F.lit(turn))
        hubs = left.groupBy("bucket").agg(F.min(F.struct(
            order.alias("order"), F.col("id").alias("hub"), F.col("n").alias("hub_n"),
            F.col("component").alias("hub_component"))).alias("h"))
        against = left.join(hubs.select("bucket", "h.hub", "h.hub_n", "h.hub_component"), "bucket")
        small, large = F.least("n", "hub_n"), F.greatest("n", "hub_n")
        pairs = stored(against.where((F.col("component") != F.col("hub_component"))
                                     & (100 * small >= percent * large))
                       .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), "pairs")
        found = stored(similar(pairs, sets, percent), "links")
        worth = found.count() * 20 > pairs.count()  # groups of copies still merge; else the rest is settled at once
        discard(pairs)
        open_ = stored(against.where("id <> hub").select("id", "n", "band", "bucket"), "buckets")
        discard(left)
        add(found)
        turn += 1
    left = unsettled(open_)
    discard(open_)
    if not left.isEmpty():
        add(stored(similar(rest_pairs(left, classes, percent), sets, percent), "links"))
    discard(left)
    discard(sets)
    return placed


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    NULL, empty or word-less texts have an empty set, are linked with nothing and are kept. Repeated rows
    keep their number; a doc_id that stands twice is one node. Other columns are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows_ = stored(signed(docs, width, bands, rows), "signed")
    classes = rows_.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig"))
    classes = stored(classes, "classes")
    linked = grouped(classes, docs, width, percent)
    member = classes.select("digest", "id")
    member = member.withColumn("component", F.col("id")) if linked is None else (
        member.join(linked, "id", "left").select("digest", F.coalesce("component", "id").alias("component")))
    out = (rows_.select("doc_id", "n_shingles", "digest").join(member.select("digest", "component"), "digest", "left")
           .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component"))
                   .otherwise(F.col("doc_id")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_superminhash(docs: DataFrame) -> DataFrame:
    """Contract: 4-word shingles, 80 per cent."""
    return near_duplicates(docs, width=4, percent=80)


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate group: the columns of ``docs``, for the smallest doc_id of the group and, of
    rows that share that doc_id, the smallest text. Rows that share a doc_id are linked by their texts alone, as
    all others. Rows without words or without doc_id all stay.

    A row whose doc_id stands more than once gets a number of its own below all doc_ids, in a written table, so
    that it is a node of its own."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", whole)
    again = stored(rows.where("doc_id is not null").groupBy(F.col("doc_id").alias("again_id"))
                   .agg(F.count("*").alias("n")).where("n > 1").select("again_id"), "repeated")
    if again.isEmpty():
        gone = near_duplicates(rows).where(~F.col("kept")).select(F.col("doc_id").alias("gone"))
        return rows.join(gone, F.col("doc_id") == F.col("gone"), "left_anti").select("row.*")
    same = F.col("doc_id") == F.col("again_id")
    least = rows.agg(F.min("doc_id")).first()[0]
    number = F.lit(least) - 1 - F.monotonically_increasing_id()
    twice = stored(rows.join(again, same, "left_semi").withColumn("id", number), "repeated-rows")
    rows = rows.join(again, same, "left_anti").withColumn("id", F.col("doc_id")).unionByName(twice)
    found = stored(near_duplicates(rows.select(F.col("id").alias("doc_id"), "text")).where("n_shingles > 0")
                   .select(F.col("doc_id").alias("id"), "component_id", "kept"), "grouped")
    # a group that holds such a row is named by one; its row that stays is chosen anew
    first = (found.where(F.col("component_id") < least).join(rows.select("id", "doc_id", "text"), "id")
             .groupBy("component_id").agg(F.min(F.struct("doc_id", "text", "id")).alias("best"))
             .select(F.col("best.id").alias("stays")))
    gone = (found.where(~F.col("kept") | (F.col("component_id") < least))
            .join(first, F.col("id") == F.col("stays"), "left_anti").select(F.col("id").alias("gone")))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")

"""Operator 5, mixing sources to target weights: Pfair scheduling of source blocks.

Every source's rows are shuffled by a hash and cut into blocks. Time is counted in blocks. A source of weight w (of
those that have not run out) releases its j-th block at floor((j - 1) / w) and must place it by ceil(j / w); among the
released blocks the earliest deadline goes first. As the weights add up to one, every block meets its window, so after
any slot each source is less than one block away from its share.

Windows come straight from the weights, without a period, and every source is a class of its own: one way for any
weights and any number of sources. When a source has run out the others share the slots by their target weights: the
windows are those of the ideal course, in which every source that has not run out gets slots in proportion to its
weight at every moment. All rows are placed and none is repeated.

The earliest deadline is decided slot by slot on the driver, over blocks, not rows: a block has BLOCK_ROWS rows, or as
many times two as make MAX_BLOCKS blocks at most (beside four per source), so the driver's work and the schedule that
goes to every executor are bounded for any number of rows (about a second, some 10 MB). The list of sources itself is
collected and has to fit there.

Rows are numbered inside a source by range partitions (``functions.ordering.Ordered``): no window holds a source, a
hash value or a repeated doc_id. Only keys are ordered; whole rows move once to their place in the mix."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import Ordered
from .common import stored

BLOCK_ROWS, MAX_BLOCKS = 64, 1 << 18
SEED = 17
FILE, ROW = "__file_of_row", "__row_in_file"


def course(blocks: list[int], weights: list[float]) -> dict[str, np.ndarray]:
    """The schedule of all blocks as columns cls, block, phase, slot, by class and block: earliest deadline first in
    the windows of the ideal course. A phase lasts until the next source of the ideal course has run out."""
    b = np.array(blocks, np.int64)
    w = np.array(weights, float)
    w = np.maximum(w / w.sum() if w.sum() > 0 else np.ones(len(w)), 1e-9)  # weight 0: when all others have run out
    cls = np.repeat(np.arange(len(b)), b)
    block = np.arange(len(cls)) - np.repeat(np.cumsum(b) - b, b)
    # the time at which each source runs out, and the slots of all sources up to then
    order = np.argsort(b / w, kind="stable")
    ends = (b / w)[order]
    live = np.cumsum(w[order][::-1])[::-1]  # weight of the sources that have not run out before
    filled = np.cumsum(np.diff(ends, prepend=0.0) * live)
    times, slots = np.append(0.0, ends), np.append(0.0, filled)
    release = np.floor(np.interp(block / w[cls], times, slots) + 1e-6).astype(np.int64)
    deadline = np.ceil(np.interp((block + 1) / w[cls], times, slots) - 1e-6).astype(np.int64)
    slot = np.empty(len(cls), np.int64)
    ready: list[tuple[int, int]] = []
    waiting = np.argsort(release, kind="stable").tolist()
    starts, due, at = release.tolist(), deadline.tolist(), 0
    for t in range(len(cls)):
        while at < len(waiting) and (starts[waiting[at]] <= t or not ready):
            heapq.heappush(ready, (due[waiting[at]], waiting[at]))
            at += 1
        slot[heapq.heappop(ready)[1]] = t
    phase = np.searchsorted(np.unique(np.floor(filled + 1e-6)), slot, side="right")
    return {"cls": cls, "block": block, "phase": phase, "slot": slot}


def _classes(docs: DataFrame, weights: dict | None) -> tuple[list, list[int], list[float]]:
    """(sources, rows of each, their weights). Without given weights a source weighs the square root of its rows;
    with them, the sources that are not named share what is left to one in this way."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n")).orderBy("source").collect()
    names, rows = [r["source"] for r in counts], [r["n"] for r in counts]
    roots = [n**0.5 for n in rows]
    if weights is None:
        return names, rows, roots
    others = sum(x for s, x in zip(names, roots) if s not in weights)
    left = max(0.0, 1.0 - sum(weights.values()))
    return names, rows, [float(weights[s]) if s in weights else left * x / others for s, x in zip(names, roots)]


def schedule(rows: list[int], weights: list[float], block_rows: int = BLOCK_ROWS) -> tuple[int, dict[str, np.ndarray]]:
    """(rows of a block, the course of all blocks with ``begin``: the position of each block's first row)."""
    while sum(-(-n // block_rows) for n in rows) > max(MAX_BLOCKS, 4 * len(rows)):
        block_rows *= 2
    place = course([-(-n // block_rows) for n in rows], weights)
    taken = np.minimum(np.array(rows, np.int64)[place["cls"]] - place["block"] * block_rows, block_rows)
    by_slot = np.argsort(place["slot"])
    begin = np.empty(len(taken), np.int64)
    begin[by_slot] = np.cumsum(taken[by_slot]) - taken[by_slot]
    return block_rows, place | {"begin": begin}


def mixed(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` (doc_id, source, any other columns) plus a struct column ``mix``: cls, block, phase, slot,
    position (gapless from 0 in the mixed order).

    Rows without a source form a source of their own. Equal rows take places of their own. An empty table gives an
    empty result. A column named ``mix`` is replaced. Rows are carried through the ordering: give the columns
    that identify a row, not texts (``in_mixed_order`` does so)."""
    spark = docs.sparkSession
    names, rows, weight = _classes(docs.select("doc_id", "source"), weights)
    if not rows:
        block_rows, place = block_rows, {k: np.zeros(0, np.int64) for k in ("cls", "block", "phase", "slot", "begin")}
    else:
        block_rows, place = schedule(rows, weight, block_rows)
    classes = F.broadcast(spark.createDataFrame(list(zip(names, range(len(names)))), docs.select(
        F.col("source").alias("its_source"), F.lit(0).alias("cls")).schema))
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "mix"]).alias("row"),
                         F.col("doc_id").alias("id"), F.col("source").alias("of"),
                         F.xxhash64("doc_id", F.lit(SEED)).alias("mark"), F.monotonically_increasing_id().alias("nth"))
    tagged = tagged.join(classes, F.col("of").eqNullSafe(F.col("its_source")))
    ranked = Ordered(tagged, "cls", ("mark", "id", "nth"), ("row",)).sum_before(F.lit(1), "rank")
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block_rows)).withColumn("seat", F.col("rank") % block_rows)
    table = pa.table({k: pa.array(v, pa.int64()) for k, v in place.items()})
    return (ranked.join(F.broadcast(spark.createDataFrame(table)), ["cls", "block"])  # bounded by MAX_BLOCKS
            .select("row.*", F.struct(
                F.col("cls").cast("int").alias("cls"), F.col("block").cast("long").alias("block"),
                F.col("phase").cast("int").alias("phase"), F.col("slot").cast("long").alias("slot"),
                (F.col("begin") + F.col("seat")).cast("long").alias("position")).alias("mix")))


def op5_pfair_mix(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """doc_id, source, cls, block, phase, slot, position of every row.

    Without ``weights`` the target weight of a source is the square root of its rows: the registered query mixes to
    these weights. NULLs, repeated rows, empty tables and other columns as in :func:`mixed`."""
    m = mixed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source"), weights)
    return m.select("doc_id", "source", "mix.cls", "mix.block", "mix.phase", "mix.slot", "mix.position")


def addressed(docs: DataFrame) -> DataFrame:
    """``docs`` and where each row is stored (file, row in it): a stable identity, also of equal rows. A table that
    is not read from Parquet files is written first."""
    try:
        at = docs.metadataColumn("_metadata")
        return docs.select("*", at["file_path"].alias(FILE), at["row_index"].alias(ROW))
    except AnalysisException:
        kept = stored(docs, "mix-input")
        at = kept.metadataColumn("_metadata")
        return kept.select("*", at["file_path"].alias(FILE), at["row_index"].alias(ROW))


def in_mixed_order(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """The rows and columns of ``docs``, range-partitioned and sorted by their place in the mix, so that the files it
    is written to hold the mixed order, file after file (``stored_order`` reads it back)."""
    rows = addressed(docs)
    place = mixed(rows.select("doc_id", "source", FILE, ROW), weights).select(
        F.col(FILE).alias("__f"), F.col(ROW).alias("__r"), F.col("mix.position").alias("__position"))
    return (rows.join(place, (F.col(FILE) == F.col("__f")) & (F.col(ROW) == F.col("__r")))
            .repartitionByRange("__position").sortWithinPartitions("__position")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def stored_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """(``docs`` with ``__place``: the row's number, from 0, in the order of the files and of the rows in them; the
    number of rows). One row per file comes to the driver."""
    rows = addressed(docs)
    files = sorted(rows.groupBy(FILE).agg((F.max(ROW) + 1).alias("n")).collect(), key=lambda r: _file_order(r[FILE]))
    begin, at = [], 0
    for r in files:
        begin.append((r[FILE], at))
        at += r["n"]
    table = docs.sparkSession.createDataFrame(begin, "__f string, __begin long")
    placed = rows.join(F.broadcast(table), F.col(FILE) == F.col("__f"))
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col("__begin") + F.col(ROW)).alias("__place")), at


def _file_order(path: str) -> tuple:
    """Spark names the file of task n part-n-..: by n, then by name."""
    name = path.rsplit("/", 1)[-1]
    number = name.split("-")[1] if name.startswith("part-") and name.count("-") > 1 else ""
    return (int(number) if number.isdigit() else 0, name)

"""Operator 1, sharding: minimax contiguous partition of atomic groups (law ``bytes``).

Rows with equal texts form one atomic group (all NULL texts form one group too). The groups stand in the
order of their text digest. The smallest capacity C for which the ordered groups fit into the shards,
each shard a contiguous run of at most C bytes, is found by binary search with a greedy check; the cuts
then go as near to equal shares as that capacity allows.

A group larger than an equal share of what is left would force C up for all; such groups (fewer than the
number of shards) stand first in the order, each in a shard of its own, and the search runs over the rest.

The driver never holds the groups. It holds a prefix histogram over digest prefixes: a capacity that is
feasible when cuts may fall only on known edges bounds C from above; one that is infeasible even when a
shard may overrun into the middle of a prefix cell bounds it from below. Only cells that can hold a cut for
a capacity between the bounds are split further (one more hexadecimal digit, one grouped query), until no
such cell holds more than one group. The histogram stays within a few cells per shard and digit, whatever
the number of groups. A shard is then a function of the digest alone: no join, no shuffle of texts.
"""

from __future__ import annotations

import bisect
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ROW_OVERHEAD = 16
FIRST_DIGITS = 3          # 4096 cells in the first histogram
RUN_ROWS = 20_000         # rows that one window of the slot numbering is meant to hold
NULL_DIGEST = "null"      # sorts after every hexadecimal digest


def _greedy_feasible(ends: list[int], sizes: list[int], single: list[bool], total: int, shards: int, cap: int,
                     optimistic: bool) -> bool:
    """Greedy check over cells. Pessimistic: cuts only after a whole cell. Optimistic: inside a cell of
    several groups a cut may fall anywhere."""
    at = 0
    for _ in range(shards):
        if at >= total:
            return True
        reach = at + cap
        i = bisect.bisect_right(ends, reach)  # cells [0, i) end within reach
        if i >= len(ends):
            return True
        if optimistic and not single[i]:
            nxt = reach
        else:
            nxt = ends[i - 1] if i else 0
            if optimistic and nxt < at:
                nxt = at
        if nxt <= at:
            return False
        at = nxt
    return at >= total


def _smallest(low: int, high: int, feasible) -> int:
    while low < high:
        mid = (low + high) // 2
        if feasible(mid):
            high = mid
        else:
            low = mid + 1
    return low


class _Cells:
    """Digest-prefix cells in order: (prefix, bytes, groups). Prefixes are disjoint and cover all digests."""

    def __init__(self, rows):
        self.rows = sorted(rows)
        self.sizes = [b for _, b, _ in self.rows]
        self.ends = []
        at = 0
        for b in self.sizes:
            at += b
            self.ends.append(at)
        self.total = at
        self.single = [g == 1 for _, _, g in self.rows]

    def feasible(self, shards, cap, optimistic):
        return _greedy_feasible(self.ends, self.sizes, self.single, self.total, shards, cap, optimistic)

    def greedy_ends(self, shards, cap, optimistic):
        """Where greedy cuts can fall at most (optimistic) or at least (pessimistic)."""
        out, at = [], 0
        for _ in range(shards):
            i = bisect.bisect_right(self.ends, at + cap)
            if i >= len(self.ends):
                out.append(self.total)
                break
            at = at + cap if optimistic and not self.single[i] else max(at, self.ends[i - 1] if i else 0)
            out.append(at)
        return out


def plan_cuts(cells_of, shards: int) -> tuple[int, list[str]]:
    """(smallest capacity, digest prefixes at which shards 1.. begin) over the ordered groups.

    ``cells_of(prefixes)`` returns (prefix, bytes, groups) of the cells one digit below the given prefixes,
    or the first histogram for None."""
    cells = _Cells(cells_of(None))
    if not cells.rows or shards <= 1:
        return cells.total, []
    while True:
        share = -(-cells.total // shards)
        floor = max([share, *(b for b, one in zip(cells.sizes, cells.single) if one)])
        low = _smallest(floor, cells.total, lambda c: cells.feasible(shards, c, True))
        high = _smallest(low, cells.total, lambda c: cells.feasible(shards, c, False))
        # a cut of any capacity in [low, high] lies between the forward greedy ends of both bounds; the balanced
        # cuts also need the cells around the equal shares
        windows = []
        pess = cells.greedy_ends(shards, low, False)
        opt = cells.greedy_ends(shards, high, True)
        for k in range(shards - 1):
            lo = pess[k] if k < len(pess) else cells.total
            hi = opt[k] if k < len(opt) else cells.total
            if low < high:
                windows.append((min(lo, hi), max(lo, hi)))
            ideal = (k + 1) * cells.total // shards
            windows.append((ideal, ideal))
        split, starts = set(), [0, *cells.ends[:-1]]
        for lo, hi in windows:
            i = max(0, bisect.bisect_left(cells.ends, lo) - (lo == hi))
            while i < len(cells.rows) and starts[i] <= hi:
                if not cells.single[i] and cells.rows[i][0] != NULL_DIGEST:
                    split.add(cells.rows[i][0])
                i += 1
        if not split:
            break
        kept = [r for r in cells.rows if r[0] not in split]
        cells = _Cells(kept + cells_of(sorted(split)))
    return high, [cells.rows[i][0] for i in _balanced(cells, shards, high)]


def _balanced(cells: _Cells, shards: int, cap: int) -> list[int]:
    """Cell indexes that begin shards 1.. : nearest to the equal shares among the cuts that keep every shard
    within ``cap`` (from the left by the cut before, from the right by greedy from the end)."""
    edges = [0, *cells.ends]
    least = [len(cells.rows)]  # least[k]: leftmost edge from which k shards reach the end
    for _ in range(shards):
        least.append(bisect.bisect_left(edges, edges[least[-1]] - cap))
    out, at = [], 0
    for k in range(1, shards):
        lo = max(at, least[shards - k])
        hi = max(lo, bisect.bisect_right(edges, edges[at] + cap) - 1)
        ideal = edges[at] + (cells.total - edges[at]) / (shards - k + 1)
        i = min(max(bisect.bisect_left(edges, ideal), lo), hi)
        if i > lo and ideal - edges[i - 1] < edges[i] - ideal:
            i -= 1
        out.append(i)
        at = i
    return [i for i in out if i < len(cells.rows)]


def shard_rows(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, text_digest, shard for every row of ``docs`` (doc_id, text).

    NULL text: size 16, text_crc32 NULL, one group. Empty text: size 16, crc 0. Repeated rows stay rows.
    An empty table gives an empty result; with fewer groups than shards the last shards stay empty."""
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(NULL_DIGEST)).alias("text_digest")), "shard-rows")
    groups = stored(rows.groupBy("text_digest").agg(F.sum("size").alias("bytes")), "shard-groups")

    # groups above the equal share of what is left: at most shards - 1, so the top `shards` groups decide
    top = groups.orderBy(F.desc("bytes"), "text_digest").limit(shards).collect()
    left = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    alone: list[str] = []
    for r in top:
        if shards - len(alone) > 1 and r["bytes"] * (shards - len(alone)) > left:
            alone.append(r["text_digest"])
            left -= r["bytes"]
        else:
            break
    rest = groups.where(~F.col("text_digest").isin(alone)) if alone else groups

    def cells_of(prefixes):
        digits = FIRST_DIGITS if prefixes is None else None
        if prefixes is None:
            found = rest.groupBy(F.substring("text_digest", 1, digits).alias("p")) if digits else rest
            got = found.agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
            return [(NULL_DIGEST if r["p"] == NULL_DIGEST[:digits] else r["p"], r["b"], r["n"]) for r in got]
        out = []
        for length in sorted({len(p) for p in prefixes}):
            mine = [p for p in prefixes if len(p) == length]
            got = (rest.where(F.substring("text_digest", 1, length).isin(mine))
                   .groupBy(F.substring("text_digest", 1, length + 1).alias("p"))
                   .agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect())
            out += [(r["p"], r["b"], r["n"]) for r in got]
        return out

    _, begins = plan_cuts(cells_of, shards - len(alone))
    shard = F.lit(len(alone)).cast("int")
    if begins:
        shard = F.lit(len(alone)) + reduce(
            lambda a, b: a + b, [(F.col("text_digest") >= b).cast("int") for b in begins])
    for i, digest in enumerate(alone):
        shard = F.when(F.col("text_digest") == digest, i).otherwise(shard)
    return rows.withColumn("shard", shard.cast("int"))


def with_slots(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within each shard, by runs of about RUN_ROWS rows (a hash of the
    doc_id and the place in a run), so that no window holds a whole shard."""
    n = rows.count()
    runs = max(1, -(-n // (shards * RUN_ROWS)) * 2)
    marked = rows.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int"))
    sizes = marked.groupBy("shard", "run").agg(F.count("*").alias("rows_in_run"))
    before = sizes.select("shard", "run", F.coalesce(
        F.sum("rows_in_run").over(Window.partitionBy("shard").orderBy("run").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # one row per run
    in_run = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "text_digest"))
    return (marked.withColumn("in_run", in_run).join(before, ["shard", "run"])
            .withColumn("slot", (F.col("before") + F.col("in_run") - 1).cast("long"))
            .drop("run", "in_run", "before"))


def op1_minimax_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Contract rows: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    placed = with_slots(shard_rows(docs, shards), shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))

"""Key rules at row level (CON-3, CON-4, CON-6): which rows of a new batch repeat a stored or an earlier key, and which
point at a parent that is not there.

Most new rows carry keys that are nowhere stored. A Bloom filter of the stored keys (``KeyFilter``) passes them without
a join; only its hits are looked up exactly, with the few hits on the small side. The filter is plain data: words of 63
bits by number, built and merged with ``bit_or`` aggregates, so it is kept as a small table next to the stored rows and
grows by merging each batch's words. Its size is chosen for the expected number of keys, MAX_WORDS at most; a fuller
filter only lets more rows through to the exact look-up, it never loses one.

Rules are named as in ``integrity``: ``pk_<table>``, ``uq_<table>_<columns>``, ``fk_<table>_<column>``. NULL keys are
ignored. Rows that break another rule hold no key. Of the others that repeat a key inside the batch one stays (the
smallest by a hash over all columns); the primary key is settled first, then the unique keys among the rows left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from ..sources.loads import row_hash
from ..sources.schemas import TABLES

ROW = "__row"
HASHES = 4
WORD_BITS = 63            # the sign bit of a long is left alone
SEGMENT = 1024            # words that one key's bits lie in
MAX_WORDS = 4_000_000     # of a filter: 32 MB, broadcast as arrays of a segment each


def keys_of(table: str) -> dict[str, tuple[str, ...]]:
    """Rule name -> key columns of a table's primary key and unique keys."""
    spec = TABLES[table]
    return {f"pk_{table}": (spec.primary_key,), **{f"uq_{table}_{'_'.join(k)}": tuple(k) for k in spec.uniques}}


def _filled(columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _bit(spot: Column) -> Column:
    """The spot's bit in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (spot % WORD_BITS).cast("int"))


class KeyFilter:
    """Bloom filter of keys as a table (word long, bits long) with one row per word; ``words`` is its length."""

    def __init__(self, table: DataFrame, words: int):
        self.table, self.words = table, words

    @staticmethod
    def size_for(keys: int, bits_per_key: int = 10) -> int:
        """Words for an expected number of keys (10 bits a key: about one false hit in a hundred)."""
        return min(MAX_WORDS, max(64, -(-keys * bits_per_key // WORD_BITS)))

    @staticmethod
    def _spots(columns: tuple[str, ...], words: int) -> list[Column]:
        """The bits of a key: all in its segment, whose last one may be shorter."""
        first = KeyFilter._segment(columns, words) * SEGMENT
        bits = F.least(F.lit(SEGMENT).cast("long"), F.lit(words) - first) * WORD_BITS
        return [first * WORD_BITS + F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), bits)
                for seed in range(HASHES)]

    @staticmethod
    def _segment(columns: tuple[str, ...], words: int) -> Column:
        """The key's segment, in proportion to the words it holds."""
        spot = F.pmod(F.xxhash64(F.lit(HASHES), *[F.col(c) for c in columns]), F.lit(words).cast("long"))
        return F.floor(spot / SEGMENT)

    @classmethod
    def of(cls, rows: DataFrame, columns: tuple[str, ...], words: int) -> "KeyFilter":
        spots = rows.where(_filled(columns)).select(F.explode(F.array(*cls._spots(columns, words))).alias("spot"))
        bit = _bit(F.col("spot"))
        set_words = spots.select(F.floor(F.col("spot") / WORD_BITS).alias("word"), bit.alias("bits"))
        every = rows.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
        return cls(set_words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits")), words)

    def merged(self, other: "KeyFilter") -> "KeyFilter":
        if self.words != other.words:
            raise ValueError("filters of different sizes")
        both = self.table.unionByName(other.table)
        return KeyFilter(both.groupBy("word").agg(F.bit_or("bits").alias("bits")), self.words)

    def may_hold(self, rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        """The rows whose key may be in the filter; the others surely are not.

        All spots of a key lie in one segment of the filter, so a row meets one short array (``SEGMENT`` words) by a
        join; neither a task nor the driver puts the words of the whole filter into one value."""
        in_part = F.struct((F.col("word") % SEGMENT).alias("at"), "bits")
        parts = (self.table.groupBy(F.floor(F.col("word") / SEGMENT).alias("__part"))
                 .agg(F.transform(F.array_sort(F.collect_list(in_part)), lambda x: x["bits"]).alias("__words")))
        found = rows.where(_filled(columns)).withColumn("__at", self._segment(columns, self.words)).join(
            F.broadcast(parts), F.col("__at") == F.col("__part"))
        hit = reduce(lambda a, b: a & b, [
            F.get("__words", F.floor((s - F.col("__part") * (SEGMENT * WORD_BITS)) / WORD_BITS).cast("int"))
            .bitwiseAND(_bit(s)) != 0 for s in self._spots(columns, self.words)])
        return found.where(hit).select(*[F.col(f"`{c}`") for c in rows.columns])


def stored_hits(batch: DataFrame, stored: DataFrame, columns: tuple[str, ...], known: KeyFilter | None = None) -> DataFrame:
    """(__row) of batch rows whose key is stored. With a filter only its hits are joined."""
    some = known.may_hold(batch, columns) if known else batch.where(_filled(columns))
    some = some.select(ROW, *columns)
    keys = stored.select(*[F.col(c).alias(f"__s_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__s_{c}") for c in columns])
    return some.join(keys, same, "left_semi").select(ROW)


def repeats_inside(batch: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(__row) of batch rows that repeat another row's key, all but one per key. Keys collapse in a partial aggregate;
    only rows of repeated keys are joined."""
    others = [c for c in batch.columns if c != ROW]
    mark = F.struct(row_hash(others, 5).alias("h"), F.col(ROW))
    filled = batch.where(_filled(columns))
    twice = (filled.groupBy(*[F.col(c).alias(f"__k_{c}") for c in columns])
             .agg(F.min(mark).alias("__first"), F.count("*").alias("__n")).where("__n > 1"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k_{c}") for c in columns])
    return filled.join(twice, same).where(F.col(ROW) != F.col("__first")[ROW]).select(ROW)


def orphans(batch: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(__row) of batch rows whose non-NULL foreign key has no parent. Distinct keys are looked up, not rows."""
    keys = batch.where(F.col(column).isNotNull()).select(F.col(column).alias("__fk")).distinct()
    lost = keys.join(parent.select(F.col(parent_column).alias("__pk")), F.col("__fk") == F.col("__pk"), "left_anti")
    return batch.join(lost, F.col(column) == F.col("__fk"), "left_semi").select(ROW)


def key_violations(batch: DataFrame, table: str, stored: DataFrame | None = None,
                   parents: dict[str, DataFrame] | None = None, filters: dict[str, KeyFilter] | None = None,
                   broken: DataFrame | None = None) -> DataFrame:
    """(__row, rules) of batch rows that break a key rule; ``batch`` has a unique column ``__row``, ``broken`` the
    ``__row`` of rows that break a row-local rule.

    A row breaks a key rule if its key is in ``stored``, or if it repeats a row of the batch that breaks no rule."""
    parts = [orphans(batch, fk.column, parents[fk.parent], fk.parent_column)
             .withColumn("rule", F.lit(f"fk_{table}_{fk.column}"))
             for fk in TABLES[table].foreign_keys if parents and fk.parent in parents]
    if stored is not None:
        parts += [stored_hits(batch, stored, columns, (filters or {}).get(rule)).withColumn("rule", F.lit(rule))
                  for rule, columns in keys_of(table).items()]
    out = reduce(DataFrame.unionByName, [p.select(ROW) for p in parts] + ([broken.select(ROW)] if broken is not None else []),
                 batch.select(ROW).limit(0))
    left = batch.join(out, ROW, "left_anti")
    for rule, columns in keys_of(table).items():
        again = repeats_inside(left, columns)
        parts.append(again.withColumn("rule", F.lit(rule)))
        left = left.join(again, ROW, "left_anti")
    return reduce(DataFrame.unionByName, parts).groupBy(ROW).agg(F.sort_array(F.collect_set("rule")).alias("rules"))


def load_rejections(t, stored, table: str) -> DataFrame:
    """CON-6 for a load: (rule, rows) rejected when all rows of ``t``'s table are loaded on top of the ``stored``
    tables, and with rule NULL the rows accepted. Parents are those of ``t``, as parents load first."""
    spec = TABLES[table]
    wanted = dict.fromkeys([c for columns in keys_of(table).values() for c in columns]
                           + [fk.column for fk in spec.foreign_keys])
    batch = scratch_table(getattr(t, table).select(*wanted).withColumn(ROW, F.monotonically_increasing_id()), "load")
    held = getattr(stored, table)
    words = KeyFilter.size_for(held.count())
    filters = {rule: KeyFilter.of(held, columns, words) for rule, columns in keys_of(table).items()}
    parents = {fk.parent: getattr(t, fk.parent) for fk in spec.foreign_keys}
    bad = scratch_table(key_violations(batch, table, held, parents, filters), "rejected")
    each = bad.select(F.explode("rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))
    good = batch.join(bad, ROW, "left_anti").agg(F.count("*").alias("rows")).select(
        F.lit(None).cast("string").alias("rule"), "rows")
    return each.unionByName(good)

"""Row order within a key, running counts, ranks and quantiles without putting a key's rows in one window.

``Ordered`` range-partitions the rows by (key, order columns), so the rows of one key that holds a third of the table,
even on one single day, lie over as many partitions as they fill. Inside a partition a window per key does the work;
what it lacks at the partition's edges comes from the neighbouring partitions' boundary rows of the same key. Only
keys that are the first or the last of a partition can reach over an edge, so there are at most a few boundary rows
per partition, and they are broadcast.

Partition numbers must survive recomputation, so the partitioned rows are written once under the shared checkpoint
folder (``session.scratch_table``); ``session.scratch_scope`` deletes such tables when their results are done."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table

PID, KEY, AT = "__pid", "__key", "__at"


class Ordered:
    """Rows of ``df`` in the order of ``order`` (columns, together unique within a key) within ``key``."""

    def __init__(self, df: DataFrame, key: str, order: tuple[str, ...], payload: tuple[str, ...] = ()):
        self.key, self.order, self.columns = key, order, list(dict.fromkeys((key, *order, *payload)))
        rows = df.select(*self.columns).repartitionByRange(key, *order)
        self.rows = scratch_table(rows.withColumn(PID, F.spark_partition_id()), "ordered")
        self.at = F.struct(*order)

    def _edge_keys(self) -> DataFrame:
        """The first and last key of every partition (at most two rows per partition)."""
        own = F.struct(F.col(self.key).alias("k"))  # a struct, as min and max pass over a bare NULL
        ends = self.rows.groupBy(PID).agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
        return ends.select(F.explode(F.array("lo", "hi")).alias("e")).select(F.col("e.k").alias(KEY)).distinct()

    def _edges(self, value: Column | None, carry: list[str]) -> DataFrame:
        """Per partition and edge key what the key's earlier and later partitions hold: rows and sum of ``value``
        before, last earlier and first later row (``carry`` columns)."""
        row = F.struct(self.at.alias("at"), F.struct(*carry).alias("row"))
        mine = self.rows.join(F.broadcast(self._edge_keys()), F.col(self.key).eqNullSafe(F.col(KEY)))
        parts = mine.groupBy(PID, KEY).agg(
            F.count("*").alias("n"), F.sum(value if value is not None else F.lit(0)).alias("total"),
            F.min(row).alias("first"), F.max(row).alias("last"))
        w = Window.partitionBy(KEY).orderBy(PID)  # a key's partitions
        earlier = w.rowsBetween(Window.unboundedPreceding, -1)
        return parts.select(
            F.col(PID).alias("__epid"), F.col(KEY),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__n"),
            F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("__total"),
            F.lag("last").over(w)["row"].alias("__prev"), F.lead("first").over(w)["row"].alias("__next"))

    def _joined(self, inner: DataFrame, value: Column | None = None, carry: list[str] | None = None) -> DataFrame:
        edges = F.broadcast(self._edges(value, carry or [self.order[-1]]))
        return inner.join(edges, (F.col(PID) == F.col("__epid")) & F.col(self.key).eqNullSafe(F.col(KEY)), "left")

    def _window(self):
        return Window.partitionBy(PID, self.key).orderBy(*self.order)

    def neighbours(self, *carry: str) -> DataFrame:
        """The rows with ``place`` (1-based position in the key) and the structs ``prev`` and ``next`` of the carried
        columns of the row before and after (NULL at the ends)."""
        w, own = self._window(), F.struct(*carry)
        inner = self.rows.select("*", F.row_number().over(w).alias("__rk"), F.lag(own).over(w).alias("__lag"),
                                 F.lead(own).over(w).alias("__lead"))
        return self._joined(inner, carry=list(carry)).select(
            *self.columns, (F.col("__rk") + F.coalesce("__n", F.lit(0))).cast("long").alias("place"),
            F.coalesce("__lag", "__prev").alias("prev"), F.coalesce("__lead", "__next").alias("next"))

    def sum_before(self, value: Column, out: str) -> DataFrame:
        """The rows with ``out``: the sum of ``value`` over the key's earlier rows."""
        w = self._window().rowsBetween(Window.unboundedPreceding, -1)
        inner = self.rows.select("*", F.coalesce(F.sum(value).over(w), F.lit(0)).alias("__in"))
        return self._joined(inner, value=value).select(
            *self.columns, (F.col("__in") + F.coalesce("__total", F.lit(0))).cast("long").alias(out))


def ordered_neighbours(df: DataFrame, key: str, day: str, row_id: str) -> DataFrame:
    """(row_id, seq, prev_id, next_id, next_day) in the order (day, id) within ``key``; ``next_day`` is the next
    row's ``day``."""
    found = Ordered(df, key, (day, row_id)).neighbours(day, row_id)
    return found.select(row_id, F.col("place").cast("int").alias("seq"), F.col(f"prev.{row_id}").alias("prev_id"),
                        F.col(f"next.{row_id}").alias("next_id"), F.col(f"next.{day}").alias("next_day"))


def with_rows_before(counts: DataFrame, col: str, n: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``before``: the sum of ``n`` over rows with a smaller ``col`` (within ``by``); ``counts`` has one
    row per distinct value.

    The values are range-partitioned and written once (so partition ids survive recomputation); each partition's
    total gives an offset (one row per partition and group), and a window inside each partition does the rest. No
    partition holds all values."""
    staged = scratch_table(counts.repartitionByRange(*by, col).withColumn(PID, F.spark_partition_id()), "counted")
    totals = staged.groupBy(PID, *by).agg(F.sum(n).alias("__tot"))
    wo = Window.partitionBy(*by) if by else Window.partitionBy()
    offsets = totals.select(F.col(PID).alias("__opid"), *[F.col(b).alias(f"__o_{b}") for b in by],
                            F.coalesce(F.sum("__tot").over(
                                wo.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    w = Window.partitionBy(PID, *by).orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    within = staged.withColumn("__in", F.coalesce(F.sum(n).over(w), F.lit(0)))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__o_{b}")) for b in by], F.col(PID) == F.col("__opid"))
    return (within.join(offsets, same).withColumn("before", F.col("__off") + F.col("__in"))
            .drop(PID, "__opid", *[f"__o_{b}" for b in by], "__off", "__in"))


def quantiles_together(df: DataFrame, points: tuple[float, ...], wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """Exact quantiles of several columns at once: (metric, part, cuts) with one row per column named in ``wanted``
    and group of the columns that stand for it there (``part``: their values as text, '' without any).

    For each point p a cut is the smallest value that has at least p * n of the n non-NULL values at or below it.
    The input is read once: every row becomes one (metric, part, value) per column, equal values collapse by a partial
    aggregate, and one range sort gives the running counts of all columns and groups together."""
    part = lambda by: F.concat_ws("\x1f", *[F.coalesce(F.col(b).cast("string"), F.lit("\x00")) for b in by]) if by else F.lit("")
    each = F.array(*[F.struct(F.lit(name).alias("metric"), part(by).alias("part"),
                              F.col(name).cast("decimal(28,6)").alias("value")) for name, by in wanted.items()])
    rows = df.select(F.explode(each).alias("e")).select("e.*").where("value is not null")
    counts = rows.groupBy("metric", "part", "value").agg(F.count("*").alias("__n"))
    ranked = with_rows_before(counts, "value", "__n", ("metric", "part"))
    # the group's size is the largest running count: read from the written counts again, not from the input
    upto = F.col("before") + F.col("__n")
    sizes = ranked.groupBy("metric", "part").agg(F.max(upto).alias("__all")).select(
        F.col("metric").alias("__m"), F.col("part").alias("__p"), "__all")
    return (ranked.join(sizes, (F.col("metric") == F.col("__m")) & (F.col("part") == F.col("__p")))
            .groupBy("metric", "part").agg(F.array(*[
                F.min(F.when(upto >= F.ceil(F.lit(p) * F.col("__all")), F.col("value"))) for p in points]).alias("cuts")))


def quantiles(df: DataFrame, col: str, points: tuple[float, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group of ``by`` with ``cuts``: for each point p the smallest value that has at least
    p * n of the n values at or below it. Exact at every size: equal values collapse by a partial
    aggregate, and the running counts come from ``with_rows_before``."""
    counts = df.groupBy(*by, col).agg(F.count("*").alias("__n"))
    ranked = with_rows_before(counts, col, "__n", by)
    if by:
        ranked = ranked.join(df.groupBy(*by).agg(F.count("*").alias("__all")), list(by))
    else:
        ranked = ranked.withColumn("__all", df.agg(F.count("*")).scalar())
    upto = F.col("before") + F.col("__n")
    return ranked.groupBy(*by).agg(F.array(*[
        F.min(F.when(upto >= F.ceil(F.lit(p) * F.col("__all")), F.col(col))) for p in points]).alias("cuts"))


def descending_rank(df: DataFrame, col: str, out: str = "rank", by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``rank() over (partition by by order by col desc)`` without a window over a group's rows.

    Ties collapse first (distinct values with their counts: a partial aggregate, so a value shared by a
    third of the rows is one row); ``with_rows_before`` counts the rows above each value.
    rank(v) = 1 + rows with a greater value. ``col`` must be non-NULL and numeric; NULLs of ``by`` are a
    group of their own."""
    groups = tuple(f"__by{i}" for i in range(len(by)))
    keyed = df.select("*", *[F.coalesce(F.col(b).cast("string"), F.lit("")).alias(g) for b, g in zip(by, groups)],
                      (-F.col(col)).alias("__neg"))
    counts = keyed.groupBy(*groups, "__neg").agg(F.count("*").alias("__n"))
    ranks = with_rows_before(counts, "__neg", "__n", groups).select(
        *groups, "__neg", (F.col("before") + 1).cast("int").alias(out))
    return keyed.join(ranks, [*groups, "__neg"]).drop(*groups, "__neg")


def sequence_ranks(steps: DataFrame, key: str, pos: str, label: str, block: int = 16) -> DataFrame:
    """(key, steps, rank) for sequences given as rows (key, pos from 1, label): equal ranks mean equal sequences, and
    ranks order sequences by their labels, a shorter one before its extensions.

    Prefix doubling: the first round ranks blocks of ``block`` labels (as text), each further round ranks pairs of
    neighbouring blocks by their two ranks, until one block covers the longest sequence. The rows halve from round to
    round, no row holds more than ``block`` labels, and no task holds a sequence. Ranks are counted over distinct
    blocks that are sorted by range."""
    blocks = scratch_table(
        steps.groupBy(key, F.floor((F.col(pos) - 1) / block).alias("b"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, label))), lambda x: x[label]),
                          "\x1f").alias("v"), F.count("*").alias("n")), "blocks")
    lengths = blocks.groupBy(key).agg(F.sum("n").alias("steps"))
    longest = -(-(lengths.agg(F.max("steps")).first()[0] or 0) // block)
    ranked = _ranked(blocks.select(key, "b", "v"), key)
    while longest > 1:
        half = lambda side: F.max(F.when(F.col("b") % 2 == side, F.col("r")))
        pairs = ranked.groupBy(key, F.floor(F.col("b") / 2).alias("b")).agg(
            F.struct(half(0).alias("left"), F.coalesce(half(1), F.lit(0)).alias("right")).alias("v"))
        ranked, longest = _ranked(scratch_table(pairs, "pairs"), key), -(-longest // 2)
    return lengths.join(ranked.select(F.col(key).alias("__k"), F.col("r").alias("rank")),
                        F.col(key).eqNullSafe(F.col("__k"))).select(key, F.col("steps").cast("long").alias("steps"), "rank")


def _ranked(rows: DataFrame, key: str) -> DataFrame:
    """(key, b, r): the rank of each row's value ``v`` among the distinct ones, from 1. ``rows`` are read twice."""
    values = with_rows_before(rows.select("v").distinct().withColumn("n", F.lit(1)), "v", "n")
    ranks = values.select(F.col("v").alias("__v"), (F.col("before") + 1).cast("long").alias("r"))
    return scratch_table(rows.join(ranks, F.col("v") == F.col("__v")).select(key, "b", "r"), "ranks")

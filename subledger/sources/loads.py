"""Load history: whole loads of the twelve tables kept side by side, and what changed between any two (DOC-19, DOC-21).

Layout under the store's folder: ``<load_id>/<table>/`` holds a load's tables as ``io.write_tables`` lays them out
(large facts by month), ``<load_id>/_manifest/`` one row per table and month: its number of rows and a digest, the
sum of two 64-bit hashes over whole rows, which does not depend on the order of rows or files. The manifest is
written last: a load that broke off has none, is not listed and can be written again under its id.

A comparison reads the two manifests first. Months whose rows and digest agree are not read at all; of the others
every row becomes (key, row hash), and one partial aggregate by key tells inserted, changed and deleted keys. Only
changed keys are joined to name the columns that differ. A key that moves to another month changes both months'
digests, so it is found."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_path
from . import io
from .schemas import LOAD_ORDER, TABLES

MANIFEST = ("load_id string, loaded_at timestamp_ntz, table_name string, part_month string, rows long, "
            "digest_a decimal(38,0), digest_b decimal(38,0)")


def row_hash(columns: list[str], seed: int) -> Column:
    """64-bit hash of whole rows; NULLs count at their place (a plain xxhash64 skips them)."""
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in columns])


def _digest(seed: int, columns: list[str]) -> Column:
    return F.coalesce(F.sum(row_hash(columns, seed).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


class LoadStore:
    """Loads of the twelve tables under ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, load_id: str, name: str) -> str:
        return os.path.join(self.path, load_id, name)

    def write(self, t, load_id: str, loaded_at: str, names: tuple[str, ...] = tuple(LOAD_ORDER),
              by_month: bool = False) -> DataFrame:
        """Write the twelve tables of ``t`` (or those named) as one load; returns its manifest. An existing load is
        never changed. ``by_month``: ``t`` reads files by month, as those of another load."""
        if not load_id or load_id.startswith(("_", ".")) or "/" in load_id:
            raise ValueError(f"not a load id: {load_id!r}")
        if path_exists(self.spark, self._folder(load_id, "_manifest/_SUCCESS")):
            raise ValueError(f"load {load_id} exists")
        parts = []
        for name in names:
            io.write_table(getattr(t, name), name, os.path.join(self.path, load_id), by_month=by_month)
            rows, columns = self._stored(load_id, name), TABLES[name].column_names
            parts.append(rows.groupBy("part_month").agg(F.count("*").alias("rows"), _digest(1, columns).alias("digest_a"),
                                                        _digest(2, columns).alias("digest_b"))
                         .select(F.lit(load_id).alias("load_id"),
                                 F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
                                 F.lit(name).alias("table_name"), "part_month", "rows", "digest_a", "digest_b"))
        target = self._folder(load_id, "_manifest")
        remove_path(self.spark, target)  # of a load that broke off while it was written
        reduce(DataFrame.unionByName, parts).coalesce(1).write.parquet(target)  # tables x months rows
        return self.manifest(load_id)

    def manifest(self, load_id: str) -> DataFrame:
        """Rows and digests of one load by table and month (NULL for tables without months)."""
        if not path_exists(self.spark, self._folder(load_id, "_manifest/_SUCCESS")):
            raise ValueError(f"no load {load_id}")
        return self.spark.read.schema(MANIFEST).parquet(self._folder(load_id, "_manifest"))

    def loads(self) -> DataFrame:
        """(load_id, loaded_at, tables, rows) of every complete load, oldest first."""
        try:
            every = self.spark.read.schema(MANIFEST).parquet(os.path.join(self.path, "*", "_manifest"))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            every = self.spark.createDataFrame([], MANIFEST)
        return (every.groupBy("load_id", "loaded_at")
                .agg(F.countDistinct("table_name").alias("tables"), F.sum("rows").alias("rows"))
                .orderBy("loaded_at", "load_id"))

    def tables(self, load_id: str, like, names: tuple[str, ...] = tuple(LOAD_ORDER)):
        """A load (its tables ``names``) as a ``Tables`` view (``like`` gives the rest of it)."""
        self.manifest(load_id)
        return like.with_tables(**{n: io.read_table(self.spark, n, os.path.join(self.path, load_id)) for n in names})

    def _stored(self, load_id: str, name: str) -> DataFrame:
        """A stored table with its month (NULL for tables without months)."""
        schema = TABLES[name].schema
        if name in io.FACT_LAYOUT:
            full = type(schema)(list(schema.fields)).add("part_month", "string")
            return self.spark.read.schema(full).parquet(self._folder(load_id, name))
        return (self.spark.read.schema(schema).parquet(self._folder(load_id, name))
                .withColumn("part_month", F.lit(None).cast("string")))

    def _months(self, earlier: str, later: str) -> DataFrame:
        """Tables and months of both loads: table_name, part_month, same, rows (of the later load)."""
        both = self.manifest(earlier).unionByName(self.manifest(later))
        side = lambda col, load: F.max(F.when(F.col("load_id") == load, F.col(col)))
        marks = ("rows", "digest_a", "digest_b")
        same = reduce(lambda a, b: a & b, [side(c, earlier).eqNullSafe(side(c, later)) for c in marks])
        return both.groupBy("table_name", "part_month").agg(
            same.alias("same"), F.coalesce(side("rows", later), F.lit(0)).alias("rows"))

    def differing(self, earlier: str, later: str, name: str) -> tuple[DataFrame, DataFrame]:
        """The rows of one table in both loads, restricted to the months that differ (bounded by the calendar)."""
        months = [r["part_month"] for r in self._months(earlier, later).where(
            (F.col("table_name") == name) & ~F.col("same")).collect()]
        named = [m for m in months if m is not None]
        wanted = F.col("part_month").isin(named) if named else F.lit(False)
        if None in months:
            wanted = wanted | F.col("part_month").isNull()
        columns = TABLES[name].column_names
        return tuple(self._stored(load, name).where(wanted).select(*columns) for load in (earlier, later))

    def unchanged(self, earlier: str, later: str, name: str) -> DataFrame:
        """The later load's rows of the months in which both loads agree."""
        months = [r["part_month"] for r in self._months(earlier, later).where(
            (F.col("table_name") == name) & F.col("same")).collect()]
        named = [m for m in months if m is not None]
        wanted = F.col("part_month").isin(named) if named else F.lit(False)
        if None in months:
            wanted = wanted | F.col("part_month").isNull()
        return self._stored(later, name).where(wanted).select(*TABLES[name].column_names)

    def changes(self, earlier: str, later: str, name: str) -> DataFrame:
        """One row per key that was inserted, changed or deleted: the key, change, earlier_rows, later_rows and
        changed_columns (in table order; NULL unless the key stands once in both loads).

        A repeated key is compared as a bag of rows; NULL keys are one key. Same loads give no row."""
        return changed_keys(*self.differing(earlier, later, name), TABLES[name].primary_key)

    def change_counts(self, earlier: str, later: str) -> DataFrame:
        """Per table: inserted, changed and deleted keys and unchanged rows."""
        months = self._months(earlier, later)
        skipped = months.groupBy("table_name").agg(
            F.coalesce(F.sum(F.when(F.col("same"), F.col("rows"))), F.lit(0)).alias("skipped"))
        parts = []
        for name in LOAD_ORDER:
            old, new = self.differing(earlier, later, name)
            marks = _compared(old, new, TABLES[name].primary_key)
            count = lambda kind: F.count_if(F.col("change") == kind)
            parts.append(marks.agg(count("insert").alias("inserted"), count("change").alias("changed"),
                                   count("delete").alias("deleted"),
                                   F.coalesce(F.sum(F.when(F.col("change") == "same", F.col("later_rows"))), F.lit(0))
                                   .alias("same_rows")).select(F.lit(name).alias("table_name"), "*"))
        return (reduce(DataFrame.unionByName, parts).join(skipped, "table_name", "left")
                .select("table_name", "inserted", "changed", "deleted",
                        (F.col("same_rows") + F.coalesce("skipped", F.lit(0))).cast("long").alias("unchanged")))


def _compared(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, change, earlier_rows, later_rows) with change in insert, change, delete, same."""
    columns = old.columns

    def side(df, rows_old, rows_new):
        return df.select(key, row_hash(columns, 1).cast("decimal(20,0)").alias("a"),
                         row_hash(columns, 2).cast("decimal(20,0)").alias("b"),
                         F.lit(rows_old).alias("o"), F.lit(rows_new).alias("n"))

    both = side(old, 1, 0).unionByName(side(new, 0, 1))
    bag = lambda h, s: F.sum(F.when(F.col(s) == 1, F.col(h)))
    same = bag("a", "o").eqNullSafe(bag("a", "n")) & bag("b", "o").eqNullSafe(bag("b", "n"))
    return both.groupBy(key).agg(
        F.sum("o").alias("earlier_rows"), F.sum("n").alias("later_rows"), same.alias("__same")).select(
        key, F.when(F.col("earlier_rows") == 0, "insert").when(F.col("later_rows") == 0, "delete")
        .when(F.col("__same") & (F.col("earlier_rows") == F.col("later_rows")), "same").otherwise("change").alias("change"),
        "earlier_rows", "later_rows")


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The keys that differ between two states of a table, with the columns that do."""
    marks = _compared(old, new, key).where(F.col("change") != "same")
    once = marks.where((F.col("change") == "change") & (F.col("earlier_rows") == 1) & (F.col("later_rows") == 1)).select(key)
    others = [c for c in old.columns if c != key]
    named = lambda df, name: df.select(key, F.struct(*others).alias(name))
    pair = (once.join(named(old, "__old"), once[key].eqNullSafe(old[key])).drop(old[key])
            .join(named(new, "__new").withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key"))).drop("__key"))
    diff = pair.select(F.col(key).alias("__key"), F.array_compact(F.array(*[
        F.when(~F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")), F.lit(c)) for c in others])).alias("changed_columns"))
    return (marks.join(diff, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
            .select(key, "change", "earlier_rows", "later_rows", "changed_columns"))

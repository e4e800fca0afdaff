"""Integrity operators (CON-*): the schema's constraints checked as Spark jobs.

Spark enforces none of the declared constraints, so each becomes a
validation that returns violations as rows ``(rule, table_name, kind,
violations, rows)`` instead of rejecting writes.

SQL three-valued logic is kept: a CHECK fails only when its predicate is
FALSE (``lenient``, the database's behaviour); ``strict`` also fails it when
the predicate is NULL (e.g. an organisation subscription with NULL seats).

Scale notes: not-null, length and CHECK rules of one table are evaluated in a
single aggregate pass (one scan, partial aggregation, one tiny shuffle).
Uniqueness is a grouped count on the key (partial aggregation first, so a hot
key costs one row per partition). Foreign keys are ``left_anti`` joins; the
fixed reference tables are broadcast, other parents are left to Catalyst/AQE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import LOAD_ORDER, TABLES

REPORT_COLUMNS = ["rule", "table_name", "kind", "violations", "rows"]
BOUNDED_PARENTS = {"products", "plans"}  # fixed seed tables: always tiny


def _report(table: str, kind, counts: dict, df: DataFrame) -> DataFrame:
    """One aggregate pass over ``df`` turned into one report row per rule. ``counts`` maps rule ->
    count expression, or rule -> (kind, count expression) when ``kind`` is None."""
    if not counts:
        return None
    names = list(counts)
    kinds = {n: (counts[n][0] if kind is None else kind) for n in names}
    exprs = {n: (counts[n][1] if kind is None else counts[n]) for n in names}
    agg = df.agg(F.count("*").alias("__rows"), *[exprs[n].alias(f"c{i}") for i, n in enumerate(names)])
    stack = ", ".join(f"'{n}', '{kinds[n]}', c{i}" for i, n in enumerate(names))
    return agg.selectExpr(f"stack({len(names)}, {stack}) as (rule, kind, violations)", "__rows").select(
        "rule", F.lit(table).alias("table_name"), "kind",
        F.col("violations").cast("bigint").alias("violations"), F.col("__rows").cast("bigint").alias("rows"))


def _union(parts) -> DataFrame:
    parts = [p for p in parts if p is not None]
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def _tables(t, names):
    return [(n, getattr(t, n)) for n in (names or LOAD_ORDER)]


def not_null_violations(t, tables=None) -> DataFrame:
    """CON-1: required columns holding NULL."""
    return _union(
        _report(n, "not_null", {f"nn_{n}_{c.name}": F.count_if(F.col(c.name).isNull())
                                for c in TABLES[n].columns if not c.nullable}, df)
        for n, df in _tables(t, tables))


def length_violations(t, tables=None) -> DataFrame:
    """CON-2: strings longer than their VARCHAR(n)."""
    return _union(
        _report(n, "length", {f"len_{n}_{c.name}": F.count_if(F.length(c.name) > c.length)
                              for c in TABLES[n].columns if c.length}, df)
        for n, df in _tables(t, tables))


def _unique_counts(t, tables=None) -> DataFrame:
    """(rule, table_name, kind, violations): rows whose PK / UNIQUE key appears more than once."""
    parts = []
    for n, df in _tables(t, tables):
        keys = [(f"pk_{n}", (TABLES[n].primary_key,))] + [
            (f"uq_{n}_{'_'.join(k)}", k) for k in TABLES[n].uniques]
        for rule, key in keys:
            notnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
            dup = (df.filter(notnull).groupBy(*key).count().filter("count > 1")
                   .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("violations")))
            parts.append(dup.select(F.lit(rule).alias("rule"), F.lit(n).alias("table_name"),
                                    F.lit("unique").alias("kind"), "violations"))
    return _union(parts)


def unique_violations(t, tables=None) -> DataFrame:
    """CON-3: rows whose primary key or unique key appears more than once (NULL keys ignored)."""
    return _unique_counts(t, tables).join(_table_rows(t, tables), "table_name").select(*REPORT_COLUMNS)


def _fk_orphans(t, tables=None) -> DataFrame:
    """(rule, table_name, violations) for every foreign key, one anti-join per *parent*: the keys
    of all children pointing at the same parent are tagged with their rule and checked together,
    so each parent's keys are shuffled once however many tables reference it."""
    by_parent: dict[str, list] = {}
    for n, df in _tables(t, tables):
        for fk in TABLES[n].foreign_keys:
            by_parent.setdefault(fk.parent, []).append((n, df, fk))
    parts = []
    for parent, items in by_parent.items():
        pk_col = items[0][2].parent_column
        # distinct child keys with their counts: one row per key and task crosses the network
        keys = reduce(DataFrame.unionByName, [
            df.filter(F.col(fk.column).isNotNull()).groupBy(F.col(fk.column).alias("__fk"))
            .agg(F.count("*").alias("__n")).withColumn("rule", F.lit(f"fk_{n}_{fk.column}")) for n, df, fk in items])
        pk = getattr(t, parent).select(F.col(pk_col).alias("__pk"))
        if parent in BOUNDED_PARENTS:
            pk = F.broadcast(pk)
        orphans = keys.join(pk, keys.__fk == pk.__pk, "left_anti")
        rules = [(f"fk_{n}_{fk.column}", n) for n, _, fk in items]
        counts = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("rule") == r, F.col("__n"))), F.lit(0)).alias(f"c{i}")
                               for i, (r, _) in enumerate(rules)])
        stack = ", ".join(f"'{r}', '{n}', c{i}" for i, (r, n) in enumerate(rules))
        parts.append(counts.selectExpr(f"stack({len(rules)}, {stack}) as (rule, table_name, violations)")
                     .select("rule", "table_name", F.col("violations").cast("bigint").alias("violations")))
    return _union(parts)


def _table_rows(t, tables=None) -> DataFrame:
    return _union(df.agg(F.count("*").cast("bigint").alias("rows")).select(F.lit(n).alias("table_name"), "rows")
                  for n, df in _tables(t, tables))


def fk_violations(t, tables=None) -> DataFrame:
    """CON-4: child rows whose non-NULL foreign key has no parent row."""
    orphans = _fk_orphans(t, tables)
    if orphans is None:
        return None
    return (orphans.join(_table_rows(t, tables), "table_name")
            .select("rule", "table_name", F.lit("foreign_key").alias("kind"), "violations", "rows"))


def check_predicate(pred: str, mode: str = "lenient") -> Column:
    """Violation condition of a CHECK predicate: FALSE fails; NULL fails only in strict mode."""
    p = F.expr(pred)
    return ~p if mode == "lenient" else ~F.coalesce(p, F.lit(False))


def check_violations(t, mode: str = "lenient", tables=None) -> DataFrame:
    """CON-5: CHECK constraints, all of one table in one aggregate pass."""
    return _union(
        _report(n, f"check_{mode}", {name: F.count_if(check_predicate(pred, mode)) for name, pred in TABLES[n].checks},
                df)
        for n, df in _tables(t, tables))


def integrity_report(t, mode: str = "lenient", tables=None) -> DataFrame:
    """CON-6: every rule of CON-1..5 as one report.

    All row-local rules of a table (not-null, length, CHECK) share one aggregate pass that also
    counts the table's rows; uniqueness costs one grouped count per key; foreign keys one
    anti-join per parent table."""
    local = _union(
        _report(n, None, {
            **{f"nn_{n}_{c.name}": ("not_null", F.count_if(F.col(c.name).isNull()))
               for c in TABLES[n].columns if not c.nullable},
            **{f"len_{n}_{c.name}": ("length", F.count_if(F.length(c.name) > c.length))
               for c in TABLES[n].columns if c.length},
            **{name: (f"check_{mode}", F.count_if(check_predicate(pred, mode))) for name, pred in TABLES[n].checks},
        }, df)
        for n, df in _tables(t, tables))
    rows = local.select("table_name", "rows").distinct()
    orphans = _fk_orphans(t, tables)
    keyed = _union([_unique_counts(t, tables),
                    orphans.withColumn("kind", F.lit("foreign_key")) if orphans is not None else None])
    if keyed is None:
        return local
    return local.unionByName(keyed.join(rows, "table_name").select(*REPORT_COLUMNS))


def quarantine(df: DataFrame, table: str, mode: str = "lenient") -> DataFrame:
    """CON-6 row-level variant: add ``violated_rules`` (array of row-local rules broken).

    Split with ``filter(size(violated_rules) = 0)`` into good and rejected rows."""
    spec = TABLES[table]
    flags = [F.when(F.col(c.name).isNull(), F.lit(f"nn_{table}_{c.name}")) for c in spec.columns if not c.nullable]
    flags += [F.when(F.length(c.name) > c.length, F.lit(f"len_{table}_{c.name}")) for c in spec.columns if c.length]
    flags += [F.when(check_predicate(pred, mode), F.lit(name)) for name, pred in spec.checks]
    return df.withColumn("violated_rules", F.array_compact(F.array(*flags)))


def quarantine_summary(t, mode: str = "lenient") -> DataFrame:
    """Good vs rejected row counts per table under the row-local rules."""
    return _union(
        quarantine(df, n, mode).groupBy(F.lit(n).alias("table_name")).agg(
            F.count_if(F.size("violated_rules") == 0).cast("bigint").alias("good_rows"),
            F.count_if(F.size("violated_rules") > 0).cast("bigint").alias("rejected_rows"))
        for n, df in _tables(t, None))


def apply_defaults(df: DataFrame, table: str, load_time: str) -> DataFrame:
    """CON-7: add a defaulted column only when it is absent (an explicit NULL must still fail CON-1).

    ``load_time`` replaces CURRENT_TIMESTAMP so loads are reproducible."""
    spec = TABLES[table]
    for col, default in spec.defaults.items():
        if col in df.columns:
            continue
        dtype = spec.schema[col].dataType
        value = F.lit(load_time).cast(dtype) if default == "load_time" else F.expr(default).cast(dtype)
        df = df.withColumn(col, value)
    return df.select(*spec.column_names)

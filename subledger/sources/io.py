"""Typed reads and writes of the twelve tables (SRC-4..6).

CSV keeps no types, so CSV is always read with the declared schema (never
``inferSchema``); malformed rows are kept apart in ``_corrupt_record``
instead of being dropped. Parquet is the default format. Large fact tables
are written partitioned by month and sorted by their lookup key so later
scans prune partitions and skip row groups.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import LOAD_ORDER, TABLES

# table -> (month column to partition by, key to sort within files by)
FACT_LAYOUT = {
    "payments": ("payment_attempted_at", "subscription_id"),
    "subscription_events": ("event_at", "subscription_id"),
    "customer_engagement": ("engagement_date", "customer_id"),
    "marketing_touchpoints": ("touchpoint_at", "customer_id"),
    "support_interactions": ("interaction_at", "customer_id"),
}
CORRUPT = "_corrupt_record"


def write_table(df: DataFrame, name: str, path: str, fmt: str = "parquet", by_month: bool = False) -> str:
    """Write one table (overwrite). CSV gets a header; Parquet facts are month-partitioned. ``by_month``: the rows
    come from files by month already, so they are not dealt out again."""
    target = os.path.join(path, name)
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(target)
        return target
    layout = FACT_LAYOUT.get(name)
    if layout:
        when, key = layout
        # a month is dealt over many tasks by the key, so a heavy month is not one task; AQE merges
        # small pieces and splits large ones
        df = df.withColumn("part_month", F.date_format(F.col(when), "yyyy-MM"))
        df = (df if by_month else df.hint("rebalance", "part_month", key)).sortWithinPartitions("part_month", key)
        df.write.mode("overwrite").partitionBy("part_month").parquet(target)
    else:
        df.write.mode("overwrite").parquet(target)
    return target


def write_tables(t, path: str, fmt: str = "parquet") -> dict[str, str]:
    """SRC-4/5: all twelve tables, parents first."""
    return {n: write_table(getattr(t, n), n, path, fmt) for n in LOAD_ORDER}


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", with_rejects: bool = False):
    """SRC-6: typed read. For CSV with ``with_rejects`` returns (rows, rejected raw lines)."""
    schema = TABLES[name].schema
    src = os.path.join(path, name)
    if fmt == "csv":
        # Parse once (PERMISSIVE keeps malformed lines in _corrupt_record) and stage the parsed rows
        # as Parquet in the shared checkpoint folder: good rows and rejects are then split from the
        # staged copy, so no later query depends on re-parsing (Spark refuses scans that read only
        # the corrupt-record column, e.g. a bare count of the good rows).
        from ..session import scratch_path

        full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
        parsed = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT).csv(src))
        stage = scratch_path(spark, f"staged-{name}")
        parsed.write.mode("overwrite").parquet(stage)
        staged = spark.read.parquet(stage)
        good = staged.filter(F.col(CORRUPT).isNull()).select(*TABLES[name].column_names)
        if with_rejects:
            return good, staged.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
        return good
    df = spark.read.schema(schema).parquet(src)
    return df.select(*TABLES[name].column_names)


def load_tables(spark: SparkSession, path: str, fmt: str = "parquet", like=None):
    """All twelve stored tables as a ``Tables`` view (reading, not deriving)."""
    from .fixtures import Tables

    base = like or Tables(spark, path)
    return base.with_tables(**{n: read_table(spark, n, path, fmt) for n in LOAD_ORDER})


# Tables keyed by subscription: bucketing them identically lets joins on subscription_id read
# matching buckets side by side instead of shuffling both inputs.
BUCKET_KEYS = {
    "subscriptions": "subscription_id",
    "payments": "subscription_id",
    "subscription_events": "subscription_id",
    "organisation_users": "subscription_id",
}


def write_bucketed_tables(t, path: str, buckets: int, prefix: str = "subledger") -> dict[str, str]:
    """Write the twelve tables as catalog tables under ``path``; the subscription-keyed ones
    bucketed and sorted by ``subscription_id`` into ``buckets`` buckets (one bucket count for all,
    so their joins need no exchange). Returns table name -> catalog table name."""
    names = {}
    for n in LOAD_ORDER:
        table = f"{prefix}_{n}"
        w = getattr(t, n).write.mode("overwrite").option("path", os.path.join(path, n)).format("parquet")
        key = BUCKET_KEYS.get(n)
        if key:
            w = w.bucketBy(buckets, key).sortBy(key)
        w.saveAsTable(table)
        names[n] = table
    return names


def load_bucketed_tables(spark: SparkSession, names: dict[str, str], like):
    """A ``Tables`` view over tables written by ``write_bucketed_tables``."""
    return like.with_tables(**{n: spark.table(tbl).select(*TABLES[n].column_names) for n, tbl in names.items()})

"""Constraint-enforcing ingest of the append-only fact tables with Structured Streaming.

The schema's constraints are enforced by the database on every insert; on
Spark the same guarantee is an ingest stream: new files of a table are read
with its declared schema, each micro-batch is checked (row-local rules, primary
and unique keys against the batch itself and everything stored before, foreign
keys against the parent tables), good rows are appended to the table and broken
rows go to a quarantine folder with the rules they broke.

Stored keys are met through a Bloom filter per key, kept as a small table beside
each batch's rows: a batch's filter is the one before it merged with its own
keys, so a new batch reads one filter and looks up only its hits
(``operators.keys``).

``foreachBatch`` writes are keyed by the batch id (one folder per batch,
overwrite), and a batch is checked against batches with smaller ids only, so a
batch replayed after a failure finds what it found before and rewrites the same
output: restarts from the checkpoint are idempotent. The checkpoint lives in the
cluster's shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.integrity import quarantine
from ..operators.keys import ROW, KeyFilter, key_violations, keys_of
from ..session import checkpoint_dir, path_exists, scratch_scope, scratch_table
from ..sources.schemas import TABLES

FILTER_KEYS = 1_000_000   # keys that a filter is made for; more only cost more exact look-ups


def _stored(spark: SparkSession, table: str, target_dir: str, batch_id: int) -> DataFrame | None:
    """Rows of the batches before ``batch_id``; batch ids count up from 0."""
    if not path_exists(spark, target_dir):
        return None
    schema = type(TABLES[table].schema)(list(TABLES[table].schema.fields)).add("batch", "long")
    rows = spark.read.schema(schema).parquet(target_dir).where(F.col("batch") < batch_id)
    return rows.select(*TABLES[table].column_names)


def _filters(spark: SparkSession, table: str, folder: str, batch_id: int) -> dict[str, KeyFilter]:
    """The filters written with the batch before this one ({}: there is none, all keys are looked up)."""
    out = {}
    for rule in keys_of(table):
        path = os.path.join(folder, f"batch={batch_id - 1}", rule)
        if path_exists(spark, os.path.join(path, "_SUCCESS")):
            out[rule] = KeyFilter(spark.read.parquet(path), KeyFilter.size_for(FILTER_KEYS))
    return out


def check_batch(batch: DataFrame, table: str, mode: str, parents: dict[str, DataFrame] | None,
                stored: DataFrame | None, filters: dict[str, KeyFilter]) -> DataFrame:
    """The rows of ``batch`` (with ``__row``) and ``violated_rules``: row-local rules first, then key rules."""
    local = quarantine(batch, table, mode)
    bad = key_violations(batch, table, stored, parents, filters, local.where(F.size("violated_rules") > 0))
    none = F.array().cast("array<string>")
    return (local.join(bad, ROW, "left")
            .withColumn("violated_rules", F.concat("violated_rules", F.coalesce("rules", none)))
            .select(*[c for c in local.columns if c != ROW]))


def start_ingest(spark: SparkSession, table: str, source_dir: str, target_dir: str, quarantine_dir: str,
                 parents: dict[str, DataFrame] | None = None, fmt: str = "parquet", mode: str = "lenient",
                 checkpoint: str | None = None, available_now: bool = True):
    """Start the ingest stream for ``table``; returns the ``StreamingQuery``."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), f"ingest-{table}")
    reader = spark.readStream.schema(TABLES[table].schema)
    stream = reader.option("header", True).csv(source_dir) if fmt == "csv" else reader.parquet(source_dir)

    filter_dir = os.path.join(ckpt, "key-segments")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope():
            # written once with row numbers: rules name rows, and every check reads the same rows
            rows = scratch_table(batch.withColumn(ROW, F.monotonically_increasing_id()), f"ingest-{table}")
            stored = _stored(spark, table, target_dir, batch_id)
            filters = _filters(spark, table, filter_dir, batch_id) if stored is not None else {}
            checked = scratch_table(check_batch(rows, table, mode, parents, stored, filters), f"checked-{table}")
            good = checked.filter(F.size("violated_rules") == 0).drop("violated_rules")
            bad = checked.filter(F.size("violated_rules") > 0).withColumn("batch_id", F.lit(batch_id))
            for rule, columns in keys_of(table).items():
                own = KeyFilter.of(good, columns, KeyFilter.size_for(FILTER_KEYS))
                if stored is not None and rule not in filters:  # a filter got lost: make it from the rows
                    filters[rule] = KeyFilter.of(stored, columns, KeyFilter.size_for(FILTER_KEYS))
                whole = filters[rule].merged(own) if rule in filters else own
                whole.table.coalesce(1).write.mode("overwrite").parquet(
                    os.path.join(filter_dir, f"batch={batch_id}", rule))
            good.write.mode("overwrite").parquet(os.path.join(target_dir, f"batch={batch_id}"))
            bad.write.mode("overwrite").parquet(os.path.join(quarantine_dir, f"batch={batch_id}"))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

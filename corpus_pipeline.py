"""Corpus pipeline: toxicity, quality rules, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last return the columns of ``documents``."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from subledger.llm import host_quality, mixing, near_dedup, packing, toxicity  # noqa: E402
from subledger.llm.common import stored, table  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_in_order(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack)]

# The classifier, the signatures and the tokenizer have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

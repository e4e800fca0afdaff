"""Mergeable distinct counts (HyperLogLog sketches) for leaf cells that are rolled up later.

A leaf table holds one sketch of at most ``2 ** lg_k`` bytes per cell, whatever the cell's rows; any coarser cell, also
over several months, is a union of leaf sketches, so ids are read and shuffled once. A union's estimate has a relative
standard error of ``1.04 / sqrt(2 ** lg_k)``; ``error_bound`` is four of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14


def error_bound(lg_k: int = LG_K) -> float:
    """Largest relative error to expect (four standard errors; 0.0325 at the default)."""
    return 4 * 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, value: str, keys: tuple[str, ...], lg_k: int = LG_K) -> DataFrame:
    """(keys, sketch) of the distinct non-null ``value`` per leaf cell."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merged_estimates(leaf: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, estimate): leaf sketches united per coarser cell."""
    return leaf.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def rollup_estimates(leaf: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, grouping_level, estimate) of every level of the rollup whose first key stands."""
    return (leaf.rollup(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
                                   F.grouping_id().cast("int").alias("grouping_level"))
            .where(F.col("grouping_level") < 2 ** len(keys) - 1))

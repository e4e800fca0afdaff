"""Registered queries of the subpackage and their DuckDB oracles."""

from __future__ import annotations

from . import (ann, host_quality, language_id, lexical_search, license_scan, mixing, near_dedup, packing, quality_cnn,
               sharding, token_alignment, toxicity, url_filter)
from .common import table


def queries() -> dict:
    return {
        "op1_minimax_shards": lambda s, d: sharding.op1_minimax_shards(table(s, d, "documents")),
        "op2_license_rules": lambda s, d: license_scan.op2_license_rules(table(s, d, "documents")),
        "op3_weak_supervision": lambda s, d: toxicity.op3_weak_supervision(
            table(s, d, "documents"), table(s, d, "labels")),
        "op4_hnsw": lambda s, d: ann.op4_hnsw(table(s, d, "embeddings")),
        "op5_pfair_mix": lambda s, d: mixing.op5_pfair_mix(table(s, d, "documents")),
        "op6_url_filter": lambda s, d: url_filter.op6_url_filter(table(s, d, "pages")),
        "op7_superminhash": lambda s, d: near_dedup.op7_superminhash(table(s, d, "documents")),
        "op8_host_rules": lambda s, d: host_quality.op8_host_rules(table(s, d, "documents")),
        "op9_byte_cnn": lambda s, d: quality_cnn.op9_byte_cnn(table(s, d, "documents"), table(s, d, "labels")),
        "op10_certified_packing": lambda s, d: packing.op10_certified_packing(table(s, d, "documents")),
        "op11_string_kernel": lambda s, d: language_id.op11_string_kernel(table(s, d, "documents")),
        "op12_token_alignment": lambda s, d: token_alignment.op12_token_alignment(table(s, d, "documents")),
        "op13_bag_search": lambda s, d: lexical_search.op13_bag_search(
            table(s, d, "documents"), table(s, d, "benchmark")),
    }


def oracle_sql() -> dict:
    return {"op2_license_rules": license_scan.oracle(), "op8_host_rules": host_quality.ORACLE,
            "op13_bag_search": lexical_search.ORACLE}

"""The queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, knn, licenses, mixing, oracles, packing, prefix_hash, quality, ranked, simhash, substrings, toxicity, units, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_additive_quality": quality.op1_additive_quality,
    "op2_chunk_reuse_bpe": bpe.op2_chunk_reuse_bpe,
    "op3_cost_balanced_packing": packing.op3_cost_balanced_packing,
    "op4_voronoi_knn": knn.op4_voronoi_knn,
    "op5_nnpu_toxicity": toxicity.op5_nnpu_toxicity,
    "op6_license_rules": licenses.op6_license_rules,
    "op7_covering_simhash": simhash.op7_covering_simhash,
    "op8_suffix_dedup": substrings.op8_suffix_dedup,
    "op9_prefix_fingerprints": prefix_hash.op9_prefix_fingerprints,
    "op10_unit_dedup": units.op10_unit_dedup,
    "op11_block_max_wand": ranked.op11_block_max_wand,
    "op12_trie_variants": variants.op12_trie_variants,
    "op13_flow_mixing": mixing.op13_flow_mixing,
}
ORACLE_SQL: dict[str, str] = {
    "op4_voronoi_knn": oracles.KNN_SQL,
    "op6_license_rules": oracles.license_sql(),
    "op10_unit_dedup": oracles.UNITS_SQL,
    "op11_block_max_wand": oracles.RANKED_SQL,
    "op12_trie_variants": oracles.VARIANTS_SQL,
}

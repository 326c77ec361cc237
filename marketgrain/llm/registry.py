"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketgrain.llm import (
    op1_repair_ids,
    op2_pivot_topk,
    op3_prob_minhash,
    op4_co_training,
    op5_kneser_ney_lid,
    op6_pseudonyms,
    op7_token_counts,
    op8_linear_grouping,
    op9_latent_semantic,
    op10_suffix_tree,
    op11_suffix_dawg,
    op12_line_cuckoo,
    op13_gnat_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repair_ids": op1_repair_ids.query,
    "op2_pivot_topk": op2_pivot_topk.query,
    "op3_prob_minhash": op3_prob_minhash.query,
    "op4_co_training": op4_co_training.query,
    "op5_kneser_ney_lid": op5_kneser_ney_lid.query,
    "op6_pseudonyms": op6_pseudonyms.query,
    "op7_token_counts": op7_token_counts.query,
    "op8_linear_grouping": op8_linear_grouping.query,
    "op9_latent_semantic": op9_latent_semantic.query,
    "op10_suffix_tree": op10_suffix_tree.query,
    "op11_suffix_dawg": op11_suffix_dawg.query,
    "op12_line_cuckoo": op12_line_cuckoo.query,
    "op13_gnat_codes": op13_gnat_codes.query,
}
ORACLES: dict[str, str] = {
    "op2_pivot_topk": op2_pivot_topk.SQL,
    "op11_suffix_dawg": op11_suffix_dawg.SQL,
    "op12_line_cuckoo": op12_line_cuckoo.SQL,
    "op13_gnat_codes": op13_gnat_codes.SQL,
}

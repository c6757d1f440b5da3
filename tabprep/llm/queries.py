"""Queries of this package: name -> (builder, SQL twin or None)."""

from tabprep.llm import (decontaminate, embedding_dedup, graph_search, language, language_model, mixing, ngram_join, quality,
                         sharding, substring_dedup, token_alignment, toxicity, vector_codes)

REGISTRY = {
    "op1_weak_supervision_toxicity": (toxicity.op1_weak_supervision_toxicity, None),
    "op2_hypergeometric_mix": (mixing.op2_hypergeometric_mix, mixing.SQL_OP2),
    "op3_collinear_chaining": (substring_dedup.op3_collinear_chaining, None),
    "op4_line_crf_quality": (quality.op4_line_crf_quality, None),
    "op5_hyperdimensional_language": (language.op5_hyperdimensional_language, None),
    "op6_spherical_kmeans_dedup": (embedding_dedup.op6_spherical_kmeans_dedup, embedding_dedup.SQL_OP6),
    "op7_positional_index": (decontaminate.op7_positional_index, decontaminate.SQL_OP7),
    "op8_kd_tree_shards": (sharding.op8_kd_tree_shards, None),
    "op9_gru_language_model": (language_model.op9_gru_language_model, None),
    "op10_count_vector_join": (ngram_join.op10_count_vector_join, ngram_join.SQL_OP10),
    "op11_anchored_token_alignment": (token_alignment.op11_anchored_token_alignment, None),
    "op12_norm_of_sum_codes": (vector_codes.op12_norm_of_sum_codes, vector_codes.SQL_OP12),
    "op13_pruned_graph_search": (graph_search.op13_pruned_graph_search, None),
}

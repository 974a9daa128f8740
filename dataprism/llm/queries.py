"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from dataprism.llm import (alignment, byte_bpe, decontaminate, hard_negatives, line_dedup, minhash, quality_fm,
                           quality_rules, sentencepiece_ac, sharding, substring, token_counts, toxicity)

QUERIES = {
    "op1_line_runs": line_dedup.op1_line_runs,
    "op2_toxicity_cnn": toxicity.op2_toxicity_cnn,
    "op3_quality_fm": quality_fm.op3_quality_fm,
    "op4_tiling": decontaminate.op4_tiling,
    "op5_minhash": minhash.op5_minhash,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_sentencepiece": sentencepiece_ac.op7_sentencepiece,
    "op8_shard_tree": sharding.op8_shard_tree,
    "op9_phrases": substring.op9_phrases,
    "op10_quality_lines": quality_rules.op10_quality_lines,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_byte_bpe": byte_bpe.op12_byte_bpe,
    "op13_alignment": alignment.op13_alignment,
}

ORACLES = {
    "op1_line_runs": line_dedup.ORACLE,
    "op8_shard_tree": sharding.ORACLE,
    "op10_quality_lines": quality_rules.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
}

"""The training-data queries by name, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from foliospark.llm import bpe, decontamination, hard_negatives, line_dedup, media, merkle, mixing, near_dedup, packing, quality_rules, secret_scan, substring_dedup, token_counts

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_media": media.op5_media,
    "page_sequences": media.page_sequences,
    "op6_packing": packing.op6_packing,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_merkle": merkle.op12_merkle,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op2_secret_scan": secret_scan.ORACLE_SQL,
    "op4_mixing": mixing.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_decontamination": decontamination.ORACLE_SQL,
    "op12_merkle": merkle.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}

"""Registered queries of the operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from hazardlake.llm import (
    bpe,
    embedding_dedup,
    embedding_whitening,
    fingerprints,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    quality_rules,
    substring_dedup,
    toxicity,
    vector_codes,
)

QUERIES = {
    "op1_embedding_dedup": (embedding_dedup.op1_embedding_dedup, embedding_dedup.SQL),
    "op2_license_scan": (license_scan.op2_license_scan, None),
    "op3_line_dedup": (line_dedup.op3_line_dedup, line_dedup.SQL),
    "op4_bpe": (bpe.op4_bpe, None),
    "op5_toxicity": (toxicity.op5_toxicity, None),
    "op6_language_id": (language_id.op6_language_id, None),
    "op7_minhash_dedup": (minhash_dedup.op7_minhash_dedup, minhash_dedup.SQL),
    "op8_mixing": (mixing.op8_mixing, None),
    "op9_suffix_array_dedup": (substring_dedup.op9_suffix_array_dedup, None),
    "op10_document_fingerprints": (fingerprints.op10_document_fingerprints, None),
    "op11_embedding_whitening": (embedding_whitening.op11_embedding_whitening, None),
    "op12_quality_rules": (quality_rules.op12_quality_rules, quality_rules.SQL),
    "op13_vector_codes": (vector_codes.op13_vector_codes, vector_codes.SQL),
}

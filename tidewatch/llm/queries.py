"""Registered queries of the corpus operators and the SQL they are checked against."""

from __future__ import annotations

from tidewatch.llm import (
    decontamination,
    embedding_dedup,
    language,
    licenses,
    line_dedup,
    manifest,
    ngram_join,
    packing,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_kd_sharding": sharding.op3_kd_sharding,
    "op4_language_id": language.op4_language_id,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_ngram_jaccard_join": ngram_join.op7_ngram_jaccard_join,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_packing": packing.op9_packing,
    "op10_quality": quality.op10_quality,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}
ORACLES = {
    "op1_license_scan": licenses.ORACLE,
    "op2_decontamination": decontamination.ORACLE,
    "op5_embedding_dedup": embedding_dedup.ORACLE,
    "op7_ngram_jaccard_join": ngram_join.ORACLE,
    "op12_substring_dedup": substring_dedup.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}

"""The queries of the dealt operators and their DuckDB SQL."""

from __future__ import annotations

from lakewash.llm import (decontamination, html_extract, merkle, mixing, passages, pii, quality_classifier, quality_rules,
                          secret_scan, simhash, token_counts, url_filter, whitening)

QUERIES = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_substring_dedup": passages.op2_substring_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_mixing": mixing.op4_mixing,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_secret_scan": secret_scan.op6_secret_scan,
    "op7_quality_classifier": quality_classifier.op7_quality_classifier,
    "op8_html_extract": html_extract.op8_html_extract,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_pii": pii.op10_pii,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLES = {
    "op5_quality_rules": quality_rules.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}

"""The queries of this subpackage and their SQL, for the entry file."""

from __future__ import annotations

from . import decontamination, exact_dedup, filter_audit, jaccard_join, langid, licences, packing, pii, source_divergence, substring_dedup, token_store, toxicity, warc_audit

QUERIES = {
    "op1_jaccard_join": jaccard_join.query,
    "op2_licence_scan": licences.query,
    "op3_warc_audit": warc_audit.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_token_store": token_store.query,
    "op6_best_fit_packing": packing.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_language_id": langid.query,
    "op9_pii": pii.query,
    "op10_decontamination": decontamination.query,
    "op11_toxicity": toxicity.query,
    "op12_source_divergence": source_divergence.query,
    "op13_filter_audit": filter_audit.query,
}

#: SQL where it can express an operator and runs on whole tables; the others are tested against brute force.
ORACLES = {
    "op1_jaccard_join": jaccard_join.ORACLE,
    "op2_licence_scan": licences.oracle(),
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op3_warc_audit": warc_audit.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op12_source_divergence": source_divergence.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}

"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from tabularium.llm import (
    alignment,
    decontam,
    editprint,
    extract,
    filteraudit,
    langid,
    licenses,
    maxent,
    mixing,
    nndescent,
    quality,
    setsketch,
    unigram,
)

QUERIES = {
    "op1_main_text": extract.op1_main_text,
    "op2_language_id": langid.op2_language_id,
    "op3_lm_scores": maxent.op3_lm_scores,
    "op4_fingerprints": editprint.op4_fingerprints,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_near_duplicates": setsketch.op6_near_duplicates,
    "op7_quality": quality.op7_quality,
    "op8_decontamination": decontam.op8_decontamination,
    "op9_mixture": mixing.op9_mixture,
    "op10_token_counts": unigram.op10_token_counts,
    "op11_nearest_neighbours": nndescent.op11_nearest_neighbours,
    "op12_filter_audit": filteraudit.op12_filter_audit,
    "op13_token_alignment": alignment.op13_token_alignment,
}

SQL = {
    "op6_near_duplicates": setsketch.OP6_SQL,
    "op8_decontamination": decontam.OP8_SQL,
    "op9_mixture": mixing.OP9_SQL,
    "op12_filter_audit": filteraudit.OP12_SQL,
}

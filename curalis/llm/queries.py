"""Queries over the test tables, one for each operator, and DuckDB SQL where it can express one."""

from __future__ import annotations

from curalis.llm import decontam, html, langid, licenses, mixing, quality, repair, search, simhash, substring, suffix_dedup, tokens, toxicity

QUERIES = {
    "op1_language_id": langid.op1,
    "op2_html_extraction": html.op2,
    "op3_mixing": mixing.op3,
    "op4_suffix_dedup": suffix_dedup.op4,
    "op5_toxicity": toxicity.op5,
    "op6_license_scan": licenses.op6,
    "op7_simhash": simhash.op7,
    "op8_substring_dedup": substring.op8,
    "op9_decontaminate": decontam.op9,
    "op10_quality_rules": quality.op10,
    "op11_token_counts": tokens.op11,
    "op12_conversation_repair": repair.op12,
    "op13_ranked_search": search.op13,
}

ORACLE = {"op4_suffix_dedup": suffix_dedup.ORACLE, "op9_decontaminate": decontam.ORACLE, "op13_ranked_search": search.ORACLE}

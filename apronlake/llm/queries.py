"""Queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, exact_dedup, fill_middle, html_text, language_id, licenses, mixing, near_dedup, secrets, substring_dedup, token_align, token_files, toxicity

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_licenses": licenses.op2_licenses,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_html_text": html_text.op4_html_text,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op7_mixing": mixing.op7_mixing,
    "op6_secrets": secrets.op6_secrets,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_token_ids": token_files.op10_token_ids,
    "op11_token_align": token_align.op11_token_align,
    "op12_language_id": language_id.op12_language_id,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}

ORACLES = {
    "op3_substring_dedup": substring_dedup.ORACLE_SQL,
    "op5_decontaminate": decontaminate.ORACLE_SQL,
    "op2_licenses": licenses.ORACLE_SQL,
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op7_mixing": mixing.ORACLE_SQL,
    "op13_fill_middle": fill_middle.ORACLE_SQL,
}

"""Operators for training-data pipelines, one module each, with their queries and SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "op1_lm_scoring",
    "op2_html_extraction",
    "op3_topk_search",
    "op4_token_ids",
    "op5_language_id",
    "op6_jaccard_join",
    "op7_license_scans",
    "op8_url_filters",
    "op9_decontamination",
    "op10_best_fit_packing",
    "op11_minmax_dedup",
    "op12_spelling_variants",
    "op13_lexical_search",
)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"{__name__}.{m}").ORACLE_SQL.items()}

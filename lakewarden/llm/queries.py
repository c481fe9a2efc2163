"""Registered queries of the operators in this subpackage, with comparison SQL where SQL can express them."""

from __future__ import annotations

from lakewarden.llm import (
    filter_audit,
    html_text,
    lexical_search,
    line_quality,
    lm_scoring,
    mixing,
    nearest,
    packing,
    pii,
    quality_rules,
    repeated_text,
    shingle_join,
    swap_packing,
)

QUERIES = {
    "op1_pii": pii.query,
    "op2_lm_scoring": lm_scoring.query,
    "op3_repeated_text": repeated_text.query,
    "op4_packing": packing.query,
    "op5_line_quality": line_quality.query,
    "op6_nearest": nearest.query,
    "op7_quality_rules": quality_rules.query,
    "op8_mixing": mixing.query,
    "op9_shingle_join": shingle_join.query,
    "op10_html_text": html_text.query,
    "op11_filter_audit": filter_audit.query,
    "op12_swap_packing": swap_packing.query,
    "op13_lexical_search": lexical_search.query,
}
ORACLES = {
    "op7_quality_rules": quality_rules.SQL,
    "op8_mixing": mixing.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op13_lexical_search": lexical_search.SQL,
}

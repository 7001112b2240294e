"""The subpackage's queries and, where SQL can express one, its DuckDB statement."""

from __future__ import annotations

from quern.llm import byte_bpe, html_text, mixing, neighbours, quality, quality_rules, sharding, simhash, substring, toxicity

QUERIES = {
    "op1_quality": quality.query,
    "op2_html_text": html_text.query,
    "op3_substring": substring.query,
    "op4_sharding": sharding.query,
    "op5_neighbours": neighbours.query,
    "op6_quality_rules": quality_rules.query,
    "op7_byte_bpe": byte_bpe.query,
    "op8_toxicity": toxicity.query,
    "op9_simhash": simhash.query,
    "op10_mixing": mixing.query,
}
ORACLES = {
    "op3_substring": substring.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op10_mixing": mixing.SQL,
}

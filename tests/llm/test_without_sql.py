"""Queries that SQL cannot express must have a test against a plain version, an exact round trip or held-out accuracy."""

from __future__ import annotations

from pathlib import Path

from brooklet.llm.queries import LLM_ORACLES, LLM_QUERIES

# Which test checks which of these queries' operators.
CHECKED_BY = {
    "op3_document_fingerprints": "test_text_operators.py",
    "op5_sentencepiece": "test_text_operators.py",
    "op6_benchmark_decontamination": "test_pipeline.py",
    "op7_toxicity": "test_text_operators.py",
    "op9_secret_scans": "test_text_operators.py",
    "op10_html_extraction": "test_page_operators.py",
    "pipeline": "test_pipeline.py",
}


def test_every_query_has_sql_or_a_test():
    assert set(CHECKED_BY) == set(LLM_QUERIES) - set(LLM_ORACLES)
    here = Path(__file__).parent
    assert all((here / name).exists() for name in CHECKED_BY.values())

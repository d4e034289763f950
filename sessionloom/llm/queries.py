"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from sessionloom.llm import q_forms, q_leaks, q_names, q_packing, q_scanned, q_spans, q_transcripts

MODULES = [q_forms, q_leaks, q_names, q_packing, q_scanned, q_spans, q_transcripts]
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}

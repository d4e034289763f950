"""All queries of the core and their SQL."""

from __future__ import annotations

from sessionloom.plans import record_queries, reference_checks, sequence_queries, text_queries

MODULES = [reference_checks, sequence_queries, text_queries, record_queries]


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}

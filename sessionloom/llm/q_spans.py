"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm.shared_spans import shared_amount, sharing_pairs
from sessionloom.tables import load


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sharing_pairs(load(spark, d, "documents", "doc_id", "text"))


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return shared_amount(load(spark, d, "documents", "doc_id", "text"))


QUERIES = {"p9_found": p9_found, "p9_shared": p9_shared}
_WINDOWS = """
d AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 300),
w AS (SELECT doc_id, k, hash(substring(text, k, 300)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS k FROM d) x),
s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)),
v AS (SELECT w.doc_id, w.k, w.h FROM w JOIN s ON s.h = w.h)"""
SQL = {
    "p9_found": f"WITH {_WINDOWS} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM v a JOIN v b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p9_shared": f"""WITH {_WINDOWS}, e AS (SELECT doc_id, k, coalesce(k - lag(k) OVER (PARTITION BY doc_id ORDER BY k), 300) AS step FROM (SELECT DISTINCT doc_id, k FROM v) q),
c AS (SELECT text, count(*) AS n_copies FROM d GROUP BY text)
SELECT d.doc_id, length(d.text) AS n_chars, x.shared_chars, n_copies FROM (SELECT doc_id, CAST(sum(least(step, 300)) AS BIGINT) AS shared_chars FROM e GROUP BY doc_id) x JOIN d ON d.doc_id = x.doc_id JOIN c ON c.text = d.text""",
}

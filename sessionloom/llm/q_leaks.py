"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.leaks import leaks
from sessionloom.tables import load

NEAR = 3


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The leaks without any edit, an exact check of those that the operator finds within its budget."""
    return leaks(load(spark, d, "documents", "doc_id", "text"), load(spark, d, "eval_items", "item_id", "text")).where("edits = 0").select("item_id", "doc_id")


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """Leaks with up to NEAR edits in thirteen words, and the fewest edits of each."""
    return leaks(load(spark, d, "documents", "doc_id", "text"), load(spark, d, "eval_items", "item_id", "text"), edits=NEAR)


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    found = p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    items = load(spark, d, "eval_items", "item_id", "suite", "lang").distinct()
    return items.join(found, "item_id", "left").select("item_id", "suite", "lang", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


QUERIES = {"p8_found": p8_found, "p8_near": p8_near, "p8_items": p8_items}
_GRAMS = """
d AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{Nd}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{Nd}]+') AS w FROM eval_items WHERE text IS NOT NULL),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d) x),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i) x),
f AS (SELECT DISTINCT item_id, doc_id FROM ig JOIN dg ON ig.g = dg.g)"""
SQL = {
    "p8_found": f"WITH {_GRAMS} SELECT item_id, doc_id FROM f",
    "p8_items": f"""WITH {_GRAMS}, n AS (SELECT item_id, count(*) AS n_docs FROM f GROUP BY item_id)
SELECT e.item_id, suite, lang, coalesce(n_docs, 0) AS n_docs FROM (SELECT DISTINCT item_id, suite, lang FROM eval_items) e LEFT JOIN n ON n.item_id = e.item_id""",
}

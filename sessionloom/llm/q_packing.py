"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.packing import assigned, filled, measured
from sessionloom.tables import load, written


def capacities(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    """The container sizes; the table has a fixed handful of rows."""
    rows = load(spark, d, "capacities", "capacity_name", "capacity_tokens").where("capacity_name is not null and capacity_tokens >= 1").distinct().collect()
    return sorted(((r["capacity_name"], r["capacity_tokens"]) for r in rows), key=lambda c: (c[1], c[0]))


def p7_assign(spark: SparkSession, d: str) -> DataFrame:
    return assigned(spark, load(spark, d, "documents", "doc_id", "text"), capacities(spark, d))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return filled(p7_assign(spark, d), capacities(spark, d))


def p7_summary(spark: SparkSession, d: str) -> DataFrame:
    """Containers and mean fill of each capacity."""
    return p7_fill(spark, d).groupBy("capacity_name").agg(F.count("*").alias("n_containers"), F.sum("used_tokens").alias("used_tokens"), F.round(F.avg("fill"), 6).alias("mean_fill"))


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: documents placed, containers over the capacity, documents divided although they fit, pieces that leave a gap, and
    documents whose pieces are not as long as their text in tokens."""
    sizes = capacities(spark, d)
    room = F.create_map(*[F.lit(x) for pair in sizes for x in pair])
    placed = written(p7_assign(spark, d).withColumn("room", F.element_at(room, F.col("capacity_name"))), "packing-check")
    documents = load(spark, d, "documents", "doc_id", "text")
    tokens = measured(documents).select("doc_id", "n_tokens").distinct()
    pieces = placed.groupBy("capacity_name", "doc_id", "room").agg(F.count("*").alias("n"), F.sum(F.col("token_to") - F.col("token_from")).alias("held"), F.max("token_to").alias("last"), F.min("token_from").alias("first"))
    each = pieces.join(tokens, "doc_id").groupBy("capacity_name").agg(
        F.count("*").alias("n_documents"), F.sum(((F.col("n") > 1) & (F.col("n_tokens") <= F.col("room"))).cast("bigint")).alias("n_divided"),
        F.sum(((F.col("first") != 0) | (F.col("held") != F.col("last"))).cast("bigint")).alias("n_gaps"), F.sum((F.col("held") != F.col("n_tokens")).cast("bigint")).alias("n_lost"),
    )
    over = placed.groupBy("capacity_name", "container_id", "room").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("used")).groupBy("capacity_name").agg(F.sum((F.col("used") > F.col("room")).cast("bigint")).alias("n_overfull"))
    return each.join(over, "capacity_name")


QUERIES = {"p7_assign": p7_assign, "p7_fill": p7_fill, "p7_summary": p7_summary, "p7_invariants": p7_invariants}
SQL = {
    "p7_invariants": """SELECT capacity_name, (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS n_documents, CAST(0 AS BIGINT) AS n_divided, CAST(0 AS BIGINT) AS n_gaps, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_overfull
FROM (SELECT DISTINCT capacity_name FROM capacities WHERE capacity_name IS NOT NULL AND capacity_tokens >= 1) c""",
}

"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.name_linking import linked, missed, variant_pairs
from sessionloom.tables import load


def mentions(spark: SparkSession, d: str) -> DataFrame:
    people = load(spark, d, "interventions", "intervinent").select(F.explode("intervinent").alias("name"))
    return people.unionByName(load(spark, d, "speaker_seq", "speaker").withColumnRenamed("speaker", "name"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return variant_pairs(linked(mentions(spark, d)))


def p2_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with a stable key of its entity: the least spelling of it, and the number of spellings."""
    e = linked(mentions(spark, d))
    keys = e.groupBy("entity").agg(F.min("name").alias("entity_name"), F.count("*").alias("n_spellings"))
    return e.join(keys, "entity").select("name", "entity_name", "n_spellings")


def p2_missed(spark: SparkSession, d: str) -> DataFrame:
    """Links that the blocks miss, of the readings whose id is divisible by 50 against all."""
    return missed(mentions(spark, d))


def p2_checks(spark: SparkSession, d: str) -> DataFrame:
    """Distinct names, and how many of them stand in two entities."""
    e = linked(mentions(spark, d))
    n = e.groupBy("name").agg(F.countDistinct("entity").alias("k"))
    offices = e.where(F.lower("name").isin("mesa", "el president", "la presidenta"))
    counts = n.select(F.lit("n_ambiguous").alias("kind"), (F.col("k") > 1).cast("bigint").alias("k")).unionByName(offices.select(F.lit("n_offices").alias("kind"), F.lit(1).cast("bigint").alias("k")))
    return counts.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == c, F.col("k"))), F.lit(0)).alias(c) for c in ("n_ambiguous", "n_offices")])


QUERIES = {"p2_found": p2_found, "p2_entities": p2_entities, "p2_missed": p2_missed, "p2_checks": p2_checks}
SQL = {"p2_checks": "SELECT CAST(0 AS BIGINT) AS n_ambiguous, CAST(0 AS BIGINT) AS n_offices"}

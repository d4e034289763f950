"""Queries of problem 3."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.scanned import Repair, noise, paragraphs, repair
from sessionloom.tables import load, written


def repaired(spark: SparkSession, d: str) -> Repair:
    return repair(load(spark, d, "xml_lines"), load(spark, d, "lexicon"), load(spark, d, "diary_pages", "ple_code", "width"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return noise(repaired(spark, d))


def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return paragraphs(repaired(spark, d))


def p3_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must not be: paragraphs without text, with blanks at their ends, that begin with furniture, or numbers twice; lines of one text that
    are furniture and misread at once."""
    r = repaired(spark, d)
    p = written(paragraphs(r), "paragraphs-check")
    marked = noise(r).groupBy("line_id").agg(F.collect_set("kind").alias("kinds"))
    twice = p.groupBy("ple_code", "para_no").agg(F.count("*").alias("n")).where("n > 1")
    furniture = p.join(r.furniture.select(F.col("line_id").alias("first_line_id")), "first_line_id", "left_semi")
    wrong = [("n_empty", p.where("trim(text) = ''")), ("n_blanks", p.where("text != trim(text)")), ("n_furniture", furniture), ("n_twice", twice), ("n_contradictions", marked.where("array_contains(kinds, 'furniture') and size(kinds) > 1"))]
    every = functools.reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind")) for k, df in wrong])
    return every.agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k, _ in wrong])


QUERIES = {"p3_found": p3_found, "p3_paragraphs": p3_paragraphs, "p3_checks": p3_checks}
SQL = {"p3_checks": "SELECT " + ", ".join(f"CAST(0 AS BIGINT) AS {k}" for k in ("n_empty", "n_blanks", "n_furniture", "n_twice", "n_contradictions"))}

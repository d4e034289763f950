"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionloom.llm.transcripts import speaker_turns
from sessionloom.tables import load, written


def p6_turns(spark: SparkSession, d: str) -> DataFrame:
    """The clean turns with their text."""
    return speaker_turns(load(spark, d, "session_texts", "record_id", "text", "urls")).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return speaker_turns(load(spark, d, "session_texts", "record_id", "text", "urls")).select("record_id", "turn_no", "speaker").distinct()


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    """Turns that break a rule: not numbered 1, 2, ..., by the speaker of the turn before, by nobody the record names, without
    a word, or with a note or a time stamp left."""
    t = written(p6_turns(spark, d), "turns-check")
    w = Window.partitionBy("record_id").orderBy("turn_no")
    names = load(spark, d, "session_texts", "record_id", "urls").where("urls is not null").select("record_id", F.explode(F.flatten("urls.names")).alias("speaker")).distinct().withColumn("named", F.lit(True))
    here = t.withColumn("before", F.lag("speaker").over(w)).withColumn("n", F.row_number().over(w)).join(names, ["record_id", "speaker"], "left")
    bad = {
        "n_misnumbered": F.col("n") != F.col("turn_no"), "n_repeated": F.col("speaker") == F.col("before"), "n_unnamed": (F.col("speaker") != "mesa") & F.col("named").isNull(),
        "n_empty": ~F.col("text").rlike(r"[\p{L}\p{N}]"), "n_notes": F.col("text").rlike(r"\[[^\[\]]*\]|\([^()]*\)|-->"),
    }
    return here.agg(*[F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("bigint")), F.lit(0)).alias(k) for k, c in bad.items()])


QUERIES = {"p6_found": p6_found, "p6_turns": p6_turns, "p6_checks": p6_checks}
SQL = {"p6_checks": "SELECT " + ", ".join(f"CAST(0 AS BIGINT) AS {k}" for k in ("n_misnumbered", "n_repeated", "n_unnamed", "n_empty", "n_notes"))}

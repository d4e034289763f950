"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.consistent_text import consistent
from sessionloom.tables import load


def texts(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "xml_lines", "line_id", "text").select(F.lit("xml_lines").alias("source_table"), F.col("line_id").alias("row_id"), F.lit(0).alias("entry_no"), F.col("text").alias("t"))
    records = load(spark, d, "session_texts", "record_id", "text")
    entries = records.select("record_id", F.posexplode("text").alias("pos", "e")).select(
        F.lit("session_texts").alias("source_table"), F.col("record_id").alias("row_id"), (F.col("pos") + 1).alias("entry_no"), F.col("e.text").alias("t")
    )
    return lines.unionByName(entries)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return consistent(texts(spark, d), only_cases=True).select("source_table", "row_id", "entry_no").distinct()


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every text, and which kinds of disguise it had."""
    return consistent(texts(spark, d)).distinct()


QUERIES = {"p5_found": p5_found, "p5_clean": p5_clean}
# What the cases are, in the words of the task: Unicode blocks of styled forms, marks, invisible characters and blanks.
_STYLED = r"[\x{132}\x{133}\x{13F}\x{140}\x{1C4}-\x{1CC}\x{1F1}-\x{1F3}\x{2102}\x{210A}-\x{2113}\x{2115}\x{2119}-\x{211D}\x{2124}\x{2128}\x{212C}\x{212D}\x{212F}-\x{2131}\x{2133}-\x{2139}\x{213C}-\x{2140}\x{2145}-\x{2149}\x{2460}-\x{2473}\x{24B6}-\x{24EA}\x{3250}-\x{327E}\x{3280}-\x{32FF}\x{3300}-\x{33FF}\x{FB00}-\x{FB06}\x{FB20}-\x{FB29}\x{FE10}-\x{FE19}\x{FE30}-\x{FE44}\x{FE47}-\x{FE6B}\x{FF01}-\x{FF60}\x{FF61}-\x{FF9F}\x{FFA1}-\x{FFEE}\x{1D400}-\x{1D7FF}\x{1EE00}-\x{1EEBB}\x{1F12B}-\x{1F14F}\x{1F190}\x{1FBF0}-\x{1FBF9}]"
_HIDDEN = r"[\x{0}-\x{8}\x{E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}\x{34F}\x{61C}\x{6DD}\x{70F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{1BCA0}-\x{1BCA3}\x{1D173}-\x{1D17A}\x{E0001}\x{E0020}-\x{E007F}\x{E0100}-\x{E01EF}]"
_BLANK = r"[\x{9}\x{B}\x{C}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_CASES = f"regexp_matches(t, '{_STYLED}') OR regexp_matches(t, '{_HIDDEN}') OR regexp_matches(t, '{_BLANK}') OR regexp_matches(t, '\\p{{L}}\\p{{Mn}}')"
SQL = {
    "p5_found": f"""
WITH x AS (
  SELECT 'xml_lines' AS source_table, line_id AS row_id, 0 AS entry_no, text AS t FROM xml_lines WHERE text IS NOT NULL
  UNION ALL SELECT 'session_texts', record_id, i, text[i].text FROM (SELECT record_id, text, unnest(range(1, len(text) + 1)) AS i FROM session_texts) s WHERE text[i].text IS NOT NULL),
w AS (SELECT *, list_filter(regexp_extract_all(nfc_normalize(t), '[\\p{{L}}\\p{{M}}\\p{{Cf}}]+'), lambda v: regexp_matches(v, '\\p{{Latin}}') AND regexp_matches(v, '[\\p{{Greek}}\\p{{Cyrillic}}]')) AS odd FROM x)
SELECT DISTINCT source_table, row_id, CAST(entry_no AS INTEGER) AS entry_no FROM w WHERE {_CASES} OR len(odd) > 0""",
}

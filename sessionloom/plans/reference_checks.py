"""Queries of the core's data checks: orphan references and interval coverage over the session tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions.keys import clock_seconds, code_key, page_key, session_code, url_key
from sessionloom.operators import intervals, orphan_refs
from sessionloom.tables import load


def references(spark: SparkSession, d: str) -> DataFrame:
    """Every reference of the interventions: ref_field, ref_key, used_at, intervention_id. Repeated rows count once."""
    i = load(spark, d, "interventions", "intervention_id", "ple_code", "page_reference", "media_url", "ingested_at")
    code, page = code_key(F.col("ple_code")), page_key(F.col("page_reference"))
    entry = lambda field, key: F.struct(F.lit(field).alias("ref_field"), key.alias("ref_key"))
    refs = F.array(
        entry("ple_code", code),
        entry("page_reference", F.when(code.isNotNull() & page.isNotNull(), F.concat_ws("#", code, page))),
        entry("media_url", url_key(F.col("media_url"))),
    )
    flat = i.distinct().select("intervention_id", F.col("ingested_at").alias("used_at"), F.explode(refs).alias("r"))
    return flat.select("intervention_id", "used_at", "r.ref_field", "r.ref_key").where("ref_key is not null")


def parents(spark: SparkSession, d: str) -> DataFrame:
    """The records that may be referred to: ref_field, ref_key, registered_at, deleted_at."""
    life = ["registered_at", "deleted_at"]
    sessions = load(spark, d, "sessions", "ple_code", *life).select(F.lit("ple_code").alias("ref_field"), code_key(F.col("ple_code")).alias("ref_key"), *life)
    pages = load(spark, d, "diary_pages", "ple_code", "page", *life)
    pages = pages.where("ple_code is not null and page is not null").select(
        F.lit("page_reference").alias("ref_field"), F.concat_ws("#", code_key(F.col("ple_code")), page_key(F.col("page"))).alias("ref_key"), *life
    )
    media = load(spark, d, "media_files", "media_url", *life).select(F.lit("media_url").alias("ref_field"), url_key(F.col("media_url")).alias("ref_key"), *life)
    return sessions.unionByName(pages).unionByName(media)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return orphan_refs.orphan_rows(references(spark, d), parents(spark, d)).select("ref_field", "intervention_id").distinct()


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_refs.orphan_report(references(spark, d), parents(spark, d))


def spoken_intervals(spark: SparkSession, d: str) -> DataFrame:
    i = load(spark, d, "interventions", "ple_code", "start", "end")
    return i.select(session_code(F.col("ple_code")).alias("entity"), clock_seconds(F.col("start")).alias("start_s"), clock_seconds(F.col("end")).alias("end_s"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.gaps(spoken_intervals(spark, d)).withColumnRenamed("entity", "ple_code")


def p4_periods(spark: SparkSession, d: str) -> DataFrame:
    """n_intervals counts distinct (start, end) pairs of the code."""
    return intervals.periods(spoken_intervals(spark, d).distinct()).withColumnRenamed("entity", "ple_code")


QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p4_found": p4_found, "p4_periods": p4_periods}

_REFS = r"""
WITH i AS (
  SELECT DISTINCT intervention_id, ingested_at,
    regexp_replace(regexp_replace(trim(ple_code), '[-/]', '_', 'g'), '_0*([0-9]+)$', '_\1') AS code,
    ltrim(trim(page_reference), '0') AS page,
    regexp_replace(regexp_replace(lower(trim(media_url)), '^https?://', ''), '/$', '') AS url
  FROM interventions),
refs AS (
  SELECT 'ple_code' AS ref_field, code AS ref_key, ingested_at, intervention_id FROM i WHERE code IS NOT NULL
  UNION ALL SELECT 'page_reference', code || '#' || page, ingested_at, intervention_id FROM i WHERE code IS NOT NULL AND page IS NOT NULL
  UNION ALL SELECT 'media_url', url, ingested_at, intervention_id FROM i WHERE url IS NOT NULL),
par AS (
  SELECT 'ple_code' AS ref_field, regexp_replace(ple_code, '_0*([0-9]+)$', '_\1') AS ref_key, registered_at, deleted_at FROM sessions
  UNION ALL SELECT 'page_reference', regexp_replace(ple_code, '_0*([0-9]+)$', '_\1') || '#' || page, registered_at, deleted_at FROM diary_pages
  UNION ALL SELECT 'media_url', regexp_replace(regexp_replace(lower(trim(media_url)), '^https?://', ''), '/$', ''), registered_at, deleted_at FROM media_files),
bad AS (
  SELECT * FROM refs r WHERE NOT EXISTS (
    SELECT 1 FROM par p WHERE p.ref_field = r.ref_field AND p.ref_key = r.ref_key
      AND p.registered_at <= r.ingested_at AND (p.deleted_at IS NULL OR p.deleted_at > r.ingested_at)))
"""
_CLOCK = r"""
  SELECT regexp_replace(regexp_replace(trim(ple_code), '[-/]', '_', 'g'), '_0*([0-9]+)$', '_\1') AS ple_code,
    string_split(regexp_replace(regexp_replace(trim("start"), '[hm.] ?', ':', 'g'), 's$', ''), ':') AS s,
    string_split(regexp_replace(regexp_replace(trim("end"), '[hm.] ?', ':', 'g'), 's$', ''), ':') AS e
  FROM interventions WHERE ple_code IS NOT NULL"""
_SECONDS = """
  SELECT ple_code, CAST(CASE WHEN a < 21600 THEN a + 86400 ELSE a END AS INTEGER) AS a, CAST(CASE WHEN b < 21600 THEN b + 86400 ELSE b END AS INTEGER) AS b FROM (
    SELECT ple_code, try_cast(s[1] AS INTEGER) * 3600 + try_cast(s[2] AS INTEGER) * 60 + coalesce(try_cast(s[3] AS INTEGER), 0) AS a,
      try_cast(e[1] AS INTEGER) * 3600 + try_cast(e[2] AS INTEGER) * 60 + coalesce(try_cast(e[3] AS INTEGER), 0) AS b FROM raw) t"""
_COVER = f"""
WITH raw AS ({_CLOCK}),
iv AS (SELECT DISTINCT * FROM ({_SECONDS}) u WHERE b >= a),
m AS (SELECT *, max(b) OVER (PARTITION BY ple_code ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv)
"""
SQL = {
    "p1_found": _REFS + "SELECT DISTINCT ref_field, intervention_id FROM bad",
    "p1_report": _REFS
    + """, n AS (SELECT ref_field, strftime(ingested_at, '%Y-%m') AS period, count(*) AS n_refs FROM refs GROUP BY 1, 2),
b AS (SELECT ref_field, strftime(ingested_at, '%Y-%m') AS period, count(*) AS n_orphans, count(DISTINCT ref_key) AS n_orphan_keys FROM bad GROUP BY 1, 2)
SELECT n.ref_field, n.period, n_refs, coalesce(n_orphans, 0) AS n_orphans, coalesce(n_orphan_keys, 0) AS n_orphan_keys
FROM n LEFT JOIN b ON n.ref_field = b.ref_field AND n.period = b.period""",
    "p4_found": _COVER + "SELECT ple_code, reach AS gap_start_s, a AS gap_end_s FROM m WHERE a > reach",
    "p4_periods": _COVER
    + """, g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY ple_code ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS p FROM m)
SELECT ple_code, min(a) AS period_start_s, max(b) AS period_end_s, count(*) AS n_intervals FROM g GROUP BY ple_code, p""",
}

"""Queries over speaker sequences, names and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions.codes import code_date, date_code
from sessionloom.functions.fuzzy import name_key, token_set_ratio
from sessionloom.functions.keys import code_key
from sessionloom.functions.text import speaker_name, title_and_name
from sessionloom.operators import pairing, runs
from sessionloom.sinks.tables import absent
from sessionloom.tables import load, written


def sequence(spark: SparkSession, d: str) -> DataFrame:
    """Speaker sequences with dense positions; null speakers and repeated rows left out."""
    return runs.dense(load(spark, d, "speaker_seq", "session", "pos", "speaker").where("speaker is not null").distinct())


def turns(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "session_texts", "record_id", "text").select("record_id", F.posexplode("text").alias("pos", "t"))
    return t.select("record_id", F.col("pos").cast("bigint").alias("pos"), F.col("t.speaker").alias("speaker"), F.col("t.text").alias("text")).distinct()


def turn_filter(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).where(runs.speaking(F.col("text"), F.col("speaker")))


def chair(spark: SparkSession, d: str) -> DataFrame:
    return runs.chair(sequence(spark, d))


def mode_speaker(spark: SparkSession, d: str) -> DataFrame:
    return runs.most_frequent(sequence(spark, d), ["session"], "speaker", "pos")


def run_heads(spark: SparkSession, d: str) -> DataFrame:
    return runs.runs(sequence(spark, d))


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return runs.blocks(sequence(spark, d))


def block_slices(spark: SparkSession, d: str) -> DataFrame:
    """The speakers of each block, in order."""
    seq = sequence(spark, d)
    rows = runs.block_contents(runs.blocks(seq).drop("speaker"), seq)
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "speaker"))), lambda x: x["speaker"]), "; ")
    return rows.groupBy("session", "block_no").agg(F.count("*").alias("n_rows"), names.alias("speakers"))


def metadata_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Interventions of each code, in its canonical form, by start, then position: (session, pos, speaker, names, media_url)."""
    i = load(spark, d, "interventions", "ple_code", "pos", "start", "intervinent", "media_url", "intervention_id").where("ple_code is not null and intervinent is not null and size(intervinent) > 0")
    i = i.withColumn("ple_code", code_key(F.col("ple_code"))).distinct().withColumnRenamed("ple_code", "session")
    each = i.select("session", F.struct("start", "pos", "intervention_id").alias("at"), F.posexplode("intervinent").alias("k", "speaker"))
    names = each.select("session", F.struct("at", "k").alias("pos"), "speaker")
    chairs = runs.chair(names)
    one = F.transform("intervinent", lambda n: F.when(n.contains(F.col("chair")), F.lit(runs.PAUSE)).otherwise(speaker_name(n)))
    return i.join(chairs, "session", "left").select("session", F.struct("start", "pos", "intervention_id").alias("pos"), runs.one_speaker(one).alias("speaker"), F.transform("intervinent", lambda n: F.split_part(n, F.lit("|"), F.lit(1))).alias("names"), "media_url")


def metadata_speakers(spark: SparkSession, d: str) -> DataFrame:
    """One speaker of each intervention, the chair as the pause speaker."""
    return metadata_sequence(spark, d).select("session", F.col("pos.intervention_id").alias("intervention_id"), "speaker")


def sorted_interventions(spark: SparkSession, d: str) -> DataFrame:
    """The rank of each intervention of a code by its start as text, nulls first."""
    from pyspark.sql import Window

    i = load(spark, d, "interventions", "ple_code", "intervention_id", "start", "pos").where("ple_code is not null").distinct()
    w = Window.partitionBy("ple_code").orderBy(F.asc_nulls_first("start"), "pos", "intervention_id")
    return i.select("ple_code", "intervention_id", F.row_number().over(w).cast("bigint").alias("place"))


def alias_names(spark: SparkSession, d: str) -> DataFrame:
    s = turns(spark, d).select("speaker").where("speaker is not null").distinct()
    return s.select("speaker", title_and_name(F.col("speaker")).alias("t")).select("speaker", "t.title", "t.name").where("name is not null")


def name_keys(spark: SparkSession, d: str) -> DataFrame:
    s = sequence(spark, d).select("speaker").distinct()
    return s.select("speaker", name_key(F.col("speaker")).alias("key"))


def session_lookup(spark: SparkSession, d: str) -> DataFrame:
    sessions = load(spark, d, "sessions", "_id", "ple_code", "date").withColumnRenamed("_id", "session_id")
    return pairing.by_code_or_date(load(spark, d, "xml_lines", "ple_code"), sessions)


def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    """Sessions to insert into a store that holds those registered before 2015."""
    s = load(spark, d, "sessions", "url", "name", "registered_at")
    stored = s.where("registered_at < timestamp_ntz'2015-01-01'").select(F.md5(F.col("url").cast("binary")).alias("_id"))
    return absent(s.select("url", "name"), stored).select("_id", "url")


def code_forms(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "sessions", "_id", "ple_code", "date").where("ple_code is not null").distinct()
    return s.select("_id", code_date(F.col("ple_code")).alias("code_date"), date_code(F.col("date")).alias("date_code"))


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    text = sequence(spark, d).withColumn("session", code_key(F.col("session")))
    chairs = runs.chair(text)
    text = pairing.apply_aliases(runs.with_chair(text, chairs), pairing.aliases(text))
    meta = metadata_sequence(spark, d).where("speaker is not null")
    meta = meta.join(text.select("session").distinct(), "session", "left_semi")
    return written(text, "text-side"), written(runs.dense(meta.select("session", "pos", "speaker")), "meta-side")


def name_matches(spark: SparkSession, d: str) -> DataFrame:
    text, meta = _sides(spark, d)
    return pairing.match_names(text, meta, pairing.aliases(text))


def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of each label of a transcript record to each name of its urls."""
    t = load(spark, d, "session_texts", "record_id", "text", "urls").where("urls is not null")
    pairs = t.select("record_id", F.explode("text.speaker").alias("label"), F.flatten("urls.names").alias("names")).select("record_id", "label", F.explode("names").alias("name")).where("label is not null").distinct()
    return pairs.withColumn("similarity", token_set_ratio(F.lower("label"), F.lower("name")))


def speaker_index(spark: SparkSession, d: str) -> DataFrame:
    text, meta = _sides(spark, d)
    return pairing.speaker_index(text, meta, pairing.match_names(text, meta, pairing.aliases(text)))


def _aligned(spark: SparkSession, d: str, local: bool = False):
    text, meta = _sides(spark, d)
    matched = written(pairing.match_names(text, meta, pairing.aliases(text)), "matches")
    index = written(pairing.speaker_index(text, meta, matched), "index")
    tb, mb = runs.blocks(text), runs.blocks(meta)
    code = lambda b, side: pairing.encoded(b, index, side).select("session", F.col("block_no").alias("pos"), "idx")
    return pairing.align(code(tb, "text_name"), code(mb, "meta_name"), local=local), tb, mb, matched


def alignment(spark: SparkSession, d: str) -> DataFrame:
    return _aligned(spark, d)[0]


def alignment_local(spark: SparkSession, d: str) -> DataFrame:
    return _aligned(spark, d, local=True)[0]


def alignment_quality(spark: SparkSession, d: str) -> DataFrame:
    return pairing.alignment_summary(_aligned(spark, d)[0])


def aligned_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a transcript block and a metadata block that may be trusted."""
    rows, tb, mb, matched = _aligned(spark, d)
    good = pairing.good_pairs(pairing.decoded(rows, tb, mb), matched)
    return good.select("session", "pair_no", "left.start", "left.end", F.col("left.speaker").alias("text_speaker"), F.col("right.start").alias("meta_start"), F.col("right.end").alias("meta_end"), F.col("right.speaker").alias("meta_speaker"))


def block_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of each sequence side by side with those of the sequence without its first turn (the longer one meets nulls)."""
    seq = sequence(spark, d)
    other = seq.withColumn("pos", F.col("pos") - 1).where("pos >= 0")
    rows = pairing.side_by_side(runs.blocks(seq), runs.blocks(other))
    return rows.select("session", "row_no", F.col("left.speaker").alias("left_speaker"), F.col("right.speaker").alias("right_speaker"))


def dictionary_codes(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with the number of their speaker among the session's speakers in order of name."""
    seq = sequence(spark, d)
    names = seq.select("session", "speaker").where(F.col("speaker") != runs.PAUSE).distinct()
    from pyspark.sql import Window

    index = names.select("session", F.col("speaker").alias("text_name"), F.col("speaker").alias("meta_name"), (F.row_number().over(Window.partitionBy("session").orderBy("speaker")) - 1).cast("bigint").alias("idx"))
    return pairing.encoded(runs.blocks(seq), index, "text_name").select("session", "block_no", "idx")


def name_sets(spark: SparkSession, d: str) -> DataFrame:
    """Union, intersection and differences of the transcript's and the metadata's names."""
    t = sequence(spark, d).select(F.col("speaker").alias("name")).distinct()
    m = load(spark, d, "interventions", "intervinent").select(F.explode("intervinent").alias("name")).where("name is not null").distinct()
    kinds = {"union": t.union(m).distinct(), "both": t.intersect(m), "text_only": t.exceptAll(m), "metadata_only": m.subtract(t)}
    out = None
    for kind, df in kinds.items():
        n = df.select(F.lit(kind).alias("kind"), "name")
        out = n if out is None else out.unionByName(n)
    return out


def distinct_speakers(spark: SparkSession, d: str) -> DataFrame:
    return sequence(spark, d).groupBy("session").agg(F.countDistinct("speaker").alias("n_speakers"), F.count("*").alias("n_turns"))


def several_urls(spark: SparkSession, d: str) -> DataFrame:
    """Per session: records, and those with more than one media URL."""
    r = load(spark, d, "session_texts", "record_id", "ple_code", "urls").select("record_id", "ple_code", F.size(F.coalesce("urls", F.array())).alias("n")).distinct()
    return r.groupBy("ple_code").agg(F.count("*").alias("n_records"), F.sum((F.col("n") > 1).cast("bigint")).alias("n_several"))


def intervention_counts(spark: SparkSession, d: str) -> DataFrame:
    i = load(spark, d, "interventions", "intervention_id", "session_id").distinct()
    return i.groupBy("session_id").agg(F.count("*").alias("n_interventions"))


QUERIES = {f"ref_{f.__name__}": f for f in (
    turn_filter, chair, mode_speaker, run_heads, blocks, block_slices, metadata_speakers, sorted_interventions, alias_names, name_keys, session_lookup, insert_if_absent, code_forms,
    name_matches, name_similarity, speaker_index, alignment, alignment_local, alignment_quality, aligned_pairs, block_pairs, dictionary_codes, name_sets, distinct_speakers, several_urls, intervention_counts,
)}

_SEQ = """seq AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY pos, speaker) - 1 AS pos, speaker
  FROM (SELECT DISTINCT session, pos, speaker FROM speaker_seq WHERE speaker IS NOT NULL) s)"""
_TURNS = """turns AS (SELECT DISTINCT record_id, CAST(k - 1 AS BIGINT) AS pos, text[k].speaker AS speaker, text[k].text AS text
  FROM (SELECT record_id, text, unnest(range(1, len(text) + 1)) AS k FROM session_texts) s)"""
_MODE = "mode AS (SELECT session, speaker AS m, n FROM (SELECT session, speaker, count(*) AS n, row_number() OVER (PARTITION BY session ORDER BY count(*) DESC, min(pos)) AS r FROM seq GROUP BY session, speaker) c WHERE r = 1)"
_BLOCKS = """said AS (SELECT *, lag(speaker) OVER (PARTITION BY session ORDER BY pos) AS prev FROM seq WHERE speaker <> 'mesa'),
heads AS (SELECT session, pos, speaker, row_number() OVER (PARTITION BY session ORDER BY pos) - 1 AS block_no, lead(pos) OVER (PARTITION BY session ORDER BY pos) AS nxt FROM said WHERE prev IS NULL OR prev <> speaker),
begun AS (SELECT h.session, h.block_no, h.speaker, h.nxt, CASE WHEN h.block_no = 0 THEN 0 WHEN b.speaker = 'mesa' THEN h.pos - 1 ELSE h.pos END AS s FROM heads h LEFT JOIN seq b ON b.session = h.session AND b.pos = h.pos - 1),
blocks AS (SELECT session, block_no, s AS start, CASE WHEN nxt IS NULL THEN s ELSE nxt - 1 END AS "end", speaker FROM begun)"""
_CODE = r"regexp_replace(regexp_replace(trim(ple_code), '[-/]', '_', 'g'), '_0*([0-9]+)$', '_\1')"
SQL = {
    "ref_turn_filter": f"WITH {_TURNS} SELECT * FROM turns WHERE text <> '' AND NOT contains(speaker, 'ORDRE') AND NOT regexp_matches(speaker, '^\\p{{Ll}}')",
    "ref_chair": f"""WITH {_SEQ}, {_MODE}, e AS (SELECT session, arg_min(speaker, pos) AS f, arg_max(speaker, pos) AS l FROM seq GROUP BY session)
SELECT e.session, CASE WHEN f = m OR f = l THEN f WHEN l = m THEN l WHEN contains(lower(f), 'parlament') THEN f WHEN contains(lower(l), 'parlament') THEN l ELSE m END AS chair FROM e JOIN mode ON mode.session = e.session""",
    "ref_mode_speaker": f"WITH {_SEQ}, {_MODE} SELECT session, m AS speaker, n FROM mode",
    "ref_run_heads": f"WITH {_SEQ}, {_BLOCKS} SELECT session, block_no AS run_no, pos, speaker FROM heads",
    "ref_blocks": f"WITH {_SEQ}, {_BLOCKS} SELECT * FROM blocks",
    "ref_block_slices": f"""WITH {_SEQ}, {_BLOCKS} SELECT b.session, block_no, count(*) AS n_rows, string_agg(s.speaker, '; ' ORDER BY s.pos) AS speakers
FROM blocks b JOIN seq s ON s.session = b.session AND s.pos BETWEEN b.start AND b."end" GROUP BY b.session, block_no""",
    "ref_metadata_speakers": f"""WITH i AS (SELECT DISTINCT {_CODE} AS session, start, pos, intervention_id, intervinent, media_url FROM interventions WHERE ple_code IS NOT NULL AND len(intervinent) > 0),
e AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY start NULLS FIRST, pos NULLS FIRST, intervention_id, k) AS at_pos FROM (SELECT session, start, pos, intervention_id, intervinent[k] AS n, k FROM (SELECT *, unnest(range(1, len(intervinent) + 1)) AS k FROM i) x) y WHERE n IS NOT NULL),
m AS (SELECT session, n AS m FROM (SELECT session, n, row_number() OVER (PARTITION BY session ORDER BY count(*) DESC, min(at_pos)) AS r FROM e GROUP BY session, n) c WHERE r = 1),
c AS (SELECT f.session, CASE WHEN f = m OR f = l THEN f WHEN l = m THEN l WHEN contains(lower(f), 'parlament') THEN f WHEN contains(lower(l), 'parlament') THEN l ELSE m END AS chair
  FROM (SELECT session, arg_min(n, at_pos) AS f, arg_max(n, at_pos) AS l FROM e GROUP BY session) f JOIN m ON m.session = f.session),
s AS (SELECT i.session, intervention_id, list_transform(intervinent, lambda n: CASE WHEN contains(n, chair) THEN 'mesa' ELSE replace(trim(split_part(n, '|', 1), ' ' || chr(160)), chr(160), ' ') END) AS names FROM i JOIN c ON c.session = i.session)
SELECT session, intervention_id, CASE WHEN len(names) = 1 OR list_position(names, 'mesa') IS NULL OR list_position(names, 'mesa') <> 1 THEN names[1] ELSE names[2] END AS speaker FROM s""",
    "ref_sorted_interventions": """SELECT ple_code, intervention_id, row_number() OVER (PARTITION BY ple_code ORDER BY start ASC NULLS FIRST, pos, intervention_id) AS place
FROM (SELECT DISTINCT ple_code, intervention_id, start, pos FROM interventions WHERE ple_code IS NOT NULL) i""",
    "ref_alias_names": f"""WITH {_TURNS} SELECT DISTINCT speaker, trim(regexp_extract(speaker, '(.+)\\((.+)\\)', 1)) AS title, trim(regexp_extract(speaker, '(.+)\\((.+)\\)', 2)) AS name
FROM turns WHERE regexp_matches(speaker, '(.+)\\((.+)\\)')""",
    "ref_name_keys": f"WITH {_SEQ} SELECT DISTINCT speaker, regexp_replace(strip_accents(lower(trim(replace(speaker, chr(160), ' ')))), '[^\\x00-\\x7F]', '', 'g') AS key FROM seq",
    "ref_session_lookup": """WITH t AS (SELECT DISTINCT ple_code FROM xml_lines WHERE ple_code IS NOT NULL), s AS (SELECT DISTINCT _id, ple_code, date FROM sessions),
c AS (SELECT t.ple_code, s._id FROM t JOIN s ON s.ple_code = t.ple_code)
SELECT ple_code, _id AS session_id, 'code' AS "by" FROM c
UNION SELECT t.ple_code, s._id, 'date' FROM t JOIN s ON s.date = t.ple_code[9:10] || '/' || t.ple_code[6:7] || '/' || t.ple_code[1:4] WHERE t.ple_code NOT IN (SELECT ple_code FROM c)""",
    "ref_insert_if_absent": "SELECT DISTINCT md5(url) AS _id, url FROM sessions WHERE url <> '' AND md5(url) NOT IN (SELECT md5(url) FROM sessions WHERE registered_at < TIMESTAMP '2015-01-01')",
    "ref_code_forms": "SELECT DISTINCT _id, ple_code[9:10] || '/' || ple_code[6:7] || '/' || ple_code[1:4] AS code_date, date[7:10] || '_' || date[4:5] || '_' || date[1:2] AS date_code FROM sessions WHERE ple_code IS NOT NULL",
    "ref_block_pairs": f"""WITH first_seq AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY pos, speaker) - 1 AS pos, speaker FROM (SELECT DISTINCT session, pos, speaker FROM speaker_seq WHERE speaker IS NOT NULL) s),
seq AS (SELECT 'a' || session AS session, pos, speaker FROM first_seq UNION ALL SELECT 'b' || session, pos - 1, speaker FROM first_seq WHERE pos > 0), {_BLOCKS},
a AS (SELECT session[2:] AS session, block_no, speaker FROM blocks WHERE session[1] = 'a'), b AS (SELECT session[2:] AS session, block_no, speaker FROM blocks WHERE session[1] = 'b')
SELECT coalesce(a.session, b.session) AS session, coalesce(a.block_no, b.block_no) AS row_no, a.speaker AS left_speaker, b.speaker AS right_speaker FROM a FULL JOIN b ON a.session = b.session AND a.block_no = b.block_no""",
    "ref_dictionary_codes": f"""WITH {_SEQ}, {_BLOCKS}, names AS (SELECT session, speaker, dense_rank() OVER (PARTITION BY session ORDER BY speaker) - 1 AS idx FROM seq WHERE speaker <> 'mesa')
SELECT DISTINCT b.session, block_no, idx FROM blocks b JOIN names n ON n.session = b.session AND n.speaker = b.speaker""",
    "ref_name_sets": f"""WITH {_SEQ}, t AS (SELECT DISTINCT speaker AS name FROM seq), m AS (SELECT DISTINCT n AS name FROM (SELECT unnest(intervinent) AS n FROM interventions) i WHERE n IS NOT NULL)
SELECT 'union' AS kind, name FROM (SELECT name FROM t UNION SELECT name FROM m) u UNION ALL SELECT 'both', name FROM (SELECT name FROM t INTERSECT SELECT name FROM m) b
UNION ALL SELECT 'text_only', name FROM (SELECT name FROM t EXCEPT SELECT name FROM m) x UNION ALL SELECT 'metadata_only', name FROM (SELECT name FROM m EXCEPT SELECT name FROM t) y""",
    "ref_distinct_speakers": f"WITH {_SEQ} SELECT session, count(DISTINCT speaker) AS n_speakers, count(*) AS n_turns FROM seq GROUP BY session",
    "ref_several_urls": """SELECT ple_code, count(*) AS n_records, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_several
FROM (SELECT DISTINCT record_id, ple_code, coalesce(len(urls), 0) AS n FROM session_texts) r GROUP BY ple_code""",
    "ref_intervention_counts": "SELECT session_id, count(*) AS n_interventions FROM (SELECT DISTINCT intervention_id, session_id FROM interventions) i GROUP BY session_id",
}

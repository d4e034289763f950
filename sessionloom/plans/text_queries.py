"""Queries over texts, layout, media and parsed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions import codes, text
from sessionloom.operators import layout, quality, runs, trimming
from sessionloom.plans.sequence_queries import _TURNS, turns
from sessionloom.sources import files, html
from sessionloom.tables import load, written


def clean_structure(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).where("text is not null").select("record_id", "pos", text.structure_clean(F.col("text")).alias("text"))


def punctuation(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents", "doc_id", "text").select("doc_id", text.punctuation(F.col("text")).alias("text"))


def sentences(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("pos", "sentence"))
    return s.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "sentence")


def well_formed(spark: SparkSession, d: str) -> DataFrame:
    s = sentences(spark, d)
    return s.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.sum(text.well_formed(F.col("sentence")).cast("bigint")).alias("n_well_formed"))


def lexicon_score(spark: SparkSession, d: str) -> DataFrame:
    return quality.lexicon_scores(load(spark, d, "documents", "doc_id", "text"), load(spark, d, "lexicon"), "doc_id")


def hyphen_fix(spark: SparkSession, d: str) -> DataFrame:
    return quality.hyphens_fixed(load(spark, d, "documents", "doc_id", "text"), load(spark, d, "lexicon"), "doc_id")


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_turns(load(spark, d, "documents", "doc_id", "text"), load(spark, d, "lexicon"), "doc_id")


def clean_sentences(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_turns(load(spark, d, "documents", "doc_id", "text"), load(spark, d, "lexicon"), "doc_id", sentence_first=True)


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The transcript records, and each document as a record of one turn; the chair of each session by its transcript turns."""
    r = load(spark, d, "session_texts", "record_id", "text", "urls", "ple_code").dropDuplicates(["record_id"])
    r = r.select(F.concat(F.lit("r"), "record_id").alias("record_id"), F.col("ple_code").alias("session"), "text", "urls", (F.col("record_id") * 1_000_000).alias("at"))
    turn = F.array(F.struct(F.col("speaker").alias("speaker"), F.col("text").alias("text")))
    url = F.array(F.struct(F.array("speaker").alias("names"), F.lit("u").alias("url")))
    docs = load(spark, d, "documents", "doc_id", "text", "speaker", "ple_code").select(F.concat(F.lit("d"), "doc_id").alias("record_id"), F.col("ple_code").alias("session"), turn.alias("text"), url.alias("urls"))
    seq = r.select("session", "at", F.posexplode("text").alias("k", "t")).select("session", (F.col("at") + F.col("k")).alias("pos"), F.col("t.speaker").alias("speaker"))
    return r.drop("at").unionByName(docs), runs.chair(seq)


def acceptance(spark: SparkSession, d: str) -> DataFrame:
    r, c = _records(spark, d)
    return quality.judged(r, c, load(spark, d, "lexicon"))


def accepted_turns(spark: SparkSession, d: str) -> DataFrame:
    r, c = _records(spark, d)
    return quality.accepted(r, c, load(spark, d, "lexicon"))


def speaking_rate(spark: SparkSession, d: str) -> DataFrame:
    """Documents as if read aloud at 15 characters a second."""
    t = load(spark, d, "documents", "doc_id", "text", "n_chars")
    media = t.select(F.col("doc_id").alias("media_url"), (F.col("n_chars") / F.lit(15.0)).alias("duration"))
    return quality.speaking_rates(t.select(F.col("doc_id").alias("record_id"), "text", F.col("doc_id").alias("media_url")), media)


def edge_words(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "documents", "doc_id", "text")
    return t.select("doc_id", F.array_join(text.first_words(F.col("text"), 5), " ").alias("head"), F.array_join(text.last_words(F.col("text"), 5), " ").alias("tail"))


def first_ngram(spark: SparkSession, d: str) -> DataFrame:
    """Where the last three words of each document first stand in it."""
    t = load(spark, d, "documents", "doc_id", "text").select("doc_id", text.words(F.col("text")).alias("w"))
    t = t.where("size(w) >= 3").withColumn("sought", F.slice("w", F.size("w") - 2, F.lit(3)))
    return t.select("doc_id", trimming.first_match(F.col("w"), F.col("sought")).cast("bigint").alias("place"))


def word_windows(spark: SparkSession, d: str) -> DataFrame:
    """All runs of four neighbouring words of each document."""
    t = load(spark, d, "documents", "doc_id", "text").select("doc_id", trimming.windows(text.words(F.col("text")), 4).alias("w"))
    return t.select("doc_id", F.posexplode("w").alias("pos", "x")).select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.array_join("x", " ").alias("words"))


def audio_parts(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "media_files", "media_url", "duration").where("duration is not null").distinct()
    p = m.select("media_url", "duration", F.posexplode(trimming.searched_parts(F.col("duration"))).alias("part", "p"))
    return p.select("media_url", F.round("duration", 4).alias("duration"), F.col("part").cast("bigint").alias("part"), F.round("p.start", 4).alias("start"), F.round("p.end", 4).alias("end"), F.round("p.offset", 4).alias("offset"))


def media_shards(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "media_files", "media_url").where("media_url is not null").distinct()
    path = codes.shard_path("text/audio", F.col("media_url"))
    return m.select("media_url", path.alias("audio_path"), codes.text_path(path).alias("text_path"), codes.stem(F.col("media_url")).alias("stem"))


def segment_names(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "media_files", "media_url", "duration").where("media_url is not null and duration is not null").distinct()
    return m.select(codes.segment_name(F.col("media_url"), F.lit(0.0), F.col("duration")).alias("name"))


def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    r = load(spark, d, "session_texts", "filepath", "urls").where("urls is not null and size(urls) > 0")
    return r.select(F.concat(F.lit("sessions/"), F.col("filepath")).alias("text_path"), codes.shard_path("audio", F.col("urls")[0]["url"]).alias("audio_path")).distinct()


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    x = load(spark, d, "xml_lines", "ple_code", "page", "line_no", "top", "left", "width", "height", "font", "text").distinct()
    return x.withColumnRenamed("ple_code", "doc")


def left_margins(spark: SparkSession, d: str) -> DataFrame:
    m = layout.left_margins(document_lines(spark, d))
    return m.select("doc", "left", "n", F.col("rank").cast("bigint").alias("rank"), F.round("share", 9).alias("share"))


def content_columns(spark: SparkSession, d: str) -> DataFrame:
    c = layout.content_columns(document_lines(spark, d))
    return c.select("doc", F.col("share").cast("double").alias("share"), F.col("columns").cast("bigint").alias("columns"), F.array_join(F.transform("lefts", lambda x: F.round(x, 3).cast("string")), ",").alias("lefts"))


def text_font(spark: SparkSession, d: str) -> DataFrame:
    return layout.text_font(document_lines(spark, d))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "diary_pages", "ple_code", "page", "width", "height").where("ple_code is not null").distinct()
    return layout.page_sizes(p.withColumnRenamed("ple_code", "doc"))


def page_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d)


def _pages(spark: SparkSession, d: str, lines: DataFrame) -> DataFrame:
    """The pages of each transcript, up to the last that has a line or a size."""
    return layout.page_counts(lines.select("doc", "page"), load(spark, d, "diary_pages", "ple_code", "page").withColumnRenamed("ple_code", "doc"))


def _layout(spark: SparkSession, d: str):
    lines = written(document_lines(spark, d), "layout-lines")
    columns, fonts = written(layout.content_columns(lines), "layout-columns"), written(layout.text_font(lines), "layout-fonts")
    tops = layout.header_footer(lines, columns, fonts, _sizes(spark, d).select("doc", "height"), _pages(spark, d, lines))
    merged = layout.merge_fragments(lines)
    return written(layout.split_content(merged, columns, tops), "layout-content"), fonts


def header_footer(spark: SparkSession, d: str) -> DataFrame:
    lines = document_lines(spark, d)
    return layout.header_footer(lines, layout.content_columns(lines), layout.text_font(lines), _sizes(spark, d).select("doc", "height"), _pages(spark, d, lines))


def line_fragments(spark: SparkSession, d: str) -> DataFrame:
    """Each line with a width, cut in two pieces side by side, as one line again."""
    x = document_lines(spark, d).where("doc is not null and page is not null and line_no is not null and try_cast(width AS int) > 4 and try_cast(left AS int) is not null and try_cast(top AS double) is not null")
    left, width, cut = F.col("left").cast("int"), F.col("width").cast("int"), F.floor(F.length("text") / 2).cast("int")
    first = F.struct((F.col("line_no") * 2).alias("line_no"), "left", F.lit("3").alias("width"), F.substring("text", F.lit(1), cut).alias("text"))
    rest = F.struct((F.col("line_no") * 2 + 1).alias("line_no"), (left + 3).cast("string").alias("left"), (width - 2).cast("string").alias("width"), F.substring("text", cut + 1, F.length("text")).alias("text"))
    cut_lines = x.select("doc", "page", "top", "height", "font", F.explode(F.array(first, rest)).alias("p")).select("doc", "page", "p.line_no", "top", "p.left", "p.width", "height", "font", "p.text")
    return layout.merge_fragments(cut_lines).select("doc", "page", (F.col("line_no") / 2).cast("int").alias("line_no"), "top", "left", "width", "height", "font", "text")


def content_lines(spark: SparkSession, d: str) -> DataFrame:
    return _layout(spark, d)[0]


def speaker_style(spark: SparkSession, d: str) -> DataFrame:
    content, fonts = _layout(spark, d)
    return layout.speaker_style(content.where("kept"), fonts)


def speeches(spark: SparkSession, d: str) -> DataFrame:
    content, fonts = _layout(spark, d)
    kept = content.where("kept")
    return layout.speeches(layout.stack_speakers(kept, written(layout.speaker_style(kept, fonts), "layout-style"), fonts))


def catalogue_pages(spark: SparkSession, d: str) -> DataFrame:
    """Sessions written as catalogue pages and read back."""
    s = load(spark, d, "sessions", "url", "name", "date", "duration").where("url is not null and name is not null and date is not null and duration is not null").distinct()
    box = F.concat(F.lit("<li><div><h2><a href='"), "url", F.lit("'>"), "name", F.lit("</a></h2><p>Data: "), "date", F.lit("</p><p>Durada: "), "duration", F.lit("</p></div></li>"))
    page = s.groupBy(F.substring(F.md5("url"), 1, 1).alias("url")).agg(F.concat(F.lit("<html><body><ul class='llista_videos'>"), F.array_join(F.collect_list(box), ""), F.lit("</ul></body></html>")).alias("html"))
    return html.catalogue(page).drop("page_url").distinct()


def page_xml(spark: SparkSession, d: str) -> DataFrame:
    """Lines written as page XML and read back."""
    x = document_lines(spark, d).where("doc is not null and page is not null")
    attr = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {c}="'), F.col(c), F.lit('"'))).otherwise(F.lit("")) for c in ("top", "left", "width", "height", "font")]
    line = F.concat(F.lit("<text"), *attr, F.lit(">"), F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("</text>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", line.alias("x")))), lambda p: p["x"]), "\n")
    docs = x.groupBy("doc", "page").agg(F.concat(F.lit('<page width="892" height="1262">'), body, F.lit("</page>")).alias("xml")).select(F.concat_ws("#", "doc", "page").alias("doc"), "xml")
    back = files.page_lines(docs)
    return back.select(F.split_part("doc", F.lit("#"), F.lit(1)).alias("doc"), F.split_part("doc", F.lit("#"), F.lit(2)).cast("int").alias("page"), "top", "left", "width", "height", "font", "text").distinct()


QUERIES = {f"ref_{f.__name__}": f for f in (
    clean_structure, punctuation, sentences, well_formed, lexicon_score, hyphen_fix, clean_text, clean_sentences, acceptance, accepted_turns, speaking_rate, edge_words, first_ngram, word_windows,
    audio_parts, media_shards, segment_names, manifest_rows, left_margins, content_columns, text_font, page_sizes, header_footer, line_fragments, content_lines, speaker_style, speeches, catalogue_pages, page_xml,
)}

_TERM = r"(\.\.\.|!\"|!''|!|\?\"|\?''|\?|\.''|\.\"|\.)"
_SENT = f"""s AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(text, '{_TERM}( *[A-ZÀÉÈÜÚÍÏÓÒÇ])', '\\1' || chr(1) || '\\2', 'g'), chr(1)),
  lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')) AS sentence, generate_subscripts(list_filter(list_transform(string_split(regexp_replace(text, '{_TERM}( *[A-ZÀÉÈÜÚÍÏÓÒÇ])', '\\1' || chr(1) || '\\2', 'g'), chr(1)),
  lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), 1) - 1 AS pos FROM documents)"""
_BLANK = r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}\x{1680}\x{205F}\x{85}\x{B}]+"
_W = f"list_filter(regexp_split_to_array(text, '{_BLANK}'), lambda x: x <> '')"
_LINES = 'l AS (SELECT DISTINCT ple_code AS doc, page, line_no, top, "left", width, height, font, text FROM xml_lines), body AS (SELECT *, page * 1000000 + line_no AS seen_at FROM l WHERE page >= 2)'
_STRIP = lambda x: f"regexp_replace({x}, '^{_BLANK}|{_BLANK}$', '', 'g')"
_MARG = """marg AS (SELECT doc, "left", n, row_number() OVER w AS rank, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) / sum(n) OVER (PARTITION BY doc) AS share
  FROM (SELECT doc, CAST("left" AS DOUBLE) AS "left", count(*) AS n, min(seen_at) AS first_at FROM body WHERE try_cast("left" AS DOUBLE) IS NOT NULL GROUP BY doc, CAST("left" AS DOUBLE)) c WINDOW w AS (PARTITION BY doc ORDER BY n DESC, first_at))"""
_COLS = """tried AS (SELECT m.doc, g.wanted, count(*) AS k, max(share) AS reached, string_agg(CAST(round("left", 3) AS VARCHAR), ',' ORDER BY "left") AS lefts
  FROM (SELECT *, coalesce(lag(share) OVER (PARTITION BY doc ORDER BY rank), 0) AS before FROM marg) m JOIN (SELECT round(0.75 + 0.025 * i, 3) AS wanted FROM range(10) r(i)) g ON before <= wanted GROUP BY m.doc, g.wanted),
cols AS (SELECT doc, wanted AS share, k // 2 AS columns, lefts FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY wanted) AS r FROM tried WHERE k IN (2, 4) AND reached > wanted) t WHERE r = 1)"""
_FONT = "font AS (SELECT doc, font AS text_font FROM (SELECT doc, font, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, min(seen_at)) AS r FROM body WHERE font IS NOT NULL GROUP BY doc, font) f WHERE r = 1)"
_SIZE = """size AS (SELECT doc, width, height, sizes FROM (SELECT ple_code AS doc, width, height, row_number() OVER (PARTITION BY ple_code ORDER BY count(*) DESC, width DESC, height DESC) AS r, count(*) OVER (PARTITION BY ple_code) AS sizes
  FROM (SELECT DISTINCT ple_code, page, width, height FROM diary_pages WHERE ple_code IS NOT NULL) p GROUP BY ple_code, width, height) q WHERE r = 1)"""
# The test tables hold no line in pieces, so these do without the fold that joins pieces; ref_line_fragments proves the fold.
_TOPS = """pg AS (SELECT doc, max(page) + 1 AS pages FROM (SELECT doc, page FROM l UNION ALL SELECT ple_code, page FROM diary_pages) p GROUP BY doc),
near AS (SELECT b.doc, b.top, b.font, b.text, count(*) AS n, min(seen_at) AS first_at FROM body b JOIN cols c ON c.doc = b.doc AND list_contains(list_transform(string_split(c.lefts, ','), lambda x: CAST(x AS DOUBLE)), round(try_cast(b."left" AS DOUBLE), 3)) JOIN font f ON f.doc = b.doc WHERE b.font <> f.text_font GROUP BY b.doc, b.top, b.font, b.text),
top2 AS (SELECT near.doc, top, row_number() OVER (PARTITION BY near.doc ORDER BY n DESC, first_at) AS r, count(*) OVER (PARTITION BY near.doc) AS found FROM near JOIN pg ON pg.doc = near.doc WHERE n >= greatest(1, pages // 3 - 2)),
y AS (SELECT t.doc, top, found, CAST(top AS DOUBLE) / height AS y FROM top2 t JOIN size s ON s.doc = t.doc WHERE r <= 2 AND found >= 2),
tops AS (SELECT DISTINCT doc, top FROM (SELECT *, min(y) OVER (PARTITION BY doc) AS lo, max(y) OVER (PARTITION BY doc) AS hi FROM y) z WHERE found = 2 OR (lo < 0.1 AND hi > 0.89))"""
_CONTENT = """content AS (SELECT l.doc, l.page, l.line_no, l.top, l."left", l.width, l.height, l.font, coalesce(l.text, '') AS text, CASE WHEN p BETWEEN 1 AND 2 THEN 0 WHEN p > 2 THEN 1 END AS col, tops.top IS NOT NULL AS repeated, coalesce(tops.top IS NULL AND p IS NOT NULL, false) AS kept
  FROM (SELECT l.*, list_position(list_transform(string_split(c.lefts, ','), lambda x: CAST(x AS DOUBLE)), round(try_cast(l."left" AS DOUBLE), 3)) AS p FROM l LEFT JOIN cols c ON c.doc = l.doc) l LEFT JOIN tops ON tops.doc = l.doc AND tops.top = l.top)"""
_STYLE = f"""k AS (SELECT c.*, {_STRIP("c.text")} AS said, page::BIGINT * 100000000 + col * 10000000 + line_no AS ord, f.text_font FROM content c LEFT JOIN font f ON f.doc = c.doc WHERE kept),
o AS (SELECT doc, font, text_font, count(*) AS n, min(ord) AS first_ord, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, min(ord)) AS place FROM k WHERE font IS NOT NULL GROUP BY doc, font, text_font),
usual AS (SELECT doc FROM o WHERE place = 1 AND font = text_font),
named AS (SELECT doc, font, arg_min(said, ord) AS said FROM k WHERE font <> text_font AND doc IN (SELECT doc FROM usual) AND regexp_matches(said, '^(El president|La presidenta|La vicepresidenta|El vicepresident|<b>)') GROUP BY doc, font),
best AS (SELECT doc, font, said FROM (SELECT named.*, row_number() OVER (PARTITION BY named.doc ORDER BY place) AS r FROM named JOIN o ON o.doc = named.doc AND o.font = named.font) q WHERE r = 1),
style AS (SELECT doc, speaker_font, speaker_height FROM (SELECT best.doc, best.font AS speaker_font, arg_max(k.height, k.ord) AS speaker_height FROM best JOIN k ON k.doc = best.doc AND k.font = best.font AND k.said = best.said GROUP BY best.doc, best.font) z WHERE speaker_height IS NOT NULL)"""
_WORDS = lambda x: f"list_filter(regexp_split_to_array({x}, '{_BLANK}'), lambda x: x <> '')"
_BARE = lambda x: f"""regexp_replace({x}, '-#| - | · | '' |<i>|</i>|[.,:;!?"()–’‘¿¡]', '', 'g')"""
# Records of the transcripts and of the documents with the chair of their session, their speaker, and the texts that count.
_RECORDS = f"""t AS (SELECT record_id, any_value(ple_code) AS session, any_value(text) AS text, any_value(urls) AS urls FROM session_texts GROUP BY record_id),
said AS (SELECT session, record_id * 1000000 + i AS pos, text[i].speaker AS n FROM (SELECT *, unnest(range(1, len(text) + 1)) AS i FROM t) x WHERE text[i].speaker IS NOT NULL),
usual AS (SELECT session, n AS m FROM (SELECT session, n, row_number() OVER (PARTITION BY session ORDER BY count(*) DESC, min(pos)) AS r FROM said GROUP BY session, n) c WHERE r = 1),
chairs AS (SELECT f.session, {_STRIP("CASE WHEN f = m OR f = l THEN f WHEN l = m THEN l WHEN contains(lower(f), 'parlament') THEN f WHEN contains(lower(l), 'parlament') THEN l ELSE m END")} AS chair
  FROM (SELECT session, arg_min(n, pos) AS f, arg_max(n, pos) AS l FROM said GROUP BY session) f JOIN usual ON usual.session = f.session),
r AS (SELECT 'r' || record_id AS record_id, session, text, coalesce(len(urls), 0) AS n_urls FROM t UNION ALL SELECT 'd' || doc_id, ple_code, [{{'speaker': speaker, 'text': text}}], 1 FROM documents),
a AS (SELECT record_id, n_urls, chair, list_sort(list_filter(list_distinct(list_transform(text, lambda x: {_STRIP("x.speaker")})), lambda x: x IS NOT NULL AND x IS DISTINCT FROM chair))[1] AS speaker,
  CASE WHEN {_STRIP("text[len(text)].speaker")} = chair THEN text[1:len(text) - 1] ELSE text END AS t FROM r LEFT JOIN chairs ON chairs.session = r.session),
b AS (SELECT *, array_to_string(list_transform(t, lambda x: coalesce(x.text, '')), '') AS all_text, array_to_string(list_transform(list_filter(t, lambda x: {_STRIP("x.speaker")} = speaker), lambda x: coalesce(x.text, '')), '') AS own FROM a)"""
_STRUCTURE = lambda x: f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace({x}, chr(160), ' '), chr(173), '-'),
  '<i>\\(.*?\\) ?</i>', '', 'g'), '\\(.*?\\)', '', 'g'), '\\{{.+\\}}', '', 'g'), ' {{2,}}', ' ', 'g'), ' \\.', '.', 'g'), '<.{{1,3}}>', '', 'g')"""  # noqa: E731
_PUNCTUATION = lambda x: "translate(regexp_replace(translate(" + x + ", '`’', ''''''), '''+', '''', 'g'), '“”«»\"', '')"
_SENTENCES = lambda x: f"""list_filter(list_transform(string_split(regexp_replace({x}, '{_TERM}( *[A-ZÀÉÈÜÚÍÏÓÒÇ])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: regexp_replace(x, '^{_BLANK}|{_BLANK}$', '', 'g')), lambda x: x <> '')"""
# fixed(k, text) of src(k, text): words that only the joined form of is in the lexicon, replaced in the order in which they first stand.
_FIXED = f"""cores AS (SELECT k, core, min(n) AS n FROM (SELECT k, unnest(c) AS core, generate_subscripts(c, 1) AS n FROM (SELECT k, list_transform(list_filter({_WORDS("text")}, lambda w: regexp_matches(w, '.-.')), lambda w: regexp_extract(w, '[a-zA-Z0-9àáéèüúíïóòçÀÁÉÈÜÚÍÏÓÒÇ\\-'']+')) AS c FROM src) a) b WHERE core <> '' GROUP BY k, core),
wrong AS (SELECT k, list(core ORDER BY n) AS w FROM cores WHERE lower(core) NOT IN (SELECT word FROM lexicon) AND lower(replace(core, '-', '')) IN (SELECT word FROM lexicon) GROUP BY k),
fixed AS (SELECT src.k, CASE WHEN w IS NULL THEN text ELSE list_reduce(list_concat([text], w), lambda t, c: replace(t, c, lower(replace(c, '-', '')))) END AS text FROM src LEFT JOIN wrong ON wrong.k = src.k)"""
SQL = {
    "ref_clean_structure": f"""WITH {_TURNS} SELECT record_id, pos, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(text, chr(160), ' '), chr(173), '-'),
  '<i>\\(.*?\\) ?</i>', '', 'g'), '\\(.*?\\)', '', 'g'), '\\{{.+\\}}', '', 'g'), ' {{2,}}', ' ', 'g'), ' \\.', '.', 'g'), '<.{{1,3}}>', '', 'g') AS text FROM turns WHERE text IS NOT NULL""",
    "ref_punctuation": "SELECT doc_id, translate(regexp_replace(translate(text, '`’', ''''''), '''+', '''', 'g'), '“”«»\"', '') AS text FROM documents",
    "ref_sentences": f"WITH {_SENT} SELECT doc_id, CAST(pos AS BIGINT) AS pos, sentence FROM s",
    "ref_well_formed": f"""WITH {_SENT} SELECT doc_id, count(*) AS n_sentences, CAST(sum(CASE WHEN NOT contains(sentence, '|') AND NOT contains(sentence, '[') AND NOT regexp_matches(sentence, '[0-9]:[0-9]')
  AND NOT regexp_matches(sentence, '\\s·') AND length(sentence) BETWEEN 31 AND 600 AND regexp_full_match(sentence, '[a-zA-Z0-9àáéèüúíïóòçÀÁÉÈÜÚÍÏÓÒÇ .!,;:''"?·$°£€%-]+') THEN 1 ELSE 0 END) AS BIGINT) AS n_well_formed FROM s GROUP BY doc_id""",
    "ref_lexicon_score": f"""WITH t AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(text, '-#| - | · | '' |<i>|</i>|[.,:;!?"()–’‘¿¡]', '', 'g')), '{_BLANK}'), lambda x: x <> '')) AS w FROM documents),
k AS (SELECT doc_id, count(l.word) AS n_known FROM (SELECT doc_id, unnest(w) AS word FROM t) u LEFT JOIN (SELECT DISTINCT word FROM lexicon) l ON l.word = u.word GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_tokens, coalesce(n_known, 0) AS n_known, round(CASE WHEN len(w) = 0 THEN 1.0::DOUBLE ELSE n_known / len(w)::DOUBLE END, 6) AS score FROM t LEFT JOIN k ON k.doc_id = t.doc_id""",
    "ref_acceptance": f"""WITH {_RECORDS},
w AS (SELECT *, CAST(coalesce(len({_WORDS("all_text")}), 0) AS INTEGER) AS n_words, CAST(coalesce(len({_WORDS("own")}), 0) AS INTEGER) AS own_words, list_distinct({_WORDS("lower(" + _BARE("own") + ")")}) AS tokens FROM b),
k AS (SELECT record_id, count(*) AS known FROM (SELECT record_id, unnest(tokens) AS word FROM w) u WHERE word IN (SELECT word FROM lexicon) GROUP BY record_id),
v AS (SELECT w.*, CASE WHEN n_urls <= 1 AND speaker IS NOT NULL THEN CASE WHEN len(tokens) = 0 THEN 1.0::DOUBLE ELSE coalesce(known, 0) / len(tokens)::DOUBLE END END AS score, CASE WHEN n_words > 0 THEN own_words / n_words::DOUBLE ELSE 0.0::DOUBLE END AS share FROM w LEFT JOIN k ON k.record_id = w.record_id)
SELECT record_id, speaker, n_words::BIGINT AS n_words, own_words::BIGINT AS own_words, round(share, 6) AS share, round(score, 6) AS score, CASE WHEN n_urls > 1 THEN 'several urls' WHEN speaker IS NULL THEN 'only the chair' WHEN score < 0.7 THEN 'lexicon' WHEN own_words < 130 THEN 'short' WHEN share < 0.7 THEN 'share' END AS reason FROM v""",
    "ref_speaking_rate": f"""SELECT doc_id AS record_id, CAST(len({_W}) AS BIGINT) AS words, n_chars / 15.0::DOUBLE AS duration, round(len({_W}) / (n_chars / 15.0::DOUBLE) * 60, 4) AS words_per_minute,
  len({_W}) / (n_chars / 15.0::DOUBLE) * 60 BETWEEN 95 AND 195 AS fits FROM documents WHERE n_chars > 0""",
    "ref_edge_words": f"SELECT doc_id, array_to_string(w[1:5], ' ') AS head, array_to_string(w[greatest(len(w) - 4, 1):], ' ') AS tail FROM (SELECT doc_id, {_W} AS w FROM documents) d",
    "ref_first_ngram": f"SELECT doc_id, CAST(list_filter(range(1, len(w) - 1), lambda i: w[i:i + 2] = w[len(w) - 2:])[1] - 1 AS BIGINT) AS place FROM (SELECT doc_id, {_W} AS w FROM documents) d WHERE len(w) >= 3",
    "ref_word_windows": f"SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, array_to_string(w[i:i + 3], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM (SELECT doc_id, {_W} AS w FROM documents) d) e",
    "ref_audio_parts": """WITH m AS (SELECT DISTINCT media_url, duration FROM media_files WHERE duration IS NOT NULL)
SELECT media_url, round(duration, 4) AS duration, CAST(part AS BIGINT) AS part, round(CASE WHEN duration > 100 AND part = 1 THEN duration - 60 ELSE 0 END, 4) AS start,
  round(CASE WHEN duration > 100 AND part = 0 THEN 60 ELSE duration END, 4) AS "end", round(CASE WHEN duration > 100 AND part = 1 THEN duration - 60 ELSE 0 END, 4) AS "offset" FROM m, range(2) p(part)""",
    "ref_media_shards": """SELECT DISTINCT media_url, 'text/audio/' || n[1] || '/' || n[2] || '/' || n AS audio_path, 'clean_text/audio/' || n[1] || '/' || n[2] || '/' || n AS text_path, split_part(n, '.', 1) AS stem
FROM (SELECT media_url, split_part(media_url, '/', -1) AS n FROM media_files WHERE media_url IS NOT NULL) m""",
    "ref_segment_names": "SELECT printf('%s_%.3f_%.3f.wav', split_part(split_part(media_url, '/', -1), '.', 1), 0.0::DOUBLE, duration) AS name FROM (SELECT DISTINCT media_url, duration FROM media_files WHERE media_url IS NOT NULL AND duration IS NOT NULL) m",
    "ref_manifest_rows": """SELECT DISTINCT 'sessions/' || filepath AS text_path, 'audio/' || n[1] || '/' || n[2] || '/' || n AS audio_path
FROM (SELECT filepath, split_part(urls[1].url, '/', -1) AS n FROM session_texts WHERE urls IS NOT NULL AND len(urls) > 0) r""",
    "ref_left_margins": f'WITH {_LINES}, {_MARG} SELECT doc, "left", n, rank, round(share, 9) AS share FROM marg',
    "ref_content_columns": f"WITH {_LINES}, {_MARG}, {_COLS} SELECT doc, CAST(share AS DOUBLE) AS share, CAST(columns AS BIGINT) AS columns, lefts FROM cols",
    "ref_text_font": f"WITH {_LINES}, {_FONT} SELECT doc, text_font FROM font",
    "ref_page_sizes": f"WITH {_SIZE} SELECT doc, width, height, sizes FROM size",
    "ref_header_footer": f"""WITH {_LINES}, {_MARG}, {_COLS}, {_FONT}, {_SIZE}, pg AS (SELECT doc, max(page) + 1 AS pages FROM (SELECT doc, page FROM l UNION ALL SELECT ple_code, page FROM diary_pages) p GROUP BY doc),
near AS (SELECT b.doc, b.top, b.font, b.text, count(*) AS n, min(seen_at) AS first_at FROM body b JOIN cols c ON c.doc = b.doc AND list_contains(list_transform(string_split(c.lefts, ','), lambda x: CAST(x AS DOUBLE)), round(try_cast(b."left" AS DOUBLE), 3)) JOIN font f ON f.doc = b.doc WHERE b.font <> f.text_font GROUP BY b.doc, b.top, b.font, b.text),
top2 AS (SELECT near.doc, top, row_number() OVER (PARTITION BY near.doc ORDER BY n DESC, first_at) AS r, count(*) OVER (PARTITION BY near.doc) AS found FROM near JOIN pg ON pg.doc = near.doc WHERE n >= greatest(1, pages // 3 - 2)),
y AS (SELECT t.doc, top, found, CAST(top AS DOUBLE) / height AS y FROM top2 t JOIN size s ON s.doc = t.doc WHERE r <= 2 AND found >= 2)
SELECT DISTINCT doc, top FROM (SELECT *, min(y) OVER (PARTITION BY doc) AS lo, max(y) OVER (PARTITION BY doc) AS hi FROM y) z WHERE found = 2 OR (lo < 0.1 AND hi > 0.89)""",
    "ref_content_lines": f"WITH {_LINES}, {_MARG}, {_COLS}, {_FONT}, {_SIZE}, {_TOPS}, {_CONTENT} SELECT * FROM content",
    "ref_speaker_style": f"WITH {_LINES}, {_MARG}, {_COLS}, {_FONT}, {_SIZE}, {_TOPS}, {_CONTENT}, {_STYLE} SELECT * FROM style",
    "ref_speeches": f"""WITH {_LINES}, {_MARG}, {_COLS}, {_FONT}, {_SIZE}, {_TOPS}, {_CONTENT}, {_STYLE},
m AS (SELECT k.*, EXISTS (SELECT 1 FROM k s JOIN style t ON t.doc = s.doc AND t.speaker_font = s.font AND t.speaker_height = s.height WHERE s.doc = k.doc AND s.said = k.said AND s.said <> '') AS is_name FROM k),
g AS (SELECT *, coalesce(lag(is_name) OVER w AND font <> text_font AND abs(lag(try_cast(top AS DOUBLE) + try_cast(height AS DOUBLE)) OVER w - try_cast(top AS DOUBLE)) <= 3, false) AS stacked FROM m WINDOW w AS (PARTITION BY doc, page ORDER BY ord)),
u AS (SELECT *, sum(CASE WHEN stacked THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS unit FROM g),
j AS (SELECT *, {_STRIP("text")} AS said FROM (SELECT doc, unit, string_agg(text, '' ORDER BY ord) AS text, first(font ORDER BY ord) AS font, first(height ORDER BY ord) AS height FROM u GROUP BY doc, unit) a),
known AS (SELECT DISTINCT j.doc, said FROM j JOIN style t ON t.doc = j.doc AND t.speaker_font = j.font AND t.speaker_height = j.height WHERE said <> ''),
n AS (SELECT j.*, known.said IS NOT NULL AS speaks, CAST(sum(CASE WHEN known.said IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY j.doc ORDER BY unit ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seq FROM j LEFT JOIN known ON known.doc = j.doc AND known.said = j.said)
SELECT doc, seq, max(CASE WHEN speaks THEN replace(said, chr(160), ' ') END) AS speaker, coalesce(string_agg(CASE WHEN NOT speaks THEN text END, '' ORDER BY unit), '') AS text FROM n WHERE seq > 0 GROUP BY doc, seq""",
    "ref_line_fragments": """SELECT DISTINCT ple_code AS doc, page, line_no, top, "left", width, height, font, coalesce(text, '') AS text FROM xml_lines WHERE ple_code IS NOT NULL AND page IS NOT NULL AND line_no IS NOT NULL
AND try_cast(width AS INTEGER) > 4 AND try_cast("left" AS INTEGER) IS NOT NULL AND try_cast(top AS DOUBLE) IS NOT NULL""",
    "ref_catalogue_pages": "SELECT DISTINCT url, name, date, duration FROM sessions WHERE url IS NOT NULL AND name IS NOT NULL AND date IS NOT NULL AND duration IS NOT NULL",
    "ref_page_xml": 'SELECT DISTINCT ple_code AS doc, page, top, "left", width, height, font, coalesce(text, \'\') AS text FROM xml_lines WHERE ple_code IS NOT NULL AND page IS NOT NULL',
}
SQL["ref_hyphen_fix"] = f"WITH src AS (SELECT doc_id AS k, text FROM documents), {_FIXED} SELECT k AS doc_id, text FROM fixed"
SQL["ref_clean_text"] = f"""WITH src AS (SELECT doc_id AS k, {_PUNCTUATION(_STRUCTURE("text"))} AS text FROM documents), {_FIXED} SELECT k AS doc_id, array_to_string({_SENTENCES("text")}, ' ') AS text FROM fixed"""
SQL["ref_clean_sentences"] = f"""WITH each AS (SELECT doc_id, unnest(s) AS text, generate_subscripts(s, 1) - 1 AS n FROM (SELECT doc_id, {_SENTENCES(_STRUCTURE("text"))} AS s FROM documents) a),
src AS (SELECT doc_id || '#' || n AS k, {_PUNCTUATION("text")} AS text FROM each), {_FIXED} SELECT CAST(split_part(k, '#', 1) AS BIGINT) AS doc_id, CAST(split_part(k, '#', 2) AS INTEGER) AS sentence_no, text FROM fixed"""
SQL["ref_accepted_turns"] = SQL["ref_acceptance"].split("SELECT record_id, speaker, n_words::BIGINT")[0] + f""", ok AS (SELECT record_id, t FROM v WHERE n_urls <= 1 AND speaker IS NOT NULL AND score >= 0.7 AND own_words >= 130 AND share >= 0.7),
turn AS (SELECT record_id, i - 1 AS pos, t[i].speaker AS speaker, t[i].text AS text FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM ok) x),
src AS (SELECT record_id || '#' || pos AS k, {_PUNCTUATION(_STRUCTURE("text"))} AS text FROM turn), {_FIXED}
SELECT record_id, CAST(pos AS INTEGER) AS pos, speaker, array_to_string({_SENTENCES("fixed.text")}, ' ') AS text FROM turn JOIN fixed ON fixed.k = record_id || '#' || pos"""

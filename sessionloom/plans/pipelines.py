"""The corpus pipeline as compositions of operators, DataFrame to DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.text import spoken_words
from sessionloom.operators import layout, pairing, quality, runs, trimming
from sessionloom.sources import files, html
from sessionloom.tables import written


def catalogue(index_pages: DataFrame, act_pages: DataFrame, acts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fetched pages -> sessions (url, name, date, duration, ple_code) and interventions. acts: session_url, pos, page_url."""
    interventions = html.interventions(act_pages)
    codes = html.session_code(interventions, acts).withColumnRenamed("session_url", "url")
    sessions = html.catalogue(index_pages).drop("page_url").distinct().join(codes, "url", "left")
    return sessions, acts.select("session_url", "page_url").join(interventions, "page_url")


@dataclass
class Transcript:
    kept: DataFrame  # content lines
    deleted: DataFrame  # lines outside the columns; headers and footers are in neither
    speeches: DataFrame  # doc, seq, speaker, text


def transcript(documents: DataFrame) -> Transcript:
    """(doc, xml) of page XML -> content lines and speeches."""
    lines = written(files.page_lines(documents), "transcript-lines")
    pages = written(files.page_sizes(documents), "transcript-pages")
    sizes = layout.page_sizes(pages)
    columns, fonts = written(layout.content_columns(lines), "transcript-columns"), written(layout.text_font(lines), "transcript-fonts")
    tops = layout.header_footer(lines, columns, fonts, sizes.select("doc", "height"), layout.page_counts(pages))
    content = written(layout.split_content(layout.merge_fragments(lines), columns, tops), "transcript-content")
    kept = content.where("kept")
    style = written(layout.speaker_style(kept, fonts), "transcript-style")
    return Transcript(kept, content.where("not kept and not repeated"), layout.speeches(layout.stack_speakers(kept, style, fonts)))


def alignment(text: DataFrame, meta: DataFrame) -> DataFrame:
    """(session, pos, speaker) of both sides -> trusted pairs of blocks (session, pair_no, row_no, left, right).

    Sessions with two entries of the speaker index or fewer keep their blocks side by side.
    """
    text = runs.dense(text.where("speaker is not null").select("session", "pos", "speaker"))
    meta = runs.dense(meta.where("speaker is not null").select("session", "pos", "speaker"))
    text = written(pairing.apply_aliases(runs.with_chair(text, runs.chair(text)), pairing.aliases(text)), "align-text")
    meta = written(runs.with_chair(meta, runs.chair(meta)), "align-meta")
    matched = written(pairing.match_names(text, meta, pairing.aliases(text)), "align-matches")
    index = written(pairing.speaker_index(text, meta, matched), "align-index")
    left, right = written(runs.blocks(text), "align-left"), written(runs.blocks(meta), "align-right")
    code = lambda b, side: pairing.encoded(b, index, side).select("session", F.col("block_no").alias("pos"), "idx")
    several = written(pairing.alignable(index), "align-sessions")
    rows = pairing.decoded(pairing.align(*(code(b, side).join(several, "session", "left_semi") for b, side in ((left, "text_name"), (right, "meta_name")))), left, right)
    few = pairing.side_by_side(*(b.join(several, "session", "left_anti") for b in (left, right)))
    return pairing.good_pairs(rows.unionByName(few), matched)


def records(text: DataFrame, meta: DataFrame) -> DataFrame:
    """Speeches (session, pos, speaker, text) and interventions (session, pos, speaker, names, url) -> session text records (session, file_no, text, urls)."""
    text = written(runs.dense(text.where("speaker is not null and text != ''")), "records-text")
    meta = written(runs.dense(meta.where("speaker is not null")), "records-meta")
    return pairing.session_records(alignment(text, meta), text, meta)


def trimmed(texts: DataFrame, heard: DataFrame, done: DataFrame) -> DataFrame:
    """Records of one turn whose audio exists and whose edges are heard, not in ``done`` (key): (key, start, end, text).

    texts: key, text (array of turns), duration (null where no audio exists); heard: as in ``trimming.edges``.
    """
    one = texts.where("size(text) = 1 and duration is not null").join(done.select("key").distinct(), "key", "left_anti")
    one = written(one.select("key", "duration", spoken_words(F.get("text", F.lit(0))["text"]).alias("words")), "trim-texts")
    found = trimming.edges(one, heard).where("start is not null and end is not null")
    return found.join(one.select("key", "words"), "key").select("key", "start", "end", trimming.cropped_text(F.col("words"), F.col("first_word"), F.col("last_word")).alias("text"))


def corpus(records: DataFrame, chairs: DataFrame, lexicon: DataFrame, media: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (record_id, session, text, urls) -> cleaned turns of the accepted ones, and their rates against media (media_url, duration)."""
    turns = written(quality.accepted(records, chairs, lexicon), "corpus-turns")
    whole = turns.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("text"))
    urls = records.select("record_id", F.get("urls", F.lit(0))["url"].alias("media_url")).distinct()
    return turns, quality.speaking_rates(whole.join(urls, "record_id"), media)

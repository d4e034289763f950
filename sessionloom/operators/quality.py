"""Acceptance of session text records, cleaning of their turns, and speaking rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.codes import shard_path, stem
from sessionloom.functions.text import VALID_WORD, n_words, punctuation, score_tokens, sentences, strip, structure_clean, words
from sessionloom.tables import written

# Least lexicon score, words of the speaker, and their share of all words; words per minute.
SCORE, WORDS, SHARE = 0.7, 130, 0.7
SLOWEST, FASTEST = 95, 195
# Turns that are too many for the manifest; folders of texts and audio.
TURNS = 3
TEXTS, AUDIO = "for_axlotl", "audio"


def lexicon_scores(texts: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """(key, n_tokens, n_known, score) of (key, text): the share of distinct words that the lexicon holds; 1 without words.

    The lexicon joins the distinct words; it is broadcast only if the planner's size limit allows.
    """
    tokens = texts.select(key, F.explode_outer(score_tokens(F.col("text"))).alias("word"))
    lex = lexicon.select(F.col("word")).where("word is not null").distinct().withColumn("known", F.lit(1))
    n = tokens.join(lex, "word", "left").groupBy(key).agg(F.count("word").alias("n_tokens"), F.count("known").alias("n_known"))
    score = F.when(F.col("n_tokens") == 0, 1.0).otherwise(F.col("n_known") / F.col("n_tokens"))
    return n.select(key, "n_tokens", "n_known", F.round(score, 6).alias("score"))


def _hyphened(text: Column) -> Column:
    """The different words of a text with a hyphen inside, without what cannot belong to a word."""
    with_hyphen = F.filter(words(text), lambda w: w.rlike(".-."))
    return F.filter(F.array_distinct(F.transform(with_hyphen, lambda w: F.regexp_extract(w, f"[{VALID_WORD}]+", 0))), lambda c: c != "")


def hyphens_fixed(texts: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """(key, text): hyphened words of which the lexicon holds only the joined form, joined in lower case wherever they stand.

    Only texts with a hyphened word take part in the joins, each with the words it asks for, so the lexicon may be
    of any size; the replacements stay in the JVM, in the order of the words.
    """
    here = texts.select(key, "text")
    plain = F.coalesce(~F.col("text").rlike(r"(?U)\S-\S"), F.lit(True))
    some = here.where(~plain)
    joined = lambda c: F.lower(F.replace(c, F.lit("-"), F.lit("")))
    asked = some.select(key, F.posexplode(_hyphened(F.col("text"))).alias("n", "core"))
    once = asked.select("core", F.explode(F.array(F.struct(F.lower("core").alias("word"), F.lit(0).alias("whole")), F.struct(joined(F.col("core")).alias("word"), F.lit(1).alias("whole")))).alias("w")).distinct()
    held = once.select("core", "w.*").join(lexicon.select("word").where("word is not null").distinct(), "word", "left_semi")
    wrong = held.groupBy("core").agg(F.min("whole").alias("first")).where("first = 1").select("core")
    fixes = asked.join(wrong, "core").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("n", "core"))).alias("fixes"))
    fixed = F.aggregate(F.coalesce("fixes", F.array().cast("array<struct<n:int,core:string>>")), F.col("text"), lambda t, x: F.replace(t, x["core"], joined(x["core"])))
    return here.where(plain).unionByName(some.join(fixes, key, "left").select(key, fixed.alias("text")))


def clean_turns(texts: DataFrame, lexicon: DataFrame, key: str, sentence_first: bool = False) -> DataFrame:
    """(key, text): structure, punctuation, hyphens, then sentences joined by blanks.

    ``sentence_first``: the order of the line cleaner, one row per sentence (key, sentence_no, text).
    """
    plain = texts.select(key, structure_clean(F.col("text")).alias("text"))
    if sentence_first:
        each = plain.select(key, F.posexplode(sentences(F.col("text"))).alias("sentence_no", "text")).withColumn("text", punctuation(F.col("text")))
        each = each.withColumn("row", F.concat_ws("\u0001", F.col(key).cast("string"), F.col("sentence_no").cast("string")))
        fixed = hyphens_fixed(each, lexicon, "row")
        return fixed.join(each.select("row", key, "sentence_no"), "row").select(key, "sentence_no", "text")
    fixed = hyphens_fixed(plain.withColumn("text", punctuation(F.col("text"))), lexicon, key)
    return fixed.select(key, F.array_join(sentences(F.col("text")), " ").alias("text"))


def turn_texts(records: DataFrame) -> DataFrame:
    """The turns of (record_id, text array<struct<speaker,text>>) as rows (record_id, pos, speaker, text)."""
    return records.select("record_id", F.posexplode("text").alias("pos", "t")).select("record_id", "pos", F.col("t.speaker").alias("speaker"), F.col("t.text").alias("text"))


def joined_text(turns: Column) -> Column:
    """The texts of the turns in order, without separator."""
    return F.array_join(F.transform(turns, lambda t: F.coalesce(t["text"], F.lit(""))), "")


def judged(records: DataFrame, chairs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(record_id, speaker, n_words, own_words, share, score, reason): why a record is rejected (null: accepted), by the first rule it breaks.

    records: record_id, session, text, urls; chairs: session, chair. Rules: one url; a speaker besides the chair
    among the record's own turns (the least name if several); then, without a last turn by the chair, the lexicon
    score of the speaker's text, its number of words, and its share of all words.
    """
    known = chairs.select("session", strip(F.col("chair")).alias("chair")).dropDuplicates(["session"])
    here = records.dropDuplicates(["record_id"]).join(known, "session", "left")
    named = F.array_distinct(F.filter(F.transform("text", lambda t: strip(t["speaker"])), lambda s: s.isNotNull() & ~s.eqNullSafe(F.col("chair"))))
    here = here.withColumn("speaker", F.array_min(named)).withColumn("urls_n", F.size(F.coalesce("urls", F.array())))
    n = F.size("text")
    last = F.get(F.col("text"), n - 1)
    here = here.withColumn("turns", F.when(strip(last["speaker"]) == F.col("chair"), F.slice("text", F.lit(1), F.greatest(n - 1, F.lit(0)))).otherwise(F.col("text")))
    own = F.filter("turns", lambda t: strip(t["speaker"]) == F.col("speaker"))
    here = here.withColumn("all_text", joined_text(F.col("turns"))).withColumn("own_text", joined_text(own))
    here = here.withColumn("n_words", F.coalesce(n_words(F.col("all_text")), F.lit(0))).withColumn("own_words", F.coalesce(n_words(F.col("own_text")), F.lit(0)))
    cheap = here.select("record_id", "speaker", "urls_n", "n_words", "own_words", "own_text")
    scores = lexicon_scores(cheap.where("urls_n <= 1 and speaker is not null").select("record_id", F.col("own_text").alias("text")), lexicon, "record_id")
    share = F.when(F.col("n_words") > 0, F.col("own_words") / F.col("n_words")).otherwise(0.0)
    reason = (
        F.when(F.col("urls_n") > 1, "several urls").when(F.col("speaker").isNull(), "only the chair").when(F.col("score") < SCORE, "lexicon")
        .when(F.col("own_words") < WORDS, "short").when(share < SHARE, "share")
    )
    done = cheap.drop("own_text").join(scores.select("record_id", "score"), "record_id", "left")
    return done.select("record_id", "speaker", "n_words", "own_words", F.round(share, 6).alias("share"), "score", reason.alias("reason"))


def accepted(records: DataFrame, chairs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(record_id, pos, speaker, text): the cleaned turns of the accepted records."""
    verdict = written(judged(records, chairs, lexicon), "verdicts")
    known = chairs.select("session", strip(F.col("chair")).alias("chair")).dropDuplicates(["session"])
    kept = records.dropDuplicates(["record_id"]).join(verdict.where("reason is null").select("record_id"), "record_id", "left_semi").join(known, "session", "left")
    n = F.size("text")
    closed = strip(F.get("text", n - 1)["speaker"]) == F.col("chair")
    turns = turn_texts(kept.withColumn("text", F.when(closed, F.slice("text", F.lit(1), n - 1)).otherwise(F.col("text")))).withColumn("turn", F.concat_ws("#", "record_id", "pos"))
    return turns.select("turn", "record_id", "pos", "speaker").join(clean_turns(turns.select("turn", "text"), lexicon, "turn"), "turn").drop("turn")


def speaking_rates(texts: DataFrame, media: DataFrame) -> DataFrame:
    """(record_id, words, duration, words_per_minute, fits): texts (record_id, text, media_url) against media (media_url, duration in seconds)."""
    rate = F.col("words") / F.col("duration") * 60
    here = texts.select("record_id", "media_url", n_words(F.col("text")).alias("words")).join(media.where("duration > 0"), "media_url")
    return here.select("record_id", "words", "duration", F.round(rate, 4).alias("words_per_minute"), rate.between(SLOWEST, FASTEST).alias("fits"))


def manifest_paths(records: DataFrame) -> DataFrame:
    """The records (session, filepath, media_url, ...) with the paths of their clean text and of their audio; a path of which a part is null is null."""
    name = F.concat("session", F.lit("-"), stem(F.col("filepath")), F.lit("-"), stem(F.col("media_url")), F.lit(".txt"))
    return records.withColumn("text_path", F.concat(F.lit(f"{TEXTS}/"), "session", F.lit("/"), name)).withColumn("audio_path", shard_path(F.lit(AUDIO), F.col("media_url")))


def manifest(records: DataFrame, media: DataFrame, done: DataFrame) -> DataFrame:
    """(text_path, audio_path, text, words_per_minute, done): records (session, filepath, text, media_url) whose audio exists and whose text stands.

    The text stands if it was written before (done: text_path), or if the record has fewer than three turns and is
    spoken at a plausible rate. media: media_url, duration. Only texts with ``done`` false are to be written.
    """
    whole = F.array_join(F.transform("text", lambda t: F.coalesce(t["text"], F.lit(""))), " ")
    old = done.select("text_path").distinct().withColumn("done", F.lit(True))
    here = manifest_paths(records).join(media.where("duration > 0").select("media_url", "duration"), "media_url").join(old, "text_path", "left")
    rate = n_words(whole) / F.col("duration") * 60
    here = here.select("text_path", "audio_path", F.size("text").alias("turns"), whole.alias("text"), rate.alias("words_per_minute"), F.coalesce("done", F.lit(False)).alias("done"))
    return here.where(F.col("done") | (F.col("turns") < TURNS) & F.col("words_per_minute").between(SLOWEST, FASTEST)).drop("turns")

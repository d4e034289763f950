"""Text cleaning, sentence splitting and lexical scores as Column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Sentence terminators, the longest first where one begins another.
TERMINATORS = r"\.\.\.|!\"|!'|!|\?\"|\?'|\?|\.'|\.\"|\."
# Fixed value: letters a new sentence may begin with.
SENTENCE_START = "A-ZÀÉÈÜÚÍÏÓÒÇ"
# Fixed value: characters of a well-formed sentence.
VALID = r"a-zA-Z0-9àáéèüúíïóòçÀÁÉÈÜÚÍÏÓÒÇ .!\-,;:'\"?·$°£€%"
# Fixed value: characters of a word with a hyphen.
VALID_WORD = r"a-zA-Z0-9àáéèüúíïóòçÀÁÉÈÜÚÍÏÓÒÇ\-'"
# What is deleted before words are scored against the lexicon (neighbours of the spaced ones are joined).
SCORE_DELETIONS = r"-#| - | · | ' |<i>|</i>|[.,:;!?\"()–’‘¿¡]"
SHORTEST, LONGEST = 31, 600
BREAK = "\u0001"


def once(value: Column, use) -> Column:
    """``use(value)``, the value computed once however often ``use`` needs it, in lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """Without blanks of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(c: Column) -> Column:
    """The words between blanks."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def n_words(c: Column) -> Column:
    return F.size(words(c)).cast("bigint")


def structure_clean(c: Column) -> Column:
    """Without captions, notes in brackets and short tags; single blanks, none before a full stop."""
    c = F.replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), F.lit("\u00ad"), F.lit("-"))
    # What is taken out, and by what it is replaced, in this order.
    for pattern, to in ((r"<i>\(.*?\) ?</i>", ""), (r"\(.*?\)", ""), (r"\{.+\}", ""), (" {2,}", " "), (r" (?=\.)", ""), ("<.{1,3}>", "")):
        c = F.regexp_replace(c, pattern, to)
    return c


def sentences(c: Column) -> Column:
    """The sentences: split after a terminator that a capital follows, blanks between or not."""
    marked = F.regexp_replace(c, f"({TERMINATORS})(?= *[{SENTENCE_START}])", f"$1{BREAK}")
    return F.filter(F.transform(F.split(marked, BREAK), strip), lambda s: s != "")


def punctuation(c: Column) -> Column:
    """One kind of apostrophe, none repeated, no quotation marks."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[`’]", "'"), "'+", "'"), "[“”«»\"]", "")


def well_formed(c: Column) -> Column:
    """Whether a sentence has only valid characters, a fit length, and no list marks, tables or times."""
    plain = ~c.contains("|") & ~c.contains("[") & ~c.rlike(r"\d:\d") & ~c.rlike(r"(?U)\s·")
    return plain & F.length(c).between(SHORTEST, LONGEST) & c.rlike(f"^[{VALID}]+$")


def score_tokens(c: Column) -> Column:
    """Distinct lower-case words for the lexicon score."""
    return F.array_distinct(words(F.lower(F.regexp_replace(c, SCORE_DELETIONS, ""))))


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<.+?>", "")


def speaker_name(c: Column) -> Column:
    """What stands before the first bar, trimmed, with ordinary blanks."""
    return F.translate(strip(F.split_part(c, F.lit("|"), F.lit(1))), "\u00a0", " ")


def title_and_name(c: Column) -> Column:
    """'Title (Name)' -> struct(title, name) by the last brackets; nulls without brackets."""
    got = c.rlike(r"(.+)\((.+)\)")
    part = lambda k: F.when(got, strip(F.regexp_extract(c, r"(.+)\((.+)\)", k)))
    return F.struct(part(1).alias("title"), part(2).alias("name"))


def first_words(c: Column, n: int) -> Column:
    return F.slice(words(c), 1, n)


def last_words(c: Column, n: int) -> Column:
    w = words(c)
    return F.slice(w, F.greatest(F.size(w) - n, F.lit(0)) + 1, F.lit(n))


def spoken_words(c: Column) -> Column:
    """Lower case without punctuation, as words are sought in recognised speech."""
    return words(F.lower(F.translate(c, ".,;:?!", "")))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML entities as characters; null stays null."""
    return s.map(html.unescape, na_action="ignore")


def inner_markup(c: Column) -> Column:
    """What stands between <text ...> and </text>, tags kept, entities resolved; empty where nothing does."""
    return F.coalesce(unescape(F.regexp_extract(c, "(?s)<text[^>]*>(.+)</text>", 1)), F.lit(""))

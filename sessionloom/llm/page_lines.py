"""Lines of scanned pages: their words, page furniture, the order of the text, and words broken at line ends.

Scale and skew: a transcript may hold a third of all lines, so nothing is grouped or ordered by transcript
alone. Statistics of a transcript are counted with partial aggregation and reach the lines through the pages;
order is kept within a page, and the last line of a page meets the first of the next by a join.

Defined results: exact repetitions of a row count once; null or blank texts are text lines without words, and
never furniture; lines without a code are one transcript with the code ''; a null font or height takes no part in statistics; without a next text line no word is broken.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.forms import canonical
from sessionloom.llm.ocr import least
from sessionloom.tables import written

SCHEMA = (
    "line_id bigint, ple_code string, page int, line_no int, x double, y double, w double, h double, font string, t string, bold boolean, note boolean, number boolean, "
    "skeleton string, words array<string>, starts array<int>, ends array<int>, compounds array<string>, tail string, mark string, open boolean, head string"
)
_TAG = re.compile(r"</?[a-z]{1,2}>")
#: A word as scanned: letters, digits and misread marks within; an apostrophe ends it.
WORD = re.compile(r"[^\W_](?:[^\W_]|·(?=[^\W_])|[!|](?=[^\W\d_]|\s+[a-zà-ÿ]|[,.;:]))*[’']?")
_COMPOUND = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*-[^\W\d_]+(?:[-’'][^\W\d_]+)*")
_TAIL = re.compile(r"([^\W_](?:[^\W_]|[·!|-](?=[^\W_]))*)(-|‐|¬|\xad)?$")
_HEAD = re.compile(r"[^\W_](?:[^\W_]|[·!|’'-](?=[^\W_]))*")
_NUMBER = re.compile(r"^(?:p[aà][gq][.,]?\s*)?[-–—·|\s]*(?:[0-9lIoO!|sS5]{1,5}|[ivxlc!1]{1,8})[-–—·|\s]*(?:(?:/|de)\s*\d{1,5})?$", re.I)
_NOTE = re.compile(r"^\W{0,2}[\dlI!oO]{1,2}[.)]\s*[^\W\d_]{3,}")
_MARKS = re.compile("[ªº²³½¼¾]")
_ROMAN = re.compile(r"^[ivxlc!1]+$")
# What a misread digit or sign stands for.
DIGIT_LETTERS = str.maketrans("01569!|", "oisbgii")
# Pronouns and places that follow a hyphen of their own.
CLITICS = ("los", "les", "ho", "hi", "ne", "se", "me", "te", "nos", "vos", "li", "la", "lo", "en", "us", "hos", "est", "oest")


@functools.lru_cache(maxsize=200_000)
def word_form(raw: str) -> str:
    """Lower case, one apostrophe; capitals misread within a word stay."""
    raw = raw.replace("'", "’")
    return raw.lower() if raw.isupper() or raw[1:].islower() or len(raw) == 1 else raw[0].lower() + raw[1:]


_FOLD = {o: unicodedata.normalize("NFD", chr(o))[0] for o in range(0xC0, 0x250) if unicodedata.decomposition(chr(o))} | {ord("·"): None}
_PIECE = re.compile(r"[^\W_!|](?:[\w!|])*")


@functools.lru_cache(maxsize=200_000)
def _bare(w: str) -> str:
    """A word's part of the skeleton."""
    if w.isdecimal():
        return ""
    letters = len(w) if w.isalpha() else sum(c.isalpha() for c in w)
    return w.translate(DIGIT_LETTERS).replace("l", "i") if letters * 2 >= len(w) and not (len(w) < 6 and _ROMAN.match(w)) else ""


def skeleton(t: str) -> str:
    """What is left of a line without numbers, marks and common misreadings."""
    return "".join(map(_bare, _PIECE.findall(t.lower().translate(_FOLD))))


@functools.lru_cache(maxsize=200_000)
def _is_word(w: str) -> bool:
    return not w.isdecimal() and any(map(str.isalpha, w)) and not (w[0].isdigit() and len(w) < 4)


def _prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for r in b.itertuples(index=False, name="Line"):
            s = canonical(r.text or "")
            bold = "<b>" in s
            t = " ".join((_TAG.sub("", s) if "<" in s else s).split())
            t = re.sub(r"\xad(?=\w)", "", t) if "\xad" in t else t
            marked = _MARKS.search(t)
            spans = [m for m in WORD.finditer(t) if _is_word(m[0]) and not (marked and _MARKS.search(m[0]))]
            tail, head = _TAIL.search(t, t.rfind(" ") + 1), _HEAD.match(t)  # a tail holds no blank
            rows.append((
                r.line_id, r.ple_code, r.page, r.line_no, r.x, r.y, r.w, r.h, r.font, t, bold, bool(_NOTE.match(t)), bool(t and _NUMBER.match(t)),
                skeleton(t), [word_form(m[0]) for m in spans], [m.start() for m in spans], [m.end() for m in spans], [c.replace("'", "’").lower() for c in _COMPOUND.findall(t)] if "-" in t else [],
                tail and word_form(tail[1]), (tail and tail[2]) or "", bool(tail), head and word_form(head[0]),
            ))
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in SCHEMA.split(", ")]).astype({"page": "Int32", "line_no": "Int32"})


def prepared(lines: DataFrame) -> DataFrame:
    number = lambda c, name: F.expr(f"try_cast(`{c}` as double)").alias(name)
    once = lines.select("line_id", "ple_code", "page", "line_no", "top", "left", "width", "height", "font", "text").distinct()
    read = once.select("line_id", F.coalesce("ple_code", F.lit("")).alias("ple_code"), "page", "line_no", number("left", "x"), number("top", "y"), number("width", "w"), number("height", "h"), "font", "text")
    return read.mapInPandas(_prepare, SCHEMA)


def widths(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(ple_code, page_width) of the prepared lines' transcripts: the most frequent width of their pages (ple_code, width); without
    one, the lines' extent with a right margin like the left one."""
    n = pages.where("ple_code is not null and width > 0").groupBy("ple_code", "width").agg(F.count("*").alias("n"))
    usual = n.groupBy("ple_code").agg(F.max_by("width", F.struct("n", "width")).alias("usual"))
    reach = lines.where("t != ''").groupBy("ple_code").agg((F.min("x") + F.max(F.col("x") + F.coalesce("w", F.lit(0.0)))).alias("reach"))
    return reach.join(usual, "ple_code", "left").select(F.col("ple_code").alias("w_code"), F.coalesce(F.col("usual").cast("double"), "reach").alias("page_width"))


def furniture(lines: DataFrame, page_widths: DataFrame, middle_within: float = 0.034) -> DataFrame:
    """(line_id) of the prepared lines that belong to the page.

    Furniture lies outside the vertical extent of the page's body lines (those in the transcript's body and
    speaker fonts) and is a page number, recurs on another page or in three transcripts, or is set in a smaller
    type than the body; a page number may also stand in the middle of the page's width, give or take a share ``middle_within`` of it. Only the few columns
    this takes are moved, not the words.
    """
    slim = lines.select("line_id", "ple_code", "page", "x", "y", "w", "h", "font", "bold", "note", "number", "skeleton").where("t != ''")
    fonts = slim.where("font is not null").groupBy("ple_code", "font").agg(F.count("*").alias("n"), F.sum(F.col("bold").cast("int")).alias("nb"))
    style = fonts.groupBy("ple_code").agg(F.max_by("font", F.struct(F.col("n") - F.col("nb"), "font")).alias("body_font"), F.max_by("font", F.struct("nb", "n", "font")).alias("bold_font"), F.max("nb").alias("any_bold"))
    heights = slim.where("h is not null").groupBy("ple_code", "h").agg(F.count("*").alias("n")).groupBy("ple_code").agg(F.max_by("h", F.struct("n", "h")).alias("body_h"))
    pages = slim.select("ple_code", "page").distinct().join(style, "ple_code", "left").join(heights, "ple_code", "left").join(page_widths, F.col("ple_code") == F.col("w_code"), "left")
    pages = pages.select(F.col("ple_code").alias("p_code"), F.col("page").alias("p_page"), "page_width", "body_font", "bold_font", "any_bold", "body_h")
    known = slim.join(pages, (F.col("ple_code") == F.col("p_code")) & F.col("page").eqNullSafe(F.col("p_page")), "left")
    body_like = F.coalesce((F.col("font") == F.col("body_font")) | (F.col("any_bold") > 0) & (F.col("font") == F.col("bold_font")), F.lit(False))
    w = Window.partitionBy("ple_code", "page")
    zoned = known.withColumn("body_like", body_like).withColumn("lo", F.min(F.when(F.col("body_like"), F.col("y"))).over(w)).withColumn("hi", F.max(F.when(F.col("body_like"), F.col("y"))).over(w))
    outside = F.coalesce((F.col("y") < F.col("lo")) | (F.col("y") > F.col("hi")), F.lit(True))
    middle = F.coalesce(F.abs(F.col("x") + F.coalesce("w", F.lit(0.0)) / 2 - F.col("page_width") / 2) < F.col("page_width") * middle_within, F.lit(False))
    small = F.coalesce(F.col("h") < F.col("body_h"), F.lit(False))
    # From here on there are only the lines that may be furniture.
    likely = written(zoned.where(~F.col("body_like")).select("line_id", "ple_code", "skeleton", "note", "number", outside.alias("outside"), middle.alias("middle"), small.alias("small")).where("outside or number and middle"), "scan-margins")
    repeated = likely.where("outside and not note and not number").groupBy("skeleton", "ple_code").agg(F.count("*").alias("n"))
    everywhere = repeated.groupBy("skeleton").agg(F.count("*").alias("transcripts"))
    evident = repeated.join(everywhere, "skeleton").where("n >= 2 or transcripts >= 3").select("ple_code", "skeleton").withColumn("recurs", F.lit(True))
    marked = likely.join(evident, ["ple_code", "skeleton"], "left")
    return marked.where("outside and not note and (number or small or coalesce(recurs, false)) or number and middle").select("line_id").distinct()


def flow(text: DataFrame, page_widths: DataFrame, column_from: float = 0.49) -> DataFrame:
    """(line_id, ple_code, page, col, place, x, bold, tail, mark, nxt) of the text lines with words, notes apart.

    ``nxt`` (line_id, head, bold) is the next line of the column flow: down the columns, then on the next page.
    The second column begins at a share ``column_from`` of the page's width.
    """
    col = F.when(F.col("x") >= F.col("page_width") * column_from, 1).otherwise(0)
    text = text.join(page_widths, F.col("ple_code") == F.col("w_code"), "left")
    lines = text.where("t != '' and not note and page is not null").select("line_id", "ple_code", "page", col.alias("col"), "x", "y", "line_no", "bold", "tail", "mark", "head")
    here = F.struct("line_id", "head", "bold")
    w = Window.partitionBy("ple_code", "page").orderBy("col", "y", "line_no", "line_id")
    inside = lines.withColumn("nxt", F.lead(here).over(w)).withColumn("place", F.row_number().over(w))
    kept = ["line_id", "ple_code", "page", "col", "place", "x", "bold", "tail", "mark"]
    first = inside.where("place = 1").select("ple_code", (F.col("page") - 1).alias("page"), here.alias("turned"))
    last = inside.where("nxt is null").drop("nxt").join(first, ["ple_code", "page"], "left").select(*kept, F.col("turned").alias("nxt"))
    return inside.where("nxt is not null").select(*kept, "nxt").unionByName(last)


def vocabulary(lines: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(v, n, lex): how often each word stands in the lines, and whether the lexicon holds it.

    Words outside the lexicon count only inside a line, as at its ends they may be pieces of words.
    """
    last = F.size("words") - 1
    each = lines.select(last.alias("last"), F.posexplode("words").alias("k", "v"))
    n = each.groupBy("v").agg(F.count("*").alias("all"), F.sum(((F.col("k") > 0) & (F.col("k") < F.col("last"))).cast("bigint")).alias("inner"))
    lex = lexicon.select(F.lower("word").alias("v")).where("v is not null").distinct().withColumn("lex", F.lit(True))
    counted = n.join(lex, "v", "full")
    return counted.select("v", F.coalesce(F.when(F.col("lex"), F.col("all")).otherwise(F.col("inner")), F.lit(0)).alias("n"), F.coalesce("lex", F.lit(False)).alias("lex")).where("lex or n > 0")


def breaks(flowing: DataFrame, vocab: DataFrame, compounds: DataFrame, total: float) -> DataFrame:
    """(line_id, next_id, a, b, joined, broken): line ends where a word goes on, or where a word's own hyphen stands (broken false)."""
    ends = flowing.where("tail is not null and nxt.head is not null and not nxt.bold").select(
        "line_id", F.col("nxt.line_id").alias("next_id"), F.col("tail").alias("a"), F.col("mark"), F.col("nxt.head").alias("full"), F.regexp_extract("nxt.head", "^[^’'-]+", 0).alias("b"),
    ).where("b != '' and not a rlike '^[0-9]+$' and not b rlike '^[0-9]+$'")
    ends = ends.withColumn("joined", F.concat("a", "b")).withColumn("own", F.concat_ws("-", "a", "full"))
    count = lambda name, key: vocab.select(F.col("v").alias(key), F.col("n").alias(f"n_{name}"), F.col("lex").alias(f"lex_{name}"))
    marked = ends.where("mark != ''").join(count("j", "joined"), "joined", "left").join(compounds.select(F.col("v").alias("own"), F.col("n").alias("n_own")), "own", "left").join(count("a", "a"), "a", "left")
    n_j, n_own = F.coalesce("n_j", F.lit(0)), F.coalesce("n_own", F.lit(0))
    joined_known = F.coalesce("lex_j", F.lit(False)) | (n_j > n_own)
    attached = (n_own > 0) | F.col("b").isin(*CLITICS) & (F.coalesce("lex_a", F.lit(False)) | (F.coalesce("n_a", F.lit(0)) >= least(3, total)) | F.col("a").rlike("r$|-"))
    marked = marked.withColumn("broken", (~F.col("mark").isin("-", "‐")) | joined_known | ~attached)
    plain = ends.where("mark = ''").join(count("j", "joined").where(F.col("lex_j") | (F.col("n_j") >= least(5, total))), "joined").join(count("a", "a"), "a", "left").join(count("b", "b"), "b", "left")
    known = lambda c: F.coalesce(f"lex_{c}", F.lit(False)) | (F.coalesce(f"n_{c}", F.lit(0)) >= F.greatest(F.lit(least(5, total)), F.col("n_j") * 0.05))
    plain = plain.withColumn("broken", ~(known("a") & known("b"))).where("broken")
    cols = ["line_id", "next_id", "a", "b", "joined", "broken"]
    return marked.select(*cols).unionByName(plain.select(*cols))

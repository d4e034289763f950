"""Layout of page-structured transcripts: columns, fonts, headers and footers, speaker style, speeches.

Lines have (doc, page, line_no, top, left, width, height, font, text), the numeric attributes as strings. All
statistics are partially aggregated per document; order is (page, column, line_no), never the file's.

Defined results: attributes that are no numbers are null and match nothing; null texts count as empty; ties
of a frequency go to the value met first; documents without enough lines, or whose content is mostly in another font
than their text, have no layout or speaker style. Edges are compared as numbers, texts without blanks at their ends.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.text import strip

# First share of the lines that the content columns must hold, its step, and how many are tried.
SHARE, STEP, TRIES = 0.75, 0.025, 10
# Header band and footer band as shares of the page height.
HEADER, FOOTER = 0.10, 0.89
# Tolerance for pieces of one line, and for two lines of one speaker.
JOIN, STACK = 1.0, 3.0
# How a speaker's line may begin.
SPEAKER_PREFIXES = ("El president", "La presidenta", "La vicepresidenta", "El vicepresident", "<b>")
COVERS = 2


def _placed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("at", F.col("page").cast("bigint") * 1_000_000 + F.col("line_no"))


def page_sizes(pages: DataFrame) -> DataFrame:
    """(doc, width, height, sizes) of (doc, page, width, height): the most frequent size, and how many different ones there are."""
    n = pages.groupBy("doc", "width", "height").agg(F.count("*").alias("n"))
    return n.groupBy("doc").agg(F.max_by(F.struct("width", "height"), F.struct("n", "width", "height")).alias("s"), F.count("*").alias("sizes")).select("doc", "s.width", "s.height", "sizes")


def page_counts(*tables: DataFrame) -> DataFrame:
    """(doc, pages): pages are numbered from 0, and those without lines count; tables: (doc, page)."""
    n = [t.groupBy("doc").agg((F.max("page") + 1).alias("pages")) for t in tables]
    every = functools.reduce(DataFrame.unionByName, n)
    return every.groupBy("doc").agg(F.max("pages").cast("bigint").alias("pages"))


def left_margins(lines: DataFrame) -> DataFrame:
    """(doc, left, n, rank, share): left edges, as numbers, by frequency, with the share of the lines up to and including each."""
    edge = F.expr("try_cast(left AS double)")
    counted = _placed(lines.where(F.col("page") >= COVERS)).withColumn("left", edge).where("left is not null").groupBy("doc", "left").agg(F.count("*").alias("n"), F.min("at").alias("first_at"))
    order = Window.partitionBy("doc").orderBy(F.desc("n"), "first_at")
    total = F.sum("n").over(Window.partitionBy("doc"))
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return counted.select("doc", "left", "n", (F.row_number().over(order)).alias("rank"), (upto / total).alias("share"))


def content_columns(lines: DataFrame) -> DataFrame:
    """(doc, share, lefts, columns): the least share whose left edges are 2 (one column) or 4 (two columns), edges in numeric order."""
    grid = F.array(*[F.lit(round(SHARE + STEP * k, 3)) for k in range(TRIES)])
    margins = left_margins(lines).withColumn("before", F.lag("share", 1, 0.0).over(Window.partitionBy("doc").orderBy("rank"))).where("before <= 0.98")
    tried = margins.withColumn("wanted", F.explode(grid)).where("before <= wanted")
    got = tried.groupBy("doc", "wanted").agg(F.count("*").alias("k"), F.sort_array(F.collect_list("left")).alias("edges"), F.max("share").alias("reached")).where("k in (2, 4) and reached > wanted")
    best = got.groupBy("doc").agg(F.min_by(F.struct("wanted", "k", "edges"), "wanted").alias("b"))
    return best.select("doc", F.col("b.wanted").alias("share"), F.col("b.edges").alias("lefts"), (F.col("b.k") / 2).cast("int").alias("columns"))


def text_font(lines: DataFrame) -> DataFrame:
    """(doc, text_font): the most frequent font."""
    n = _placed(lines.where((F.col("page") >= COVERS) & F.col("font").isNotNull())).groupBy("doc", "font").agg(F.count("*").alias("n"), F.min("at").alias("first_at"))
    return n.groupBy("doc").agg(F.max_by("font", F.struct("n", -F.col("first_at"))).alias("text_font"))


def header_footer(lines: DataFrame, columns: DataFrame, fonts: DataFrame, heights: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(doc, top): tops of the repeated lines outside the text font. heights: (doc, height); pages: (doc, pages), by default up to the last page with a line.

    A line counts by its (top, font, text) and is repeated on max(1, pages / 3 - 2) pages or more. Two such lines
    are header and footer; of more, the two most frequent, if they lie in the header and footer bands.
    """
    body = lines.where(F.col("page") >= COVERS)
    pages = page_counts(lines) if pages is None else pages.select("doc", "pages")
    near = body.withColumn("edge", F.expr("try_cast(left AS double)")).join(columns.select("doc", F.explode("lefts").alias("edge")), ["doc", "edge"], "left_semi").join(fonts, "doc").where(F.col("font") != F.col("text_font"))
    n = _placed(near).groupBy("doc", "top", "font", "text").agg(F.count("*").alias("n"), F.min("at").alias("first_at")).join(pages, "doc").where(F.col("n") >= F.greatest(F.lit(1), F.floor(F.col("pages") / 3) - 2))
    w = Window.partitionBy("doc").orderBy(F.desc("n"), "first_at")
    top2 = n.withColumn("rank", F.row_number().over(w)).withColumn("found", F.count("*").over(Window.partitionBy("doc"))).where("rank <= 2 and found >= 2").join(heights, "doc")
    y = F.col("top").cast("double") / F.col("height")
    each = Window.partitionBy("doc")
    return top2.withColumn("lo", F.min(y).over(each)).withColumn("hi", F.max(y).over(each)).where((F.col("found") == 2) | ((F.col("lo") < HEADER) & (F.col("hi") > FOOTER))).select("doc", "top").distinct()


LINE = "doc string, page int, line_no int, top string, left string, width string, height string, font string, text string"


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    number = lambda v: float(v) if v is not None and v == v and str(v).replace(".", "", 1).replace("-", "", 1).isdigit() else None
    for b in batches:
        rows = []
        for doc, page, parts in zip(b["doc"], b["page"], b["parts"], strict=True):
            last: dict | None = None
            for p in sorted(parts, key=lambda p: p["line_no"]):
                p = dict(p)
                x = [number(v) for v in (last["top"], p["top"], last["left"], last["width"], p["left"], p["width"])] if last else []
                if last and None not in x and abs(x[0] - x[1]) <= JOIN and abs(x[2] + x[3] - x[4]) <= JOIN:
                    last["text"] = (last["text"] or "") + (p["text"] or "")
                    last["width"] = str(int(x[3]) + int(x[5]) - 1)
                else:
                    if last:
                        rows.append((doc, page, *(last[c] for c in ("line_no", "top", "left", "width", "height", "font", "text"))))
                    last = p
            if last:
                rows.append((doc, page, *(last[c] for c in ("line_no", "top", "left", "width", "height", "font", "text"))))
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in LINE.split(", ")])


def merge_fragments(lines: DataFrame) -> DataFrame:
    """Pieces of one line (same top, the next where the last ends) as one line; a fold per page, as the width grows."""
    parts = F.collect_list(F.struct("line_no", "top", "left", "width", "height", "font", F.coalesce("text", F.lit("")).alias("text")))
    return lines.groupBy("doc", "page").agg(parts.alias("parts")).mapInPandas(_merge, LINE)


def split_content(merged: DataFrame, columns: DataFrame, tops: DataFrame) -> DataFrame:
    """The merged lines with ``col`` 0 or 1 for content, ``repeated`` for headers and footers, and ``kept`` for content that is none."""
    marks = tops.withColumn("repeated", F.lit(True))
    here = merged.join(marks, ["doc", "top"], "left").join(columns.select("doc", "lefts"), "doc", "left")
    at = F.array_position("lefts", F.expr("try_cast(left AS double)"))
    col = F.when(at.between(1, 2), 0).when(at > 2, 1)
    here = here.withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    return here.withColumn("col", col).withColumn("kept", ~F.col("repeated") & col.isNotNull()).drop("lefts")


def speaker_style(content: DataFrame, fonts: DataFrame) -> DataFrame:
    """(doc, speaker_font, speaker_height): the most frequent other font with a line that begins like a speaker's; the last height of its first such text.

    Only documents whose content lines are mostly in the text font have one.
    """
    every = _ordered(content).withColumn("said", strip(F.col("text")))
    n = every.where("font is not null").groupBy("doc", "font").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))
    rank = F.struct("n", F.struct(-F.col("first_ord.page"), -F.col("first_ord.col"), -F.col("first_ord.line_no")))
    usual = n.groupBy("doc").agg(F.max_by("font", rank).alias("text_font")).join(fonts.select("doc", "text_font"), ["doc", "text_font"])
    placed = every.join(usual, "doc").where(F.col("font") != F.col("text_font"))
    begins = F.lit(False)
    for p in SPEAKER_PREFIXES:
        begins = begins | F.col("said").startswith(p)
    first = placed.where(begins).groupBy("doc", "font").agg(F.min_by("said", "ord").alias("said"))
    best = first.join(n, ["doc", "font"]).groupBy("doc").agg(F.max_by(F.struct("font", "said"), rank).alias("b")).select("doc", "b.font", "b.said")
    height = placed.join(best, ["doc", "font", "said"]).groupBy("doc", "font").agg(F.max_by("height", "ord").alias("speaker_height"))
    return height.select("doc", F.col("font").alias("speaker_font"), "speaker_height").where("speaker_height is not null")


def _ordered(content: DataFrame) -> DataFrame:
    return content.withColumn("ord", F.struct("page", "col", "line_no"))


def _names(lines: DataFrame, style: DataFrame) -> DataFrame:
    """(doc, said): the different texts set like a speaker's name."""
    return lines.join(style, "doc").where((F.col("font") == F.col("speaker_font")) & (F.col("height") == F.col("speaker_height")) & (F.col("said") != "")).select("doc", "said").distinct()


def stack_speakers(content: DataFrame, style: DataFrame, fonts: DataFrame) -> DataFrame:
    """(doc, page, unit, text, speaks): content lines in reading order, speaker names of two lines joined.

    A line joins the one above if that one is a name, it is not in the text font, and it begins where the other
    ends. Names are then sought once more among the joined lines. Windows are per page, so that a document that
    holds a third of all lines is no single task; a name never goes on on the next page, where the tops begin anew.
    """
    w = Window.partitionBy("doc", "page").orderBy("col", "line_no")
    here = content.withColumn("said", strip(F.col("text"))).join(fonts.select("doc", "text_font"), "doc", "left").withColumn("pos", F.row_number().over(w))
    here = here.join(_names(here, style).withColumn("is_name", F.lit(True)), ["doc", "said"], "left").withColumn("is_name", F.coalesce("is_name", F.lit(False)))
    o = Window.partitionBy("doc", "page").orderBy("pos")
    number = lambda c: F.expr(f"try_cast({c} AS double)")
    here = here.withColumn("before", F.lag(F.struct("is_name", (number("top") + number("height")).alias("bottom"))).over(o))
    follows = F.col("before.is_name") & (F.col("font") != F.col("text_font")) & (F.abs(F.col("before.bottom") - number("top")) <= STACK)
    here = here.withColumn("unit", F.sum((~F.coalesce(follows, F.lit(False))).cast("int")).over(o))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "")
    joined = here.groupBy("doc", "page", "unit").agg(text.alias("text"), F.min_by(F.struct("font", "height"), "pos").alias("set")).select("doc", "page", "unit", "text", "set.*").withColumn("said", strip(F.col("text")))
    known = _names(joined, style).withColumn("speaks", F.lit(True))
    return joined.join(known, ["doc", "said"], "left").select("doc", "page", "unit", "text", F.coalesce("speaks", F.lit(False)).alias("speaks"))


def speeches(stacked: DataFrame) -> DataFrame:
    """(doc, seq, speaker, text): each speaker's line with all text up to the next; lines before the first speaker are left out.

    Speakers are counted within pages; the counts of the pages before come from the much shorter table of pages.
    """
    o = Window.partitionBy("doc", "page").orderBy("unit")
    here = stacked.withColumn("own", F.sum(F.col("speaks").cast("int")).over(o))
    pages = here.groupBy("doc", "page").agg(F.max("own").alias("n"))
    pages = pages.select("doc", "page", (F.sum("n").over(Window.partitionBy("doc").orderBy("page")) - F.col("n")).alias("before"))
    here = here.join(pages, ["doc", "page"]).withColumn("seq", (F.col("before") + F.col("own")).cast("bigint")).where("seq > 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("speaks"), F.struct("page", "unit", "text")))), lambda x: x["text"]), "")
    name = F.max(F.when(F.col("speaks"), F.translate(strip(F.col("text")), "\u00a0", " ")))
    return here.groupBy("doc", "seq").agg(name.alias("speaker"), text.alias("text"))

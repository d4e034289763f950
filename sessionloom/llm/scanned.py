"""Scanned pages into continuous text: composition of page_lines.py and ocr.py."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm import ocr, page_lines
from sessionloom.tables import written


@dataclass
class Repair:
    furniture: DataFrame  # line_id
    text: DataFrame  # prepared lines without furniture and empty lines
    flowing: DataFrame  # text lines with their successor
    broken: DataFrame  # line_id, next_id, a, b, joined, broken
    fixes: DataFrame  # line_id, start, stop, fixed
    pieces: DataFrame  # line_id, next_id, a, b, fixed, place: words broken at a line's end, how they are read, and where in a + b they differ first


def repair(lines: DataFrame, lexicon: DataFrame, pages: DataFrame) -> Repair:
    """The noise of the lines. pages: (ple_code, width); a transcript without pages there is as wide as its lines reach, with margins alike."""
    prep = written(page_lines.prepared(lines), "scan-lines")
    widths = written(page_lines.widths(prep, pages), "scan-widths")
    marked = written(page_lines.furniture(prep, widths), "scan-furniture")
    text = written(prep.where("t != ''").join(marked, "line_id", "left_anti"), "scan-text")
    flowing = written(page_lines.flow(text, widths), "scan-flow")
    vocab = written(page_lines.vocabulary(text, lexicon), "scan-vocabulary")
    size = vocab.agg(F.sum("n").alias("total"), F.max(F.length("v")).alias("longest")).first()
    total, longest = float(size["total"] or 1), int(size["longest"] or 0)
    compounds = text.select(F.explode("compounds").alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    broken = written(page_lines.breaks(flowing, vocab, compounds, total), "scan-breaks")
    cut = broken.where("broken")
    last = cut.select("line_id").withColumn("cut_last", F.lit(True))
    first = cut.select(F.col("next_id").alias("line_id")).distinct().withColumn("cut_first", F.lit(True))
    i_last = F.size("words") - 1
    kept = F.transform("words", lambda w, i: F.when((F.col("cut_last") & (i == i_last)) | (F.col("cut_first") & (i == 0)), None).otherwise(w))
    tokens = text.select("line_id", "words", "bold").join(last, "line_id", "left").join(first, "line_id", "left").na.fill(False, ["cut_last", "cut_first"]).select((F.col("line_id") * 2).alias("line_id"), kept.alias("words"), "bold", F.col("words").alias("all_words"))
    # A broken word is decoded between its neighbours, as a line of its own with an odd number.
    near = lambda key, k, name: text.select(F.col("line_id").alias(key), F.get("words", k).alias(name))
    joints = cut.join(near("line_id", F.size("words") - 2, "before"), "line_id").join(near("next_id", F.lit(1), "after"), "next_id")
    joints = joints.select((F.col("line_id") * 2 + 1).alias("line_id"), F.array("before", "joined", "after").alias("words"), F.lit(False).alias("bold"))
    tokens = written(tokens.drop("all_words").unionByName(joints), "scan-tokens")
    said = tokens.where("line_id % 2 = 0").select(F.explode("words").alias("w")).where("w is not null").unionByName(cut.select(F.col("joined").alias("w")))
    unknown = said.groupBy("w").agg(F.count("*").alias("n")).join(vocab.where("lex").select(F.col("v").alias("w")), "w", "left_anti").where("length(w) > 1")
    cands = written(ocr.candidates(written(unknown, "ocr-unknown"), vocab, total, longest), "ocr-known-candidates")
    chances = ocr.confusion_probabilities(cands, vocab, total)
    decoded = written(ocr.corrections(tokens, vocab, cands, chances, total), "ocr-fixes")
    fixes = decoded.where("line_id % 2 = 0").withColumn("line_id", (F.col("line_id") / 2).cast("bigint"))
    joint = decoded.where("line_id % 2 != 0 and start = 1 and stop = 2").select(((F.col("line_id") - 1) / 2).cast("bigint").alias("line_id"), "fixed")
    where = cands.select(F.col("w").alias("joined"), F.concat_ws(" ", "v", "second").alias("fixed"), F.array_min("at").alias("place")).groupBy("joined", "fixed").agg(F.min("place").alias("place"))
    pieces = cut.join(joint, "line_id").join(where, ["joined", "fixed"]).select("line_id", "next_id", "a", "b", "fixed", "place")
    return Repair(marked, text, flowing, broken, fixes, written(pieces, "scan-pieces"))


def noise(r: Repair) -> DataFrame:
    """(line_id, kind): furniture, hyphen and ocr lines."""
    kinds = [
        r.furniture.select("line_id", F.lit("furniture").alias("kind")),
        r.broken.where("broken").select("line_id", F.lit("hyphen").alias("kind")),
        r.fixes.select("line_id", F.lit("ocr").alias("kind")),
        r.pieces.select(F.when(F.col("place") < F.length("a"), F.col("line_id")).otherwise(F.col("next_id")).alias("line_id"), F.lit("ocr").alias("kind")),
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).unionByName(kinds[3]).distinct()


def _fixed_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for t, starts, ends, fixes in zip(b["t"], b["starts"], b["ends"], b["edits"], strict=True):
            for f in sorted(fixes if fixes is not None else [], key=lambda f: -f["start"]):
                p, q = int(starts[f["start"]]), int(ends[f["stop"] - 1])
                new = f["fixed"] if t[p].islower() or not t[p].isalpha() else f["fixed"][:1].upper() + f["fixed"][1:]
                t = t[:p] + new + t[q:]
            out.append(t)
        yield b.drop(columns=["t", "starts", "ends", "edits"]).assign(t=out)


def piece_fixes(r: Repair) -> DataFrame:
    """(line_id, start, stop, fixed): how the pieces of misread broken words are read in their own lines.

    The piece without the first difference stays if the reading allows it. Pieces that are only a part of a word as the
    line has it (behind a hyphen of its own, say) are left alone.
    """
    a, b, fixed = F.col("a"), F.col("b"), F.col("fixed")
    keeps_b = (F.col("place") < F.length("a")) & (F.right(fixed, F.length(b)) == b)
    cut = F.when(keeps_b, F.length(fixed) - F.length(b)).otherwise(F.length(a))
    both = r.pieces.select("line_id", "next_id", "a", "b", F.substring(fixed, F.lit(1), cut).alias("head"), F.substring(fixed, cut + 1, F.length(fixed)).alias("rest"))
    words = r.text.select("line_id", "words")
    last = both.join(words, "line_id").where("element_at(words, -1) = a and head != a").select("line_id", (F.size("words") - 1).alias("start"), F.size("words").alias("stop"), F.col("head").alias("fixed"))
    first = both.select(F.col("next_id").alias("line_id"), "b", "rest").join(words, "line_id").where("words[0] = b and rest != b").select("line_id", F.lit(0).alias("start"), F.lit(1).alias("stop"), F.col("rest").alias("fixed"))
    return last.unionByName(first)


def paragraphs(r: Repair, indent: float = 8.0) -> DataFrame:
    """(ple_code, para_no, first_line_id, is_speaker, text): the repaired text in the order of the columns.

    A paragraph begins at a speaker's line, after one, and at an indented line. Paragraphs are counted within
    pages; the counts of the pages before come from the much shorter table of pages.
    """
    edits = r.fixes.unionByName(piece_fixes(r)).groupBy("line_id").agg(F.collect_list(F.struct("start", "stop", "fixed")).alias("edits"))
    page = Window.partitionBy("ple_code", "page")
    order = page.orderBy("place")
    ahead = r.broken.select("line_id", "broken", F.lit(True).alias("glued"))
    words = r.text.select("line_id", "t", "starts", "ends").join(ahead, "line_id", "left").join(edits, "line_id", "left")
    lines = r.flowing.select("line_id", "ple_code", "page", "place", "x", "col", "bold", "mark").join(words, "line_id")
    base = F.min("x").over(Window.partitionBy("ple_code", "page", "col"))
    begins = F.col("bold") | F.coalesce(F.lag("bold").over(order), F.lit(False)) | F.coalesce(F.col("x") - base > indent, F.lit(False))
    lines = lines.withColumn("begins", begins.cast("int")).withColumn("own", F.sum("begins").over(order))
    pages = lines.groupBy("ple_code", "page").agg(F.max("own").alias("n"))
    pages = pages.select("ple_code", "page", (F.sum("n").over(Window.partitionBy("ple_code").orderBy("page")) - F.col("n")).alias("before"))
    lines = lines.join(pages, ["ple_code", "page"]).withColumn("para_no", (F.col("before") + F.col("own")).cast("bigint"))
    kept = lines.select("ple_code", "para_no", "page", "place", "line_id", "bold", "t", "starts", "ends", "edits", "mark", F.coalesce("broken", F.lit(False)).alias("broken"), F.coalesce("glued", F.lit(False)).alias("glued"))
    fixed = kept.mapInPandas(_fixed_text, "ple_code string, para_no bigint, page int, place int, line_id bigint, bold boolean, mark string, broken boolean, glued boolean, t string")
    piece = F.when(F.col("broken"), F.regexp_replace("t", r"[-‐¬\x{AD}]$", "")).when(F.col("glued"), F.col("t")).otherwise(F.concat("t", F.lit(" ")))
    return fixed.groupBy("ple_code", "para_no").agg(
        F.min_by("line_id", F.struct("page", "place")).alias("first_line_id"), F.max("bold").alias("is_speaker"),
        F.rtrim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "place", piece.alias("piece")))), lambda x: x["piece"]), "")).alias("text"),
    )

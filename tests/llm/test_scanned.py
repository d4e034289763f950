"""Furniture, broken words and misread words on a small made-up transcript, and the parts alone."""

from datetime import datetime

import pytest

from sessionloom.llm import ocr, page_lines
from sessionloom.llm.scanned import noise, paragraphs, repair

COLS = "line_id long, ple_code string, page int, line_no int, top string, left string, width string, height string, font string, text string, loaded_at timestamp_ntz, skeleton string"
WORDS = "aquest debat agrari del sector rural necessita una taxa digital per primera vegada dictamen".split()


def transcript(lines_per_page=12, pages=4, code="c"):
    """Two columns; each line a window of WORDS, so that all words and pairs are frequent."""
    rows, expect, n = [], set(), 0

    def add(page, top, left, text, font="1", height="17", width="300", kinds=()):
        nonlocal n
        rows.append((n, code, page, len(rows), str(top), str(left), width, height, font, text, datetime(2020, 1, 1), "x"))
        expect.update((n, k) for k in kinds)
        n += 1

    for p in range(pages):
        add(p, 40, 85, f"Sessió núm. 12 / 0{p}", font="9", height="14", kinds=("furniture",))
        add(p, 1220, 430, str(p + 1), font="8", width="8", kinds=("furniture",))
        for c, left in enumerate((85, 460)):
            for k in range(lines_per_page):
                at = (p + c + k) % len(WORDS)
                add(p, 100 + 26 * k, left, " ".join((WORDS * 2)[at : at + 6]) + ".")
    return rows, expect, add


PAGES = [("c", 892), ("c", 892), ("c", 612), ("d", None), (None, 5)]


def check(spark, rows, expect, words=WORDS):
    lines = spark.createDataFrame(rows, COLS)
    lexicon = spark.createDataFrame([(w,) for w in words], "word string")
    r = repair(lines, lexicon, spark.createDataFrame(PAGES, "ple_code string, width int"))
    assert {tuple(x) for x in noise(r).collect()} == expect
    return r


def test_a_transcript(spark):
    rows, expect, add = transcript()
    last = 100 + 26 * 12
    add(0, last, 460, "aquest debat agrari del sec-", kinds=("hyphen",))
    add(1, 90, 85, "tor rural necessita una taxa.")  # the next page's first column
    add(1, last, 85, "aqu3st no; dcl sector rural necessita", kinds=())
    rows[-1] = (*rows[-1][:9], "aquest debaf agrari del sector rural.", *rows[-1][10:])
    expect.add((rows[-1][0], "ocr"))
    add(1, last + 26, 85, "aquest debatagrari del sector rural.", kinds=("ocr",))
    add(1, last + 52, 85, "una taxa digi tal per primera vegada.", kinds=("ocr",))
    add(2, last, 85, "una taxa digital per primera ve¬", kinds=("hyphen",))
    add(2, last + 26, 85, "gada aquest debat agrari.")
    add(2, last + 52, 85, "una taxa digi­tal per primera vegada.")
    add(2, last + 78, 85, "")
    add(2, last + 78, 460, "1. Vegeu l’annex 3.", font="7")
    add(3, last, 85, None, font=None, height=None)
    add(3, last + 26, 460, "17")
    rows.append(rows[5])
    r = check(spark, rows, expect)
    text = {x["first_line_id"]: x["text"] for x in paragraphs(r).collect()}
    whole = " ".join(text.values())
    assert "del sector rural necessita una taxa." in whole and "aquest debat agrari del sector rural." in whole and "primera vegada aquest debat agrari." in whole
    assert "Sessió" not in whole and "debaf" not in whole and "debatagrari" not in whole


def test_a_misread_broken_word(spark):
    rows, expect, add = transcript()
    last = 100 + 26 * 12
    add(1, last, 460, "aquest debat agrari del sector rural neces-", kinds=("hyphen",))
    add(2, 90, 85, "sifa una taxa digital.", kinds=("ocr",))
    add(2, last, 85, "una taxa digital per primera vegada dicfa-", kinds=("hyphen", "ocr"))
    add(2, last + 26, 85, "men aquest debat agrari.")
    r = check(spark, rows, expect)
    whole = " ".join(x["text"] for x in paragraphs(r).collect())
    assert "sector rural necessita una taxa" in whole and "vegada dictamen aquest debat" in whole and "sifa" not in whole and "dicfa" not in whole


def test_lines_without_a_code(spark):
    rows, expect, add = transcript(code=None)
    add(2, 100 + 26 * 12, 85, "aquest debaf agrari del sector rural.", kinds=("ocr",))
    r = check(spark, rows, expect)
    assert "aquest debat agrari del sector rural. " in " ".join(x["text"] for x in paragraphs(r).collect()) + " "


def test_empty_tables(spark):
    assert noise(repair(spark.createDataFrame([], COLS), spark.createDataFrame([("a",)], "word string"), spark.createDataFrame([], "ple_code string, width int"))).count() == 0


@pytest.mark.parametrize(("w", "v"), [("aqucst", "aquest"), ("dictarnen", "dictamen"), ("eur0s", "euros"), ("terntori", "territori"), ("aqiiest", "aquest"), ("penclent", "pendent"), ("inst!tut", "institut"), ("conse1l", "consell"), ("capdava11", "capdavall"), ("hidràuIic", "hidràulic")])
def test_candidates(w, v):
    assert v in {c for c, second, _, _ in ocr.candidates_of(w, 20) if second is None}


def test_candidates_split_and_places():
    assert ("tècnic", "exclou") in {(a, b) for a, b, _, _ in ocr.candidates_of("tècnicexclou", 20)}
    assert next((ops, at) for c, s, ops, at in ocr.candidates_of("dcbat", 20) if c == "debat") == ([ocr.CONFUSIONS.index(("e", "c"))], [1])
    long = "c" * 300
    assert not list(ocr.candidates_of(long, 20))  # no known word is that long
    assert list(ocr.candidates_of(long, 299)) and ("responsabilitatsocialadministrativa",) in {(c,) for c, s, _, _ in ocr.candidates_of("responsabi1itat5ocia1admini5trativa", 40) if s is None}
    assert not ocr.listed("1" * 11) and not [s for _, s, _, _ in ocr.candidates_of("1" * 11, 40) if s is None]


def test_words_with_any_number_of_wrong_marks(spark):
    unknown = spark.createDataFrame([("i1!1|1!1!1!|", 1), ("dcbat", 1), ("1" * 60, 1)], "w string, n long")
    vocab = spark.createDataFrame([("ililililillI".lower(), 50, True), ("debat", 50, True), ("lo", 5, True)], "v string, n long, lex boolean")
    got = {(r["w"], r["v"]) for r in ocr.candidates(unknown, vocab, 1000.0, 12).collect()}
    assert got == {("i1!1|1!1!1!|", "ilililililli"), ("dcbat", "debat")}
    assert ocr.least(3, 10.0) == 3 and ocr.least(3, 1e9) == 30


def test_words_and_skeletons():
    found = lambda t: [m[0] for m in page_lines.WORD.finditer(t)]
    assert found("l’escola inst!tut no! serve! aquest") == ["l’", "escola", "inst!tut", "no!", "serve!", "aquest"]
    assert page_lines.skeleton("5essió núm. 25 / 18/07/2012") == page_lines.skeleton("Sessió núm. 3") and page_lines.skeleton("— 28 —") == page_lines.skeleton("xii") == ""

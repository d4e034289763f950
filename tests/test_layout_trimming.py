"""Layout statistics, speeches, and word search in recognised speech."""

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import layout, trimming
from sessionloom.plans import text_queries

COLS = "doc string, page int, line_no int, top string, left string, width string, height string, font string, text string"


def document(spark, doc="d", pages=8):
    rows = []
    for p in range(pages):
        n = 0

        def add(top, left, text, font="1", height="17", width="100"):
            nonlocal n
            rows.append((doc, p, n, str(top), str(left), width, height, font, text))
            n += 1

        if p >= 2:
            add(40, 85, "DIARI", font="9", height="14")
            add(1230, 85, "ISSN 1", font="9", height="14")
        for c, left in enumerate((85, 460)):
            add(100, left, f"<b>Nom {p}{c}</b>", font="2")
            for k in range(6):
                add(120 + 20 * k, left + (17 if k % 2 else 0), f"text {p}.{c}.{k} ")
    return spark.createDataFrame(rows, COLS)


def test_layout_of_two_columns(spark):
    lines = document(spark)
    columns = layout.content_columns(lines).first()
    assert (columns["columns"], columns["lefts"]) == (2, [85.0, 102.0, 460.0, 477.0])
    fonts = layout.text_font(lines)
    assert fonts.first()["text_font"] == "1"
    heights = spark.createDataFrame([("d", 1262)], "doc string, height int")
    tops = layout.header_footer(lines, layout.content_columns(lines), fonts, heights)
    assert sorted(r["top"] for r in tops.collect()) == ["1230", "40"]
    content = layout.split_content(layout.merge_fragments(lines), layout.content_columns(lines), tops)
    assert content.count() == lines.count() and content.where("not kept").count() == 12
    kept = content.where("kept")
    style = layout.speaker_style(kept, fonts)
    assert tuple(style.first()) == ("d", "2", "17")
    got = layout.speeches(layout.stack_speakers(kept, style, fonts)).orderBy("seq").collect()
    assert len(got) == 16 and got[0]["speaker"] == "<b>Nom 00</b>" and got[1]["speaker"] == "<b>Nom 01</b>"
    assert got[3]["text"] == "".join(f"text 1.1.{k} " for k in range(6))


@pytest.mark.parametrize(("pages", "least"), [(30, 8), (6, 1)])
def test_header_threshold_counts_all_pages(spark, pages, least):
    """A line repeated on max(1, pages // 3 - 2) pages is header or footer; pages without lines count."""
    def tops(times):
        rows = [("d", 2 + k, 0, "40", "85.0", "9", "14", "9", "DIARI") for k in range(times)] + [("d", 2 + k, 1, "1230", "85", "9", "14", "9", "ISSN") for k in range(times)]
        rows += [("d", 2, 2 + k, str(100 + k), str(85 + 17 * (k % 2)), "9", "17", "1", f"t{k}") for k in range(200)]
        lines = spark.createDataFrame(rows, COLS)
        counts = spark.createDataFrame([("d", pages)], "doc string, pages int")
        heights = spark.createDataFrame([("d", 1262)], "doc string, height int")
        return layout.header_footer(lines, layout.content_columns(lines), layout.text_font(lines), heights, counts).count()

    assert tops(least) == 2 and (least == 1 or tops(least - 1) == 0)


def test_style_and_names_without_blanks(spark):
    rows = [("d", 0, 0, "100", "85", "9", "17", "2", "<b>Nom</b> "), ("d", 0, 1, "140", "85", "9", "17", "1", "U. "), ("d", 0, 2, "160", "85", "9", "17", "1", "Dos."), ("d", 0, 3, "200", "85", "9", "17", "2", "<b>Nom</b>"), ("d", 0, 4, "240", "85", "9", "17", "1", "Tres. ")]
    content = spark.createDataFrame(rows, COLS).withColumn("col", F.lit(0))
    fonts = spark.createDataFrame([("d", "1")], "doc string, text_font string")
    style = layout.speaker_style(content, fonts)
    assert [tuple(r) for r in style.collect()] == [("d", "2", "17")]
    assert [tuple(r) for r in layout.speeches(layout.stack_speakers(content, style, fonts)).orderBy("seq").collect()] == [("d", 1, "<b>Nom</b>", "U. Dos."), ("d", 2, "<b>Nom</b>", "Tres. ")]
    assert layout.speaker_style(content, fonts.withColumn("text_font", F.lit("7"))).count() == 0


def test_fragments(spark):
    rows = [("d", 0, 0, "100", "10", "50", "17", "1", "a"), ("d", 0, 1, "100.5", "60", "20", "17", "1", "b"), ("d", 0, 2, "100", "79", "5", "17", "1", "c"), ("d", 0, 3, "130", "84", "5", "17", "1", None), ("d", 0, 4, None, "89", "x", "17", "1", "e")]
    got = layout.merge_fragments(spark.createDataFrame(rows, COLS)).orderBy("line_no").collect()
    assert [(r["text"], r["width"]) for r in got] == [("abc", "73"), ("", "5"), ("e", "x")]


def test_two_line_speaker_names(spark):
    rows = [("d", 0, 0, "100", "85", "9", "17", "2", "<b>El conseller de</b>"), ("d", 0, 1, "118", "85", "9", "17", "2", "<b>Salut</b>"), ("d", 0, 2, "140", "85", "9", "17", "1", "Bon dia. "), ("d", 0, 3, "160", "85", "9", "17", "1", "Gràcies.")]
    content = spark.createDataFrame(rows, COLS).withColumn("col", F.lit(0))
    style = spark.createDataFrame([("d", "2", "17")], "doc string, speaker_font string, speaker_height string")
    fonts = spark.createDataFrame([("d", "1")], "doc string, text_font string")
    got = layout.speeches(layout.stack_speakers(content, style, fonts)).collect()
    assert [tuple(r) for r in got] == [("d", 1, "<b>El conseller de</b><b>Salut</b>", "Bon dia. Gràcies.")]


def test_layout_of_an_empty_table(spark):
    lines = spark.createDataFrame([], COLS)
    assert layout.content_columns(lines).count() == 0 and layout.text_font(lines).count() == 0 and layout.merge_fragments(lines).count() == 0


@pytest.mark.parametrize(("shares", "columns"), [((50, 50), 1), ((40, 30, 20, 10), 2)])
def test_column_counts(spark, shares, columns):
    rows = [("d", 2, k, "1", str(100 + i), "1", "1", "1", "x") for i, n in enumerate(shares) for k in range(n)]
    assert layout.content_columns(spark.createDataFrame(rows, COLS)).first()["columns"] == columns


def test_page_sizes(spark):
    p = spark.createDataFrame([("d", 1, 892, 1262), ("d", 2, 892, 1262), ("d", 3, 900, 1262)], "doc string, page int, width int, height int")
    assert tuple(layout.page_sizes(p).first()) == ("d", 892, 1262, 2)


def arrays(spark, words, sought):
    return spark.createDataFrame([(words, sought)], "w array<string>, s array<string>")


def test_windows_and_first_match(spark):
    df = arrays(spark, list("abcde"), list("cd"))
    assert df.select(trimming.windows(F.col("w"), 4)).first()[0] == [list("abcd"), list("bcde")]
    assert df.select(trimming.windows(F.col("s"), 4)).first()[0] == []
    assert df.select(trimming.first_match(F.col("w"), F.col("s"))).first()[0] == 2
    assert arrays(spark, list("ab"), list("abc")).select(trimming.first_match(F.col("w"), F.col("s"))).first()[0] is None
    assert arrays(spark, [], []).select(trimming.first_match(F.col("w"), F.col("s"))).first()[0] is None


@pytest.mark.parametrize(("words", "compat", "want"), [("x y c d e z", False, (2, 2, 3)), ("x y c d e z", True, None), ("a b c d q", True, (0, 0, 4)), ("q", False, None)])
def test_longest_match(spark, words, compat, want):
    df = arrays(spark, words.split(), list("abcde"))
    got = df.select(trimming.longest_match(F.col("w"), F.col("s"), compat=compat).alias("m")).first()["m"]
    assert (tuple(got) if got else None) == want


def test_audio_limits(spark):
    df = spark.createDataFrame([(300.0,), (50.0,)], "d double")
    assert [[tuple(p) for p in r[0]] for r in df.select(trimming.audio_limits(F.col("d"))).collect()] == [[(0.0, 60.0), (240.0, 300.0)], []]
    assert [[p["offset"] for p in r[0]] for r in df.select(trimming.searched_parts(F.col("d"))).collect()] == [[0.0, 240.0], [0.0, 0.0]]


def test_edges_of_long_audio(spark):
    words = [f"w{k}" for k in range(20)]
    texts = spark.createDataFrame([("k", words, 300.0), ("silent", words, 300.0)], "key string, words array<string>, duration double")
    said = [("k", "begin", i, float(i), i + 0.5, w) for i, w in enumerate(["noise", "<sil>", *words[:8]])] + [("k", "end", i, float(i), i + 0.5, w) for i, w in enumerate([*words[12:], "tail"])]
    heard = spark.createDataFrame(said, "key string, side string, pos int, start double, end double, word string")
    got = {r["key"]: r for r in trimming.edges(texts, heard).collect()}
    assert (got["k"]["start"], got["k"]["end"], got["k"]["first_word"], got["k"]["last_word"]) == (2.0, 240 + 7.5 + 0.2, 0, 19)
    assert got["silent"]["start"] is None and got["silent"]["end"] is None


def test_phonemes(spark):
    conversion = spark.createDataFrame([("a", "A"), ("j", "Y"), ("ʋ", "V"), ("", "X"), (None, "Z")], "espeak string, cmu string")
    t = spark.createDataFrame([("vai", "ˈvaɪ"), ("bad", "q")], "word string, ipa string")
    spaced = t.withColumn("ipa", F.when(F.col("word") == "vai", "v_aɪ").otherwise(F.col("ipa")))
    assert dict(map(tuple, trimming.mapped_phonemes(spaced, conversion).collect())) == {"vai": "V A Y", "bad": None}
    words = spark.createDataFrame([("vai",), ("pa",), ("no",)], "word string")
    d = spark.createDataFrame([("pa", "P A")], "word string, phonemes string")
    got = trimming.pronunciations(words, d, trimming.mapped_phonemes(spaced, conversion))
    assert dict(map(tuple, got.collect())) == {"vai": "V A Y", "pa": "P A", "no": None}


def test_word_windows_reach_the_end_of_the_text(spark, tmp_path):
    words = [f"w{k}" for k in range(40)]
    texts = [(1, " ".join(words)), (2, "a b  c\nd"), (3, "a b c"), (4, ""), (5, None)]
    spark.createDataFrame(texts, "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["pos"], r["words"]) for r in text_queries.word_windows(spark, str(tmp_path)).collect()}
    assert got == {(1, k, " ".join(words[k : k + 4])) for k in range(37)} | {(2, 0, "a b c d")}

"""Text, code and name functions against hand-traced results."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sessionloom.functions import codes, text
from sessionloom.functions.fuzzy import name_key, token_set_similarity
from sessionloom.operators import quality


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(("given", "want"), [
    ("Bon dia (Aplaudiments) .", "Bon dia."), ("a {x} b {y} c", "a c"), ("<i>(Remor) </i>Sí", "Sí"), ("co­ma x", "co-ma x"), ("<b>Nom</b>", "Nom"), ("", ""), (None, None),
])
def test_structure_clean(spark, given, want):
    assert one(spark, given, text.structure_clean) == want


@pytest.mark.parametrize(("given", "want"), [
    ("Hola. Bon dia! què? no... Sí", ["Hola.", "Bon dia! què? no...", "Sí"]), ("U.Dos", ["U.", "Dos"]), ('Diu "ja!" Ara', ['Diu "ja!"', "Ara"]), ("", []), ("sense final", ["sense final"]),
])
def test_sentences(spark, given, want):
    assert one(spark, given, text.sentences) == want


def test_punctuation(spark):
    assert one(spark, "`l’home ''diu'' «sí»`", text.punctuation) == "'l'home 'diu' sí'"


def test_well_formed_lengths(spark):
    ok = lambda s: one(spark, s, text.well_formed)
    assert ok("a" * 30) is False and ok("a" * 31) is True and ok("a" * 600) is True and ok("a" * 601) is False
    assert ok("A les 10:30 comença la sessió plenària d'avui") is False and ok("Una frase llarga amb | barra i prou lletres") is False
    assert ok("Una frase llarga amb un caràcter estrany: ß i prou") is False


def test_words_at_the_ends(spark):
    assert one(spark, " a b c ", lambda c: text.first_words(c, 5)) == ["a", "b", "c"]
    assert one(spark, "a b c", lambda c: text.last_words(c, 5)) == ["a", "b", "c"]
    assert one(spark, "1 2 3 4 5 6 7", lambda c: text.last_words(c, 5)) == ["3", "4", "5", "6", "7"]


def test_codes(spark):
    assert one(spark, "2018_03_14_123", codes.code_date) == "14/03/2018"
    assert one(spark, "Data 14/03/2018.", codes.date_code) == "2018_03_14" and one(spark, "cap", codes.date_code) is None
    assert one(spark, "/x/123.pdf", lambda c: codes.file_name(F.lit("14/03/2018"), c)) == "2018_03_14_123.pdf"
    assert one(spark, "http://h/abcd.mp3", lambda c: codes.shard_path("audio", c)) == "audio/a/b/abcd.mp3"
    assert one(spark, "a/123.pdf#page=7", codes.page_number) == "7" and one(spark, "a", codes.page_number) is None
    assert tuple(one(spark, "De 10:00:00 a 10:05:00 - Durada 5", codes.time_range)) == ("10:00:00", "10:05:00")
    assert [one(spark, n, lambda c: codes.zero_padded(c.cast("int"))) for n in ("7", "12", "123")] == ["07", "12", "123"]
    assert one(spark, "x/y.mp3", lambda c: codes.segment_name(c, F.lit(1.5), F.lit(2))) == "y_1.500_2.000.wav"
    assert one(spark, "../b.html", lambda c: codes.absolute(F.lit("http://h/a/x.html"), c)) == "http://h/b.html"


def test_names(spark):
    assert one(spark, "  Mònica Çà ", name_key) == "monica ca"
    assert one(spark, "Nom Cognom|Grup", text.speaker_name) == "Nom Cognom"
    assert tuple(one(spark, "El conseller (de) X (Pere Pi)", text.title_and_name)) == ("El conseller (de) X", "Pere Pi")
    assert one(spark, "a &amp; b", text.unescape) == "a & b"
    assert one(spark, '<text top="1">a &lt; <b>b</b></text>', text.inner_markup) == "a < <b>b</b>" and one(spark, "<text/>", text.inner_markup) == ""
    assert token_set_similarity("pere pi", "pi, pere") == 100 and token_set_similarity("", "x") == 0 and token_set_similarity("pere pi", "pere") == 100
    assert token_set_similarity("Anna Soler", "Marc Vidal") < 60
    names = ["pere pi i mas", "pi i mas, p.", "anna roc", "ana roca i vila", "el conseller", "la consellera de salut", "conseller de salut"]
    for over in (60, 80, 90):
        for a in names:
            for b in names:
                full = token_set_similarity(a, b)
                assert token_set_similarity(a, b, over) == (full if full > over else 0)


def test_lexicon_score_and_hyphens(spark):
    docs = spark.createDataFrame([(1, "Parlament obert, obert! zzz"), (2, ""), (3, None), (4, "par-lament obert dir-ho al Vint-i-cinc"), (5, "(Par-lament), o-bert o-bert-a")], "id int, text string")
    lex = spark.createDataFrame([("parlament",), ("obert",), ("dir-ho",), ("dirho",), ("obert",)], "word string")
    got = {r["id"]: (r["n_tokens"], r["n_known"], r["score"]) for r in quality.lexicon_scores(docs, lex, "id").collect()}
    assert got[1] == (3, 2, 0.666667) and got[2] == (0, 0, 1.0) and got[3] == (0, 0, 1.0)
    fixed = {r["id"]: r["text"] for r in quality.hyphens_fixed(docs, lex, "id").collect()}
    assert fixed == {1: "Parlament obert, obert! zzz", 2: "", 3: None, 4: "parlament obert dir-ho al Vint-i-cinc", 5: "(parlament), obert obert-a"}
    clean = {r["id"]: r["text"] for r in quality.clean_turns(docs, lex, "id").collect()}
    assert clean[4] == "parlament obert dir-ho al Vint-i-cinc"


def test_acceptance_rules(spark):
    long = "bon dia " * 80
    turn = lambda s, t: {"speaker": s, "text": t}
    url = {"names": ["A"], "url": "u"}
    records = [
        (1, "s", [turn("A", long)], [url]), (2, "s", [turn("A", long)], [url, url]), (3, "s", [turn("A", "bon dia")], [url]), (4, "s", [turn("A", "xx " * 200)], [url]),
        (5, "s", [turn("A", long), turn(" C ", long)], None), (6, "s", [turn("B", long), turn("A", long + long)], []), (7, "only", [turn("C", long)], [url]), (8, "s", None, [url]),
        (9, "s", [turn("Z ", long)], [url]), (10, "none", [turn("C", long)], [url]), (11, "s", [turn("A", "bon dia " * 60), turn("C", long), turn("A", "bon")], [url]),
    ]
    r = spark.createDataFrame(records, "record_id int, session string, text array<struct<speaker:string,text:string>>, urls array<struct<names:array<string>,url:string>>")
    s = spark.createDataFrame([("s", "C"), ("only", " C")], "session string, chair string")
    lex = spark.createDataFrame([("bon",), ("dia",)], "word string")
    got = {x["record_id"]: x["reason"] for x in quality.judged(r, s, lex).collect()}
    # The speaker is one of the record's own turns; words are the speaker's.
    assert got == {1: None, 2: "several urls", 3: "short", 4: "lexicon", 5: None, 6: "share", 7: "only the chair", 8: "only the chair", 9: None, 10: None, 11: "short"}
    assert {(x["record_id"], x["pos"]) for x in quality.accepted(r, s, lex).collect()} == {(1, 0), (5, 0), (9, 0), (10, 0)}


def test_speaking_rates(spark):
    t = spark.createDataFrame([(1, "a " * 300, "u"), (2, "a", "u"), (3, "a", "none")], "record_id int, text string, media_url string")
    m = spark.createDataFrame([("u", 120.0), ("zero", 0.0)], "media_url string, duration double")
    got = {r["record_id"]: (r["words_per_minute"], r["fits"]) for r in quality.speaking_rates(t, m).collect()}
    assert got == {1: (150.0, True), 2: (0.5, False)}


def test_unescape_keeps_nulls():
    assert text.unescape.func(pd.Series(["&lt;", None])).tolist()[0] == "<"

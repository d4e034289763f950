"""Consistent text forms and speaker turns: hand-made cases, agreement of both formulations, odd rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionloom.llm import forms
from sessionloom.llm.consistent_text import consistent
from sessionloom.llm.transcripts import speaker_turns, speech, stamp, turns

CASES = [
    ("ｆｕｌｌ", "full", "styled"), ("𝐛𝐨𝐥𝐝 𝟏", "bold 1", "styled"), ("conﬂicte", "conflicte", "styled"), ("paraŀlel", "paral·lel", "styled"), ("és", "és", "combining"), ("a​b", "ab", "invisible"),
    ("a﻿b", "ab", "invisible"), ("a b", "a b", "blank"), ("a\tb", "a b", "blank"), ("a　b", "a b", "blank"), ("cоsta", "costa", "lookalike"), ("metropοlità", "metropolità", "lookalike"), ("ｍеs", "mes", "lookalike"),
]
PLAIN = ["", "costa\nmar", "3ª, 2º, m², ½, …, 4 °C", "“però” — «sí» l’home", "co­marca", "Ελπίδα Спасибо", "12 μ de gruix", "5 μm, 3 kΩ", "π"]


def run(spark, texts, **kw):
    df = spark.createDataFrame([("s", k, 0, t, "x") for k, t in enumerate(texts)], "source_table string, row_id long, entry_no int, t string, clean_text string")
    return {r["row_id"]: r for r in consistent(df, **kw).collect()}


def test_cases_and_their_kinds(spark):
    got = run(spark, [c[0] for c in CASES])
    for k, (text, clean, kind) in enumerate(CASES):
        assert got[k]["clean_text"] == clean and got[k][kind], (text, got[k])
        assert forms.canonical(text) == clean


def test_plain_texts_stay(spark):
    got = run(spark, [*PLAIN, None])
    assert len(got) == len(PLAIN)
    for k, text in enumerate(PLAIN):
        assert got[k]["clean_text"] == text and not any(got[k][f] for f in ("styled", "combining", "invisible", "blank", "lookalike")), text
        assert forms.canonical(text) == text


def test_only_cases_and_empty_table(spark):
    texts = [c[0] for c in CASES] + PLAIN + ["x" * 200_000 + "ﬁ"]
    assert set(run(spark, texts, only_cases=True)) == {*range(len(CASES)), len(texts) - 1}
    assert run(spark, []) == {}


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcé ｗ𝐱ﬁо́​ οЖ", max_size=20))
def test_both_formulations_agree(text):
    import duckdb

    from sessionloom.llm.consistent_text import macros

    m = macros()
    con = duckdb.connect()
    clean = con.execute(f"SELECT {m['clean']} FROM (SELECT {m['nfc']} AS n FROM (SELECT ? AS t))", [text]).fetchone()[0]
    assert clean == forms.canonical(text)
    assert forms.canonical(clean) == clean


@pytest.mark.parametrize(("text", "seconds", "rest"), [
    ("[00:12:21] Hola", 741, "Hola"), ("00:13:13,458 --> 00:13:17,000 Ehm", 793.458, "Ehm"), ("13:49 - Gràcies", 829, "Gràcies"), ("(03:08) Bon", 188, "Bon"), ("[4m26s] Ah", 266, "Ah"), ("Hola 10:30", None, "Hola 10:30"), ("00:14:19", 859, ""),
])
def test_stamps(text, seconds, rest):
    assert stamp(text) == (seconds, rest)


@pytest.mark.parametrize(("text", "said"), [
    ("Eh… ehm.", ""), ("♪", ""), ("<i>(Rialles.)</i>", ""), ("*tus* Bon dia, eeeh, a tothom. {tall de so}", "Bon dia a tothom."), ("És evident… uh, que sí", "És evident… que sí"), ("hem vist el mar", "hem vist el mar"), ("[inaudible] [aplaudiments]", ""),
])
def test_speech(text, said):
    assert speech(text) == said


NAMES = ["Delfí Balvinet i Arpeliga", "Remei Balvinet i Arpeliga", "Octavi Bordraó i Merfoiga", "Anna Maria Llapelard i Tormunell"]


def test_labels_and_turns():
    entries = [
        ("EL PRESIDENT:", "Comencem.\nSR. BORDRAÓ: Gràcies. Cal dir-ho: sí."), (None, "I més coses."), ("Diversos", "(Aplaudiments.)"), ("Mesa", "[soroll de fons]"), ("Bordraó i Merfoiga, Octavi (Mixt)", "Acabo."),
        ("La vicepresidenta primera", "Té la paraula. — A. Llapelard i Tormunell: Bona tarda.\n>> SRA. BALVINET: Bon dia."), ("El conseller d’Interior (D. Balvinet i Arpeliga)", "Adeu."),
    ]
    got = turns(entries, NAMES)
    assert [s for s, _ in got] == ["mesa", NAMES[2], "mesa", NAMES[3], NAMES[1], NAMES[0]]
    assert got[1][1] == "Gràcies. Cal dir-ho: sí. I més coses. Acabo."


def test_order_by_stamps_only_if_all_have_one():
    late, early = ("Mesa", "[00:02:00] segon"), ("SR. BORDRAÓ", "01:00 - primer")
    assert [t for _, t in turns([late, early], NAMES)] == ["primer", "segon"]
    assert [t for _, t in turns([late, early, ("Mesa", "sense hora")], NAMES)] == ["segon", "primer", "sense hora"]


def test_odd_records(spark):
    schema = "record_id long, text array<struct<speaker:string,text:string>>, urls array<struct<names:array<string>,url:string>>, turn_no int"
    e = lambda s, t: {"speaker": s, "text": t}
    rows = [(1, None, None, 9), (2, [], [], 9), (3, [e(None, None), e(None, "parla ningú")], [{"names": None, "url": None}], 9), (4, [e("Algú Altre", "hola")], None, 9), (5, [e("mesa", "bon " * 50_000)], None, 9), (5, [e("mesa", "bon " * 50_000)], None, 9)]
    got = sorted((r["record_id"], r["turn_no"], r["speaker"], len(r["text"])) for r in speaker_turns(spark.createDataFrame(rows, schema)).collect())
    assert got == [(3, 1, None, 11), (4, 1, "Algú Altre", 4), (5, 1, "mesa", 199_999), (5, 1, "mesa", 199_999)]
    assert speaker_turns(spark.createDataFrame([], schema)).count() == 0

"""Runs, blocks, the chair, matching and alignment: hand-traced cases and properties."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionloom.operators import pairing, runs


def seq(spark, names, session="s"):
    return spark.createDataFrame([(session, k, n) for k, n in enumerate(names)], "session string, pos long, speaker string")


@pytest.mark.parametrize(("names", "want"), [
    ("mesa A mesa A mesa B B mesa C", [(0, 4, "A"), (4, 7, "B"), (7, 7, "C")]), ("A B", [(0, 0, "A"), (1, 1, "B")]), ("mesa mesa", []), ("A", [(0, 0, "A")]),
])
def test_blocks(spark, names, want):
    got = runs.blocks(seq(spark, names.split())).orderBy("block_no").collect()
    assert [(r["start"], r["end"], r["speaker"]) for r in got] == want


def test_full_last_block_and_contents(spark):
    s = seq(spark, ["A", "mesa", "B", "B"])
    b = runs.blocks(s, full_last=True)
    assert [(r["start"], r["end"]) for r in b.orderBy("block_no").collect()] == [(0, 1), (1, 3)]
    inside = runs.block_contents(b.drop("speaker"), s).orderBy("block_no", "pos").collect()
    assert [(r["block_no"], r["pos"]) for r in inside] == [(0, 0), (0, 1), (1, 1), (1, 2), (1, 3)]


@pytest.mark.parametrize(("names", "want"), [
    ("A B A B A", "A"), ("A B B C A", "A"), ("A B B A C C C A", "A"), ("A B B", "B"), ("A C C El.Parlament", "El.Parlament"), ("A C C B", "C"),
])
def test_chair(spark, names, want):
    assert [r["chair"] for r in runs.chair(seq(spark, names.split())).collect()] == [want]


def test_mode_takes_the_first_on_ties(spark):
    assert runs.most_frequent(seq(spark, ["B", "A", "A", "B", None]), ["session"], "speaker", "pos").first()["speaker"] == "B"


@pytest.mark.parametrize(("names", "want"), [(["mesa", "X"], "X"), (["X"], "X"), (["X", "Y"], "X"), (["mesa"], "mesa"), (["X", "mesa", "Y"], "X"), (["mesa", "mesa"], "mesa")])
def test_one_speaker(spark, names, want):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(names,)], "n array<string>").select(runs.one_speaker(F.col("n"))).first()[0] == want


def test_empty_sequences(spark):
    s = seq(spark, [])
    assert runs.blocks(s).count() == 0 and runs.chair(s).count() == 0 and runs.runs(s).count() == 0


def test_global_alignment_goldens():
    g = pairing.GAP_INDEX
    assert pairing.global_alignment([0, 1, 2], [0, 2]) == ([(0, 0), (1, g), (2, 2)], 15)
    assert pairing.global_alignment([], [7]) == ([(g, 7)], -5) and pairing.global_alignment([], []) == ([], 0)


def brute(a, b):
    if not a or not b:
        return -5 * (len(a) + len(b))
    return max(brute(a[1:], b[1:]) + (10 if a[0] == b[0] else -5), brute(a[1:], b) - 5, brute(a, b[1:]) - 5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=6), st.lists(st.integers(0, 3), max_size=6))
def test_global_alignment_properties(a, b):
    pairs, score = pairing.global_alignment(a, b)
    g = pairing.GAP_INDEX
    assert [x for x, _ in pairs if x != g] == a and [y for _, y in pairs if y != g] == b and (g, g) not in pairs
    assert score == sum(10 if x == y else -5 for x, y in pairs) == brute(a, b) == pairing.global_alignment(b, a)[1]
    local, best = pairing.local_alignment(a, b)
    assert best == sum(10 if x == y else -5 for x, y in local) and best >= max(0, score)
    assert best == max([0, *(brute(a[i:j], b[k:m]) for i in range(len(a)) for j in range(i + 1, len(a) + 1) for k in range(len(b)) for m in range(k + 1, len(b) + 1))])


def test_matching_stages(spark):
    text = seq(spark, ["mesa", "Pere Pi i Mas", "La consellera de Salut", "Desconegut Total"])
    meta = seq(spark, ["mesa", "Pi i Mas, Pere", "Anna Vila i Roca"])
    alias = spark.createDataFrame([("s", "la consellera de salut i afers", "Pere Pi i Mas")], "session string, alias string, name string")
    got = {(r["text_name"], r["meta_name"]) for r in pairing.match_names(text, meta, alias).collect()}
    assert got == {("mesa", "mesa"), ("Pere Pi i Mas", "Pi i Mas, Pere"), ("La consellera de Salut", "Pi i Mas, Pere")}
    matched = spark.createDataFrame([("s", *p) for p in got], "session string, text_name string, meta_name string")
    index = pairing.speaker_index(text, meta, matched).orderBy("idx").collect()
    assert index[0]["text_name"] == "mesa" and [r["idx"] for r in index] == list(range(5)) and index[-1]["text_name"] is None


def test_alignment_to_pairs(spark):
    text, meta = seq(spark, "A B C D A".split()), seq(spark, "A B D A".split())
    index = spark.createDataFrame([("s", n, n, k) for k, n in enumerate("ABCD")], "session string, text_name string, meta_name string, idx long")
    tb, mb = runs.blocks(text), runs.blocks(meta)
    code = lambda b, side: pairing.encoded(b, index, side).selectExpr("session", "block_no as pos", "idx")
    aligned = pairing.align(code(tb, "text_name"), code(mb, "meta_name"))
    rows = pairing.decoded(aligned, tb, mb).orderBy("row_no").collect()
    assert [(r["left"] and r["left"]["speaker"], r["right"] and r["right"]["speaker"]) for r in rows] == [("A", "A"), ("B", "B"), ("C", None), ("D", "D"), ("A", "A")]
    quality = pairing.alignment_summary(aligned).first()
    assert (quality["length"], quality["matches"], quality["identity"]) == (5, 4, 80.0)
    matched = spark.createDataFrame([("s", n, n) for n in "ABD"], "session string, text_name string, meta_name string")
    assert pairing.good_pairs(pairing.decoded(aligned, tb, mb), matched).count() == 0
    whole = pairing.side_by_side(tb, tb)
    good = pairing.good_pairs(whole, matched).orderBy("row_no").collect()
    assert [r["row_no"] for r in good] == [1, 2, 3]  # C is no matched name, but the names are alike


def test_results_do_not_depend_on_row_order(spark):
    names = [random.Random(5).choice(["A", "B", "mesa"]) for _ in range(60)]
    s = seq(spark, names)
    assert sorted(map(tuple, runs.blocks(s).collect())) == sorted(map(tuple, runs.blocks(s.orderBy("speaker").repartition(3)).collect()))


def test_sessions_by_code_then_date(spark):
    texts = spark.createDataFrame([("2018_03_14_1",), ("2018_03_15_2",), ("2018_03_16_3",), (None,)], "ple_code string")
    sessions = spark.createDataFrame([("a", "2018_03_14_1", "14/03/2018"), ("b", None, "15/03/2018"), ("c", "x", "15/03/2018"), ("d", None, None)], "session_id string, ple_code string, date string")
    got = sorted(map(tuple, pairing.by_code_or_date(texts, sessions).collect()))
    assert got == [("2018_03_14_1", "a", "code"), ("2018_03_15_2", "b", "date"), ("2018_03_15_2", "c", "date")]

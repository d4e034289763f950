"""Documents found again in their own words: nothing is moved, and results are those of rows and of brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import trimming
from sessionloom.plans import record_queries


def longest(words, sought, least):
    for n in range(5, least - 1, -1):
        for at in range(5 - n + 1):
            run = sought[at : at + n]
            if len(run) == n and (places := [k for k in range(len(words)) if words[k : k + n] == run]):
                return places[0], at, n
    return None


def found(w):
    heard = [x for x in w[1:-1] if x != "<sil>"]
    at = [k for k in range(1, len(w) - 1) if w[k] != "<sil>"]
    b, e = longest(heard, w[:5], 3), longest(heard[::-1], w[: -5 - 1 : -1], 3)
    start, end = b and float(at[b[0]]), e and round(at[::-1][e[0]] + 0.7, 3)
    return start, end, len(w) - e[1] - b[1] if b and e else None


def test_word_edges_of_odd_documents_without_moving_a_word(spark, tmp_path):
    rnd = random.Random(3)
    texts = [None, "", " ".join("abcdefghijk"), "A, b. " * 6, " ".join(f"w{k}" for k in range(20)), "a <sil> b c <sil> d e f " * 3, "x " * 12, "a b\tc d e\nf g h i j k l!"]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(12, 40))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = record_queries.word_edges(spark, str(tmp_path))
    got = {r["doc_id"]: (r["start"], r["end"], r["n_words"]) for r in df.collect()}
    words = {k: t.lower().translate({ord(c): None for c in ".,;:?!"}).split() for k, t in enumerate(texts) if t}
    want = {k: found(w) for k, w in words.items() if len(w) >= 12}
    assert want[4] == (1.0, 18.7, 18) and {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert {k: v[2] for k, v in got.items() if want[k][2] is not None} == {k: v[2] for k, v in want.items() if v[2] is not None}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_edges_of_rows_and_of_arrays_are_the_same(spark):
    rnd = random.Random(5)
    some = lambda n, top: [rnd.choice(["a", "b", "b", "c", "<sil>"][:top]) for _ in range(n)]
    texts = spark.createDataFrame([(k, some(rnd.randint(0, 12), 4), rnd.choice([50.0, 300.0])) for k in range(40)], "key int, words array<string>, duration double")
    rows = [(k, side, i, float(i), i + rnd.choice([0.0, 0.5]), w) for k in range(0, 40, 2) for side in ("begin", "end") for i, w in enumerate(some(90, 5))]
    rnd.shuffle(rows)
    heard = spark.createDataFrame(rows, "key int, side string, pos int, start double, end double, word string")
    lists = {s: {k: [x[2:] for x in sorted(rows, key=lambda x: x[2]) if x[0] == k and x[1] == s] for k in range(0, 40, 2)} for s in ("begin", "end")}
    arrays = spark.createDataFrame([(k, b, lists["end"][k]) for k, b in lists["begin"].items()], ", ".join(["key int", *(f"{s} array<struct<pos:int,start:double,end:double,word:string>>" for s in ("begin", "end"))]))
    within = texts.join(arrays.withColumns({s: F.filter(s, trimming.is_word) for s in ("begin", "end")}), "key", "left")
    columns = ("key", "start", "end", "first_word", "last_word")
    for compat in (False, True):
        by_rows = sorted(tuple(r) for r in trimming.edges(texts, heard, compat).fillna(-1).collect())
        assert by_rows == sorted(tuple(r) for r in trimming.edges_within(within, compat).select(*columns).fillna(-1).collect())
        assert any(r[1] >= 0 for r in by_rows)
    assert "Broadcast" not in trimming.edges(texts, heard)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("compat", [False, True])
def test_longest_match_is_that_of_all_places(spark, compat):
    rnd = random.Random(7)
    cases = [([rnd.choice("abc") for _ in range(rnd.randint(0, 25))], [rnd.choice("abcd") for _ in range(rnd.randint(0, 7))]) for _ in range(150)] + [(None, list("abc")), (list("abc"), None)]
    df = spark.createDataFrame(cases, "w array<string>, s array<string>")
    got = [r["m"] and tuple(r["m"]) for r in df.select(trimming.longest_match(F.col("w"), F.col("s"), compat=compat).alias("m")).collect()]
    assert got == [longest(w, s[:5], 4 if compat else 3) if w and s else None for w, s in cases]

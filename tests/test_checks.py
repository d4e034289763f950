"""Orphan references and interval coverage: hand-made cases, brute force, skew, empty tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sessionloom.functions.keys import clock_seconds, page_key, session_code, url_key
from sessionloom.operators import intervals, orphan_refs

T0 = datetime(2020, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [1, 3, 10**6])
def test_orphans_match_brute_force(spark, hot_rows):
    rnd = random.Random(3)
    parents = [("f", rnd.choice("abc"), T0 + timedelta(hours=a), None if rnd.random() < 0.3 else T0 + timedelta(hours=a + rnd.randint(-1, 9))) for a in (rnd.randint(0, 40) for _ in range(15))]
    refs = [("f", rnd.choice(["a", "a", "a", "b", "c", "d", None]), T0 + timedelta(hours=rnd.randint(0, 50)), i, "x") for i in range(120)]
    p = spark.createDataFrame(parents, "ref_field string, ref_key string, registered_at timestamp_ntz, deleted_at timestamp_ntz")
    r = spark.createDataFrame(refs, "ref_field string, ref_key string, used_at timestamp_ntz, id int, live_from string")
    want = sorted(i for f, k, t, i, _ in refs if k is not None and not any(k == q and a <= t and (b is None or b > t) for _, q, a, b in parents))
    assert sorted(x["id"] for x in orphan_refs.orphan_rows(r, p, hot_rows).collect()) == want
    report = orphan_refs.orphan_report(r, p, hot_rows).collect()
    assert sum(x["n_orphans"] for x in report) == len(want) and sum(x["n_refs"] for x in report) == sum(k is not None for _, k, *_ in refs)


def test_orphans_without_parents_or_references(spark):
    p = spark.createDataFrame([], "ref_field string, ref_key string, registered_at timestamp_ntz, deleted_at timestamp_ntz")
    r = spark.createDataFrame([("f", "a", T0, 1), ("f", None, T0, 2)], "ref_field string, ref_key string, used_at timestamp_ntz, id int")
    assert [x["id"] for x in orphan_refs.orphan_rows(r, p).collect()] == [1]
    assert orphan_refs.orphan_rows(r.limit(0), p).count() == 0
    assert orphan_refs.orphan_report(r.limit(0), p).count() == 0


def sweep(iv):
    out, reach = [], None
    for s, e in sorted(iv):
        if reach is not None and s > reach:
            out.append((reach, s))
        reach = e if reach is None else max(reach, e)
    return out


@pytest.mark.parametrize("block", [1, 7, 900])
def test_gaps_and_periods_match_a_sweep(spark, block):
    rnd = random.Random(block)
    data = {k: [(s, s + rnd.randint(0, 12)) for s in (rnd.randint(0, 200) for _ in range(n))] for k, n in (("hot", 60), ("b", 9), ("c", 1))}
    flat = [(k, s, e) for k, iv in data.items() for s, e in iv] + [("hot", *data["hot"][0])] * 3 + [("b", 50, 40), (None, 1, 2), ("c", None, 5)]
    df = spark.createDataFrame(flat, "entity string, start_s int, end_s int")
    assert rows(intervals.gaps(df, block)) == sorted((k, a, b) for k, iv in data.items() for a, b in sweep(iv))
    periods = rows(intervals.periods(df, block))
    assert sum(p[3] for p in periods) == sum(len(iv) for iv in data.values()) + 3
    for k, iv in data.items():
        mine = [p[1:3] for p in periods if p[0] == k]
        assert [(a[1], b[0]) for a, b in zip(mine, mine[1:])] == sweep(iv)
        assert mine[0][0] == min(s for s, _ in iv) and mine[-1][1] == max(e for _, e in iv)


def test_intervals_of_an_empty_table(spark):
    df = spark.createDataFrame([], "entity string, start_s int, end_s int")
    assert intervals.gaps(df).count() == 0 and intervals.periods(df).count() == 0


def test_canonical_keys(spark):
    df = spark.createDataFrame(
        [(" 2006-01-18-0598 ", "018 ", " HTTP://X.test/A.mp3/", "18h 21m 01s"), ("2006/01/22/148", "7", "https://x.test/a.mp3", "20.02.12"), (None, None, None, " 05:59:59 "), ("volum", "", "", "24:10"), ("2006_01_22_148", "0", "x", "n/d")],
        "c string, p string, u string, t string",
    )
    got = [tuple(r) for r in df.select(session_code(F.col("c")), page_key(F.col("p")), url_key(F.col("u")), clock_seconds(F.col("t"))).collect()]
    assert got == [
        ("2006_01_18_598", "18", "x.test/a.mp3", 66061), ("2006_01_22_148", "7", "x.test/a.mp3", 72132), (None, None, None, 5 * 3600 + 59 * 60 + 59 + 86400),
        (None, None, None, 24 * 3600 + 600), ("2006_01_22_148", "0", "x", None),
    ]

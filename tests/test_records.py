"""Name scores in the join, alignment against the plain table, manifests, downloads, nested sessions, the shared folder."""

import random
import types

import pytest

from sessionloom import tables
from sessionloom.functions.fuzzy import similar_pairs, token_set_similarity, with_tokens
from sessionloom.operators import pairing, quality, sessions
from sessionloom.sinks import tables as sinks


@pytest.mark.parametrize("over", [60, 80, 90])
def test_scores_of_the_join_are_those_of_all_pairs(spark, over):
    rnd = random.Random(over)
    parts = ["pere", "pi", "i", "mas", "anna", "roc", "roca", "vila", "maria", "teresa", "mària", "joan-pau", "d'ors"]
    names = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(60)] + ["", "...", "Pere  PI", "pero pi i mos"]
    df = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    df = with_tokens(with_tokens(df, "a", "x"), "b", "y")
    got = {(r["a"], r["b"]): r["score"] for r in similar_pairs(df, "x", "y", over).collect()}
    assert got == {(a, b): s for a in names for b in names if (s := token_set_similarity(a, b, over)) > over}


def plain(a, b, local):
    """Both alignments by the whole table."""
    m, n = len(a), len(b)
    s = [[0 if local else -5 * (i + j) if not i or not j else 0 for j in range(n + 1)] for i in range(m + 1)]
    best, at = 0, (0, 0)
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            s[i][j] = max(s[i - 1][j - 1] + (10 if a[i - 1] == b[j - 1] else -5), s[i - 1][j] - 5, s[i][j - 1] - 5, *([0] if local else []))
            if s[i][j] >= best:
                best, at = s[i][j], (i, j)
    i, j, out = *(at if local else (m, n)), []
    while i and j and (not local or s[i][j] > 0):
        if s[i][j] == s[i - 1][j - 1] + (10 if a[i - 1] == b[j - 1] else -5):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif s[i][j] == s[i - 1][j] - 5:
            i -= 1
            out.append((a[i], -1))
        else:
            j -= 1
            out.append((-1, b[j]))
    if not local:
        out += [(v, -1) for v in reversed(a[:i])] + [(-1, v) for v in reversed(b[:j])]
    return out[::-1], best if local else s[m][n]


def test_alignments_match_the_plain_table():
    rnd = random.Random(1)
    for _ in range(150):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(0, 15))] for _ in range(2))
        assert pairing.global_alignment(a, b) == plain(a, b, False)
        assert pairing.local_alignment(a, b) == plain(a, b, True)


def test_manifest(spark):
    turn = {"speaker": "A", "text": "a " * 50}
    r = spark.createDataFrame([("s", "t/01.yaml", [turn], "h/ab1.mp3"), ("s", "t/02.yaml", [turn] * 3, "h/ab1.mp3"), ("s", "t/03.yaml", [turn] * 3, "h/ab1.mp3"), ("s", "t/04.yaml", [turn, turn], "h/ab1.mp3"), ("s", "t/05.yaml", [turn], "h/none.mp3"), ("s", "t/06.yaml", None, "h/ab1.mp3")], "session string, filepath string, text array<struct<speaker:string,text:string>>, media_url string")
    media = spark.createDataFrame([("h/ab1.mp3", 30.0), ("h/none.mp3", None)], "media_url string, duration double")
    done = spark.createDataFrame([("for_axlotl/s/s-03-ab1.txt",)], "text_path string")
    got = {x["text_path"]: (x["audio_path"], x["words_per_minute"], x["done"]) for x in quality.manifest(r, media, done).collect()}
    assert got == {"for_axlotl/s/s-01-ab1.txt": ("audio/a/b/ab1.mp3", 100.0, False), "for_axlotl/s/s-03-ab1.txt": ("audio/a/b/ab1.mp3", 300.0, True)}


def test_downloads_follow_one_redirect(spark, tmp_path):
    pages = {"http://a": (200, "http://a"), "http://b": (302, "http://a"), "http://c": (302, "/login"), "http://d": (302, "http://b"), "http://e": (404, "http://e")}
    wanted = spark.createDataFrame([(u, f"{tmp_path}/{u[-1]}.mp3") for u in pages] + [("http://a", f"{tmp_path}/a.wav"), (None, "x")], "url string, target string")
    got = {(r["url"], r["target"][-3:]): (r["size"], r["error"]) for r in sinks.downloaded(wanted, fetch=lambda u: u.encode(), status=lambda u: pages[u], wait_s=0.0).collect()}
    assert got == {("http://a", "mp3"): (8, None), ("http://b", "mp3"): (8, None), ("http://c", "mp3"): (None, "status 401"), ("http://d", "mp3"): (None, "status 302"), ("http://e", "mp3"): (None, "status 404"), ("http://a", "wav"): (None, "not a .mp3 file")}
    assert (tmp_path / "b.mp3").read_text() == "http://a"


def test_nested_sessions(spark):
    s = spark.createDataFrame([("x", "X"), ("y", "Y")], "_id string, name string")
    i = spark.createDataFrame([("x", 2, "b", 1), ("x", 1, "a", 1), (None, 1, "c", 1)], "session_id string, pos int, media_url string, name int")
    assert {r["_id"]: [v["media_url"] for v in r["interventions"]] for r in sessions.with_interventions(s, i, "media_url").collect()} == {"x": ["a", "b"], "y": []}


def test_a_cluster_must_name_its_shared_folder():
    def session(master, named=None):
        conf = types.SimpleNamespace(get=lambda k, d=None: named, set=lambda k, v: None)
        return types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master, getConf=lambda: conf))

    assert tables.shared_dir(session("spark://h:7077", "hdfs://x")) == "hdfs://x" and tables.shared_dir(session("local[4]")).startswith("file:")
    for master in ("spark://h:7077", "local-cluster[3,2,1024]", "yarn"):
        with pytest.raises(ValueError):
            tables.shared_dir(session(master))

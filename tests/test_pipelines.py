"""The composed pipeline, and the selection of sessions and records."""

from pyspark.sql import functions as F

from sessionloom.operators import sessions
from sessionloom.plans import pipelines


def test_selection(spark):
    s = spark.createDataFrame([("a", "Ple ordinari"), ("b", "Sessió de Constitució"), ("c", "La sessió constitutiva"), ("d", None)], "id string, name string")
    assert sorted(r["id"] for r in sessions.plenary(s).collect()) == ["a", "d"] and sessions.plenary(s, False).count() == 4
    r = spark.createDataFrame([("f1", ["x"], [{"url": "u"}]), ("f2", ["x", "y"], None), ("f3", ["x"], [])], "filepath string, text array<string>, urls array<struct<url:string>>")
    assert [tuple(x)[::2] for x in sessions.to_download(r).collect()] == [("f1", "u")]
    keyed = r.withColumnRenamed("filepath", "key")
    found = spark.createDataFrame([("f1", 0.0, 9.0), ("f2", 1.0, 2.0), ("f3", None, 2.0)], "key string, start double, end double")
    assert [x["key"] for x in sessions.croppable(keyed, found, found.limit(0)).collect()] == ["f1"]
    assert sessions.croppable(keyed, found, found).count() == 0


def test_transcript_from_xml(spark):
    def page(p):
        line = lambda top, left, text, font=1, height=17: f'<text top="{top}" left="{left}" width="100" height="{height}" font="{font}">{text}</text>'
        body = [line(40, 85, "DIARI", 9, 14), line(1230, 85, f"ISSN {1}", 9, 14)] if p > 1 else []
        for left in (85, 460):
            body += [line(100, left, f"<b>Nom {left}</b>", 2)] + [line(120 + 20 * k, left + 17 * (k % 2), f"t{p}.{k} ") for k in range(6)]
        return f'<page width="892" height="1262">{"".join(body)}</page>'

    docs = spark.createDataFrame([("d", "<pdf>" + "".join(map(page, range(8))) + "</pdf>")], "doc string, xml string")
    t = pipelines.transcript(docs)
    assert t.deleted.count() == 0 and t.kept.count() == 8 * 14
    got = t.speeches.orderBy("seq").collect()
    assert len(got) == 16 and got[4]["text"] == "".join(f"t2.{k} " for k in range(6))


def test_alignment_of_two_sequences(spark):
    text = "El president;Pere Pi;El president;Anna Roc;El president;Joan Mas;El president;Pere Pi;El president"
    meta = "Mesa|x;Pi, Pere;Mesa|x;Roc, Anna;Mesa|x;Mas, Joan;Mesa|x;Pi, Pere;Mesa|x"
    side = lambda names: spark.createDataFrame([("s", k, n) for k, n in enumerate(names.split(";"))], "session string, pos long, speaker string")
    got = pipelines.alignment(side(text), side(meta)).orderBy("row_no").collect()
    assert [(r["left"]["speaker"], r["right"]["speaker"]) for r in got] == [("Anna Roc", "Roc, Anna"), ("Joan Mas", "Mas, Joan")]
    assert pipelines.alignment(side(text).limit(0), side(meta).limit(0)).count() == 0


def test_records_of_two_sequences(spark):
    text = "El president;Pere Pi;El president;Anna Roc;El president;Joan Mas;El president;Pere Pi;El president".split(";")
    meta = "Mesa|x;Pi, Pere;Mesa|x;Roc, Anna;Mesa|x;Mas, Joan;Mesa|x;Pi, Pere;Mesa|x".split(";")
    t = spark.createDataFrame([("s", k, n, f"t{k}") for k, n in enumerate(text)], "session string, pos long, speaker string, text string")
    m = spark.createDataFrame([("s", k, n, [n], f"u{k}") for k, n in enumerate(meta)], "session string, pos long, speaker string, names array<string>, url string")
    got = pipelines.records(t, m).orderBy("file_no").collect()
    assert [(r["file_no"], [x["text"] for x in r["text"]], [u["url"] for u in r["urls"]]) for r in got] == [("01", ["t2", "t3", "t4"], ["u2", "u3", "u4"]), ("02", ["t4", "t5", "t6"], ["u4", "u5", "u6"])]
    few = lambda df: df.where("pos < 4")
    assert pipelines.records(few(t), few(m)).count() == 0  # the first and the last pair are never trusted


def test_trimming_of_records(spark):
    words = [f"w{k}" for k in range(20)]
    turn = lambda n: [{"speaker": "A", "text": " ".join(words)}] * n
    texts = spark.createDataFrame([("a", turn(1), 90.0), ("two", turn(2), 90.0), ("silent", turn(1), None), ("old", turn(1), 90.0)], "key string, text array<struct<speaker:string,text:string>>, duration double")
    heard = spark.createDataFrame([(k, side, i, float(i), i + 0.5, w) for k in ("a", "two", "silent", "old") for side in ("begin", "end") for i, w in enumerate(words)], "key string, side string, pos int, start double, end double, word string")
    got = pipelines.trimmed(texts, heard, texts.where("key = 'old'")).collect()
    assert [(r["key"], r["start"], r["end"], r["text"]) for r in got] == [("a", 0.0, 19.7, " ".join(words))]


def test_corpus(spark):
    turn = {"speaker": "A", "text": "Bon dia (Aplaudiments.) a tothom. " * 60}
    r = spark.createDataFrame([(1, "s", [turn], [{"names": ["A"], "url": "u"}])], "record_id int, session string, text array<struct<speaker:string,text:string>>, urls array<struct<names:array<string>,url:string>>")
    s = spark.createDataFrame([("s", "C")], "session string, chair string")
    lex = spark.createDataFrame([(w,) for w in "bon dia a tothom aplaudiments".split()], "word string")
    media = spark.createDataFrame([("u", 96.0)], "media_url string, duration double")
    turns, rates = pipelines.corpus(r, s, lex, media)
    assert turns.first()["text"].startswith("Bon dia a tothom. Bon dia") and rates.select(F.col("fits")).first()[0]


def test_catalogue(spark):
    index = spark.createDataFrame([("i", '<ul class="llista_videos"><li><div><h2><a href="/s">S</a></h2><p>Data: 14/03/2018</p></div></li></ul>')], "url string, html string")
    act = spark.createDataFrame([("p", '<ul class="llista_videos"><li><p>14/03/2018</p><p>Diari <a href="/x/9.pdf#page=2">d</a></p></li></ul>')], "url string, html string")
    acts = spark.createDataFrame([("/s", 0, "p")], "session_url string, pos int, page_url string")
    sessions_found, interventions = pipelines.catalogue(index, act, acts)
    assert sessions_found.first()["ple_code"] == "2018_03_14_9" and interventions.first()["page_reference"] == "2"

"""Parsers over fixtures in the sources' own markup, sinks, and the stream of landed pages."""

from datetime import datetime
from pathlib import Path

from sessionloom.sinks import tables as sinks
from sessionloom.sources import files, html
from sessionloom.streaming import landing

CATALOGUE = """<ul class="llista_videos"><li><div><h2><a href="/s/1">Sessió 1</a></h2><p>Data: 14/03/2018</p><p>Durada: 4:15:00</p><p>sense res</p></div></li>
<li><div><h2><a href="/s/2">Sessió &amp; 2</a></h2><p>Altres: x</p></div></li></ul>"""
ACT = """<ul class="llista_videos"><li><p>Sessió del 14/03/2018</p><p>Intervinent: <a href="/d/1">Pere Pi</a></p><p><a href="/x/123.pdf#page=7">Diari</a></p><p>De 10:00:00 a 10:05:00 - Durada 5 m</p>
<p class="titol_pod"><a href="/t/1">Títol</a></p><p>Cal Javascript</p><ul><li class="video"><a href="/v.mp4">v</a></li><li class="audio"><a href="/a.mp3">a</a></li></ul></li>
<li>buit</li>
<li><p>Intervinent: Anna</p><p>Intervinent: Joan</p><p>Diari <a href="/x/nopage.pdf">d</a></p><p class="mes_videos"><a class="titol_pod" id="lnkbox1">més</a></p><div id="box1"><ul><li><a href="/t/2">Un</a></li><li>Dos</li></ul></div>
<ul><li class="video"><a href="/v2.mp4">v</a></li></ul></li></ul>"""
DIARY = """<table><tr><th class="col_document_s icona"><a href=" /pdf/12.pdf ">PDF</a></th><td class="col_descripcio"> DSPC 12 </td><td class="col_data">14/03/2018</td></tr>
<tr><th class="col_document_s icona"><a href="/pdf/13.pdf">PDF</a></th><td class="col_data">15/03/2018</td></tr></table>"""


def pages(spark, *content):
    return spark.createDataFrame([(f"u{k}", c) for k, c in enumerate(content)], "url string, html string")


def test_catalogue(spark):
    got = [tuple(r) for r in html.catalogue(pages(spark, CATALOGUE, "<p>res</p>", None)).collect()]
    assert got == [("u0", "/s/1", "Sessió 1", "14/03/2018", "4:15:00"), ("u0", "/s/2", "Sessió & 2", None, None)]


def test_interventions(spark):
    a, b = html.interventions(pages(spark, ACT, "")).orderBy("pos").collect()
    assert (a["intervinent"], a["intervinen_urls"], a["ple_code"], a["page_reference"], a["title"], a["title_url"]) == (["Pere Pi"], [["/d/1"]], "2018_03_14_123", "7", ["Títol"], ["/t/1"])
    assert (a["start"], a["end"], a["media_url"], a["error"]) == ("10:00:00", "10:05:00", "/a.mp3", None)
    assert (b["intervinent"], b["ple_code"], b["title"], b["title_url"], b["start"], b["media_url"]) == (["Anna", "Joan"], None, ["Un", "Dos"], ["/t/2", None], None, "/v2.mp4")
    assert "nopage" in b["error"]
    acts = spark.createDataFrame([("s", 0, "u9"), ("s", 1, "u0")], "session_url string, pos int, page_url string")
    assert [tuple(r) for r in html.session_code(html.interventions(pages(spark, ACT)), acts).collect()] == [("s", "2018_03_14_123")]


def test_links_and_diary(spark):
    links = '<ul class="pagina_llistat"><li><a href="/1">a</a></li><li><a href="/2">b</a></li></ul>'
    assert [tuple(r) for r in html.act_links(pages(spark, links)).collect()] == [("u0", 0, "/1"), ("u0", 1, "/2")]
    got = [tuple(r) for r in html.diary_index(pages(spark, DIARY)).collect()]
    assert got == [("u0", "14/03/2018", "DSPC 12", "/pdf/12.pdf", None), ("u0", "15/03/2018", None, "/pdf/13.pdf", "incomplete row")]
    assert [r["url"] for r in html.page_urls(spark, "http://h/x", 2).collect()] == ["http://h/x?p_cp20=1", "http://h/x?p_cp20=2"]


def test_page_xml_keeps_markup_and_order(spark):
    xml = '<pdf><page number="1" height="1262" width="892"><text top="1" left="2" width="3" height="4" font="0">Comença la <i>sessió</i>. </text><text top="9" left="2"/>\n<text top="5" left="2" font="1">a &amp; b</text></page><page height="x" width="892"/><page width="1" height="2.5"></page></pdf>'
    docs = spark.createDataFrame([("d", xml), ("n", None)], "doc string, xml string")
    got = [(r["page"], r["line_no"], r["top"], r["height"], r["text"]) for r in files.page_lines(docs).collect()]
    assert got == [(0, 0, "1", "4", "Comença la <i>sessió</i>. "), (0, 1, "9", None, ""), (0, 2, "5", None, "a & b")]
    assert files.page_sizes(docs).count() == 2


def test_yaml_records_and_trees(spark):
    record = "ple_code: 2018_03_14_1\ntext:\n- !!python/tuple [Anna, bon dia]\nurls:\n- !!python/tuple\n  - [Anna]\n  - http://a\n"
    evil = "!!python/object/apply:os.system ['true']"
    got = files.session_records(spark.createDataFrame([("a", record), ("b", evil), ("c", "text: 5")], "path string, content string")).orderBy("path").collect()
    assert (got[0]["ple_code"], got[0]["text"][0]["text"], got[0]["urls"][0]["names"], got[0]["error"]) == ("2018_03_14_1", "bon dia", ["Anna"], None)
    assert got[1]["error"].startswith("ConstructorError") and got[2]["error"]
    tree = files.speaker_trees(spark.createDataFrame([("t", "- A: u\n- B: v\n- A: w\n")], "path string, content string"))
    assert [tuple(r)[1:] for r in tree.collect()] == [(0, "A", "u"), (1, "B", "v"), (2, "A", "w")]


def test_yaml_records_with_nulls_and_values_of_other_kinds(spark):
    rows = [("a", '{"ple_code":null,"text":[["A",null]],"urls":[[["A",null],null],[null,"u"]]}'), ("b", '{"ple_code":"c","text":null}'), ("c", "urls: [[[A], [u]]]"), ("d", "urls: [[A, u]]"), ("e", "ple_code: [c]")]
    got = files.session_records(spark.createDataFrame(rows, "path string, content string")).orderBy("path").collect()
    assert [tuple(u) for u in got[0]["urls"]] == [(["A", None], None), (None, "u")] and tuple(got[0]["text"][0]) == ("A", None) and got[0]["error"] is None
    assert tuple(got[1])[1:] == ("c", None, None, None)
    assert all(r["error"].startswith("TypeError") and r["urls"] is None for r in got[2:])


def test_yaml_records_query_keeps_every_value(spark, tmp_path):
    """A URL and lists that are null, quotes and brackets in a URL, characters that YAML would fold or reject, a record loaded twice."""
    from sessionloom.plans.record_queries import yaml_records

    odd = "a\x85b\u2028c\x7f\ufeff \"],\"text\" \\ \t\n😀 null ~"
    rows = [(1, "c", [("A", odd), ("B", None), None], [(["A"], None), (None, 'u"]]'), None]), (2, None, None, None), (3, '"],"text"', [], []), (4, None, [("A", "x")], None), (4, "c", [("A", "x")], None)]
    df = spark.createDataFrame(rows, "record_id bigint, ple_code string, text array<struct<speaker:string,text:string>>, urls array<struct<names:array<string>,url:string>>")
    df.write.parquet(str(tmp_path / "session_texts.parquet"))
    got = {tuple(r) for r in yaml_records(spark, str(tmp_path)).collect()}
    assert got == {(1, "c", 3, odd + "\n\n", 3, None), (2, None, None, None, 0, None), (3, '"],"text"', 0, "", 0, None), (4, "c", 1, "x", 0, None)}


def test_file_scans(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "2018_03_14_7_speaker.yaml").write_text("- A: b\n")
    (tmp_path / "dict.txt").write_text("casa K AA Z AH\nsol\npa P A\n")
    (tmp_path / "conv.csv").write_text("#xsamba,ipa,espeak,cmu\n@,ə,ə,EA\n,,ɐ,AE\n")
    got = files.whole_files(spark, str(tmp_path), "*.yaml").collect()
    assert [(r["name"], r["code"], r["content"]) for r in got] == [("2018_03_14_7_speaker.yaml", "2018_03_14_7", "- A: b")]
    assert dict(map(tuple, files.pronunciation_dictionary(spark, str(tmp_path / "dict.txt")).collect())) == {"casa": "K AA Z AH", "pa": "P A"}
    assert [tuple(r) for r in files.phoneme_conversion(spark, str(tmp_path / "conv.csv")).collect()] == [("@", "ə", "ə", "EA"), (None, None, "ɐ", "AE")]
    names = files.listing(spark, str(tmp_path), "*.txt")
    assert [r["name"] for r in names.collect()] == ["dict.txt"]
    wanted = spark.createDataFrame([("dict.txt",), ("other.txt",)], "name string")
    assert [r["name"] for r in files.not_done(wanted, names, "name").collect()] == ["other.txt"]
    assert files.lexicon(spark, str(tmp_path / "dict.txt")).count() == 3 and files.text_lines(spark, str(tmp_path / "dict.txt")).count() == 3


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "c"), ("", "d"), (None, "e")], "url string, name string")
    for _ in range(2):
        sinks.insert_if_absent(rows, str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t")).orderBy("url").collect()
    assert [(r["url"], r["name"]) for r in got] == [("u1", "a"), ("u2", "c")]


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a b", "/x/1.txt", '/a/"1".mp3')], "text string, text_path string, audio_path string")
    sinks.manifest(df, str(tmp_path / "m"))
    sinks.sentences_file(df, str(tmp_path / "s"))
    read = lambda d: "".join(p.read_text() for p in Path(tmp_path / d).glob("part-*"))
    assert read("m") == '/x/1.txt,/a/"1".mp3\n' and read("s") == "a b\n"
    records = spark.createDataFrame([("c1", 5, "x"), ("c1", 9, "y"), ("c2", 1, "z")], "ple_code string, pair_no int, t string")
    numbered = sinks.numbered_records(records)
    assert sorted((r["ple_code"], r["file_no"]) for r in numbered.collect()) == [("c1", "01"), ("c1", "02"), ("c2", "01")]
    sinks.write_partitioned(numbered, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3 and (tmp_path / "p" / "ple_code=c2").exists()


def test_manifest_lines_of_records_without_audio_and_of_odd_paths(spark, tmp_path):
    from sessionloom.plans.record_queries import manifest_file

    df = spark.createDataFrame([(" a,b", "c "), ("a", None), (None, "b")], "text_path string, audio_path string")
    sinks.manifest(df, str(tmp_path / "m"))
    assert "".join(p.read_text() for p in (tmp_path / "m").glob("part-*")) == " a,b,c \n"
    rows = [(1, "s", "t/1.yaml", ["h/ab.mp3"]), (2, "s", "t/2.yaml", [None, "h/x.mp3"]), (3, "s", "t/3.yaml", [None]), (4, None, "t/4.yaml", ["h/cd.mp3"]), (5, "s", None, ["h/ef.mp3"]), (6, "s", "t/6.yaml", None)]
    records = spark.createDataFrame([(i, c, f, [], u and [([], x) for x in u]) for i, c, f, u in rows], "record_id bigint, ple_code string, filepath string, text array<struct<speaker:string,text:string>>, urls array<struct<names:array<string>,url:string>>")
    records.write.parquet(str(tmp_path / "session_texts.parquet"))
    assert sorted((r["value"] for r in manifest_file(spark, str(tmp_path)).collect()), key=str) == [None, "for_axlotl/s/s-1-ab.txt,audio/a/b/ab.mp3"]


def test_one_file_a_record(spark, tmp_path):
    df = spark.createDataFrame([("s1", "text/01.yaml", "a/b/x.mp3", "hola"), ("s1", "text/02.yaml", "a/b/y.mp3", None)], "session string, record string, audio string, text string")
    for _ in range(2):
        assert [tuple(r) for r in sinks.text_files(df, str(tmp_path / "f")).collect()] == [(f"{tmp_path}/f/s1-01-x.txt", 4)]


def test_downloads(spark, tmp_path):
    (tmp_path / "src.bin").write_bytes(b"12345")
    wanted = [(f"file://{tmp_path}/src.bin", f"{tmp_path}/o/a/x.mp3"), (f"file://{tmp_path}/none", f"{tmp_path}/o/y.mp3"), ("file:///x", f"{tmp_path}/o/z.wav")]
    df = spark.createDataFrame(wanted, "url string, target string")
    got = {r["target"].rsplit("/", 1)[1]: (r["size"], r["error"] is None) for r in sinks.downloaded(df, wait_s=0.0).collect()}
    assert got == {"x.mp3": (5, True), "y.mp3": (None, False), "z.wav": (None, False)}


def test_landed_pages_are_inserted_once(spark, tmp_path):
    at = datetime(2020, 1, 1, 12)
    rows = lambda *urls: spark.createDataFrame([(u, "<p>", at) for u in urls], landing.PAGES)
    for urls in (("a", "b", "a"), ("b", "c")):
        rows(*urls).write.mode("append").parquet(str(tmp_path / "in"))
        landing.append_new(landing.landed_pages(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b", "c"]

"""Scans of page XML, YAML records, text lines, dictionaries and directory listings."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINES = "doc string, page int, line_no int, top string, left string, width string, height string, font string, text string"
PAGES = "doc string, page int, width double, height double"
_PAGE = re.compile(r"<page\b([^>]*)>(.*?)</page>", re.S)
_TEXT = re.compile(r"<text\b([^>]*?)(?:/>|>(.*?)</text>)", re.S)
_ATTRIBUTE = re.compile(r'([\w:-]+)\s*=\s*"([^"]*)"')
CODE = r"\d{4}_\d{2}_\d{2}_\d+"


def _attributes(s: str) -> dict[str, str]:
    return {k: html.unescape(v) for k, v in _ATTRIBUTE.findall(s)}


def page_lines(documents: DataFrame) -> DataFrame:
    """(doc, xml) -> lines in file order; inline tags are kept, entities resolved, an unreadable text is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, xml in zip(b["doc"], b["xml"], strict=True):
                for page, (_, inside) in enumerate(_PAGE.findall(xml)):
                    for n, (attrs, text) in enumerate(_TEXT.findall(inside)):
                        a = _attributes(attrs)
                        rows.append((doc, page, n, *(a.get(k) for k in ("top", "left", "width", "height", "font")), html.unescape(text or "")))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in LINES.split(", ")])

    return documents.select("doc", "xml").where("xml is not null").mapInPandas(run, LINES)


def page_sizes(documents: DataFrame) -> DataFrame:
    """(doc, xml) -> (doc, page, width, height)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, xml in zip(b["doc"], b["xml"], strict=True):
                for page, (attrs, _) in enumerate(_PAGE.findall(xml)):
                    a = _attributes(attrs)
                    rows.append((doc, page, *(float(a[k]) if re.fullmatch(r"\d+(\.\d+)?", a.get(k, "")) else None for k in ("width", "height"))))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in PAGES.split(", ")])

    return documents.select("doc", "xml").where("xml is not null").mapInPandas(run, PAGES)


def whole_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, name, code, content) of the files below ``path`` that match; code is the session code of the name, null without one."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    name = F.col("_metadata.file_name")
    code = F.regexp_extract(name, CODE, 0)
    return files.select(F.col("_metadata.file_path").alias("path"), name.alias("name"), F.when(code != "", code).alias("code"), F.col("value").alias("content"))


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, name) of the files below ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def not_done(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The wanted rows whose output does not exist yet."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("text"))


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(word) of a text file, one word a line; pickled sets are not read, as they may run code."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word != ''").distinct()


def pronunciation_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(word, phonemes): the first token and the rest of each line; of repeated words the last."""
    parts = F.filter(F.split("value", r"\s+"), lambda w: w != "")
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at")
    d = spark.read.text(path).select(parts.alias("p"), place).where("size(p) > 1")
    return d.select(F.get("p", F.lit(0)).alias("word"), "at", F.array_join(F.slice("p", F.lit(2), F.size("p") - 1), " ").alias("phonemes")).groupBy("word").agg(F.max_by("phonemes", "at").alias("phonemes"))


def phoneme_conversion(spark: SparkSession, path: str) -> DataFrame:
    """(xsamba, ipa, espeak, cmu) of a CSV file; its header begins with '#'."""
    return spark.read.schema("xsamba string, ipa string, espeak string, cmu string").option("comment", "#").csv(path)


RECORD = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("ple_code", T.StringType()),
    T.StructField("text", T.ArrayType(T.StructType([T.StructField("speaker", T.StringType()), T.StructField("text", T.StringType())]))),
    T.StructField("urls", T.ArrayType(T.StructType([T.StructField("names", T.ArrayType(T.StringType())), T.StructField("url", T.StringType())]))),
    T.StructField("error", T.StringType()),
])


def _yaml(content: str):
    """A YAML document; tuples are read as lists, no other tag runs code, and plain scalars stay text (a session code looks like a number)."""
    import yaml

    class Loader(yaml.SafeLoader):
        yaml_implicit_resolvers = {c: [r for r in rs if r[0].endswith(":null")] for c, rs in yaml.SafeLoader.yaml_implicit_resolvers.items()}

    Loader.add_constructor("tag:yaml.org,2002:python/tuple", lambda loader, node: loader.construct_sequence(node, deep=True))
    return yaml.load(content, Loader=Loader)


def _string(x: object) -> str | None:
    if not (x is None or isinstance(x, str)):
        raise TypeError(f"text expected, found {type(x).__name__}")
    return x


def _list(x: object, item) -> list | None:
    if not (x is None or isinstance(x, list)):
        raise TypeError(f"list expected, found {type(x).__name__}")
    return None if x is None else [item(v) for v in x]


def session_records(files: DataFrame) -> DataFrame:
    """(path, content) of YAML records -> path, ple_code, text, urls, error (what could not be read).

    What is null in the file or missing there is null; a list or map where a text belongs is an error of its record."""

    def turn(v) -> dict:
        speaker, text = v
        return {"speaker": _string(speaker), "text": _string(text)}

    def media(v) -> dict:
        names, url = v
        return {"names": _list(names, _string), "url": _string(url)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    d = _yaml(content)
                    rows.append((path, _string(d.get("ple_code")), _list(d.get("text"), turn), _list(d.get("urls"), media), None))
                except Exception as e:  # noqa: BLE001  a broken file is reported, not fatal
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=["path", "ple_code", "text", "urls", "error"])

    return files.select("path", "content").where("content is not null").mapInPandas(run, RECORD)


def speaker_trees(files: DataFrame) -> DataFrame:
    """(path, content) of YAML lists of one-key maps -> (path, seq, speaker, text) in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, k, s, t) for p, c in zip(b["path"], b["content"], strict=True) for k, d in enumerate(_yaml(c) or []) for s, t in d.items()]
            yield pd.DataFrame(rows, columns=["path", "seq", "speaker", "text"])

    return files.select("path", "content").where("content is not null").mapInPandas(run, "path string, seq int, speaker string, text string")


def media_entries(trees: DataFrame) -> DataFrame:
    """(people map<person, map<talk, struct<id,text,audio>>>) -> (person, talk, id, text, audio)."""
    talks = trees.select(F.explode("people").alias("person", "talks"))
    return talks.select("person", F.explode("talks").alias("talk", "e")).select("person", "talk", "e.id", "e.text", "e.audio")

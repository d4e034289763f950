"""Sinks: insert-if-absent tables, partitioned records, manifests, text files, and downloads with retries."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import urlparse

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.codes import record_key, stem, zero_padded

ATTEMPTS, WAIT_S = 3, 1.0


def absent(rows: DataFrame, stored: DataFrame | None, url: str = "url") -> DataFrame:
    """The rows with ``_id`` (md5 of the URL) that the store does not hold; one of repeated URLs. Null or empty URLs are left out."""
    keyed = rows.where((F.col(url) != "")).withColumn("_id", record_key(F.col(url)))
    once = keyed.groupBy("_id").agg(F.min(F.struct(*rows.columns)).alias("r")).select("_id", "r.*")
    return once if stored is None else once.join(stored.select("_id").distinct(), "_id", "left_anti")


def insert_if_absent(rows: DataFrame, path: str, url: str = "url") -> None:
    """Append the rows whose URL the table at ``path`` does not hold yet."""
    spark = rows.sparkSession
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table yet, or an empty folder
            raise
        stored = None
    absent(rows, stored, url).write.mode("append").parquet(path)


def numbered_records(records: DataFrame, key: str = "ple_code", order: str = "pair_no") -> DataFrame:
    """The records with ``file_no``: 01, 02, ... within their session."""
    w = Window.partitionBy(key).orderBy(order)
    return records.withColumn("file_no", zero_padded(F.row_number().over(w)))


def write_partitioned(records: DataFrame, path: str, key: str = "ple_code") -> None:
    """One folder a session, written with one shuffle on (session, part) so that a large session is several files."""
    records.withColumn("part", F.pmod(F.xxhash64(*records.columns[:2]), F.lit(8))).repartition(key, "part").drop("part").write.mode("overwrite").partitionBy(key).parquet(path)


def manifest(rows: DataFrame, path: str) -> None:
    """text_path,audio_path lines without header or quotes, the paths as they are; rows without one of the paths have no line."""
    line = F.concat("text_path", F.lit(","), "audio_path")
    rows.select(line.alias("value")).where("value is not null").write.mode("overwrite").text(path)


def sentences_file(rows: DataFrame, path: str) -> None:
    """One cleaned sentence a line."""
    rows.select("text").write.mode("overwrite").text(path)


class shared_file:  # noqa: N801  used like a function
    """A file at a path or URL of any file system that Arrow knows; written whole or not at all."""

    def __init__(self, target: str) -> None:
        from pyarrow import fs

        uri = target.replace("s3a://", "s3://") if "://" in target or target.startswith("file:") else Path(target).absolute().as_uri()
        self.system, self.path = fs.FileSystem.from_uri(uri)

    def size(self) -> int | None:
        """Its size; None where it does not exist."""
        return self.system.get_file_info(self.path).size

    def write(self, data: bytes) -> None:
        part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        with self.system.open_output_stream(part) as out:
            out.write(data)
        self.system.move(part, self.path)


def text_files(rows: DataFrame, folder: str) -> DataFrame:
    """(session, record, audio, text) -> (path, size): one file <session>-<record>-<audio>.txt a row, written in the tasks; one that exists stays.

    ``folder`` is a path or URL of a file system that all executors share.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, text in zip(b["name"], b["text"], strict=True):
                place = shared_file(f"{folder}/{name}")
                if place.size() is None:
                    place.write(text.encode("utf-8"))
                out.append((f"{folder}/{name}", place.size()))
            yield pd.DataFrame(out, columns=["path", "size"])

    named = rows.where("text is not null").select(F.concat(F.concat_ws("-", "session", stem(F.col("record")), stem(F.col("audio"))), F.lit(".txt")).alias("name"), "text")
    return named.mapInPandas(run, "path string, size bigint")


def kept_and_deleted(lines: DataFrame, path: str) -> None:
    """Lines with ``kept`` to two folders of one table, in one pass."""
    lines.write.mode("overwrite").partitionBy("kept").parquet(path)


def local_fetch(url: str) -> bytes:
    """Bytes of a file URL; other schemes need a fetch function of the caller's."""
    p = urlparse(url)
    if p.scheme not in ("", "file"):
        raise ValueError(f"no fetcher for {p.scheme}")
    return Path(p.path).read_bytes()


def found_status(url: str, status: Callable[[str], tuple[int, str]]) -> tuple[int, str]:
    """Status and final URL after one redirect; a redirect to no address counts as 401."""
    code, target = status(url)
    if code == 302:
        code, target = status(target) if "http" in target else (401, url)
    return (401, url) if code == 302 and "http" not in target else (code, target)


def downloaded(wanted: DataFrame, fetch: Callable[[str], bytes] = local_fetch, status: Callable[[str], tuple[int, str]] | None = None, attempts: int = ATTEMPTS, wait_s: float = WAIT_S, suffix: str = ".mp3") -> DataFrame:
    """(url, target) -> (url, target, size, error): each file fetched in the tasks, with retries.

    ``status`` gives the status of a URL and where it redirects; 401 is final, other failures are tried again. A
    target that exists is skipped (size of what is there); a target of another kind is an error, not fetched.
    Targets are paths or URLs of a file system that all executors share. Parallelism is the number of partitions.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url, target in zip(b["url"], b["target"], strict=True):
                place, error = shared_file(target), None
                if not target.endswith(suffix):
                    error = f"not a {suffix} file"
                for k in range(attempts if error is None and place.size() is None else 0):
                    try:
                        code, source = found_status(url, status) if status else (200, url)
                        if code != 200:
                            raise ConnectionError(f"status {code}")
                        place.write(fetch(source))
                        error = None
                        break
                    except Exception as e:  # noqa: BLE001  reported in the row
                        error = str(e) if isinstance(e, ConnectionError) else f"{type(e).__name__}: {e}"[:200]
                        if error == "status 401":
                            break
                        if k + 1 < attempts:
                            time.sleep(wait_s)
                rows.append((url, target, place.size(), error))
            yield pd.DataFrame(rows, columns=["url", "target", "size", "error"]).astype({"size": "Int64"})

    return wanted.select("url", "target").where("url is not null and target is not null").mapInPandas(run, "url string, target string, size bigint, error string")

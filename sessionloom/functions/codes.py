"""Session codes, dates, file names, URLs and record keys as Column expressions."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def code_date(code: Column) -> Column:
    """yyyy_mm_dd_n -> dd/mm/yyyy."""
    parts = F.split(code, "_")
    return F.array_join(F.reverse(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))), "/")


def date_code(text: Column) -> Column:
    """The first dd/mm/yyyy of a text as yyyy_mm_dd; null without one."""
    at = r"(\d\d)/(\d\d)/(\d{4})"
    return F.when(text.rlike(at), F.concat_ws("_", *(F.regexp_extract(text, at, k) for k in (3, 2, 1))))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_name(date: Column, href: Column) -> Column:
    """dd/mm/yyyy and a link -> yyyy_mm_dd_<last part of the link>."""
    return F.concat_ws("_", F.array_join(F.reverse(F.split(date, "/")), "_"), base_name(href))


def stem(path: Column) -> Column:
    """The base name up to its first point."""
    return F.split_part(base_name(path), F.lit("."), F.lit(1))


def page_number(link: Column) -> Column:
    """Digits after 'page='; null without them."""
    got = F.regexp_extract(link, r"page=(\d+)", 1)
    return F.when(got != "", got)


def time_range(text: Column) -> Column:
    """'De <start> a <end> - Durada ...' -> struct(start, end); nulls otherwise."""
    at = "De (.+) a (.+) - Durada"
    part = lambda k: F.when(text.rlike(at), F.regexp_extract(text, at, k))
    return F.struct(part(1).alias("start"), part(2).alias("end"))


def shard_path(base: Column | str, url: Column) -> Column:
    """<base>/<first>/<second character of the name>/<name>."""
    name = base_name(url)
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(base, F.lit("/"), F.substring(name, 1, 1), F.lit("/"), F.substring(name, 2, 1), F.lit("/"), name)


def text_path(audio_path: Column) -> Column:
    return F.replace(audio_path, F.lit("text"), F.lit("clean_text"))


def zero_padded(n: Column, width: int = 2) -> Column:
    """At least ``width`` digits; longer numbers stay whole."""
    s = n.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def segment_name(path: Column, start: Column, end: Column) -> Column:
    """<stem>_<start>_<end>.wav with three decimals, the name of a cut piece of audio."""
    return F.format_string("%s_%.3f_%.3f.wav", stem(path), start.cast("double"), end.cast("double"))


def record_key(url: Column) -> Column:
    """Hex md5 of the URL's UTF-8 bytes."""
    return F.md5(url.cast("binary"))


@F.pandas_udf(StringType())
def absolute(base: pd.Series, link: pd.Series) -> pd.Series:
    """The link resolved against its base; null if the link is null."""
    return pd.Series([None if x is None else urljoin(b or "", x) for b, x in zip(base, link, strict=True)])

"""Which sessions and records go on to the next stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constitutive(name: Column) -> Column:
    """Sessions that only constitute the chamber."""
    return name.contains("sessió constitutiva") | F.lower(name).contains("constitució")


def plenary(sessions: DataFrame, skip_constitutive: bool = True) -> DataFrame:
    """The sessions to process; those without a name are kept."""
    return sessions.where(~F.coalesce(constitutive(F.col("name")), F.lit(False))) if skip_constitutive else sessions


def to_download(records: DataFrame) -> DataFrame:
    """(filepath, text, media_url): each record with its first URL; records without one are left out."""
    return records.select("filepath", "text", F.get("urls", F.lit(0))["url"].alias("media_url")).where("media_url is not null")


def croppable(records: DataFrame, found: DataFrame, done: DataFrame) -> DataFrame:
    """Records (key, text) of exactly one turn whose edges (key, start, end) were found and whose output is not in ``done`` (key)."""
    edges = found.where("start is not null and end is not null").select("key", "start", "end")
    return records.where(F.size("text") == 1).join(edges, "key").join(done.select("key").distinct(), "key", "left_anti")


def sessions_on(sessions: DataFrame, date: str) -> DataFrame:
    """The stored sessions of one date; the filter reaches the scan."""
    return sessions.where(F.col("date") == date)


def with_interventions(sessions: DataFrame, interventions: DataFrame, *fields: str) -> DataFrame:
    """The sessions (_id, ...) as nested documents: ``interventions`` holds the ``fields`` of their interventions (session_id, pos, ...) in order."""
    each = interventions.groupBy(F.col("session_id").alias("_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("i")))), lambda x: x["i"]).alias("interventions"))
    return sessions.join(each, "_id", "left").withColumn("interventions", F.coalesce("interventions", F.array().cast(each.schema["interventions"].dataType)))

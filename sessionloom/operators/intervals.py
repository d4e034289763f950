"""Continuous periods and gaps of the time intervals of each entity.

Starts and ends are ranked independently per entity. With k starts before it, a start opens a new period
exactly if it exceeds the end of rank k; that end closes the period before it. So gaps are the matches of an
equi-join on (entity, k), however the intervals overlap or nest.

Skew: equal starts (ends) of an entity are counted before ranking, and ranks come from sums within and over
blocks of ``block`` seconds, so no task orders more than the distinct times of one block or the blocks of
one entity, whatever share of the rows one entity has. The join key holds the rank, so a hot entity spreads.

Defined results: rows with null entity, start or end, or end < start, are ignored; repeated rows change
nothing; a zero-length interval covers its point; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.tables import written

BLOCK = 900


def _events(intervals: DataFrame, block: int) -> DataFrame:
    """(entity, t, starts, ends, b) of the valid intervals: how many start and end at t. Written, as four branches read it."""
    ok = intervals.select("entity", "start_s", "end_s").where("entity is not null and end_s >= start_s")
    both = F.explode(F.array(F.struct(F.col("start_s").alias("t"), F.lit(1).alias("s"), F.lit(0).alias("e")), F.struct(F.col("end_s").alias("t"), F.lit(0).alias("s"), F.lit(1).alias("e"))))
    at = ok.select("entity", both.alias("x")).groupBy("entity", F.col("x.t").alias("t")).agg(F.sum("x.s").alias("starts"), F.sum("x.e").alias("ends"))
    return written(at.withColumn("b", F.floor(F.col("t") / block)), "interval-events")


def _ranked(events: DataFrame, count: str) -> DataFrame:
    """(entity, t) -> distinct t with the ranks first_rank..last_rank of its copies, counted by the column ``count``."""
    n = events.where(F.col(count) > 0).select("entity", "t", "b", F.col(count).alias("n"))
    inside = Window.partitionBy("entity", "b").orderBy("t")
    upto = Window.partitionBy("entity").orderBy("b")
    blocks = n.groupBy("entity", "b").agg(F.sum("n").alias("in_block"))
    blocks = blocks.select("entity", "b", (F.sum("in_block").over(upto) - F.col("in_block")).alias("before"))
    r = n.withColumn("within", F.sum("n").over(inside)).join(blocks, ["entity", "b"])
    last = F.col("before") + F.col("within")
    return r.select("entity", "t", (last - F.col("n") + 1).alias("first_rank"), last.alias("last_rank"))


def _pairs(intervals: DataFrame, block: int, how: str) -> DataFrame:
    """(entity, k, s, e): the start s that follows k starts, and the end e of rank k."""
    events = _events(intervals, block)
    starts = _ranked(events, "starts").select("entity", (F.col("first_rank") - 1).alias("k"), F.col("t").alias("s"))
    ends = _ranked(events, "ends").select("entity", F.col("last_rank").alias("k"), F.col("t").alias("e"))
    return starts.join(ends, ["entity", "k"], how)


def gaps(intervals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(entity, start_s, end_s) -> (entity, gap_start_s, gap_end_s)."""
    found = _pairs(intervals, block, "inner").where("s > e")
    return found.select("entity", F.col("e").cast("int").alias("gap_start_s"), F.col("s").cast("int").alias("gap_end_s"))


def periods(intervals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(entity, start_s, end_s) -> maximal continuous periods (entity, period_start_s, period_end_s, n_intervals)."""
    p = _pairs(intervals, block, "full")
    # The first start (k = 0) and the last end have no partner; the other unpaired ranks lie inside a period.
    edges = p.where("s > e or (e is null and k = 0) or s is null")
    w = Window.partitionBy("entity").orderBy("k")
    shut = edges.withColumn("last_k", F.max("k").over(Window.partitionBy("entity"))).where("s is not null or k = last_k")
    shut = shut.withColumn("period_end_s", F.lead("e").over(w)).withColumn("next_k", F.lead("k").over(w))
    return shut.where("s is not null").select(
        "entity", F.col("s").cast("int").alias("period_start_s"), F.col("period_end_s").cast("int").alias("period_end_s"),
        (F.col("next_k") - F.col("k")).cast("bigint").alias("n_intervals"),
    )

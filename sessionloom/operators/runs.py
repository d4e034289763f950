"""Speaker sequences: filters, the chair, runs and blocks, by windows over an explicit position.

All windows are per session; sequences have rows (session, pos, speaker). Defined results: null speakers count
as no speaker and are left out; repeated rows of a position should be removed before (``distinct``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAUSE = "mesa"


def speaking(text: Column, speaker: Column, capital: bool = True) -> Column:
    """A turn that counts: some text, no order of the day and, with ``capital``, no lower-case name."""
    ok = (text != "") & ~speaker.contains("ORDRE")
    return ok & ~speaker.rlike(r"^\p{Ll}") if capital else ok


def most_frequent(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys, value, n): the most frequent value of each key, the first met on ties."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first_at"))
    return counted.groupBy(*keys).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), "first_at")).alias("m")).select(*keys, f"m.{value}", "m.n")


def chair(seq: DataFrame, key: str = "session") -> DataFrame:
    """(key, chair): majority of the first, last and most frequent speaker; else the first of them that names the parliament; else the most frequent."""
    known = seq.where("speaker is not null")
    ends = known.groupBy(key).agg(F.min_by("speaker", "pos").alias("f"), F.max_by("speaker", "pos").alias("l"))
    mode = most_frequent(known, [key], "speaker", "pos").select(key, F.col("speaker").alias("m"))
    f, last, m = F.col("f"), F.col("l"), F.col("m")
    of_house = [F.when(F.lower(c).contains("parlament"), c) for c in (f, last, m)]
    pick = F.when(f == m, f).when(f == last, last).when(last == m, last).otherwise(F.coalesce(*of_house, m))
    return ends.join(mode, key).select(key, pick.alias("chair"))


def with_chair(seq: DataFrame, chairs: DataFrame, key: str = "session") -> DataFrame:
    """The sequence with the chair's name, or any text that holds it, replaced by the pause speaker."""
    here = seq.join(chairs, key, "left")
    return here.withColumn("speaker", F.when(F.col("speaker").contains(F.col("chair")), F.lit(PAUSE)).otherwise(F.col("speaker"))).drop("chair")


def one_speaker(speakers: Column) -> Column:
    """Of several names of one intervention: without the first pause speaker, the first."""
    at = F.array_position(speakers, PAUSE)
    rest = F.when(at > 0, F.concat(F.slice(speakers, F.lit(1), (at - 1).cast("int")), F.slice(speakers, (at + 1).cast("int"), F.size(speakers)))).otherwise(speakers)
    return F.when(F.size(speakers) == 1, F.get(speakers, F.lit(0))).otherwise(F.get(rest, F.lit(0)))


def runs(seq: DataFrame, key: str = "session", pause: str = PAUSE) -> DataFrame:
    """(key, run_no, pos, speaker): first positions of the runs of one speaker, pauses left out."""
    w = Window.partitionBy(key).orderBy("pos")
    said = seq.where(F.col("speaker").isNotNull() & (F.col("speaker") != pause))
    heads = said.withColumn("before", F.lag("speaker").over(w)).where("before is null or before != speaker")
    return heads.select(key, (F.row_number().over(w) - 1).cast("bigint").alias("run_no"), "pos", "speaker")


def blocks(seq: DataFrame, key: str = "session", pause: str = PAUSE, full_last: bool = False) -> DataFrame:
    """(key, block_no, start, end, speaker): inclusive ranges of dense positions 0..n-1.

    A pause between two runs belongs to both blocks. The last block has one element, or with ``full_last`` all.
    """
    w = Window.partitionBy(key).orderBy("pos")
    here = seq.select(key, "pos", "speaker").withColumn("before", F.lag("speaker").over(w)).withColumn("last_pos", F.max("pos").over(Window.partitionBy(key)))
    heads = runs(seq, key, pause).join(here.select(key, "pos", "before", "last_pos"), [key, "pos"])
    start = F.when(F.col("run_no") == 0, F.lit(0)).when(F.col("before") == pause, F.col("pos") - 1).otherwise(F.col("pos"))
    made = heads.withColumn("start", start).withColumn("next_pos", F.lead("pos").over(w))
    end = F.coalesce(F.col("next_pos") - 1, F.col("last_pos") if full_last else F.col("start"))
    return made.select(key, F.col("run_no").alias("block_no"), F.col("start").cast("bigint").alias("start"), end.cast("bigint").alias("end"), "speaker")


def dense(seq: DataFrame, key: str = "session") -> DataFrame:
    """Positions renumbered 0, 1, ... in their order."""
    w = Window.partitionBy(key).orderBy("pos", "speaker")
    return seq.withColumn("pos", (F.row_number().over(w) - 1).cast("bigint"))


def block_contents(block_rows: DataFrame, elements: DataFrame, key: str = "session") -> DataFrame:
    """(key, block_no, pos, ...): the elements within each block's inclusive range.

    Both sides meet in blocks of 64 positions, so that the range condition filters an equi-join.
    """
    b = block_rows.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / 64), F.floor(F.col("end") / 64))))
    e = elements.withColumn("cell", F.floor(F.col("pos") / 64))
    return b.select(key, "block_no", "start", "end", "cell").join(e, [key, "cell"]).where("pos between start and end").drop("cell", "start", "end")

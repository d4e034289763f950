"""All pairs within sets, in salted parts, so that one large set is many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1024


def pairs_within(members: DataFrame, key: str, member: str, part: int = PART) -> DataFrame:
    """(key, member, n) -> (a, b), a < b: the pairs of members of each set; n is the size of the set.

    One side of a set is cut into parts of about ``part`` members, the other is repeated for each part. The pairs
    are the result; nothing else grows with the square of a set. Nulls meet nothing.
    """
    parts = F.ceil(F.col("n") / part).cast("int")
    left = members.select(key, F.col(member).alias("a"), F.pmod(F.xxhash64(member, F.lit(part)), parts).cast("int").alias("salt"))
    right = members.select(key, F.col(member).alias("b"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    return left.join(right, [key, "salt"]).where("a < b").select("a", "b")

"""References to records that do not exist (yet, or any more).

Distinct non-null foreign keys, each with the time at which it was used, are anti-joined with the parent
keys' periods of life; the orphans are joined back to the referring rows for reports.

Skew: the foreign side is deduplicated before the join; keys used at more than ``hot_rows`` different times
are salted by the time and their parents repeated once per salt. Parent rows of one key are
collapsed before they are ordered. The list of hot keys is broadcast only if the planner finds it small enough.

Defined results: null keys are no references; blank keys count as null; repeated rows count once; a parent
without ``registered_at`` never lives; empty tables give no parents or no orphans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 200_000


def _merged(periods: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, a, b): overlapping or touching periods of the same keys as one."""
    w = Window.partitionBy(*keys).orderBy("a")
    before = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = periods.withColumn("fresh", F.coalesce((F.col("a") > before).cast("int"), F.lit(1))).withColumn("island", F.sum("fresh").over(w))
    return islands.groupBy(*keys, "island").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("island")


def live_periods(parents: DataFrame) -> DataFrame:
    """(ref_field, ref_key, registered_at, deleted_at) -> disjoint periods [live_from, live_to); the far future where still alive.

    Periods are merged within the days of registration first, so that the order over a key's whole life holds merged ones only.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    p = (
        parents.select("ref_field", "ref_key", F.col("registered_at").alias("a"), F.coalesce("deleted_at", far).alias("b"))
        .where("ref_key is not null and a is not null and b > a")
        .groupBy("ref_field", "ref_key", F.to_date("a").alias("day"), "a").agg(F.max("b").alias("b"))
    )
    daily = _merged(p, ["ref_field", "ref_key", "day"]).drop("day")
    return _merged(daily, ["ref_field", "ref_key"]).select("ref_field", "ref_key", F.col("a").alias("live_from"), F.col("b").alias("live_to"))


def orphan_keys(references: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct (ref_field, ref_key, used_at) without a parent alive at ``used_at``.

    references: ref_field, ref_key, used_at (further columns are ignored);
    parents: ref_field, ref_key, registered_at, deleted_at.
    """
    probes = references.where("ref_key is not null").select("ref_field", "ref_key", "used_at").distinct()
    hot = (
        probes.groupBy("ref_field", "ref_key").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
        .select("ref_field", "ref_key", F.ceil(F.col("n") / hot_rows).cast("int").alias("salts"))
    )
    salts = F.coalesce("salts", F.lit(1))
    keys = ["ref_field", "ref_key"]
    left = probes.join(hot, keys, "left").withColumn("salt", F.pmod(F.xxhash64("used_at"), salts).cast("int")).drop("salts")
    right = (
        live_periods(parents).join(hot, keys, "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    )
    alive = (
        (left.ref_field == right.ref_field) & (left.ref_key == right.ref_key) & (left.salt == right.salt)
        & (right.live_from <= left.used_at) & (right.live_to > left.used_at)
    )
    return left.join(right, alive, "left_anti").drop("salt")


def orphan_rows(references: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The referring rows (all columns of ``references``) whose reference is an orphan."""
    r, o = references.alias("r"), orphan_keys(references, parents, hot_rows).alias("o")
    same = (F.col("r.ref_field") == F.col("o.ref_field")) & (F.col("r.ref_key") == F.col("o.ref_key")) & F.col("r.used_at").eqNullSafe(F.col("o.used_at"))
    return r.join(o, same, "left_semi")


def orphan_report(references: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per ref_field and month of use: references, orphans and distinct orphan keys."""
    period = F.date_format("used_at", "yyyy-MM").alias("period")
    every = references.where("ref_key is not null").groupBy("ref_field", period).agg(F.count("*").alias("n_refs"))
    bad = (
        orphan_rows(references, parents, hot_rows).groupBy("ref_field", period, "ref_key").agg(F.count("*").alias("n"))
        .groupBy("ref_field", "period").agg(F.sum("n").alias("n_orphans"), F.count("*").alias("n_orphan_keys"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return every.join(bad, ["ref_field", "period"], "left").select("ref_field", "period", F.col("n_refs").cast("bigint").alias("n_refs"), zero("n_orphans"), zero("n_orphan_keys"))

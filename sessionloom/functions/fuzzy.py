"""Similarity of names: accent folding and the sorted-token-set ratio, as Arrow functions."""

from __future__ import annotations

import functools
import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType


@F.pandas_udf(StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without the characters outside ASCII; null stays null."""
    return s.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")


def name_key(c: Column) -> Column:
    """Trimmed, lower case, ASCII."""
    return ascii_fold(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")))


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step a character."""
    if a == b:
        return len(a)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _ratio(a: str, b: str, over: int) -> int:
    """Matching-blocks ratio of 0..100; 0 if it can't exceed ``over``, as matching blocks are a common subsequence."""
    n = len(a) + len(b)
    if not a or not b or round(200 * min(len(a), len(b)) / n) <= over or round(200 * common_subsequence(a, b) / n) <= over:
        return 0
    return round(100 * SequenceMatcher(None, a, b, autojunk=False).ratio())


def name_tokens(c: Column) -> Column:
    """The different words of a name, in lower case and in order."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")))


def with_tokens(df: DataFrame, name: str, out: str) -> DataFrame:
    """The rows with ``out``, the words of the column ``name``, and what ``similar_pairs`` needs of them: the words longer than two
    characters, the lengths of all and of the others, and how often each letter stands in them, as bits."""
    joined = lambda c: F.length(F.array_join(c, " "))
    df = df.withColumn(out, name_tokens(F.col(name))).withColumn(f"{out}_s", F.array_join(out, ""))
    times = lambda c: F.length(f"{out}_s") - F.length(F.replace(f"{out}_s", F.lit(c)))
    bit = lambda k, c, n: F.when(times(c) >= n, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint")
    letters = list(enumerate("abcdefghijklmnopqrstuvwxyz"))
    bits = [functools.reduce(Column.__add__, [bit(k, c, n) + bit(k + 26, c, n + 1) for k, c in letters]) for n in (1, 3)]
    df = df.withColumns({f"{out}_long": F.filter(out, lambda w: F.length(w) > 2), f"{out}_len": joined(F.col(out)), f"{out}_short": joined(F.filter(out, lambda w: F.length(w) <= 2))})
    return df.withColumns({f"{out}_once": bits[0], f"{out}_often": bits[1]}).drop(f"{out}_s")


@F.pandas_udf(IntegerType())
def _blocks_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_ratio(x, y, -1) for x, y in zip(a, b, strict=True)], dtype="int32")


def similar_pairs(pairs: DataFrame, x: str, y: str, over: int) -> DataFrame:
    """The pairs whose token-set similarity is above ``over``, with ``score``; x and y are made by ``with_tokens``.

    First go pairs that share no longer word, whose short words cannot be enough, and whose letters differ in more
    places than a ratio above ``over`` leaves. The shared words against each side have a closed form. The two sides are compared in Python only if their edit distance allows a ratio above
    ``over``: matching blocks leave out at least as many characters as it has edits.
    """
    joined = lambda *parts: F.array_join(F.concat(*parts), " ")
    shared = F.array_intersect(x, y)
    differ = sum((F.bit_count(F.col(f"{x}_{k}").bitwiseXOR(F.col(f"{y}_{k}"))) for k in ("once", "often")), F.lit(0))
    shorter = F.least(f"{x}_len", f"{y}_len")
    likely = (differ <= (F.col(f"{x}_len") + F.col(f"{y}_len")) * (1 - (over + 0.5) / 100)) | (F.least(f"{x}_short", f"{y}_short") * (200 - over) >= shorter * over) | F.arrays_overlap(f"{x}_long", f"{y}_long")
    both = pairs.where(likely).withColumn("_s", F.length(F.array_join(shared, " "))).withColumn("_l", joined(shared, F.array_except(x, y))).withColumn("_r", joined(shared, F.array_except(y, x)))
    part = lambda side: F.bround(F.lit(100.0) * (F.lit(2.0) * F.col("_s") / (F.col("_s") + F.length(side))))
    n = F.length("_l") + F.length("_r")
    both = both.withColumn("_part", F.when(F.col("_s") > 0, F.greatest(part("_l"), part("_r"))).otherwise(0.0).cast("int"))
    within = (F.length("_l") > 0) & (F.length("_r") > 0) & (F.levenshtein("_l", "_r") <= n * (1 - (over + 0.5) / 100))
    both = both.where(F.when(F.col("_part") > over, True).otherwise(within)).withColumn("score", F.when(F.col("_part") == 100, 100).otherwise(F.greatest("_part", _blocks_ratio("_l", "_r"))))
    return both.where(F.col("score") > over).drop("_s", "_l", "_r", "_part")


@functools.lru_cache(maxsize=100_000)
def _tokens(s: str) -> frozenset[str]:
    return frozenset(re.sub(r"[\W_]+", " ", s.lower()).split())


def token_set_similarity(a: str, b: str, over: int = -1) -> int:
    """0..100: the best ratio among the shared tokens and each side's sorted tokens that begin with them; 0 if not above ``over``."""
    x, y = _tokens(a), _tokens(b)
    if not x or not y:
        return 0
    shared = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, (shared, " ".join(sorted(s - o))))) for s, o in ((x, y), (y, x)))
    best = max([_ratio(left, right, over), *([_ratio(shared, left, over), _ratio(shared, right, over)] if shared else [])])
    return best if best > over else 0


@F.pandas_udf(IntegerType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Token-set similarity of two names; null or blank names have 0."""
    return pd.Series([token_set_similarity(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="int32")


def similarity_over(a: Column, b: Column, over: int) -> Column:
    """The token-set similarity where it is above ``over``, else 0; far cheaper than the similarity of every pair."""

    @F.pandas_udf(IntegerType())
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([token_set_similarity(p or "", q or "", over) for p, q in zip(x, y, strict=True)], dtype="int32")

    return score(a, b)

"""Speakers of a transcript against those of the metadata: fuzzy matching, sequence alignment, good pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.codes import zero_padded
from sessionloom.functions.fuzzy import name_key, similar_pairs, similarity_over, with_tokens
from sessionloom.functions.text import strip, title_and_name, without_tags
from sessionloom.operators.runs import block_contents
from sessionloom.tables import written

PAUSE = "mesa"
# Similarity thresholds (strictly above) of the first pass, the aliases, the rest, and a doubtful pair.
FIRST, ALIAS, REST, DOUBTFUL = 90, 80, 80, 60
# Scores of the alignment.
MATCH, MISMATCH, GAP = 10, -5, -5
GAP_INDEX = -1


def aliases(names: DataFrame, key: str = "session") -> DataFrame:
    """(key, alias, name): full string and title of the 'Title (Name)' entries, as keys; the least name on conflicts."""
    got = names.select(key, "speaker", title_and_name(F.col("speaker")).alias("t")).where("t.name is not null")
    both = got.select(key, F.explode(F.array(F.col("speaker"), F.col("t.title"))).alias("written"), F.col("t.name").alias("name"))
    return both.withColumn("alias", name_key(F.col("written"))).groupBy(key, "alias").agg(F.min("name").alias("name"))


def apply_aliases(seq: DataFrame, alias: DataFrame, key: str = "session") -> DataFrame:
    """The sequence with each speaker that is an alias replaced by its name."""
    keyed = seq.withColumn("alias", name_key(F.col("speaker")))
    return keyed.join(alias, [key, "alias"], "left").withColumn("speaker", F.coalesce("name", "speaker")).drop("alias", "name")


def _best(scored: DataFrame, key: str) -> DataFrame:
    """Each metadata name with its best text name; ties go to the lesser name."""
    return scored.groupBy(key, "meta_name").agg(F.min_by("text_name", F.struct(-F.col("score"), "text_name")).alias("text_name")).select(key, "text_name", "meta_name")


def match_names(text: DataFrame, meta: DataFrame, alias: DataFrame, key: str = "session") -> DataFrame:
    """(key, text_name, meta_name): the chair, then names above 90, then aliases, then the rest above 80.

    Names are distinct per session, and their tokens are made once each. The pairs of a session are scored in one
    pass for both thresholds; they are pruned within the join, so that only those that may be similar are rows. A
    text name may take several metadata names, not the reverse.
    """
    names = lambda df, name: df.select(key, F.col("speaker").alias(name)).where(F.col(name).isNotNull()).distinct()
    t, m = written(names(text, "text_name"), "text-names"), written(names(meta, "meta_name"), "meta-names")
    chairs = t.where(F.col("text_name") == PAUSE).join(m.where(F.col("meta_name") == PAUSE), key).select(key, "text_name", "meta_name")
    t1, m1 = (x.join(chairs, [key, c], "left_anti") for x, c in ((t, "text_name"), (m, "meta_name")))
    # So many tasks, as a few bytes of names make far more pairs than the planner expects.
    tasks = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = (with_tokens(x.repartition(tasks, key), c, f"{c}_tokens") for x, c in ((t1, "text_name"), (m1, "meta_name")))
    pairs = left.join(right, key)
    scored = written(similar_pairs(pairs, "text_name_tokens", "meta_name_tokens", min(FIRST, REST)).select(key, "text_name", "meta_name", "score"), "name-scores")
    first = _best(scored.where(F.col("score") > FIRST), key)
    done = written(chairs.unionByName(first), "matches-first")  # three later steps read it
    t2 = t.join(done, [key, "text_name"], "left_anti").withColumn("k", name_key(F.col("text_name")))
    titled = t2.where(~F.col("k").contains("mesa") & ~F.col("k").contains("president")).join(alias, key)
    likely = similar_pairs(with_tokens(with_tokens(titled, "k", "x"), "alias", "y"), "x", "y", ALIAS)
    likely = likely.join(done.select(key, F.col("text_name").alias("name"), "meta_name"), [key, "name"])
    by_alias = likely.groupBy(key, "text_name").agg(F.min_by("meta_name", F.struct(-F.col("score"), "name", "meta_name")).alias("meta_name"))
    known = written(done.unionByName(by_alias), "matches-known")
    rest = scored.where(F.col("score") > REST).join(known, [key, "text_name"], "left_anti").join(known, [key, "meta_name"], "left_anti")
    return known.unionByName(_best(rest, key))


def speaker_index(text: DataFrame, meta: DataFrame, matched: DataFrame, key: str = "session") -> DataFrame:
    """(key, text_name, meta_name, idx): the full outer match of both name sets, numbered densely from 0, the chair first."""
    t = text.select(key, F.col("speaker").alias("text_name")).where("text_name is not null").distinct()
    m = meta.select(key, F.col("speaker").alias("meta_name")).where("meta_name is not null").distinct()
    only_t = t.join(matched, [key, "text_name"], "left_anti").withColumn("meta_name", F.lit(None).cast("string"))
    only_m = m.join(matched, [key, "meta_name"], "left_anti").withColumn("text_name", F.lit(None).cast("string"))
    every = matched.unionByName(only_t).unionByName(only_m)
    rank = F.when(F.col("text_name") == PAUSE, 0).when(F.col("text_name").isNotNull() & F.col("meta_name").isNotNull(), 1).when(F.col("text_name").isNotNull(), 2).otherwise(3)
    w = Window.partitionBy(key).orderBy(rank, "text_name", "meta_name")
    return every.select(key, "text_name", "meta_name", (F.row_number().over(w) - 1).cast("bigint").alias("idx"))


def encoded(block_rows: DataFrame, index: DataFrame, side: str, key: str = "session") -> DataFrame:
    """The blocks with the first index of their speaker; names of one text speaker share the first of their indices."""
    same = index.where("text_name is not null").groupBy(key, "text_name").agg(F.min("idx").alias("low"))
    merged = index.join(same, [key, "text_name"], "left").withColumn("idx", F.coalesce("low", "idx")).drop("low")
    first = merged.groupBy(key, F.col(side).alias("speaker")).agg(F.min("idx").alias("idx"))
    return block_rows.join(first, [key, "speaker"])


class _Scores:
    """The score matrix of an alignment with linear gaps. Every k-th row is kept, the rows between are made again when they
    are read, so that two sequences take about 8 * length * sqrt(length) bytes; a row is one running maximum."""

    def __init__(self, a: list[int], b: list[int], local: bool) -> None:
        self.a, self.b, self.local = np.asarray(a, np.int64), np.asarray(b, np.int64), local
        self.steps = np.arange(len(b) + 1) * GAP
        self.every = max(1, math.isqrt(len(a)))
        row = np.zeros(len(b) + 1, np.int64) if local else self.steps
        self.kept, self.best, self.at = [row], 0, (0, 0)
        for i in range(1, len(a) + 1):
            row = self._next(row, i)
            if i % self.every == 0:
                self.kept.append(row)
            if local and (top := int(row.max())) >= self.best:
                self.best, self.at = top, (i, int(np.nonzero(row == top)[0][-1]))
        self.last, self.block, self.rows = row, -1, []

    def _next(self, row: np.ndarray, i: int) -> np.ndarray:
        through = row[:-1] + np.where(self.b == self.a[i - 1], MATCH, MISMATCH)
        best = np.concatenate(([0 if self.local else i * GAP], np.maximum(through, row[1:] + GAP)))
        return np.maximum.accumulate((np.maximum(best, 0) if self.local else best) - self.steps) + self.steps

    def __call__(self, i: int, j: int) -> int:
        block = i // self.every
        if self.block * self.every <= i < self.block * self.every + len(self.rows):
            block = self.block  # the row after the block is held too, as a step back reads two rows
        else:
            rows = [self.kept[block]]
            for k in range(block * self.every + 1, min((block + 1) * self.every, len(self.a)) + 1):
                rows.append(self._next(rows[-1], k))
            self.block, self.rows = block, rows
        return int(self.rows[i - block * self.every][j])


def _traced(score: _Scores, a: list[int], b: list[int], i: int, j: int) -> tuple[list[tuple[int, int]], int, int]:
    """The aligned pairs back from (i, j), the last first, and where they begin: the diagonal is preferred, then a gap in ``b``, then a gap in ``a``."""
    out = []
    while i and j and (not score.local or score(i, j) > 0):
        here, up = score(i, j), [score(i - 1, j - 1), score(i - 1, j)]
        if here == up[0] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif here == up[1] + GAP:
            i -= 1
            out.append((a[i], GAP_INDEX))
        else:
            j -= 1
            out.append((GAP_INDEX, b[j]))
    return out, i, j


def global_alignment(a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], int]:
    """Needleman-Wunsch: pairs of elements (GAP_INDEX for a gap) and the score."""
    score = _Scores(a, b, False)
    out, i, j = _traced(score, a, b, len(a), len(b))
    out += [(v, GAP_INDEX) for v in reversed(a[:i])] + [(GAP_INDEX, v) for v in reversed(b[:j])]
    return out[::-1], int(score.last[-1])


def local_alignment(a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], int]:
    """Smith-Waterman: the aligned pairs of the best local region (the last one met on ties) and its score; nothing for an empty sequence."""
    score = _Scores(a, b, True)
    return _traced(score, a, b, *score.at)[0][::-1], score.best


def align(left: DataFrame, right: DataFrame, key: str = "session", local: bool = False) -> DataFrame:
    """(key, row_no, left_idx, right_idx, score): the alignment of two sequences (key, pos, idx); null is a gap.

    One pair of sequences is one row (arrays ordered by pos), aligned in numpy within the partition.
    """
    side = lambda df, name: df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "idx"))), lambda x: x["idx"]).alias(name))
    both = side(left, "a").join(side(right, "b"), key, "full")
    kind = dict(left.dtypes)[key]
    how = local_alignment if local else global_alignment

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, a, b in zip(batch[key], batch["a"], batch["b"], strict=True):
                pairs, score = how(list(a) if a is not None else [], list(b) if b is not None else [])
                rows += [(k, n, x if x != GAP_INDEX else None, y if y != GAP_INDEX else None, score) for n, (x, y) in enumerate(pairs)]
            yield pd.DataFrame(rows, columns=[key, "row_no", "left_idx", "right_idx", "score"]).astype({"left_idx": "Int64", "right_idx": "Int64"})

    return both.mapInPandas(run, f"{key} {kind}, row_no bigint, left_idx bigint, right_idx bigint, score bigint")


def alignment_summary(aligned: DataFrame, key: str = "session") -> DataFrame:
    """(key, length, matches, score, identity): identity is the percentage of equal columns."""
    same = F.col("left_idx") == F.col("right_idx")
    done = aligned.groupBy(key).agg(F.count("*").alias("length"), F.sum(F.coalesce(same.cast("int"), F.lit(0))).alias("matches"), F.max("score").alias("score"))
    return done.withColumn("identity", F.round(F.col("matches") * 100.0 / F.col("length"), 6))


def decoded(aligned: DataFrame, left_blocks: DataFrame, right_blocks: DataFrame, key: str = "session") -> DataFrame:
    """(key, row_no, left, right): the aligned rows with their blocks, null at gaps. The n-th non-gap is the n-th block."""
    w = Window.partitionBy(key).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    nth = lambda c: F.when(F.col(c).isNotNull(), F.count(c).over(w) - 1)
    rows = aligned.select(key, "row_no", nth("left_idx").alias("l_no"), nth("right_idx").alias("r_no"))
    block = F.struct("start", "end", "speaker")
    lb = left_blocks.select(key, F.col("block_no").alias("l_no"), block.alias("left"))
    rb = right_blocks.select(key, F.col("block_no").alias("r_no"), block.alias("right"))
    return rows.join(lb, [key, "l_no"], "left").join(rb, [key, "r_no"], "left").select(key, "row_no", "left", "right")


def side_by_side(left_blocks: DataFrame, right_blocks: DataFrame, key: str = "session") -> DataFrame:
    """(key, row_no, left, right): blocks paired by their number; the longer side meets nulls."""
    block = F.struct("start", "end", "speaker")
    lb = left_blocks.select(key, F.col("block_no").alias("row_no"), block.alias("left"))
    rb = right_blocks.select(key, F.col("block_no").alias("row_no"), block.alias("right"))
    return lb.join(rb, [key, "row_no"], "full")


def trusted(left: Column, right: Column, matched: Column) -> Column:
    """Both speakers are matched ones, or their names without tags are similar above 60."""
    return matched | (similarity_over(F.lower(without_tags(left)), F.lower(right), DOUBTFUL) > 0)


def good_pairs(rows: DataFrame, matched: DataFrame, key: str = "session") -> DataFrame:
    """(key, pair_no, left, right): rows that are neither first nor last, whose neighbours and themselves have both sides, and whose speakers are trusted."""
    w = Window.partitionBy(key).orderBy("row_no")
    whole = (F.col("left.speaker").isNotNull() & F.col("right.speaker").isNotNull()).cast("int")
    near = rows.withColumn("whole", F.min(whole).over(w.rowsBetween(-1, 1))).withColumn("n", F.row_number().over(w)).withColumn("last", F.count("*").over(Window.partitionBy(key)))
    near = near.where("whole = 1 and n > 1 and n < last")
    lt = matched.select(key, F.col("text_name").alias("l")).distinct().withColumn("l_known", F.lit(True))
    rt = matched.select(key, F.col("meta_name").alias("r")).distinct().withColumn("r_known", F.lit(True))
    near = near.withColumn("l", F.col("left.speaker")).withColumn("r", F.col("right.speaker")).join(lt, [key, "l"], "left").join(rt, [key, "r"], "left")
    kept = near.where(trusted(F.col("l"), F.col("r"), F.coalesce(F.col("l_known") & F.col("r_known"), F.lit(False))))
    return kept.select(key, F.row_number().over(w).cast("bigint").alias("pair_no"), "row_no", "left", "right")


def by_code_or_date(texts: DataFrame, sessions: DataFrame, date_only: bool = False) -> DataFrame:
    """(ple_code, session_id, by): the stored sessions of each transcript code: those with its code, else all of its date.

    texts: ple_code; sessions: session_id, ple_code, date (dd/mm/yyyy).
    """
    from sessionloom.functions.codes import code_date

    t = texts.select("ple_code").where("ple_code is not null").distinct()
    s = sessions.select("session_id", "ple_code", "date").distinct()
    by_code = t.join(s.select("ple_code", "session_id"), "ple_code").withColumn("by", F.lit("code"))
    rest = t if date_only else t.join(by_code, "ple_code", "left_anti")
    by_date = rest.withColumn("date", code_date(F.col("ple_code"))).join(s.where("date is not null").select("date", "session_id"), "date").select("ple_code", "session_id", F.lit("date").alias("by"))
    return by_date.distinct() if date_only else by_code.unionByName(by_date).distinct()


def clean_names(names: Column) -> Column:
    return F.transform(names, strip)


def alignable(index: DataFrame, key: str = "session") -> DataFrame:
    """(key) of the sessions with more than two entries of the speaker index; the blocks of others stay as they are."""
    return index.groupBy(key).agg(F.count("*").alias("n")).where("n > 2").select(key)


def speaker_pairs(index: DataFrame, chairs: DataFrame, key: str = "session") -> DataFrame:
    """(key, pair_no, text_name, meta_name): the chair's names on both sides, then the index without its first entry, missing names empty.

    chairs: key, text_chair, meta_chair.
    """
    first = chairs.select(key, F.lit(0).cast("bigint").alias("pair_no"), F.col("text_chair").alias("text_name"), F.split_part("meta_chair", F.lit("|"), F.lit(1)).alias("meta_name"))
    rest = index.where("idx > 0").select(key, F.col("idx").alias("pair_no"), F.coalesce("text_name", F.lit("")).alias("text_name"), F.coalesce("meta_name", F.lit("")).alias("meta_name"))
    return first.unionByName(rest)


def session_records(pairs: DataFrame, said: DataFrame, media: DataFrame, key: str = "session") -> DataFrame:
    """(key, file_no, text, urls): the session text record of each pair of blocks, numbered 01, 02, ... within its session.

    pairs: key, pair_no, left and right (start, end); said: key, pos, speaker, text; media: key, pos, names, url. Positions are dense
    and blocks inclusive. A block without elements gives an empty list.
    """
    def contents(side: str, elements: DataFrame, fields: list[str]) -> DataFrame:
        rows = block_contents(pairs.select(key, F.col("pair_no").alias("block_no"), f"{side}.start", f"{side}.end"), elements.select(key, "pos", *fields), key)
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("e")))), lambda x: x["e"])
        return rows.groupBy(key, F.col("block_no").alias("pair_no")).agg(ordered.alias(side))

    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    both = pairs.select(key, "pair_no").join(contents("left", said, ["speaker", "text"]), [key, "pair_no"], "left").join(contents("right", media, ["names", "url"]), [key, "pair_no"], "left")
    w = Window.partitionBy(key).orderBy("pair_no")
    return both.select(
        key, zero_padded(F.row_number().over(w)).alias("file_no"), empty("left", "array<struct<speaker:string,text:string>>").alias("text"), empty("right", "array<struct<names:array<string>,url:string>>").alias("urls"),
    )


def speakers_of_blocks(text: DataFrame, meta: DataFrame, alias: DataFrame, key: str = "session") -> DataFrame:
    """(key, text_speakers, meta_speakers): how many different speakers the blocks of each side have, aliases of the text side resolved."""
    n = lambda df, name: df.groupBy(key).agg(F.countDistinct("speaker").alias(name))
    both = n(apply_aliases(text, alias, key), "text_speakers").join(n(meta, "meta_speakers"), key, "full")
    return both.select(key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("text_speakers", "meta_speakers")])

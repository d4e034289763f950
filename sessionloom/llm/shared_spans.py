"""Long spans that stand verbatim in more than one document, by relative Lempel-Ziv parsing.

A winnowed index (the least hash of each neighbourhood of windows of ``SEED`` characters) tells which texts may
share a stretch of ``LEAST`` characters: any such stretch holds an indexed seed in both. Seeds held by the same
documents are one *voice*; the stretches around the seeds of a voice, with all that a shared stretch through
them can reach, are the document's *block* for that voice. The blocks of a voice are indexed as one reference
(hashes of all windows of LEAST / 2 characters), and each block is factored greedily against it: at the first
place that some other block holds, the factor is the longest match there, and parsing goes on behind it. A factor
of LEAST characters is a shared span. A shared stretch may also be cut by the end of a factor, or be shorter than
a factor of a third block; so windows every LEAST / 2 characters within each factor and on both sides of its
boundaries are looked up, and each occurrence is extended to both sides, character by character. Any stretch of
LEAST characters holds one of these windows whole, so no span is lost.

Scale and skew: exact copies of whole texts are one representative until the end, equal blocks of a voice are one
kind. References are parsed many at a time, up to ``CHARS`` characters. A voice with more than ``KINDS`` kinds or
CHARS characters (a phrase shorter than LEAST in a third of all documents, say) takes windows of the full LEAST
characters as its seeds instead: every holder of such a window shares it, so the windows are the factors, and no
pair without a shared span is looked at. Pairs within a set of documents are made in salted parts.

Defined results: null texts and texts shorter than LEAST share nothing; lengths are code points, nothing is
normalised; repeated rows of a doc_id count once; spans repeated only within one document do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.pairs import pairs_within
from sessionloom.llm.rolling import code_points, window_hashes, winnowed
from sessionloom.tables import written

LEAST = 300
SEED = 128
KINDS = 512
CHARS = 1_000_000
_STOP = 0x110000  # above all code points; every block part ends with a stop of its own


def _seeds(batches: Iterator[pa.RecordBatch], least: int, seed: int) -> Iterator[pa.RecordBatch]:
    import xxhash

    width = least - seed + 1
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int32()), ("copy", pa.binary()), ("seeds", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        copies, sizes, seeds, places = [], [], [], []
        for at in range(0, len(texts), 64):
            part = texts[at : at + 64]
            points, offsets = code_points(part)
            hashes = window_hashes(points, seed)
            for t, a, b in zip(part, offsets[:-1], offsets[1:], strict=True):
                own = hashes[a : b - seed + 1] if b - a >= least else hashes[:0]
                chosen = winnowed(own, width)
                sizes.append(b - a)
                copies.append(xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")))
                seeds.append(own[chosen].view(np.int64))
                places.append(chosen.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(copies, pa.binary()), pa.array(seeds, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))], schema=schema)


BLOCK = "voice bigint, kind binary, doc_id bigint, starts array<int>, ends array<int>, texts array<string>"


def _blocks(batches: Iterator[pd.DataFrame], least: int, seed: int) -> Iterator[pd.DataFrame]:
    """The parts of each document around the seeds of each voice; overlapping ones are one part."""
    import xxhash

    for b in batches:
        rows = []
        for doc, text, wanted in zip(b["doc_id"], b["text"], b["wanted"], strict=True):
            parts: dict[int, list[list[int]]] = {}
            for voice, p in sorted((int(w["voice"]), int(w["place"])) for w in wanted):
                own, a, z = parts.setdefault(voice, []), max(0, p - (least - seed)), min(len(text), p + least)
                if own and a <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], z)
                else:
                    own.append([a, z])
            for voice, own in parts.items():
                texts = [text[a:z] for a, z in own]
                kind = xxhash.xxh3_128(",".join(str(len(t)) for t in texts))
                for t in texts:
                    kind.update(t.encode("utf-8", "surrogatepass"))
                rows.append((voice, kind.digest(), doc, [a for a, _ in own], [z for _, z in own], texts))
        yield pd.DataFrame(rows, columns=["voice", "kind", "doc_id", "starts", "ends", "texts"])


def _ahead(p: np.ndarray, a: int, b: int) -> int:
    """How many characters from ``a`` on agree with those from ``b`` on."""
    n, step, most = 0, 64, len(p) - max(a, b)
    while n < most:
        k = min(step, most - n)
        off = p[a + n : a + n + k] != p[b + n : b + n + k]
        first = int(off.argmax())
        if off[first]:
            return n + first
        n, step = n + k, step * 4
    return n


class Reference:
    """The indexed blocks of some voices, each block a list of texts; blocks of one voice are reference to one another."""

    def __init__(self, voices: list[int], blocks: list[list[str]], least: int) -> None:
        self.least, self.half = least, max(1, least // 2)
        flat = [t for texts in blocks for t in texts]
        points, offsets = code_points([f"{t}\0" for t in flat])
        self.points = points.copy()
        self.points[offsets[1:] - 1] = _STOP + np.arange(len(flat), dtype=np.uint32)
        self.behind = self.points[::-1]
        self.starts = offsets
        sizes = [len(texts) for texts in blocks]
        self.block_of_part = np.repeat(np.arange(len(blocks)), sizes)
        self.first_part = np.concatenate(([0], np.cumsum(sizes)))
        number = {v: k for k, v in enumerate(dict.fromkeys(voices))}
        voice = np.repeat(np.array([number[v] for v in voices], np.uint64), [sum(len(t) + 1 for t in texts) for texts in blocks])
        owner = np.repeat(np.arange(len(blocks)), [sum(len(t) + 1 for t in texts) for texts in blocks])
        keys = window_hashes(self.points, self.half)
        keys = (keys ^ (voice[: len(keys)] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
        self.order = np.argsort(keys, kind="stable")
        ordered = keys[self.order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, bool)
        at = np.nonzero(first)[0]
        self.stops = np.append(at[1:], len(keys))
        self.run = np.empty(len(keys), np.int64)  # the run of equal windows that each place belongs to
        self.run[self.order] = np.cumsum(first) - 1
        self.runs = at
        if len(at):
            own = owner[self.order]
            several = np.minimum.reduceat(own, at) != np.maximum.reduceat(own, at)
            self.held = np.nonzero(several[self.run])[0]  # places whose window another block holds
        else:
            self.held = np.zeros(0, np.int64)
        self.owner = owner

    def stretch(self, a: int, b: int) -> tuple[int, int]:
        """The maximal common stretch around the equal windows at ``a`` and ``b``, as its limits at ``a``."""
        last = len(self.points) - 1
        return a - _ahead(self.behind, last - a + 1, last - b + 1) if min(a, b) else a, a + self.half + _ahead(self.points, a + self.half, b + self.half)

    def factored(self, block: int) -> list[tuple[int, int, int, int]]:
        """(other block, place, place in the other, length) of the shared spans found by parsing ``block``."""
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        half, out = self.half, []

        def look(k: int) -> int:
            """Every occurrence of the window at ``k`` in another block; how far the longest match reaches."""
            r, reach = self.run[k], k + half
            for q in self.order[self.runs[r] : self.stops[r]].tolist():
                other = int(self.owner[q])
                if other == block:
                    continue
                known = spans.setdefault((other, q - k), [])
                lo, hi = next(((a, z) for a, z in known if a <= k and k + half <= z), (0, 0))
                if not hi:
                    lo, hi = self.stretch(k, q)
                    known.append((lo, hi))
                    if hi - lo >= self.least:
                        out.append((other, lo, lo + q - k, hi - lo))
                reach = max(reach, hi)
            return reach

        a, z = int(self.starts[self.first_part[block]]), int(self.starts[self.first_part[block + 1]])
        places = self.held[np.searchsorted(self.held, a) : np.searchsorted(self.held, z)]
        n = 0
        while n < len(places):
            i = int(places[n])
            end = look(i)  # the factor [i, end)
            for k in [*range(i + half, end - half + 1, half), end - half]:
                if k > i:
                    look(k)
            n = int(np.searchsorted(places, end))
        return out

    def part(self, place: int) -> tuple[int, int]:
        """The part of its block that a place lies in, and the offset there."""
        p = int(np.searchsorted(self.starts, place, "right")) - 1
        return p - int(self.first_part[self.block_of_part[p]]), place - int(self.starts[p])


LINK = "voice bigint, x binary, y binary, x_part int, x_from int, y_part int, y_from int, length int"


def _parsed(rows: list[tuple[int, bytes, list[str]]], least: int) -> pd.DataFrame:
    ref = Reference([v for v, _, _ in rows], [list(t) for _, _, t in rows], least)
    out = []
    for k, (voice, kind, _) in enumerate(rows):
        for other, at, there, n in ref.factored(k):
            if k < other:
                out.append((voice, kind, rows[other][1], *ref.part(at), *ref.part(there), n))
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in LINK.split(", ")])


def _parse(batches: Iterator[pd.DataFrame], least: int, chars: int) -> Iterator[pd.DataFrame]:
    """The blocks come in the order of their voices; whole voices are parsed together, up to ``chars`` characters."""
    held: list[tuple[int, bytes, list[str]]] = []
    size = 0
    for b in batches:
        for row in zip(b["voice"], b["kind"], b["texts"], strict=True):
            if size >= chars and held and row[0] != held[-1][0]:
                yield _parsed(held, least)
                held, size = [], 0
            held.append(row)
            size += sum(map(len, row[2]))
    if held:
        yield _parsed(held, least)


def _windows(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for voice, kind, texts in zip(b["voice"], b["kind"], b["texts"], strict=True):
            for part, t in enumerate(texts):
                h = window_hashes(code_points([t])[0], least)
                yield pd.DataFrame({"voice": voice, "kind": kind, "part": part, "start": np.arange(len(h), dtype=np.int32), "window": h.view(np.int64)})


def _voice(member: str) -> list[Column]:
    """Aggregates that tell sets of members apart."""
    return [F.count("*").alias("n"), F.sum(F.xxhash64(member).cast("decimal(38,0)")).alias("sum"), F.min(member).alias("lo"), F.max(member).alias("hi")]


@dataclass
class Parse:
    members: DataFrame  # doc_id, rep, n_chars: the representative of each document's copies
    blocks: DataFrame  # voice, kind, doc_id, starts, ends: of representatives
    links: DataFrame  # LINK: spans shared by two kinds
    windows: DataFrame  # voice, kind, part, start, window: shared windows of crowded voices


def parsed(documents: DataFrame, least: int = LEAST, seed: int = SEED, kinds: int = KINDS, chars: int = CHARS) -> Parse:
    """(doc_id, text) -> the parse of all documents against the references."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text").where("text is not null and doc_id is not null")
    found = docs.mapInArrow(lambda it: _seeds(it, least, seed), "doc_id bigint, n_chars int, copy binary, seeds array<bigint>, places array<int>")
    found = written(found.where(F.col("n_chars") >= least), "span-seeds")
    first = found.groupBy("copy").agg(F.min("doc_id").alias("rep"))
    members = written(found.select("doc_id", "n_chars", "copy").distinct().join(first, "copy").select("doc_id", "rep", "n_chars"), "span-copies")
    reps = found.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    index = reps.select("doc_id", F.explode(F.arrays_zip(F.col("seeds").alias("seed"), F.col("places").alias("place"))).alias("z")).select("doc_id", F.col("z.seed").alias("seed"), F.col("z.place").alias("place"))
    # Repeated seeds of one document weigh on the voice's key only, which then stands for fewer seeds.
    held = index.groupBy("seed").agg(*_voice("doc_id")).where("lo < hi").select("seed", F.xxhash64("n", "sum", "lo", "hi").alias("voice"))
    wanted = index.join(held, "seed").groupBy("doc_id").agg(F.collect_list(F.struct("voice", "place")).alias("wanted"))
    again = docs.hint("shuffle_hash").join(wanted.hint("shuffle_hash"), "doc_id")
    full = again.mapInPandas(lambda it: _blocks(it, least, seed), BLOCK).dropDuplicates(["doc_id", "voice"])
    full = written(full, "span-blocks")
    slim = full.drop("texts")
    length = F.aggregate(F.zip_with("ends", "starts", lambda z, a: z - a), F.lit(0), lambda s, n: s + n)
    sizes = slim.groupBy("voice", "kind").agg(F.first(length).alias("n_chars")).groupBy("voice").agg(F.count("*").alias("kinds"), F.sum("n_chars").alias("chars")).where("kinds > 1")
    sizes = written(sizes, "span-voices")
    crowded = (F.col("kinds") > kinds) | (F.col("chars") > chars)
    texts = lambda which: full.join(sizes.where(which).select("voice"), "voice", "left_semi").groupBy("voice", "kind").agg(F.first("texts").alias("texts"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts(~crowded).repartition(tasks, "voice").sortWithinPartitions("voice")
    links = written(ordered.mapInPandas(lambda it: _parse(it, least, chars), LINK), "span-links")
    crowd = texts(crowded).mapInPandas(lambda it: _windows(it, least), "voice bigint, kind binary, part int, start int, window bigint")
    shared = crowd.groupBy("voice", "window").agg(F.min("kind").alias("lo"), F.max("kind").alias("hi")).where("lo < hi").select("voice", "window")
    return Parse(members, slim, links, written(crowd.join(shared, ["voice", "window"]), "span-windows"))


def sharing_pairs(documents: DataFrame, least: int = LEAST, seed: int = SEED, kinds: int = KINDS, chars: int = CHARS) -> DataFrame:
    """(doc_id, text) -> the pairs doc_id_a < doc_id_b with a common stretch of ``least`` characters."""
    p = parsed(documents, least, seed, kinds, chars)
    # Sets of documents that share a block, or a window of a crowded voice; one of equal sets is enough.
    same = ["n", "sum", "lo", "hi"]
    windows = p.windows.groupBy("voice", "window").agg(*_voice("kind")).groupBy("voice", *same).agg(F.min("window").alias("window")).select("voice", "window")
    windows = p.windows.select("voice", "window", "kind").distinct().join(windows, ["voice", "window"])
    # A voice is derived from its documents, so windows of one name in two voices differ.
    sets = p.blocks.select(F.concat_ws(" ", "voice", F.hex("kind")).alias("set"), "doc_id").unionByName(
        windows.join(p.blocks.select("voice", "kind", "doc_id"), ["voice", "kind"]).select(F.concat_ws("#", "voice", "window").alias("set"), "doc_id")
    )
    one = sets.groupBy("set").agg(*_voice("doc_id")).where("n > 1").groupBy(*same).agg(F.min("set").alias("set")).select("set", "n")
    equal = pairs_within(sets.join(one, "set"), "set", "doc_id")
    side = p.blocks.select("voice", "kind", "doc_id")
    links = p.links.select("voice", "x", "y").distinct()
    across = links.join(side.select("voice", F.col("kind").alias("x"), F.col("doc_id").alias("a")), ["voice", "x"]).join(side.select("voice", F.col("kind").alias("y"), F.col("doc_id").alias("b")), ["voice", "y"])
    reps = equal.unionByName(across.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    # Copies: every copy shares what its representative shares, and the copies share all.
    grown = p.members.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1")
    alike = pairs_within(p.members.join(grown, "rep").select("rep", "doc_id", "n"), "rep", "doc_id")
    ids = p.members.select("rep", "doc_id")
    spread = reps.join(ids.select(F.col("rep").alias("a"), F.col("doc_id").alias("da")), "a").join(ids.select(F.col("rep").alias("b"), F.col("doc_id").alias("db")), "b")
    spread = spread.select(F.least("da", "db").alias("a"), F.greatest("da", "db").alias("b"))
    return alike.unionByName(spread).select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def shared_amount(documents: DataFrame, least: int = LEAST, seed: int = SEED, kinds: int = KINDS, chars: int = CHARS) -> DataFrame:
    """(doc_id, n_chars, shared_chars, n_copies): how much of each document stands in another one too; documents without any are left out.

    No pair is made: each block is covered by what its own parse found.
    """
    p = parsed(documents, least, seed, kinds, chars)
    alike = p.blocks.groupBy("voice", "kind").agg(F.count("*").alias("n")).where("n > 1").select("voice", "kind")
    parts = F.explode(F.arrays_zip(F.col("starts").alias("a"), F.col("ends").alias("b"))).alias("z")
    whole = p.blocks.join(alike, ["voice", "kind"]).select("doc_id", parts).select("doc_id", "z.a", "z.b")
    side = lambda s: p.links.select("voice", F.col(s).alias("kind"), F.col(f"{s}_part").alias("part"), F.col(f"{s}_from").alias("start"), "length")
    every = side("x").unionByName(side("y")).unionByName(p.windows.select("voice", "kind", "part", "start", F.lit(least).alias("length")))
    every = every.groupBy("voice", "kind", "part", "start").agg(F.max("length").alias("length"))
    spans = p.blocks.join(every, ["voice", "kind"]).select("doc_id", (F.get("starts", F.col("part")) + F.col("start")).alias("a"), "length").select("doc_id", "a", (F.col("a") + F.col("length")).alias("b"))
    w = Window.partitionBy("doc_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.unionByName(whole).distinct().withColumn("till", F.coalesce(F.max("b").over(w), F.lit(0))).groupBy("doc_id").agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", "till"))).alias("shared"))
    sizes = p.members.groupBy("rep").agg(F.count("*").alias("n_copies"))
    each = p.members.join(sizes, "rep").join(covered.withColumnRenamed("doc_id", "rep"), "rep", "left")
    amount = F.when(F.col("n_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("shared", F.lit(0)))
    return each.select("doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), amount.cast("bigint").alias("shared_chars"), "n_copies").where("shared_chars > 0")

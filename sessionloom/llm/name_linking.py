"""Links the spellings of one person or organisation.

Distinct names become readings (see names.py). Candidates come from suffix blocking: readings meet that share the
last ``min_suffix`` characters of a token, so those that share a longer suffix meet too. No block is dropped: one of more
than ``common`` readings is cut into parts of about that many, and each part is compared with each. Readings of
three or more tokens that differ in one also meet by all the other tokens, in blocks as whole. The pairs of a block are tested
by bit operations on arrays (name_filter.py); those that may be linked are compared by the longest-common-subsequence ratio,
token by token, with the tokens' document frequencies: two established spellings are two words.

Each reading points to its best match among the more frequent ones; following the pointers gives entities, so
that relatives do not chain through an ambiguous spelling. Readings that leave something out (an initial, a
missing surname, a title for a given name) join an entity only if exactly one fits best.

Scale and skew: mentions are counted before anything else, so that a name that holds a third of all rows is
one row; a task compares two parts of a block at most, and pairs are never rows; their number does
grow with the square of the block, as no pair is left out, but few of them are compared in full; nothing is collected or broadcast; tables between the steps are written to the shared folder.

Defined results: nulls, blanks, offices and unnamed groups have no reading and no entity; repeated rows
count once for links; ties go to the higher score, then the more frequent reading, then the greater key.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.name_filter import candidates, rare
from sessionloom.llm.names import Reading, comparable, compare, read
from sessionloom.llm.pairs import pairs_within
from sessionloom.tables import written

MIN_SUFFIX = 4
COMMON = 8192
FEW, BATCH = 12, 50_000
BLOCK = ["key", "i", "j", "part", "id", "tokens", "dfs", "titled", "organisation"]
READING = "name string, n bigint, core string, tokens array<string>, titled boolean, organisation boolean"
LINK = ["src", "dst", "kind", "score"]
LINKS = "src bigint, dst bigint, kind string, score double"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(x, n, r.core, list(r.tokens), r.titled, r.organisation) for x, n in zip(b["name"], b["n"], strict=True) if (r := read(x))]
        yield pd.DataFrame(rows, columns=["name", "n", "core", "tokens", "titled", "organisation"])


def readings(mentions: DataFrame) -> DataFrame:
    """(name) -> distinct names that name somebody, with their reading and its key ``id``."""
    names = mentions.select("name").where("name is not null").groupBy("name").agg(F.count("*").alias("n"))
    return names.mapInPandas(_read, READING).withColumn("id", F.xxhash64("core", "titled", "organisation"))


def blocks(tokens: DataFrame, min_suffix: int, common: int) -> DataFrame:
    """(id, tokens) -> (id, key, n): readings that share a key, held by ``n`` of them, are candidates.

    ``common`` drops nothing: ``edges`` cuts larger blocks into parts."""
    each = tokens.select("id", F.explode("tokens").alias("token")).where(F.length("token") >= min_suffix)
    suffixes = each.select("id", F.expr(f"right(token, {min_suffix})").alias("key")).distinct()
    # All tokens but one, of three or more.
    numbered = tokens.where(F.size("tokens") > 2).select("id", "tokens", F.posexplode("tokens").alias("pos", "token"))
    starred = F.concat_ws(" ", F.transform("tokens", lambda t, i: F.when(i == F.col("pos"), F.lit("*")).otherwise(t)))
    but_one = numbered.select("id", starred.alias("key"))
    keys = suffixes.unionByName(but_one).distinct()
    n = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return keys.join(n, "key").select("id", "key", "n")


def _record(i: int, r: dict) -> tuple[int, Reading, dict[str, int]]:
    return i, Reading(tuple(r["tokens"]), bool(r["titled"]), bool(r["organisation"])), dict(zip(r["tokens"], r["dfs"], strict=True))


def _links(a: tuple, b: tuple) -> list[tuple[int, int, str, float]]:
    """(src, dst, kind, score) of two readings."""
    (i, x, s), (j, y, t) = a, b
    if not comparable(x, y):
        return []
    df = s | t

    def may_be_one(p: str, q: str) -> bool:
        return rare(*sorted((df[p], df[q])))

    there, back = compare(x, y, may_be_one), compare(y, x, may_be_one)
    if any(m and m.kind == "same" for m in (there, back)):
        score = max(m.score for m in (there, back) if m)
        return [(i, j, "same", score), (j, i, "same", score)]
    return [(i, j, "part", there.score)] if there else [(j, i, "part", back.score)] if back else []


def _block(rows: list[tuple], i: int, j: int) -> Iterator[tuple[int, int, str, float]]:
    """The links of a part with itself or with another part of its block, of rows (part, id, tokens, dfs, titled, organisation)."""

    def records(k: int) -> list[tuple]:
        split = [(x, tuple(t.split(" ")), d, titled, org) for p, x, t, d, titled, org in rows if p == k]
        return [(x, Reading(t, bool(titled), bool(org)), dict(zip(t, map(int, d.split(" ")), strict=True))) for x, t, d, titled, org in split]

    mine = records(i)
    others = mine if i == j else records(j)
    if len(mine) + len(others) <= FEW:
        pairs = itertools.combinations(mine, 2) if i == j else itertools.product(mine, others)
    else:
        counts = {t: n for _, _, d in itertools.chain(mine, others) for t, n in d.items()}
        found = candidates([r for _, r, _ in mine], None if i == j else [r for _, r, _ in others], counts)
        pairs = ((mine[x], others[y]) for x, y in found)
    for s, t in pairs:
        yield from _links(*((s, t) if s[0] < t[0] else (t, s)))


def _compare_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in the order of (key, i, j): all pairs of each block, or of two parts of it, that may be linked, compared."""
    every = (r for b in batches for r in zip(*(b[c] for c in BLOCK), strict=True))
    out = []
    for (_, i, j), rows in itertools.groupby(every, key=lambda r: r[:3]):
        for link in _block([r[3:] for r in rows], i, j):
            out.append(link)
            if len(out) >= BATCH:
                yield pd.DataFrame(out, columns=LINK)
                out = []
    yield pd.DataFrame(out, columns=LINK)


def parted(k: DataFrame, size: int) -> DataFrame:
    """(id, key, n) -> (id, key, part, i, j): each block in parts of about ``size`` readings, each part beside each."""
    parts = F.ceil(F.col("n") / size)
    part = F.pmod(F.xxhash64("id", F.lit(size)), parts).cast("int")
    at = k.select("id", "key", part.alias("part"), parts.cast("int").alias("parts")).select("id", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("to"))
    return at.select("id", "key", "part", F.least("part", "to").alias("i"), F.greatest("part", "to").alias("j"))


def with_frequencies(known: DataFrame) -> DataFrame:
    """(id, tokens, titled, organisation) -> (id, r): the readings with the document frequency of each token."""
    token_df = known.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    placed = known.select("id", F.posexplode("tokens").alias("pos", "token")).join(token_df, "token")
    dfs = placed.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "df"))), lambda x: x["df"]).alias("dfs"))
    return known.join(dfs, "id").select("id", F.struct("tokens", "dfs", "titled", "organisation").alias("r"))


def edges(known: DataFrame, min_suffix: int = MIN_SUFFIX, common: int = COMMON) -> DataFrame:
    """(id, tokens, titled, organisation) -> (src, dst, kind, score)."""
    full = with_frequencies(known)
    flat = full.select("id", F.array_join("r.tokens", " ").alias("tokens"), F.array_join(F.col("r.dfs").cast("array<string>"), " ").alias("dfs"), "r.titled", "r.organisation")
    k = written(blocks(known.select("id", "tokens"), min_suffix, common), "name-blocks")
    whole = k.where(F.col("n") <= common).select("id", "key", F.lit(0).alias("part"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    at = whole.unionByName(parted(k.where(F.col("n") > common), common))
    # A number of partitions, as few rows make many pairs here: by their bytes they would be one task.
    tasks = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = at.join(flat, "id").select(*BLOCK).repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInPandas(_compare_blocks, LINKS).distinct()


def _follow(pointers: DataFrame, label: str) -> DataFrame:
    """(id, to) -> (id, root), by doubling; ``to`` is null at a root."""
    p = written(pointers.select("id", F.coalesce("to", "id").alias("root")), label)
    while True:
        n = p.join(p.select(F.col("id").alias("root"), F.col("root").alias("next")), "root").select("id", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved"))
        n = written(n, label)
        if n.where("moved").isEmpty():
            return n.select("id", "root")
        p = n.select("id", "root")


def linked(mentions: DataFrame, min_suffix: int = MIN_SUFFIX, common: int = COMMON) -> DataFrame:
    """(name) -> (name, entity): every name that names somebody, with the key of its entity."""
    names = written(readings(mentions), "names")
    known = names.groupBy("id").agg(F.sum("n").alias("n"), F.first("tokens").alias("tokens"), F.first("titled").alias("titled"), F.first("organisation").alias("organisation"))
    known = written(known, "readings")
    links = written(edges(known, min_suffix, common), "name-links")
    weight = known.select("id", "n")
    ranked = (
        links.where("kind = 'same'").join(weight.select(F.col("id").alias("src"), F.col("n").alias("ns")), "src").join(weight.select(F.col("id").alias("dst"), F.col("n").alias("nd")), "dst")
        .where("nd > ns or (nd = ns and dst > src)").groupBy(F.col("src").alias("id")).agg(F.max_by("dst", F.struct("score", "nd", "dst")).alias("to"))
    )
    roots = _follow(known.select("id").join(ranked, "id", "left"), "name-roots")
    # Readings that leave something out join the one entity that fits.
    part = links.where("kind = 'part'")
    whole = part.join(part.select(F.col("src").alias("dst")).distinct(), "dst", "left_anti").select("src", "dst", "score")
    at = whole.join(roots.select(F.col("id").alias("src"), F.col("root").alias("from_root")), "src").join(roots.select(F.col("id").alias("dst"), F.col("root").alias("to_root")), "dst")
    best = at.where("from_root != to_root").groupBy("from_root", "to_root").agg(F.max("score").alias("score")).withColumn("top", F.max("score").over(Window.partitionBy("from_root")))
    targets = best.where("score >= top - 0.02").groupBy(F.col("from_root").alias("id")).agg(F.min("to_root").alias("lo"), F.max("to_root").alias("hi"))
    joined = roots.select("root").distinct().select(F.col("root").alias("id")).join(targets.where("lo = hi").select("id", F.col("lo").alias("to")), "id", "left")
    final = _follow(joined, "name-entities")
    of_reading = roots.join(final.select(F.col("id").alias("root"), F.col("root").alias("entity")), "root").select("id", "entity")
    return names.join(of_reading, "id").select("name", "entity")


def variant_pairs(entities: DataFrame) -> DataFrame:
    """(name, entity) -> the pairs name_a < name_b of each entity."""
    sizes = entities.groupBy("entity").agg(F.count("*").alias("n")).where("n > 1")
    return pairs_within(entities.join(sizes, "entity"), "entity", "name").select(F.col("a").alias("name_a"), F.col("b").alias("name_b"))


def missed(mentions: DataFrame, every: int = 50, min_suffix: int = MIN_SUFFIX, common: int = COMMON) -> DataFrame:
    """(kind, n_links, n_missed): the links of the readings whose id is divisible by ``every`` against all readings, compared in
    blocks without any index, and how many of them the index does not find."""
    names = written(readings(mentions), "names")
    known = names.groupBy("id").agg(F.first("tokens").alias("tokens"), F.first("titled").alias("titled"), F.first("organisation").alias("organisation"))
    full = written(with_frequencies(known), "missed-readings")
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = full.where(F.pmod("id", F.lit(every)) == 0).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("asked", F.lit(True))
    here = asked.unionByName(full.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("asked", F.lit(False)))

    def compare_all(b: pd.DataFrame) -> pd.DataFrame:
        queries, others = ([_record(x, r) for x, q, r in zip(b["id"], b["asked"], b["r"], strict=True) if q == k] for k in (True, False))
        return pd.DataFrame([x for s, t in itertools.product(queries, others) if s[0] != t[0] for x in _links(*((s, t) if s[0] < t[0] else (t, s)))], columns=LINK)

    keys = ["src", "dst", "kind"]
    want = here.groupBy("part").applyInPandas(compare_all, LINKS).select(*keys).distinct()
    got = edges(known, min_suffix, common).select(*keys, F.lit(1).alias("found")).distinct()
    return want.join(got, keys, "left").groupBy("kind").agg(F.count("*").alias("n_links"), F.sum(F.col("found").isNull().cast("bigint")).alias("n_missed"))

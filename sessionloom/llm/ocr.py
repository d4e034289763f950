"""Noisy-channel correction of words in scanned lines.

A word outside the lexicon gets candidates by undoing character confusions, a lost blank or an added blank.
A path through the candidates of a line costs the channel probabilities (estimated from the corpus, one for
each confusion) times a bigram model with unigram back-off over the corpus; Viterbi finds the best path.

Scale and skew: candidates are made once for each distinct unknown word; only lines with a candidate reach the
decoder, each with the few counts it needs, joined by word or word pair. Corpus counts are partially
aggregated. To the driver go only the confusion probabilities, one row for each entry of CONFUSIONS.

Words may be of any length and hold any number of digits and marks, which are always wrong within a word: the
choices for these are made together, and up to two further places at most are tried beside them. Where the choices
are too many to be listed, the word meets the known words of one form once look-alike characters are one, and the
differences are checked place by place. How often a word must stand in the corpus to be known is a number that
grows with very large corpora (``least``), so that frequent misreadings do not become words.

Defined results: words of the lexicon stay; without candidates a line stays; ties keep the scanned word; nothing can
be a misreading of a known word that is shorter than any reading of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (letters meant, letters seen).
CONFUSIONS = (
    ("l", "1"), ("l", "I"), ("i", "!"), ("i", "1"), ("s", "5"), ("o", "0"), ("g", "9"), ("b", "6"), ("ó", "6"), ("b", "8"), ("z", "2"), ("a", "o"), ("e", "c"), ("c", "e"), ("t", "f"), ("v", "y"),
    ("n", "u"), ("u", "n"), ("n", "ri"), ("ri", "n"), ("u", "ii"), ("ü", "ii"), ("d", "cl"), ("m", "rn"), ("rn", "m"), ("cl", "d"), ("ií", "n"), ("h", "b"), ("h", "li"), ("o", "a"), ("f", "t"), ("l", "|"), ("i", "|"), ("l", "!"), ("w", "vv"), ("à", "á"), ("ç", "c"), ("é", "c"), ("è", "c"), ("à", "o"), ("ò", "0"), ("ó", "0"),
)
LOST = len(CONFUSIONS)
#: A second confusion in a word is likelier than two in two words.
BURST = 50.0
#: Odds that a word outside the lexicon which is one confusion from a known word is a word of its own.
OWN_WORD = 0.003
#: The same for a word with a digit, a mark or a capital within.
OWN_MIXED = 1e-6
#: The same in a speaker's line, for a word that could only be two words.
OWN_NAME = 0.1
#: Chance of a lost or an added blank where the pieces allow it.
BLANK = 0.02
#: Weight of the bigram in the language model, the rest is the unigram's.
BIGRAM = 0.7
#: Choices for the wrong places of a word that are listed one by one.
CHOICES = 1024
#: Words of a corpus from which on the least counts of known words grow with it.
CORPUS = 100_000_000
CANDIDATE = "w string, v string, second string, ops array<int>, at array<int>"


_SINGLE = {c: [k for k, (_, seen) in enumerate(CONFUSIONS) if seen == c] for c in "0123456789!|I"}
# Characters that confusions of one character by one make interchangeable.
_ALIKE: dict[str, str] = {}
for _meant, _seen in CONFUSIONS:
    if len(_meant) == len(_seen) == 1:
        _low, _high = sorted((_ALIKE.get(_meant, _meant), _ALIKE.get(_seen, _seen)))
        _ALIKE |= {_meant: _low, _seen: _low} | {c: _low for c, to in _ALIKE.items() if to == _high}


def least(n: int, total: float) -> int:
    """The least count ``n`` of a known word in a corpus of ``total`` words."""
    return max(n, round(n * total / CORPUS))


def wrong_places(w: str) -> list[int]:
    """Digits and marks within a word, and capitals I but at its beginning."""
    return [p for p, c in enumerate(w) if c in _SINGLE and (c != "I" or p)]


def listed(w: str) -> bool:
    """Whether the choices for the wrong places are few enough to be listed."""
    return math.prod(len(_SINGLE[w[p]]) for p in wrong_places(w)) <= CHOICES


def candidates_of(w: str, longest: int) -> Iterator[tuple[str, str | None, list[int], list[int]]]:
    """(v, second half or None, confusions, places in w) for one word outside the lexicon; known words have up to ``longest`` characters."""
    wrong = wrong_places(w)
    more = 1 if wrong else 2
    # Each place undone takes one character at most.
    if listed(w) and len(w) - len(wrong) - more <= longest:
        places = [(p, k) for k, (meant, seen) in enumerate(CONFUSIONS) for p in range(len(w)) if w.startswith(seen, p) and not any(q in wrong for q in range(p, p + len(seen)))]
        for fixed in product(*([(p, k) for k in _SINGLE[w[p]]] for p in wrong)):
            for n in range(0 if wrong else 1, more + 1):
                for others in combinations(places, n):
                    spans = sorted((p, p + len(CONFUSIONS[k][1]), k) for p, k in (*fixed, *others))
                    if any(a[1] > b[0] for a, b in zip(spans, spans[1:], strict=False)):
                        continue
                    out, last = [], 0
                    for p, end, k in spans:
                        out += [w[last:p], CONFUSIONS[k][0]]
                        last = end
                    yield "".join(out) + w[last:], None, [k for _, _, k in spans], [p for p, _, _ in spans]
    for p in range(1, len(w)):
        a, b = w[:p], w[p:]
        if p <= longest and len(b) <= longest and b not in ("’",) and not a.endswith("’"):
            yield a, b, [LOST], [p]


def _candidates(batches: Iterator[pd.DataFrame], longest: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for k in range(0, len(b), 500):
            rows = [(w, v, s, ops, at) for w in b["w"].iloc[k : k + 500] for v, s, ops, at in candidates_of(w, longest)]
            yield pd.DataFrame(rows, columns=["w", "v", "second", "ops", "at"])


def _alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of words of one form whose differences are all confusions and undo every wrong place."""
    of = {(meant, seen): k for k, (meant, seen) in reversed(list(enumerate(CONFUSIONS)))}
    for b in batches:
        rows = []
        for w, v in zip(b["w"], b["v"], strict=True):
            off = [p for p in range(len(w)) if w[p] != v[p]]
            if set(wrong_places(w)) <= set(off) and all((v[p], w[p]) in of for p in off):
                rows.append((w, v, None, [of[v[p], w[p]] for p in off], off))
        yield pd.DataFrame(rows, columns=["w", "v", "second", "ops", "at"])


def candidates(unknown: DataFrame, vocab: DataFrame, total: float, longest: int) -> DataFrame:
    """(w, n) -> (w, n, v, second, ops, at, nv): the candidates that are known words, or two of them."""
    every = unknown.select("w").mapInPandas(lambda it: _candidates(it, longest), CANDIDATE)
    form = lambda c: F.translate(c, "".join(_ALIKE), "".join(_ALIKE.values()))
    many = unknown.where(F.length(F.regexp_replace("w", "[^0-9!|I]", "")) * math.log(3) > math.log(CHOICES)).select("w", form("w").alias("form"))
    every = every.unionByName(many.join(vocab.select("v", form("v").alias("form")), "form").where("length(w) = length(v)").select("w", "v").mapInPandas(_alike, CANDIDATE)).join(unknown, "w")
    known = vocab.where(F.col("lex") | (F.col("n") >= least(3, total)))
    one = every.where("second is null").join(known.select("v", F.col("n").alias("nv"), "lex"), "v").where("lex or nv >= 3 * n").select("w", "n", "v", "second", "ops", "at", "nv")
    good = vocab.where(F.col("lex") | (F.col("n") >= least(10, total)))
    first = good.select("v", F.col("n").alias("nv"), F.col("lex").alias("lex_v"))
    second = good.select(F.col("v").alias("second"), F.col("n").alias("n2"), F.col("lex").alias("lex_2"))
    fits = "(lex_v or nv >= 5 * n) and (lex_2 or n2 >= 5 * n) and (lex_v or lex_2) and (length(v) > 1 or lex_v) and (length(second) > 1 or lex_2)"
    two = every.where("second is not null").join(first, "v").join(second, "second").where(fits).select("w", "n", "v", "second", "ops", "at", F.least("nv", "n2").alias("nv"))
    return one.unionByName(two).distinct()


def confusion_probabilities(cands: DataFrame, vocab: DataFrame, total: float) -> dict[int, float]:
    """Share of the places of each confusion that were misread: words with one candidate against all places in known words."""
    seen = cands.where("second is null and size(ops) = 1 and nv > 10 * n").select(F.col("ops")[0].alias("k"), "w", "n").distinct().groupBy("k").agg(F.sum("n").alias("seen"))
    counts = [F.sum(F.col("n") * ((F.length("v") - F.length(F.replace("v", F.lit(meant)))) / len(meant))).alias(str(k)) for k, (meant, _) in enumerate(CONFUSIONS)]
    places = vocab.where(F.col("lex") | (F.col("n") >= least(10, total))).agg(*counts).first()
    got = {r["k"]: float(r["seen"]) for r in seen.collect()}
    return {k: min(0.05, max(1e-7, (got.get(k, 0.0) + 0.1) / (float(places[str(k)] or 0) + 1000.0))) for k in range(len(CONFUSIONS))}


def _decode(batches: Iterator[pd.DataFrame], total: float) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for line_id, words, arcs, pairs in zip(b["line_id"], b["words"], b["arcs"], b["pairs"], strict=True):
            count = {(p["x"], p["y"]): p["n"] for p in (pairs if pairs is not None else [])}
            ends: dict[int, list] = {}
            best: dict[int, list] = {0: [(0.0, "", 0.0, (), True)]}  # place -> [(cost, last word, its count, corrections, as scanned)]
            for a in arcs:
                ends.setdefault(int(a["start"]), []).append(a)
            for p in range(len(words)):
                if words[p] is None:  # a piece of a broken word: the context starts anew
                    best.setdefault(p + 1, []).extend((cost, "", 0.0, path, True) for cost, _, _, path, _ in best.get(p, []))
                for cost, last, n_last, path, scanned in best.get(p, []):
                    for a in ends.get(p, []):
                        c, prev, n_prev = cost - a["logp"], last, n_last
                        for y, n in ((a["v"], a["nv"]), *(((a["second"], a["n2"]),) if a["second"] is not None else ())):
                            # The line itself is no evidence for its own reading.
                            own = not a["kind"]
                            unigram = max(float(n) - own, 0.5) / total
                            pair = 0 if own and a["logp"] < 0 else max(0, count.get((prev, y), 0) - (own and scanned))
                            c -= math.log(BIGRAM * min(1.0, pair / n_prev) + (1 - BIGRAM) * unigram) if prev and n_prev else math.log(unigram)
                            prev, n_prev = y, 0.0 if own and a["logp"] < 0 else max(float(n), 1.0)
                        best.setdefault(int(a["stop"]), []).append((c, prev, n_prev, (*path, a) if a["kind"] else path, not a["kind"]))
                if p in best:
                    del best[p]
                if p + 1 in best:  # one path for each last word is enough
                    kept: dict[str, tuple] = {}
                    for s in best[p + 1]:
                        if s[1] not in kept or (s[0], len(s[3])) < (kept[s[1]][0], len(kept[s[1]][3])):
                            kept[s[1]] = s
                    best[p + 1] = list(kept.values())
            path = min(best.get(len(words), [(0.0, "", 0.0, (), True)]), key=lambda s: (s[0], len(s[3])))[3]
            rows += [(line_id, int(a["start"]), int(a["stop"]), a["v"] if a["second"] is None else f"{a['v']} {a['second']}") for a in path]
        yield pd.DataFrame(rows, columns=["line_id", "start", "stop", "fixed"])


def corrections(tokens: DataFrame, vocab: DataFrame, cands: DataFrame, chances: dict[int, float], total: float) -> DataFrame:
    """(line_id, words, bold) -> (line_id, start, stop, fixed): words start..stop-1 of the line read ``fixed``.

    A null in ``words`` stands for a piece of a broken word, which ends the context.
    """
    from sessionloom.tables import written

    chance = F.create_map(*[x for k, p in chances.items() for x in (F.lit(k), F.lit(math.log(p)))], F.lit(LOST), F.lit(math.log(BLANK)))
    logp = F.aggregate("ops", F.lit(0.0), lambda s, k: s + F.element_at(chance, k)) + (F.size("ops") - 1) * math.log(BURST)
    placed = tokens.select("line_id", "bold", F.posexplode("words").alias("pos", "w")).where("w is not null")
    fixes = written(cands.withColumn("logp", logp), "ocr-candidates")
    counts = vocab.select(F.col("v").alias("key"), F.col("n").alias("k"), "lex")
    swap = placed.join(fixes, "w").join(counts.select(F.col("key").alias("v"), F.col("k").alias("kv")), "v").join(counts.select(F.col("key").alias("second"), F.col("k").alias("k2")), "second", "left")
    swap = swap.select("line_id", F.col("pos").alias("start"), (F.col("pos") + 1).alias("stop"), "v", "second", "logp", F.greatest("kv", F.lit(1)).alias("nv"), F.greatest(F.coalesce("k2", F.lit(1)), F.lit(1)).alias("n2"), F.lit(True).alias("kind"))
    # Two words that make one known word, unless both are known and used together.
    both = tokens.select("line_id", F.expr("explode(transform(sequence(0, greatest(size(words) - 2, 0)), i -> struct(i as pos, get(words, i) as x, get(words, i + 1) as y)))").alias("p")).select("line_id", "p.*").where("x is not null and y is not null")
    glued = both.groupBy("x", "y").agg(F.count("*").alias("together")).withColumn("v", F.concat("x", "y"))
    x, y = (counts.select(F.col("key").alias(c), F.col("k").alias(f"k_{c}"), F.col("lex").alias(f"lex_{c}")) for c in "xy")
    merged = glued.join(counts.where(F.col("lex") | (F.col("k") >= least(20, total))).select(F.col("key").alias("v"), F.col("k").alias("nv")), "v").join(x, "x", "left").join(y, "y", "left")
    known = lambda c: F.coalesce(f"lex_{c}", F.lit(False)) | (F.coalesce(f"k_{c}", F.lit(0)) > F.greatest(F.lit(least(20, total)), F.col("nv") * 0.05))
    alone = ~F.coalesce("lex_x", F.lit(False)) & ~F.coalesce("lex_y", F.lit(False)) & (F.col("together") <= 0.2 * F.col("nv"))
    merged = merged.where(~(known("x") & known("y")) & ((F.col("together") <= 1 + 0.01 * F.col("nv")) | alone)).select("x", "y", "v", "nv")
    join = both.join(written(merged, "ocr-merged"), ["x", "y"]).select("line_id", F.col("pos").alias("start"), (F.col("pos") + 2).alias("stop"), "v", F.lit(None).cast("string").alias("second"), F.lit(math.log(BLANK)).alias("logp"), F.greatest("nv", F.lit(1)).alias("nv"), F.lit(1).cast("bigint").alias("n2"), F.lit(True).alias("kind"))
    other = written(swap.unionByName(join), "ocr-arcs")
    affected = other.select("line_id").distinct()
    here = placed.join(affected, "line_id", "left_semi")
    doubtful = fixes.groupBy("w").agg(F.max("n").alias("n_w"), F.min(F.col("second").isNotNull()).alias("only_two")).withColumn("doubt", F.lit(True))
    own = here.join(counts.select(F.col("key").alias("w"), F.col("k").alias("k")), "w", "left").join(doubtful, "w", "left")
    itself = F.greatest(F.coalesce("k", F.lit(0)), F.coalesce("n_w", F.lit(0))).cast("double")
    odds = F.when(F.col("w").rlike(".[0-9!|I]|^[0-9]"), math.log(OWN_MIXED)).when(F.col("bold") & F.col("only_two"), math.log(OWN_NAME)).otherwise(math.log(OWN_WORD))
    own = own.select("line_id", F.col("pos").alias("start"), (F.col("pos") + 1).alias("stop"), F.col("w").alias("v"), F.lit(None).cast("string").alias("second"), F.when(F.col("doubt"), odds).otherwise(0.0).alias("logp"), F.greatest(itself, F.lit(1.0)).alias("nv"), F.lit(1.0).alias("n2"), F.lit(False).alias("kind"))
    arcs = written(own.unionByName(other.withColumn("nv", F.col("nv").cast("double")).withColumn("n2", F.col("n2").cast("double"))), "ocr-lattice")
    left = arcs.select("line_id", F.col("stop").alias("at"), F.coalesce("second", "v").alias("x"))
    right = arcs.select("line_id", F.col("start").alias("at"), F.col("v").alias("y"))
    inner = arcs.where("second is not null").select("line_id", F.col("v").alias("x"), F.col("second").alias("y"))
    asked = written(left.join(right, ["line_id", "at"]).select("line_id", "x", "y").unionByName(inner).distinct(), "ocr-asked")
    bigrams = both.groupBy("x", "y").agg(F.count("*").alias("n")).join(asked.select("x", "y").distinct(), ["x", "y"])
    pairs = asked.join(bigrams, ["x", "y"]).groupBy("line_id").agg(F.collect_list(F.struct("x", "y", "n")).alias("pairs"))
    lattice = arcs.groupBy("line_id").agg(F.collect_list(F.struct("start", "stop", "v", "second", "logp", "nv", "n2", "kind")).alias("arcs"))
    lines = lattice.join(tokens.select("line_id", "words"), "line_id").join(pairs, "line_id", "left").select("line_id", "words", "arcs", "pairs")
    return lines.mapInPandas(lambda it: _decode(it, total), "line_id bigint, start int, stop int, fixed string")

"""Where a text begins and ends in long audio: windows of words sought in recognised words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.text import once

# Words sought at each end, shortest run, length of the searched ends and the audio they apply to, padding.
ENDS, SHORTEST = 5, 3
EDGE, LONG = 60.0, 100.0
PADDING = 0.2
# Fixed value: frames a second of the recogniser.
FRAMES = 100


def audio_limits(duration: Column) -> Column:
    """The searched parts [(start, end)] of an audio: its ends if it is long, else none."""
    part = lambda a, b: F.struct(a.cast("double").alias("start"), b.cast("double").alias("end"))
    none = F.array().cast("array<struct<start:double,end:double>>")
    return F.when(duration >= LONG, F.array(part(F.lit(0.0), F.lit(EDGE)), part(duration - EDGE, duration))).otherwise(none)


def searched_parts(duration: Column) -> Column:
    """Beginning and ending parts with their offset: the two ends of a long audio, else the whole twice."""
    part = lambda a, b: F.struct(a.cast("double").alias("start"), b.cast("double").alias("end"), a.cast("double").alias("offset"))
    whole = part(F.lit(0.0), duration)
    return F.when(duration > LONG, F.array(part(F.lit(0.0), F.lit(EDGE)), part(duration - EDGE, duration))).otherwise(F.array(whole, whole))


def seek(start: Column) -> Column:
    """struct(seek, rest): the whole seconds before a start, and what is left to skip after seeking there."""
    return F.struct(F.floor(start).alias("seek"), (start - F.floor(start)).alias("rest"))


def frame_seconds(frame: Column) -> Column:
    return frame / FRAMES


def windows(words: Column, size: int) -> Column:
    """All runs of ``size`` neighbouring words; none if there are fewer."""
    none = F.array().cast("array<array<string>>")
    return once(words, lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda k: F.slice(w, k, size))).otherwise(none))


def first_match(words: Column, sought: Column) -> Column:
    """0-based place of the first run of ``words`` equal to ``sought``; null if there is none."""

    def place(w: Column, s: Column) -> Column:
        n = F.size(s)
        last = F.size(w) - n + 1
        head = F.get(s, F.lit(0))  # most places differ in the first word already
        places = F.filter(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda k: (k <= last) & (F.get(w, k - 1) == head) & (F.slice(w, k, n) == s))
        return F.when(n > 0, F.get(places, F.lit(0)) - 1)

    return once(words, lambda w: once(sought, lambda s: place(w, s)))


def longest_match(words: Column, sought: Column, size: int = ENDS, compat: bool = False) -> Column:
    """struct(place in words, place in sought, n) of the longest run of ``sought`` in ``words``, the first on ties.

    Runs of ``size`` down to SHORTEST words are tried; with ``compat`` only ``size`` and ``size - 1``.
    """

    def tried(w: Column, s: Column, near: Column, at: int, n: int) -> Column:
        run = F.slice(s, at + 1, n)
        place = once(run, lambda r: F.get(F.filter(near, lambda k: F.slice(w, k + 1, n) == r), F.lit(0)))
        return F.when(F.size(s) >= at + n, once(place, lambda k: F.when(k.isNotNull(), F.struct(k.cast("int").alias("place"), F.lit(at).alias("sought_at"), F.lit(n).alias("n")))))

    def longest(w: Column, s: Column) -> Column:
        # the words are gone through once: a run can only begin where one of the sought words stands
        near = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0))), lambda k: F.array_contains(s, F.get(w, k)))
        runs = [(at, n) for n in range(size, (size - 2 if compat else SHORTEST - 1), -1) for at in range(size - n + 1)]
        return once(near, lambda p: F.coalesce(*[tried(w, s, p, at, n) for at, n in runs]))

    return once(words, lambda w: once(sought, lambda s: longest(w, s)))


def is_word(heard: Column) -> Column:
    """Whether what was heard is a word that lasts, and no silence."""
    return (heard["word"] != "<sil>") & (heard["end"] > heard["start"])


def edges_within(texts: DataFrame, compat: bool = False) -> DataFrame:
    """texts (words, duration, begin, end, ...) with start, end, first_word, last_word in place of begin and end, the words heard in order in either part.

    Both are arrays of struct(start, end, word, ...). Each row is judged by itself: nothing is moved. Times are seconds in
    the whole audio: the part's offset is added, and the end is padded. Null where nothing matches.
    """
    parts = searched_parts(F.col("duration"))
    first = longest_match(F.col("begin")["word"], F.slice("words", 1, ENDS), compat=compat)
    n = F.size("words")
    # the ending is sought from behind, so that the last occurrence and the last words win
    tail = F.reverse(F.slice("words", F.greatest(n - ENDS, F.lit(0)) + 1, F.lit(ENDS)))
    last = longest_match(F.reverse(F.col("end")["word"]), tail, compat=compat)
    here = texts.withColumns({"b": first, "e": last})
    start = F.get(parts, F.lit(0))["offset"] + F.get("begin", F.col("b.place"))["start"]
    end = F.get(parts, F.lit(1))["offset"] + F.get("end", F.size("end") - 1 - F.col("e.place"))["end"] + PADDING
    kept = [c for c in texts.columns if c not in ("begin", "end")]
    return here.select(*kept, F.round(start, 3).alias("start"), F.round(end, 3).alias("end"), F.col("b.sought_at").alias("first_word"), (n - 1 - F.col("e.sought_at")).alias("last_word"))


def edges(texts: DataFrame, heard: DataFrame, compat: bool = False) -> DataFrame:
    """(key, start, end, first_word, last_word): texts (key, words, duration) against heard (key, side 'begin'|'end', pos, start, end, word).

    Times are as in ``edges_within``, which takes the words heard as arrays.
    """
    word = F.struct("pos", "start", "end", "word")
    lists = heard.where(is_word(word)).groupBy("key").agg(*[F.sort_array(F.collect_list(F.when(F.col("side") == s, word))).alias(s) for s in ("begin", "end")])
    # merged, as the planner takes the lists for as small as the rows in their files and would send them whole to every executor
    return edges_within(texts.join(lists.hint("merge"), "key", "left"), compat).select("key", "start", "end", "first_word", "last_word")


def cropped_text(words: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(words, first + 1, F.greatest(last - first + 1, F.lit(0))), " ")


def grammar(words: Column) -> Column:
    """Alternatives of a recognition grammar."""
    return F.array_join(words, " | ")


def pronunciations(words: DataFrame, dictionary: DataFrame, fallback: DataFrame) -> DataFrame:
    """(word, phonemes): from the dictionary, else from the fallback transcriptions; null if neither has it."""
    f = fallback.select("word", F.col("phonemes").alias("guess"))
    return words.select("word").distinct().join(dictionary.select("word", "phonemes"), "word", "left").join(f, "word", "left").select("word", F.coalesce("phonemes", "guess").alias("phonemes"))


def mapped_phonemes(transcribed: DataFrame, conversion: DataFrame) -> DataFrame:
    """(word, phonemes): transcriptions (word, ipa) with symbols joined by '_' mapped through conversion (espeak, cmu); unknown symbols make the word null."""
    # Symbols rewritten before the split; stress marks are dropped and blanks separate symbols.
    plain = F.regexp_replace(F.replace(F.replace("ipa", F.lit("aɪ"), F.lit("a_j")), F.lit("v"), F.lit("ʋ")), "[ˈˌ]", "")
    each = transcribed.select("word", F.posexplode(F.filter(F.split(F.translate(plain, " ", "_"), "_"), lambda s: s != "")).alias("pos", "espeak"))
    table = conversion.where("espeak is not null and espeak != ''").groupBy("espeak").agg(F.max("cmu").alias("cmu"))
    got = each.join(table, "espeak", "left").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("pos", "cmu"))).alias("p"), F.count("*").alias("n"), F.count("cmu").alias("known"))
    return got.select("word", F.when(F.col("n") == F.col("known"), F.array_join(F.transform("p", lambda x: x["cmu"]), " ")).alias("phonemes"))

"""One consistent form for texts that look the same but differ in their characters.

DuckDB runs inside the Arrow partitions: styled forms and blanks by ``translate``, ligatures and invisible
characters by regular expressions, accents by ``nfc_normalize``, look-alike letters by ``translate`` within
words that also hold Latin letters. One pass over the texts, no shuffle; memory is one Arrow batch a task.

Defined results: a null text gives no row, an empty one stays as it is; texts are processed whole; repeated
rows give repeated rows; marks without a composed form stay, and the text counts as a case. Greek or
Cyrillic words, and signs such as the short units with a Greek letter, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.forms import BLANKS, LOOKALIKES, invisible, styled

FLAGS = ["styled", "combining", "invisible", "blank", "lookalike"]
SCHEMA = "source_table string, row_id bigint, entry_no int, clean_text string, " + ", ".join(f"{f} boolean" for f in FLAGS)
#: A character that no consistent text of these languages needs, or that needs a closer look; texts without one are consistent.
SUSPECT = r"[^\x{20}-\x{7E}\n\r\x{A1}-\x{AC}\x{AE}-\x{FF}\x{2010}-\x{2023}\x{2026}]"
#: Units written with a Greek letter and a Latin one are signs, not disguised words.
UNITS = r"[μΩΔσπλ]\p{Latin}{1,2}|[kMGm]Ω"


def _class(chars: str) -> str:
    """An RE2 character class of ``chars``, as ranges of code points."""
    points, out = sorted(map(ord, chars)), []
    for o in points:
        if out and o == out[-1][1] + 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return "[" + "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in out) + "]"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def macros() -> dict[str, str]:
    """SQL expressions over a text ``t``: one flag each, and ``clean``."""
    single = {k: v for k, v in styled().items() if len(v) == 1}
    several = {k: v for k, v in styled().items() if len(v) > 1}
    look, like = "".join(LOOKALIKES), "".join(LOOKALIKES.values())
    alone = rf"(^|[^\p{{L}}\p{{M}}])(?:{UNITS})([^\p{{L}}\p{{M}}]|$)"
    other, word = r"[\p{Greek}\p{Cyrillic}]", r"[\p{L}\p{M}]+"
    spelled = f"translate(t, {_text(''.join(single))}, {_text(''.join(single.values()))})"
    # Forms that stand for several characters are looked up one by one, in the texts that have any.
    runs, keys, values = _text(f"{_class(''.join(several))}|{_class(''.join(several)).replace('[', '[^', 1)}+"), f"[{', '.join(map(_text, several))}]", f"[{', '.join(map(_text, several.values()))}]"
    one_by_one = f"array_to_string(list_transform(regexp_extract_all({spelled}, {runs}), lambda w: coalesce(list_extract({values}, list_position({keys}, w)), w)), '')"
    spelled = f"CASE WHEN regexp_matches(t, {_text(_class(''.join(several)))}) THEN {one_by_one} ELSE {spelled} END"
    shown = f"regexp_replace(regexp_replace({spelled}, {_text(_class(invisible()))}, '', 'g'), {_text(_class(BLANKS))}, ' ', 'g')"
    nfc = f"nfc_normalize({shown})"
    mixed = rf"{other}\p{{M}}*\p{{Latin}}|\p{{Latin}}\p{{M}}*{other}"
    return {
        "styled": f"regexp_matches(t, {_text(_class(''.join(styled())))})",
        "combining": r"regexp_matches(t, '\p{L}\p{Mn}')",
        "invisible": f"regexp_matches(t, {_text(_class(invisible()))})",
        "blank": f"regexp_matches(t, {_text(_class(BLANKS))})",
        # invisible characters and styled letters must not hide that a word is mixed
        "lookalike": f"regexp_matches(regexp_replace(n, {_text(alone)}, {_text(chr(92) + '1 ' + chr(92) + '2')}, 'g'), {_text(mixed)})",
        "nfc": nfc,
        "clean": f"""CASE WHEN regexp_matches(n, {_text(other)}) THEN nfc_normalize(array_to_string(list_transform(
            regexp_extract_all(n, {_text(word + '|[^' + chr(92) + 'p{L}' + chr(92) + 'p{M}]+')}), lambda w: CASE WHEN regexp_matches(w, {_text(mixed)}) AND NOT regexp_full_match(w, {_text(UNITS)})
            THEN translate(w, {_text(look)}, {_text(like)}) ELSE w END), '')) ELSE n END""",
    }


def _consistent(batches: Iterator[pa.RecordBatch], only_cases: bool) -> Iterator[pa.RecordBatch]:
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    m = macros()
    flags = ", ".join(f"{m[f]} AS {f}" for f in FLAGS)
    any_flag = " OR ".join(FLAGS)
    suspect = f"regexp_matches(t, {_text(SUSPECT)})"
    query = f"""SELECT source_table, row_id, entry_no, {m['clean']} AS clean_text, {', '.join(FLAGS)}
        FROM (SELECT *, {flags} FROM (SELECT *, {m['nfc']} AS n FROM b WHERE {suspect})) {f'WHERE {any_flag}' if only_cases else ''}"""
    if not only_cases:
        query += f" UNION ALL SELECT source_table, row_id, entry_no, t, {', '.join('false' for _ in FLAGS)} FROM b WHERE NOT {suspect}"
    for batch in batches:
        con.register("b", pa.Table.from_batches([batch]))
        out = con.sql(query).to_arrow_table()
        con.unregister("b")
        yield from out.cast(pa.schema([("source_table", pa.string()), ("row_id", pa.int64()), ("entry_no", pa.int32()), ("clean_text", pa.string()), *((f, pa.bool_()) for f in FLAGS)])).to_batches()


def consistent(texts: DataFrame, only_cases: bool = False) -> DataFrame:
    """(source_table, row_id, entry_no, t) -> the same keys, clean_text and a flag for each kind of disguise.

    With ``only_cases`` only the texts that needed a change; the filter runs inside DuckDB.
    """
    keyed = texts.select("source_table", F.col("row_id").cast("bigint").alias("row_id"), F.col("entry_no").cast("int").alias("entry_no"), "t").where("t is not null")
    return keyed.mapInArrow(lambda it: _consistent(it, only_cases), SCHEMA)

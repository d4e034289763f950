"""Transcript entries into clean, ordered speaker turns.

A finite-state line parser reads each record: time stamp, label, speech. Annotations and standalone fillers
are dropped, labels are resolved to the record's names or the chair, lines of one speaker are merged.

One record is one row, so nothing is shuffled; a task holds one Arrow batch of records.

Defined results: a null or empty list of entries gives no turns; null texts hold no speech; speech before any
label has the speaker null; a label that means none of the record's names starts a turn of its own under its
clean label; equal readings of several names go to the best score, then to the first name; repeated records
give repeated turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from sessionloom.llm.forms import canonical
from sessionloom.llm.names import compare, fold, inner, is_chair, read

CHAIR_SPEAKER = "mesa"
SCHEMA = "record_id bigint, turn_no int, speaker string, text string"
_CLOCK = r"(?:(\d{1,3}):)?(\d{1,3}):(\d{2})(?:[.,](\d{1,3}))?"
_STAMP = re.compile(rf"^\s*[\[(]?\s*(?:{_CLOCK}|(?:(\d+)\s*h\s*)?(\d+)\s*m\s*(\d+)\s*s)(?:\s*[\])])?(?:\s*-->\s*{_CLOCK.replace('(', '(?:').replace('(?:?:', '(?:')})?(?:\s+[-–—](?=\s|$))?\s*")
_INLINE = re.compile(r"\s+(?=(?:>>|[—–])\s*[^:\n]{2,}:)")
_LABEL = re.compile(r"^\s*(>>|[—–-]\s)?\s*([^:\n]{2,}?)\s*:(?=\s|$)\s*")
# Hesitations (after folding); letters may be held.
_FILLER_WORD = r"(?:e+h+m*|e+m{2,}|h+m{1,}|m{2,}h*|u+h+m*|u+m{1,}|a+h+m*|e{2,}h?|a{2,}h?)"
_FILLER = re.compile(rf"(?:,\s*|(?<![\w’'-])){_FILLER_WORD}(?![\w’'-])(?:\s*(?:…|\.\.\.|[,.]))?", re.I)
_NOTE = re.compile(r"</?[a-z]{1,3}>|\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|\*[^*\n]{1,40}\*|[♪♫♩♬]+", re.I)
_SPEECH = re.compile(r"[^\W_]")
# Given names of women that do not end in -a.
_WOMEN = {"agnes", "assumpcio", "carme", "concepcio", "consol", "dolors", "ester", "immaculada", "ingrid", "irene", "iris", "isabel", "judit", "llum", "merce", "montserrat", "neus", "noemi", "pilar", "queralt", "remei", "roser", "rut", "violant", "elisabet", "abril", "xell", "raquel"}


def stamp(text: str) -> tuple[float | None, str]:
    """Start time in seconds (None without a stamp) and the text after it."""
    m = _STAMP.match(text)
    if not m:
        return None, text
    h, mi, s, ms, h2, m2, s2 = m.groups()[:7]
    t = int(h or 0) * 3600 + int(mi) * 60 + int(s) + float(f"0.{ms or 0}") if mi else int(h2 or 0) * 3600 + int(m2) * 60 + int(s2)
    return float(t), text[m.end() :]


def speech(text: str) -> str:
    """The text without annotations and standalone fillers; empty if nothing is said."""
    t, n = text, 1
    while n:  # notes within notes, from the inside
        t, n = _NOTE.subn(" ", t)
    t = re.sub(r"<[^<>]{1,3}>", "", t)
    t = _FILLER.sub(" ", t)
    t = re.sub(r"\s+", " ", t).strip()
    t = re.sub(r"\s+([,.;:!?…])", r"\1", t)
    t = re.sub(r"^(?:[,;…]|\.\.\.|>>|[—–-]\s)+\s*", "", t)
    return t if _SPEECH.search(t) else ""


class Labels:
    """Resolves the labels of one record."""

    def __init__(self, names: list[str]) -> None:
        self.names = [(n, r) for n in dict.fromkeys(names) if (r := read(n))]
        self.known: dict[str, str | None] = {}

    def resolve(self, label: str) -> str | None:
        if label not in self.known:
            self.known[label] = self._resolve(label)
        return self.known[label]

    def _resolve(self, label: str) -> str | None:
        r = read(label)
        if r is None:
            return CHAIR_SPEAKER if is_chair(label) else None
        found = []
        for k, (name, full) in enumerate(self.names):
            link = compare(r, full) or compare(full, r)
            if link:
                exact = all(t in full.tokens for t in r.tokens)
                found.append((link.kind == "same", exact, self._gender(label, full.tokens[0]), link.score, -k, name))
        return max(found)[-1] if found else None

    @staticmethod
    def _gender(label: str, given: str) -> bool:
        title = fold(label).split(" ")[0].rstrip(".")
        woman = given.endswith("a") or given in _WOMEN
        return title not in ("sr", "sra") or (title == "sra") == woman


def pieces(speaker: str | None, text: str, labels: Labels) -> Iterator[tuple[str | None, str]]:
    """(label or None, raw speech) of an entry, label by label; the state is the label in force."""
    state = speaker if speaker and fold(speaker) else None
    held: list[str] = []
    for line in _INLINE.sub("\n", text).split("\n"):
        m = _LABEL.match(line)
        who = m and (labels.resolve(m[2]) or (inner(m[2]) if m[1] == ">>" else None))
        if who:
            yield state, " ".join(held)
            state, held, line = m[2], [], line[m.end() :]
        held.append(line)
    yield state, " ".join(held)


def turns(entries: list[tuple[str | None, str | None]], names: list[str]) -> list[tuple[str | None, str]]:
    """(speaker, clean text) of the turns of one record, in order."""
    labels = Labels(names)
    read_entries = [(*stamp(canonical(t or "")), s) for s, t in entries]
    if read_entries and all(at is not None for at, _, _ in read_entries):
        read_entries.sort(key=lambda e: e[0])
    out: list[tuple[str | None, list[str]]] = []
    for _, text, label in read_entries:
        for who, raw in pieces(canonical(label) if label else None, text, labels):
            said = speech(raw)
            if not said:
                continue
            name = None if who is None else labels.resolve(who) or inner(who) or re.sub(r"\s+", " ", who).strip(" :")
            if who is None and out:
                name = out[-1][0]
            if out and out[-1][0] == name:
                out[-1][1].append(said)
            else:
                out.append((name, [said]))
    return [(s, " ".join(t)) for s, t in out]


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for record_id, text, urls in zip(b["record_id"], b["text"], b["urls"], strict=True):
            names = [n for u in (urls if urls is not None else []) if u is not None and u["names"] is not None for n in u["names"] if n]
            entries = [(e["speaker"], e["text"]) for e in (text if text is not None else []) if e is not None]
            rows += [(record_id, k, s, t) for k, (s, t) in enumerate(turns(entries, names), 1)]
        yield pd.DataFrame(rows, columns=["record_id", "turn_no", "speaker", "text"])


def speaker_turns(records: DataFrame) -> DataFrame:
    """(record_id, text, urls) -> (record_id, turn_no, speaker, text)."""
    return records.select("record_id", "text", "urls").where("text is not null").mapInPandas(_parse, SCHEMA)

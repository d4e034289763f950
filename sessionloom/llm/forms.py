"""Which characters only look like others, and what they stand for.

The tables are built by rule from the Unicode character database, except the look-alike letters.
"""

from __future__ import annotations

import functools
import re
import unicodedata

# Letters of other scripts that look like Latin ones, each below the letter it resembles.
LOOKALIKE_CYRILLIC = "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ"
LATIN_OF_CYRILLIC = "ABESIJKMHOPCTYXaesijopcyxhdqw"
LOOKALIKE_GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϳυι"
LATIN_OF_GREEK = "ABEZHIKMNOPTYXovjui"
# Blanks other than the ordinary one and the line break.
BLANKS = "\t\x0b\x0c\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Invisible characters outside the format category.
INVISIBLE_EXTRA = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
SOFT_HYPHEN = "\xad"
#: Decomposition tags of forms that are the same letter, digit or mark in another style.
STYLE_TAGS = {"<wide>", "<narrow>", "<font>", "<circle>", "<square>", "<small>", "<vertical>"}


def _plain(ch: str) -> str | None:
    """What a styled form or ligature stands for, None for any other character."""
    parts = unicodedata.decomposition(ch).split()
    if not parts or parts[0][0] != "<" or ch in INVISIBLE_EXTRA or ch in BLANKS:
        return None
    to = unicodedata.normalize("NFKC", ch)
    if parts[0] in STYLE_TAGS:
        return to
    letters = unicodedata.category(ch).startswith("L") and "LATIN" in unicodedata.name(ch, "") and all(c.isalpha() or c == "·" for c in to)
    return to if parts[0] == "<compat>" and letters and len(to) > 1 else None


@functools.cache
def styled() -> dict[str, str]:
    """Every styled form and ligature of the Unicode database."""
    return {chr(o): p for o in range(0x80, 0x110000) if (p := _plain(chr(o))) is not None}


@functools.cache
def invisible() -> str:
    """Format characters but the soft hyphen, variation selectors, and control characters that are no blanks or line breaks."""
    every = (chr(o) for a, b in ((0, 0x2FFF), (0xFE00, 0xFFFB), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0001, 0xE01EF)) for o in range(a, b + 1))
    hidden = [c for c in every if unicodedata.category(c) in ("Cf", "Cc") or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF]
    return "".join(c for c in hidden if c not in BLANKS + SOFT_HYPHEN + "\n\r" and not 0x600 <= ord(c) <= 0x605) + INVISIBLE_EXTRA




def _accented(pairs: dict[str, str]) -> dict[str, str]:
    """The look-alikes and their composed forms with one accent."""
    out = dict(pairs)
    for a, b in pairs.items():
        for mark in "\u0300\u0301\u0302\u0303\u0308\u0327":
            x, y = unicodedata.normalize("NFC", a + mark), unicodedata.normalize("NFC", b + mark)
            if len(x) == len(y) == 1:
                out[x] = y
    return out


LOOKALIKES = _accented(dict(zip(LOOKALIKE_CYRILLIC + LOOKALIKE_GREEK, LATIN_OF_CYRILLIC + LATIN_OF_GREEK, strict=True)))
_WORD = re.compile("(?:[^\\W\\d_][\u0300-\u036f]*)+")
_LATIN = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u1e00-\u1eff]")
_OTHER = re.compile("[Ͱ-ϿЀ-ԯ]")
_SUSPECT = re.compile("[^\x20-\x7e\n\xa1-\xac\xae-\xff‐-‧]")


@functools.cache
def _table() -> dict[int, str | None]:
    return {ord(k): v for k, v in styled().items()} | {ord(c): " " for c in BLANKS} | {ord(c): None for c in invisible()}


def _latin_word(m: re.Match) -> str:
    w = m[0]
    return "".join(LOOKALIKES.get(c, c) for c in w) if _OTHER.search(w) and _LATIN.search(w) else w


def canonical(text: str) -> str:
    """The consistent form of a text, in Python, for operators that parse texts anyway."""
    if not _SUSPECT.search(text):
        return text
    text = unicodedata.normalize("NFC", text.translate(_table()))
    return unicodedata.normalize("NFC", _WORD.sub(_latin_word, text)) if _OTHER.search(text) else text

"""Reading names as people type them, and comparing two readings.

A reading is a sequence of folded tokens without titles, offices, groups and connectors. Tokens are compared
by the longest common subsequence.
"""

from __future__ import annotations

import functools
import os.path
import re
import unicodedata
from dataclasses import dataclass

from sessionloom.llm.forms import canonical

# Words of offices; a text that begins with an article and holds no name in brackets is an office or an unnamed group.
ARTICLES = ("el", "la", "els", "les", "l", "un", "una", "uns", "unes", "los", "las", "lo", "the", "diversos", "diverses", "alguns", "algunes", "varios", "varias", "several")
CHAIR = ("president", "presidenta", "presidente", "vicepresident", "vicepresidenta", "vicepresidente")
OFFICES = (*CHAIR, "mesa", "secretari", "secretaria", "secretario", "conseller", "consellera", "consejero", "consejera", "diputat", "diputada", "diputats", "diputades", "diputado", "diputados", "portaveu", "ministre", "ministra", "lletrat", "lletrada", "interventor", "interventora", "public", "orador", "oradora", "compareixent", "member", "speaker", "members")
TITLES = {"sr", "sra", "srta", "srs", "sres", "senyor", "senyora", "senor", "senora", "don", "dona", "dr", "dra", "hble", "mr", "mrs", "ms", "il·lm", "ilm", "excm", "molt"}
CONNECTORS = {"i", "y", "e", "and", "de", "d", "del", "dels", "la", "l", "el", "els", "les", "los", "las", "per", "a", "al", "als", "of", "the"}
# Hypocoristics that no clipping or diminutive explains.
HYPOCORISTICS = {
    "berto": "albert", "biel": "gabriel", "cati": "caterina", "cento": "vicenç", "cesc": "francesc", "chelo": "consol", "cinta": "jacinta", "conxa": "concepció", "conxita": "concepció",
    "laia": "eulàlia", "lali": "eulàlia", "lola": "dolors", "loles": "dolors", "maite": "maria teresa", "manel": "manuel", "manolo": "manuel", "mari": "maria",
    "merxe": "mercè", "mila": "milagros", "mingo": "domènec", "nando": "ferran", "nuri": "núria", "paco": "francesc", "pep": "josep", "pepa": "josepa", "pepe": "josep",
    "pitu": "josep", "rafel": "rafael", "sisco": "francesc", "siscu": "francesc", "tavi": "octavi", "txell": "meritxell", "uri": "oriol", "ximo": "joaquim", "xesc": "francesc",
}


LEAST = 0.6  # the least ratio of two tokens that may be one


def fold(s: str) -> str:
    """Canonical characters, lower case, no accents, single blanks."""
    s = unicodedata.normalize("NFKD", canonical(s).replace("’", "'").replace("·", "").lower())
    return re.sub(r"\s+", " ", "".join(c for c in s if not unicodedata.combining(c))).strip()


def lcs(a: str, b: str) -> int:
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


def ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


@dataclass(frozen=True)
class Reading:
    tokens: tuple[str, ...]
    titled: bool = False  # a title stands where the given name is missing
    organisation: bool = False

    @property
    def core(self) -> str:
        return " ".join(self.tokens)


_TOKEN = re.compile(r"[^\W_]+(?:\.(?=\s|$|,|-))?")
_BRACKETS = re.compile(r"^(.*?)\s*\(([^()]*)\)\s*(.*)$")


def _is_office(folded: str) -> bool:
    words = re.findall(r"[^\W\d_]+", folded)
    article = bool(words) and words[0] in ARTICLES and (len(words[0]) > 1 or folded[1:2] == "'")
    return article or bool(words) and words[0] in OFFICES


def is_chair(label: str) -> bool:
    """An office of the chair: president, vice-president or mesa, with an ordinal or the chamber's name."""
    words = re.findall(r"[^\W\d_]+", fold(label))
    while words and words[0] in (*ARTICLES, *TITLES, "honorable"):
        words = words[1:]
    if not words or words[0] not in (*CHAIR, "mesa"):
        return False
    return all(w in CONNECTORS or w in ("primer", "primera", "primero", "segon", "segona", "segundo", "segunda", "tercer", "tercera", "quart", "quarta", "parlament", "parlamento", "cambra", "camara", "mesa", "edat", "edad", "accidental", "funcions", "en") for w in words[1:])


def inner(name: str) -> str | None:
    """The name proper: without group, office and final colon; None for offices and unnamed groups."""
    s = re.sub(r"\s+", " ", canonical(name)).split("|")[0].strip().rstrip(":").strip()
    m = _BRACKETS.match(s)
    if m:
        s = m[2] if _is_office(fold(m[1])) else f"{m[1]} {m[3]}".strip()
    return s if s and not _is_office(fold(s)) else None


@functools.lru_cache(maxsize=100_000)
def read(name: str) -> Reading | None:
    """The reading of a name; None for blanks, offices and unnamed groups."""
    s = inner(name)
    if s is None:
        return None
    if s.count(",") == 1:
        last, first = s.split(",")
        s = f"{first.strip()} {last.strip()}"
    upper = s.split(" ")[0]
    f = fold(s)
    words = _TOKEN.findall(f.replace("-", " ").replace("'", " "))
    of = any(w in ("de", "d", "del", "dels", "of") for w in words[1:])
    acronym = 2 <= len(upper) <= 5 and upper.isupper() and upper.isalpha() and upper.lower() not in TITLES and s != s.upper()
    titled = False
    while words and words[0].rstrip(".") in TITLES:
        words, titled = words[1:], True
    titled = titled and sum(w not in CONNECTORS for w in words) <= 2
    raw = _TOKEN.findall(s.replace("·", "").replace("-", " ").replace("'", " ").replace("’", " "))
    if s not in (s.lower(), s.upper()) and len(raw) >= len(words):  # a small word in lower case is a connector, even misspelt
        small = [r.islower() and (len(r) == 1 or len(r) <= 4 and any(ratio(r, c) >= (0.5 if r[0] == c[0] else 0.6) for c in ("de", "del", "dels", "la", "les", "els", "per"))) for r in raw[len(raw) - len(words) :]]
        words = [w for w, drop in zip(words, small, strict=True) if not drop]
    tokens = tuple(w.rstrip(".") if len(w) == 2 else w for w in words if w.rstrip(".") not in CONNECTORS or len(w.rstrip(".")) == 1 and w.endswith("."))
    return Reading(tokens, titled, of or acronym) if tokens else None


def abbreviates(short: str, long: str) -> bool:
    """An initial, or a shortening with a point: the same first letter and the other letters in order."""
    if not short or not long or short[0] != long[0]:
        return False
    if len(short) == 1:
        return True
    return short.endswith(".") and lcs(short[:-1], long) == len(short) - 1 and len(short) - 1 < len(long)


@functools.lru_cache(maxsize=50_000)
def short_for(short: str, long: str) -> bool:
    """Whether ``short`` is a familiar form of the given name ``long``: clipped, a diminutive, or a known one."""
    if len(short) >= 3 and " " not in short + long and len(short) < len(long) and (long.startswith(short) or long.endswith(short)):
        return True
    known = HYPOCORISTICS.get(short)
    if known and (fold(known) == long or fold(known) in long.split(" ")):
        return True
    first = long.split(" ")[0]
    for ending in ("etes", "eta", "ets", "et", "ina", "ita", "ito"):
        stem = short.removesuffix(ending)
        shared = len(os.path.commonprefix([stem, first]))
        if stem != short and len(stem) >= 3 and shared >= max(3, min(len(stem), len(first)) - 1):
            return True
        if ending == "et" and stem != short and f"{long}et".endswith(short):
            return True
    # Another ending on a clipped name, always shorter than the name: Assumpta, Berto.
    stem = short[:-1]
    if len(short) < len(long) and short[-1] in "aeiou" and len(stem) >= 4:
        return long.endswith(stem) or len(os.path.commonprefix([stem, first])) >= max(5, len(stem) - 1)
    return False


def given_match(a: str, b: str) -> bool:
    """Given names (perhaps of several tokens) that may be one: initials of parts, or a familiar form."""
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and all(p == q or abbreviates(p, q) or abbreviates(q, p) or short_for(p, q) or short_for(q, p) for p, q in zip(x, y, strict=True)):
        return True
    if (len(x) == 1) != (len(y) == 1):
        one, more = (x[0], y) if len(x) == 1 else (y[0], x)
        return abbreviates(one, more[0]) and len(one) == 1 or short_for(one, " ".join(more)) or any(one == w or short_for(one, w) for w in more)
    return False


def slip(a: str, b: str) -> bool:
    """One letter lost or doubled in a long word, too small a difference for two words of one name."""
    return min(len(a), len(b)) >= 5 and "." not in (a[-1], b[-1]) and len(a) + len(b) - 2 * lcs(a, b) <= 1


def typo(a: str, b: str, least: float) -> bool:
    """Two letters wrong, lost, added or swapped at most; short words may differ more in proportion."""
    if min(len(a), len(b)) < 2 or "." in (a[-1], b[-1]):
        return False
    off = len(a) + len(b) - 2 * lcs(a, b)
    return off <= 4 and 1 - off / (len(a) + len(b)) >= (least if max(len(a), len(b)) <= 5 else least + 0.1)


@dataclass(frozen=True)
class Link:
    kind: str  # same: both name the whole; part: the first leaves something out
    score: float


def compare(a: Reading, b: Reading, rare=lambda s, t: True, least: float = LEAST, total: float = 0.86) -> Link | None:
    """How ``a`` may name what ``b`` names. ``rare(s, t)``: two tokens may be one word in spite of their spelling.

    Tokens pair in order. A token may be misspelt, an initial or an abbreviation; a given name may be a familiar
    form; a person's given name (after a title) or second surname may be missing in ``a``.
    """
    s, t = a.tokens, b.tokens
    score = ratio(a.core, b.core)
    if a.organisation or b.organisation:
        return _organisations(s, t, rare, least, score) if len(s) > 1 or len(t) > 1 else None
    if not s or not t:
        return None

    def word(p: str, q: str) -> bool:
        return p == q or slip(p, q) or typo(p, q, least) and rare(p, q)

    def near(p: tuple[str, ...], q: tuple[str, ...]) -> float:
        return ratio(" ".join(p), " ".join(q))

    def surnames(ps: tuple[str, ...], qs: tuple[str, ...]) -> str | None:
        """'same', 'part' (an initial stands for a surname), or None."""
        kind = "same"
        for p, q in zip(ps, qs, strict=True):
            if not word(p, q):
                if not (len(p) == 1 and abbreviates(p, q)):
                    return None
                kind = "part"
        return kind

    if a.titled and len(s) <= 2:  # "Sr. A i B", "Sr. A"
        if len(t) < 2 or b.titled and len(t) == len(s):
            return Link("same", score) if s == t else None
        tail = t[-2:] if len(t) > 2 else t[-1:]
        k = surnames(s, tail[: len(s)]) if len(s) <= len(tail) else None
        return Link("part", near(s, tail[: len(s)])) if k else None
    if b.titled and len(t) <= 2 or len(t[0]) == 1 and len(s[0]) > 1:
        return None  # then b leaves out more than a does
    for given_len in range(1, max(2, len(t) - 1)):
        g, rest = " ".join(t[:given_len]), t[given_len:]
        for own in range(1, len(s)):
            h, mine = " ".join(s[:own]), s[own:]
            if not mine or len(mine) > len(rest) or len(rest) > 2 or own > given_len and len(mine) < 2:
                continue
            k = surnames(mine, rest[: len(mine)])
            if k is None:
                continue
            initial = len(s[0]) == 1
            if h == g or given_match(h, g):
                whole = k == "same" and len(mine) == len(rest) and not initial
                return Link("same", score) if whole else Link("part", near(mine, rest[: len(mine)]))
            exact = mine == rest
            if own == given_len and score >= total and all(word(p, q) or exact and ratio(p, q) >= least and rare(p, q) for p, q in zip(s[:own], t[:given_len], strict=True)):
                return Link("same", score) if k == "same" and len(mine) == len(rest) else Link("part", near(mine, rest[: len(mine)]))
    return None


_FULL = {short: fold(name).split(" ") for short, name in HYPOCORISTICS.items()}


def _may_shorten(short: str, long: str) -> bool:
    """False only where neither ``abbreviates`` nor ``short_for`` holds; cheaper than both."""
    return short[0] == long[0] or short in _FULL or long.endswith((short, short[:-1])) or f"{long}et".endswith(short)


@functools.lru_cache(maxsize=500_000)
def _related(p: str, q: str) -> bool:
    """Whether two tokens of given names may match in any way that ``compare`` allows."""
    if p == q or ratio(p, q) >= LEAST:
        return True
    return any(_may_shorten(a, b) and (abbreviates(a, b) or short_for(a, b)) or b in _FULL.get(a, ()) for a, b in ((p, q), (q, p)))


def comparable(a: Reading, b: Reading) -> bool:
    """False only where ``compare`` finds no link in either direction: persons without related given names,
    organisations of unrelated words."""
    s, t = a.tokens, b.tokens
    if a.organisation or b.organisation:
        if len(s) == len(t):
            return all(_related(p, q) for p, q in zip(s, t, strict=True))
        few, many = (s, t) if len(s) < len(t) else (t, s)
        k = len(many) - len(few) + 1
        return few[0] == "".join(w[0] for w in many[:k])
    if a.titled or b.titled:
        return True
    if min(len(s), len(t)) < 2:
        return False
    given = lambda x, y: x[: max(1, len(x) - (1 if len(x) < len(y) else 2))]
    return any(_related(p, q) for p in given(s, t) for q in given(t, s))


def _organisations(s: tuple[str, ...], t: tuple[str, ...], rare, least: float, score: float) -> Link | None:
    """Words pair in order; abbreviations count, and an acronym may stand for the first words."""
    def words(p: tuple[str, ...], q: tuple[str, ...]) -> bool:
        return len(p) == len(q) and all(x == y or abbreviates(x, y) or abbreviates(y, x) or slip(x, y) or typo(x, y, least) and rare(x, y) for x, y in zip(p, q, strict=True))

    if len(s) == len(t):
        off = sum(x != y for x, y in zip(s, t, strict=True))
        return Link("same", score) if off <= max(1, len(s) - 1) and words(s, t) else None
    few, many = (s, t) if len(s) < len(t) else (t, s)
    k = len(few[0])
    if k > 1 and k == len(many) - len(few) + 1 and few[0] == "".join(w[0] for w in many[:k]) and words(few[1:], many[k:]):
        return Link("same", score)
    return None

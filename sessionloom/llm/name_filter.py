"""Which pairs of readings of one block may be linked at all, by bit operations on whole arrays.

Each test is a necessary condition of ``names.compare`` (a comparison of every pair in the tests checks that), so the pairs
that pass are compared in full and no link is lost. Two tokens that may be one word differ in at most four letters
lost or added; then their bags of letters differ in as many, and that is one XOR and one count of bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np

from sessionloom.llm.names import HYPOCORISTICS, LEAST, Reading

OFF = 4  # the most letters in which two spellings of a token differ, see names.typo
CELLS = 1 << 17  # pairs tested at a time: their bits stay in the cache
KINDS = TWO, THREE, FOUR, TITLED, OTHER, ORGANISATION = range(6)
_KNOWN = set(HYPOCORISTICS)


def bag(token: str) -> int:
    """Letters with their counts up to two, in unary: one letter more or less changes one bit at most."""
    bits = 0
    for c in token:
        k = ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 6
        low = 1 << 2 * k
        bits |= low << 1 if bits & low else low
    return bits


def rare(low, high):
    """Whether a token of document frequency ``low`` may be a misspelling of one of frequency ``high``; two established spellings are two words."""
    return (low <= 1) | (low <= 3) & (2 * low <= high) | (10 * low <= high)


def kind(r: Reading) -> int:
    n = len(r.tokens)
    if r.organisation:
        return ORGANISATION
    if r.titled:
        return TITLED if n == 2 else OTHER
    return {2: TWO, 3: THREE, 4: FOUR}.get(n, OTHER)


class Side:
    """Readings of one kind, by the tokens at the places that ``compare`` pairs: the first, the last but one, the last."""

    def __init__(self, at: Sequence[int], readings: Sequence[Reading], counts: Mapping[str, int]) -> None:
        self.at = np.asarray(at)
        tokens = [readings[k].tokens for k in at]
        self.n = np.array([len(t) for t in tokens])
        self.given = _given([t[0] for t in tokens])
        self.places = {k: _place([t[k] if len(t) >= max(-k, 1) else "" for t in tokens], counts) for k in (0, -2, -1)}


def _place(tokens: list[str], counts: Mapping[str, int]) -> tuple[np.ndarray, ...]:
    """Bag, first letter (0: no token), whether it may be short for another token, length, and document frequency."""
    short = [len(t) == 1 or t.endswith(".") for t in tokens]
    bags, letters = np.array([bag(t) for t in tokens], np.uint64), np.array([ord(t[0]) if t else 0 for t in tokens], np.uint32)
    return bags, letters, np.array(short, bool), np.array([len(t) for t in tokens]), np.array([counts.get(t, 1) for t in tokens])


def _given(tokens: list[str]) -> tuple[np.ndarray, ...]:
    """Of given names: a known familiar form, the first three letters, the last and the last but one, and the ending 'et'."""
    code = lambda s: sum(ord(c) << 21 * k for k, c in enumerate(s))
    letter = lambda k: np.array([ord(t[-k]) if len(t) >= k else 0 for t in tokens], np.uint32)
    return np.array([t in _KNOWN for t in tokens], bool), np.array([code(t[:3]) if len(t) > 2 else 0 for t in tokens], np.uint64), letter(1), letter(2), np.array([t.endswith("et") for t in tokens], bool)


def _near(a: tuple, b: tuple, least: float | None = None) -> np.ndarray:
    """Whether two tokens may be one word, or one an initial or abbreviation of the other; no token is near none.

    With ``least`` also by the ratio that ``names.typo`` asks for, and by the frequencies: two frequent tokens are two words."""
    (p, f, s, m, x), (q, g, t, n, y) = a, b
    off = np.bitwise_count(p ^ q)
    near = off <= OFF
    if least is not None:
        near &= (off <= 1) | rare(np.minimum(x, y), np.maximum(x, y)) & (off <= (1 - np.where(np.maximum(m, n) <= 5, least, least + 0.1)) * (m + n) + 1e-9)
    if s.any() or t.any():
        near |= (f == g) & (s | t)
    if not (f.all() and g.all()):
        near &= (f != 0) & (g != 0)
    return near


def _related(a: tuple, b: tuple, g: list[np.ndarray], h: list[np.ndarray]) -> np.ndarray:
    """Whether two given names may be related (``names._related``): known, alike, an initial or abbreviation, of the same
    three first letters, or one the end of the other, perhaps but for its own ending."""
    (p, f, s, m, _), (q, e, t, n, _) = a, b
    alike = np.bitwise_count(p ^ q) <= (1 - LEAST) * (m + n) + 1e-9

    def ends(p: np.ndarray, g: list[np.ndarray], q: np.ndarray, h: list[np.ndarray]) -> np.ndarray:
        return (np.bitwise_count(p & ~q) <= 2) & (g[4] | (g[2] == h[2]) | (g[3] == h[2]))

    return g[0] | h[0] | alike | (f == e) & (s | t) | (g[1] == h[1]) & (g[1] != 0) | ends(p, g, q, h) | ends(q, h, p, g)


def _tests(x: int, y: int) -> list[tuple[tuple[int, int], ...]] | None:
    """Places of persons' tokens: of each list of pairs, one must be near; None: never linked."""
    if OTHER in (x, y):
        return [((-1, -1), (-1, -2), (-2, -1))]
    if x == y == TWO:
        return [((-1, -1),)]
    if TWO in (x, y):  # the last surname is missing in one
        return None if TITLED in (x, y) else [((-1, -2),)] if x == TWO else [((-2, -1),)]
    if {x, y} == {THREE, FOUR}:  # two surnames, or two given names and a surname
        less = (-1, -2) if x == THREE else (-2, -1)
        return [((-2, -2), less), ((-1, -1), less)]
    return [((-2, -2),), ((-1, -1),)]


def _pairs(a: Side, x: int, b: Side, y: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The first test on all pairs, in strips; the others on those that are left. A side with itself: each pair once."""
    organisations = ORGANISATION in (x, y)
    tests = [((0, 0),)] if organisations else _tests(x, y)
    if tests is None:
        return
    step = max(1, CELLS // len(b.at))
    for lo in range(0, len(a.at), step):
        start = lo if a is b else 0
        found = []
        for k, m in tests[0]:
            p, q = [v[lo : lo + step, None] for v in a.places[k]], [v[None, start:] for v in b.places[m]]
            found.append(p[1] == q[1] if organisations else _near(p, q))
            if organisations:
                found.append(_near(p, q))
        i, j = np.nonzero(found[0] if len(found) == 1 else np.logical_or.reduce(found))
        i, j = i + lo, j + start
        if a is b:
            i, j = i[i < j], j[i < j]

        def place(side: Side, k: int, at: np.ndarray) -> list[np.ndarray]:
            return [v[at] for v in side.places[k]]

        def keep(test: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return np.logical_or.reduce([_near(place(a, k, i), place(b, m, j), LEAST) for k, m in test])

        if organisations:
            # Words pair in order, or the first is an acronym of the first words of the other.
            m, n = a.n[i], b.n[j]
            f, g = place(a, 0, i), place(b, 0, j)
            acronym = (f[1] == g[1]) & (np.where(m < n, f[3], g[3]) == np.abs(m - n) + 1)
            at = np.where(m == n, _near(f, g, LEAST), acronym)
            i, j, m, n = i[at], j[at], m[at], n[at]
            ends, middle = keep(((-1, -1),), i, j), keep(((-2, -2),), i, j)
            at = np.where(m == n, ends & (middle | (m == 1)), ends | (np.minimum(m, n) == 1))
            i, j = i[at], j[at]
        else:
            for test in [*tests[1:], tests[0]]:
                at = keep(test, i, j)
                i, j = i[at], j[at]
            if x in (TWO, THREE) and y in (TWO, THREE):
                at = _related(place(a, 0, i), place(b, 0, j), [v[i] for v in a.given], [v[j] for v in b.given])
                i, j = i[at], j[at]
        yield a.at[i], b.at[j]


def _sides(readings: Sequence[Reading], counts: Mapping[str, int]) -> list[tuple[int, Side]]:
    kinds = np.array([kind(r) for r in readings])
    return [(k, Side(at, readings, counts)) for k in KINDS if len(at := np.flatnonzero(kinds == k))]


def candidates(mine: Sequence[Reading], others: Sequence[Reading] | None = None, counts: Mapping[str, int] = {}) -> Iterator[tuple[int, int]]:  # noqa: B006
    """The places (i, j) of the pairs of ``mine`` and ``others`` that may be linked; without ``others`` each pair of ``mine`` once.

    ``counts``: the document frequencies of the tokens; a token without one counts as rare."""
    left = _sides(mine, counts)
    right = left if others is None else _sides(others, counts)
    for x, a in left:
        for y, b in right:
            if others is None and y < x:
                continue
            for i, j in _pairs(a, x, b, y):
                yield from zip(i.tolist(), j.tolist(), strict=True)

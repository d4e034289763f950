"""Passages of evaluation items inside documents, whole or with a few edits.

Q-gram lemma filtering: items and documents are folded to words (letters and digits, no case, no accents, one
blank between words). Character q-grams are looked up in an index of the items; hits are counted in overlapping
diagonal bands (place in the document minus place in the item). An edit destroys q q-grams at most, so a passage
of ``words`` words, t characters with the blanks around it, keeps t - q + 1 - ``edits`` * q of them; q is lowered
until this bound is t / 4 or more for the shortest passage of the item (it is so at the latest for single letters,
with up to half as many edits as words). The q-grams kept differ by ``edits`` diagonals at most, so one of the
overlapping bands, each twice as wide, holds them all, and bands below the bound are dropped. The others are verified by banded alignment: passages without
edits are runs along a diagonal of the band, the rest is an alignment of all passages of the item within the band.

Scale: the items are indexed in blocks of some BLOCK_CHARS characters, by tasks, in the shared folder; a task reads one
block at a time. The documents are read once and folded once for all blocks, and never shuffled, and nothing
grows on the driver. Hits are held for ``CHUNK`` documents at a time.

Defined results: null texts and items match nothing; items of fewer than ``words`` words cannot leak; repeated
rows count once; a character that is no letter, digit or combining mark ends a word; the ends of a text end a word.
"""

from __future__ import annotations

import functools
import itertools
import pickle
import unicodedata
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.rolling import code_points, window_hashes
from sessionloom.tables import written

WORDS = 13
#: Edits that a passage may have; exact passages are a part of what is found.
EDITS = 1
BLOCK_CHARS = 8_000_000
CHUNK = 256
#: Lengths of q-grams, the longest that fits is taken.
GRAMS = (32, 24, 16, 12, 8, 6, 4, 3, 2, 1)
#: Read blocks of items that a worker keeps.
KEPT = 2
SPACE, DROP, END = 32, 0, 1


def _table() -> np.ndarray:
    """What each code point folds to: a letter or digit, SPACE, or DROP (combining marks)."""
    t = np.full(0x110000, SPACE, np.uint32)
    for o in range(0x80, 0x110000):
        if 0xD800 <= o < 0xE000:
            continue
        c = chr(o)
        kind = unicodedata.category(c)
        if kind[0] == "M":
            t[o] = DROP
        elif kind[0] == "L" or kind == "Nd":
            t[o] = o
    for o in range(0x80):
        if chr(o).isalnum():
            t[o] = ord(chr(o).lower())
    # Base letters in lower case; a letter that folds to several keeps the first, in items and documents alike.
    for o in range(0x80, 0x3000):
        c = chr(o)
        if t[o] == o:
            base = unicodedata.normalize("NFD", c.lower())
            t[o] = ord(base[0])
    for o in range(0x1F00, 0x2000):
        if t[o] != SPACE and t[o] != DROP:
            t[o] = ord(unicodedata.normalize("NFD", chr(o).lower())[0])
    return t


_FOLD: np.ndarray | None = None


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The folded code points of all texts, with END before the first and after each, and where each text starts (and the end)."""
    global _FOLD
    if _FOLD is None:
        _FOLD = _table()
    points, _ = code_points(["\x01", *(t + "\x01" for t in texts)])
    ends = points == END
    out = _FOLD[points]
    out[ends] = END
    out = out[out != DROP]
    gap = out <= SPACE
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1] & (out[1:] == SPACE)  # the first blank after a word
    keep |= out == END
    out = out[keep]
    # no blank before END
    drop = np.zeros(len(out), bool)
    drop[:-1] = (out[:-1] == SPACE) & (out[1:] == END)
    out = out[~drop]
    stops = np.nonzero(out == END)[0]
    return out, stops + 1


def word_starts(points: np.ndarray) -> np.ndarray:
    first = points > SPACE
    first[1:] &= points[:-1] <= SPACE
    return np.nonzero(first)[0]


@dataclass
class Index:
    """The q-grams of one block of items."""

    ids: np.ndarray
    points: np.ndarray
    starts: np.ndarray
    groups: list  # (q, bound by item, sorted hashes, their places)

    @functools.cached_property
    def filters(self) -> list[np.ndarray]:
        """Of each group: which leading bits of a hash occur."""
        out = []
        for _, _, hashes, _ in self.groups:
            bits = np.zeros(1 << 22, bool)
            bits[(hashes >> np.uint64(42)).astype(np.int64)] = True
            out.append(bits)
        return out


def blanked(points: np.ndarray) -> np.ndarray:
    """END as a blank, so that the ends of a text are those of words."""
    return np.maximum(points, SPACE)


def build(ids: list[int], texts: list[str], words: int, edits: int) -> Index:
    points, starts = folded(texts)
    groups: dict[int, list] = {}
    bounds: dict[int, np.ndarray] = {}
    at = word_starts(points)
    first_word, last_word = np.searchsorted(at, starts[:-1]), np.searchsorted(at, starts[1:])
    for k in range(len(ids)):
        w = at[first_word[k] : last_word[k]]
        if len(w) < words:
            continue
        stops = np.append(w[1:] - 1, starts[k + 1] - 1)  # the blank after each word
        shortest = int((stops[words - 1 :] - w[: len(w) - words + 1]).min()) + 2
        kept = lambda q: shortest - q + 1 - edits * q  # noqa: B023, E731
        q = next((q for q in GRAMS if kept(q) >= max(1, shortest / 4)), 1)
        bounds.setdefault(q, np.zeros(len(ids), np.int32))[k] = kept(q)
        groups.setdefault(q, []).append(np.arange(starts[k] - 1, starts[k + 1] - q + 1))
    made = []
    for q, places in groups.items():
        p = np.concatenate(places)
        h = window_hashes(blanked(points), q)
        order = np.argsort(h[p], kind="stable")
        p = p[order]
        made.append((q, bounds[q], h[p], p))
    return Index(np.asarray(ids, np.int64), points, starts, made)


def whole_words(a: np.ndarray, b: np.ndarray, words: int) -> bool:
    """Whether ``words`` consecutive whole words of ``b`` stand in ``a`` at the same places; both begin and end with a blank or END."""
    gap = (a <= SPACE) & (b <= SPACE)
    breaks = np.concatenate(([-1], np.nonzero((a != b) & ~gap)[0], [len(a)]))
    gaps = np.concatenate(([0], np.cumsum(gap)))
    longest = gaps[breaks[1:]] - gaps[breaks[:-1] + 1]
    return bool((longest > words).any())


def aligned(a: np.ndarray, b: np.ndarray, offset: int, width: int, words: int, edits: int) -> int:
    """The least edits, from 1 up to ``edits``, of a passage of ``words`` words of ``b`` in ``a``; ``edits`` + 1 if it takes more.

    Banded alignment of all passages at once: column j of row i is place i + offset + j - edits of ``a``, for j up
    to ``width`` + 2 * ``edits``. A passage begins and ends with the blank around it, so that words match whole; it may begin anywhere
    in the band.
    """
    at = word_starts(b)
    n = len(at) - words + 1
    begins, ends = at[:n] - 1, np.append(at[words:] - 1, len(b) - 1)[:n]
    columns = width + 2 * edits + 1
    padded = np.concatenate((np.full(edits + 1, END, a.dtype), a, np.full(columns + 1, END, a.dtype)))
    x, y = np.where(padded <= SPACE, SPACE, padded), np.where(b <= SPACE, SPACE, b)
    top = np.full((n, columns + 2), edits + 1, np.int16)
    row = top.copy()
    row[:, 1:-1] = 0
    out = np.full(n, edits + 1, np.int16)
    step = np.arange(columns + 2, dtype=np.int16)
    span = np.arange(columns)
    for k in range(int((ends - begins).max()) + 1):
        i = np.minimum(begins + k, len(b) - 1)
        places = np.clip(i[:, None] + (offset + 1) + span, 0, len(x) - 1)
        new = top.copy()
        new[:, 1:-1] = np.minimum(row[:, 1:-1] + (x[places] != y[i][:, None]), row[:, 2:] + 1)
        # a character of the document more: from the column before
        new = np.minimum.accumulate(new - step, axis=1) + step
        row = np.minimum(new, edits + 1)
        row[:, 0] = row[:, -1] = edits + 1
        done = begins + k == ends
        if done.any():
            out[done] = row[done, 1:-1].min(axis=1)
    return max(1, int(out.min()))


def find(index: Index, points: np.ndarray, starts: np.ndarray, words: int, edits: int) -> dict[tuple[int, int], int]:
    """(document number, item number) -> least edits, of the leaks among folded documents.

    Documents and items are folded with an END before the first.
    """
    found: dict[tuple[int, int], int] = {}
    step, plain = edits + 1, blanked(points)
    for (q, bounds, hashes, places), bits in zip(index.groups, index.filters, strict=True):
        h = window_hashes(plain, q)
        w = np.nonzero(bits[(h >> np.uint64(42)).astype(np.int64)])[0]
        hw = h[w]
        lo, hi = np.searchsorted(hashes, hw, "left"), np.searchsorted(hashes, hw, "right")
        n = hi - lo
        if not n.sum():
            continue
        d_place = np.repeat(w, n)
        offsets = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i_place = places[np.repeat(lo, n) + offsets]
        # the blank before a text is the end of the one before
        doc = np.searchsorted(starts - 1, d_place, "right") - 1
        item = np.searchsorted(index.starts - 1, i_place, "right") - 1
        # within its document and item, so that the bands of different ones don't touch
        diagonal = (d_place - starts[doc]) - (i_place - index.starts[item])
        # Band k holds 2 * step diagonals from k * step on, so every ``step`` neighbouring diagonals lie within one.
        band = diagonal // step
        doc, item, band = np.tile(doc, 2), np.tile(item, 2), np.concatenate((band, band - 1))
        order = np.lexsort((band, item, doc))
        keys = np.stack((doc, item, band), 1)[order]
        first = np.nonzero(np.concatenate(([True], np.any(keys[1:] != keys[:-1], axis=1))))[0]
        counts = np.diff(np.append(first, len(keys)))
        for k, i, g in keys[first[counts >= bounds[keys[first, 1]]]].tolist():
            if found.get((k, i), edits + 1) == 0:
                continue
            a, b = points[starts[k] - 1 : starts[k + 1]], index.points[index.starts[i] - 1 : index.starts[i + 1]]
            n = edits + 1
            for d in range(g * step, g * step + 2 * step):  # runs along the diagonals of the band
                lo_a, lo_b = max(0, d), max(0, -d)
                size = min(len(a) - lo_a, len(b) - lo_b)
                if size > 2 * words and whole_words(a[lo_a : lo_a + size], b[lo_b : lo_b + size], words):
                    n = 0
                    break
            if n and edits:
                n = aligned(a, b, g * step, 2 * step - 1, words, edits)
            if n <= edits:
                found[k, i] = min(n, found.get((k, i), n))
    return found


def _built(batches: Iterator[pa.RecordBatch], words: int, edits: int) -> Iterator[pa.RecordBatch]:
    """One index of all items of the partition."""
    ids, texts = [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        texts += batch.column(1).to_pylist()
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(build(ids, texts, words, edits), protocol=5)], pa.binary())], names=["block"])


_READ: OrderedDict[str, list[Index]] = OrderedDict()


def _blocks(path: str) -> list[Index]:
    """The indexes in one file of the shared folder (none where no item fell there); a worker keeps the last KEPT files."""
    from pyarrow import fs, parquet

    if path not in _READ:
        where, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
        _READ[path] = [pickle.loads(b) for b in parquet.read_table(inner, filesystem=where).column("block").to_pylist()]
        while len(_READ) > KEPT:
            _READ.popitem(last=False)
    return _READ[path]


def _search(batches: Iterator[pa.RecordBatch], paths: list[str], words: int, edits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        parts = [(at, *folded(texts[at : at + CHUNK])) for at in range(0, len(texts), CHUNK)]
        rows = []
        for path in paths:
            for index, (at, points, starts) in itertools.product(_blocks(path), parts):
                rows += [(int(index.ids[i]), ids[at + d], n) for (d, i), n in find(index, points, starts, words, edits).items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())], names=["item_id", "doc_id", "edits"])


def leaks(documents: DataFrame, items: DataFrame, words: int = WORDS, edits: int = EDITS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, text), (item_id, text) -> (item_id, doc_id, edits): the documents that hold ``words`` consecutive words of an
    item with at most ``edits`` inserted, lost or changed characters, and the fewest such edits."""
    known = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    sizes = known.agg(F.sum(F.length("text") + 2).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(sizes) // block_chars))
    built = written(known.repartition(blocks, "item_id").mapInArrow(lambda it: _built(it, words, edits), "block binary"), "leak-items")
    paths = built.inputFiles()
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    found = docs.mapInArrow(lambda it: _search(it, paths, words, edits), "item_id bigint, doc_id bigint, edits int")
    return found.groupBy("item_id", "doc_id").agg(F.min("edits").alias("edits"))

"""Documents into containers of fixed capacity, along a space-filling curve.

Each document's tokens are hashed to a random direction each; their mean, a hashed document vector, has ``DIMS``
dimensions. Documents are range-sorted by the Hilbert key of that vector, and each range is packed in the order
of the curve: ``CHUNK`` neighbours at a time, the longest first, each into the fullest open container it fits.

Scale and skew: texts are read once and not moved; only (doc_id, n_tokens, key) is written and range-sorted.
Equal keys are spread by a hash of the doc_id, so that copies do not crowd one range. A task keeps the open
containers of its last ``KEEP`` chunks. Each range leaves a few containers unfilled at its end.

Defined results: a document over the capacity is divided into full containers and a rest that is packed like any
other document; null texts are left out; empty texts take a place of 0 tokens; repeated rows count once;
capacities that are null or below 1 get no containers.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.tables import written

#: Vocabulary file of the tokenizer: lines of a base64 token and its rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the tokenizer's published configuration splits text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIMS, BITS = 4, 10
CHUNK, KEEP = 2048, 4


def tokenizer(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("containers", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Keys of the points ``cells`` (rows of coordinates below 2**bits) along the Hilbert curve.

    Skilling's transform: undo the excess work of the Gray code from the top bit down, then interleave.
    """
    x = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for k in range(n):
            hit = (x[k] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[k]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ swap)
            x[k] = x[k] ^ swap if k else x[0]
        q >>= 1
    for k in range(1, n):
        x[k] = x[k] ^ x[k - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for k in range(n):
            key = (key << 1) | (((x[k] ^ t) >> b) & 1)
    return key


def _measure(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoding, directions = tokenizer(path), None
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        if directions is None:
            directions = np.random.default_rng(11).standard_normal((encoding.n_vocab, DIMS)).astype(np.float32)
        sizes, means = np.zeros(len(texts), np.int32), np.zeros((len(texts), DIMS), np.float32)
        for k, t in enumerate(texts):
            tokens = encoding.encode_to_numpy(t, allowed_special="all")
            sizes[k] = len(tokens)
            if len(tokens):
                means[k] = directions[tokens].mean(axis=0)
        cells = np.clip((np.tanh(2 * means) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(hilbert(cells, BITS))], names=["doc_id", "n_tokens", "curve"])


def measured(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_tokens, curve)."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return docs.mapInArrow(lambda it: _measure(it, path), "doc_id bigint, n_tokens int, curve bigint")


class Packer:
    """Containers of one capacity, filled chunk by chunk."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next, self.age = capacity, first, 0
        self.open: list[tuple[int, int]] = []  # (room, container), least room first
        self.born: dict[int, int] = {}

    def _new(self, room: int) -> int:
        c, self.next = self.next, self.next + 1
        if room > 0:
            insort(self.open, (room, c))
            self.born[c] = self.age
        return c

    def chunk(self, docs: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
        """(container, doc_id, part, from, to) for each piece of the documents (doc_id, n_tokens)."""
        rest = []
        for doc, n in docs:
            part = 0
            while n - part * self.capacity > self.capacity:
                yield self._new(0), doc, part, part * self.capacity, (part + 1) * self.capacity
                part += 1
            rest.append((n - part * self.capacity, doc, part))
        for size, doc, part in sorted(rest, key=lambda r: (-r[0], r[1])):
            at = bisect_left(self.open, (size, -1))
            if at < len(self.open):
                room, c = self.open.pop(at)
                if room > size:
                    insort(self.open, (room - size, c))
                else:
                    del self.born[c]
            else:
                c = self._new(self.capacity - size)
            start = part * self.capacity
            yield c, doc, part, start, start + size
        self.age += 1
        kept = [(room, c) for room, c in self.open if self.born[c] > self.age - KEEP]
        self.born = {c: self.born[c] for _, c in kept}
        self.open = kept


def _pack(batches: Iterator[pa.RecordBatch], capacities: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 40
    packers = [(name, size, Packer(size, first)) for name, size in capacities]
    names = ["capacity_name", "container_id", "doc_id", "part_no", "token_from", "token_to"]

    def out(docs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        for name, _, packer in packers:
            rows = np.array(list(packer.chunk(docs)), np.int64).reshape(-1, 5)
            columns = [pa.array([name] * len(rows)), pa.array(rows[:, 0]), pa.array(rows[:, 1]), *(pa.array(rows[:, k].astype(np.int32)) for k in (2, 3, 4))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    held: list[tuple[int, int]] = []
    for batch in batches:
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        while len(held) >= CHUNK:
            yield from out(held[:CHUNK])
            held = held[CHUNK:]
    if held:
        yield from out(held)


def assigned(spark: SparkSession, documents: DataFrame, capacities: list[tuple[str, int]], path: str = VOCABULARY) -> DataFrame:
    """(capacity_name, container_id, doc_id, part_no, token_from, token_to): every document in a container of each capacity."""
    sizes = written(measured(documents, path), "document-sizes").distinct()
    ordered = sizes.withColumn("tie", F.xxhash64("doc_id")).repartitionByRange("curve", "tie").sortWithinPartitions("curve", "tie", "doc_id").select("doc_id", "n_tokens")
    schema = "capacity_name string, container_id bigint, doc_id bigint, part_no int, token_from int, token_to int"
    return ordered.mapInArrow(lambda it: _pack(it, capacities), schema)


def filled(assignment: DataFrame, capacities: list[tuple[str, int]]) -> DataFrame:
    """(capacity_name, container_id, capacity_tokens, used_tokens, n_pieces, fill) of every container."""
    size = F.create_map(*[F.lit(x) for pair in capacities for x in pair])
    used = assignment.groupBy("capacity_name", "container_id").agg(F.sum((F.col("token_to") - F.col("token_from")).cast("bigint")).alias("used_tokens"), F.count("*").alias("n_pieces"))
    used = used.withColumn("capacity_tokens", F.element_at(size, F.col("capacity_name")))
    return used.select("capacity_name", "container_id", "capacity_tokens", "used_tokens", "n_pieces", F.round(F.col("used_tokens") / F.col("capacity_tokens"), 6).alias("fill"))

"""Encoding of a corpus by a public byte-level BPE vocabulary, by two-tier lookup."""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary file lies on the driver; a parameter of ``encode``.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct pre-tokens a worker remembers before it forgets them all, and the longest remembered one.
CACHE_ENTRIES = 400_000
CACHE_CHARS = 64
_MASK = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings: hash and displace.

    Keys are dealt to buckets; each bucket, largest first, gets the least displacement that sends its keys to
    free slots. n keys fill n slots. A key outside the set lands on some slot and is told apart by its bytes."""

    __slots__ = ("n", "buckets", "shift", "keys", "values", "encoders")

    def __init__(self, table: dict[bytes, int]):
        self.n = len(table)
        self.encoders: dict[str, Encoder] = {}  # filled by a worker, lives as long as its copy of the table
        self.buckets = max(1, self.n // 3)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        dealt: dict[int, list] = {}
        for k in table:
            b, h1, h2 = self._hashes(k)
            dealt.setdefault(b, []).append((k, h1, h2))
        self.keys: list = [None] * self.n
        self.values = np.zeros(self.n, dtype=np.int32)
        for b, members in sorted(dealt.items(), key=lambda x: (-len(x[1]), x[0])):
            d = 0
            while True:
                at = [self._slot(h1, h2, d) for _, h1, h2 in members]
                if len(set(at)) == len(at) and all(self.keys[s] is None for s in at):
                    break
                d += 1
            self.shift[b] = d
            for (k, _, _), s in zip(members, at):
                self.keys[s] = k
                self.values[s] = table[k]

    def _hashes(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        low = h & _MASK
        return (low >> 32) % self.buckets, h >> 64, low

    def _slot(self, h1: int, h2: int, d: int) -> int:
        # the displacement is mixed in, so that every bucket reaches every slot
        x = (h1 + d * 0x9E3779B97F4A7C15 + (h2 ^ d) * (2 * d + 1)) & _MASK
        x ^= x >> 31
        return (x * 0xBF58476D1CE4E5B9 & _MASK) % self.n

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        b, h1, h2 = self._hashes(key)
        s = self._slot(h1, h2, int(self.shift[b]))
        return int(self.values[s]) if self.keys[s] == key else None


def merge(piece: bytes, rank) -> list[int]:
    """Ids of one pre-token: a heap of mergeable neighbours over a doubly linked list of byte runs.

    ``rank(bytes)`` gives the id of a run or None. The pair of the lowest rank, leftmost among equals, is
    merged first. n bytes take O(n log n) steps."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the run starting here
    before = list(range(-1, n - 1))
    after = [*range(1, n), -1]
    alive = [True] * n
    ids = [rank(piece[i : i + 1]) for i in range(n)]
    heap = []
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = after[i]
        if j < 0 or end[j] != stop:
            continue  # stale: one of the two runs has grown since
        alive[j] = False
        end[i], ids[i] = stop, r
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            x = rank(piece[i : end[k]])
            if x is not None:
                heapq.heappush(heap, (x, i, end[k]))
        b = before[i]
        if b >= 0:
            x = rank(piece[b:stop])
            if x is not None:
                heapq.heappush(heap, (x, b, stop))
    return [t for t, a in zip(ids, alive) if a]


class Encoder(dict):
    """Pre-token -> its ids as int32 bytes, filled on demand (a bounded memory of the two-tier lookup)."""

    def __init__(self, table: PerfectHash, pattern: str = PATTERN):
        super().__init__()
        self.table = table
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "replace")
        whole = self.table.get(raw)
        ids = [whole] if whole is not None else merge(raw, self.table.get)
        packed = np.asarray(ids, dtype=np.int32).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join([self[p] for p in self.split(text)])


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Rows (key, ids): the ids of every text, without special tokens; text that looks like one is ordinary.

    Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are whole entries. Tier two:
    the rest are merged by a heap over linked bytes. The vocabulary (some 50,000 entries, fixed by its file) is
    read on the driver and broadcast. One Arrow pass, no shuffle; ids leave Python as one int32 buffer a batch.

    Null and empty texts both give an empty array; blank texts are encoded as they are. Repeated rows give
    repeated results; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(PerfectHash(read_ranks(vocabulary)))
    slim = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = slim.schema["_key"].dataType.simpleString()

    def run(batches):
        table = shared.value
        enc = table.encoders.get(pattern)
        if enc is None:
            enc = table.encoders[pattern] = Encoder(table, pattern)
        for batch in batches:
            rows = [b"" if not t else enc.encode(t) for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(rows) + 1, dtype=np.int64)
            np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(rows), dtype=np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["_key", "ids"])

    return slim.mapInArrow(run, f"_key {kind}, ids array<int>").withColumnRenamed("_key", key)

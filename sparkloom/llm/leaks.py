"""Evaluation passages in training text: a BM25 inverted index of the test items with block-max WAND."""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters and digits in a row that make a leak.
RUN = 60
#: Letters and digits of one index term; a run holds RUN - TERM + 1 terms.
TERM = 20
#: Every STRIDE-th term of a document is probed first; a run holds several of these.
STRIDE = 8
#: Passages of a document: windows that overlap so much that every run lies whole in one.
WINDOW = 256
#: Items of one block of a posting list.
BLOCK = 16
#: Letters of the items that one broadcast index may hold: about 40 bytes each, 80 MB. More items take further passes.
CHARS_PER_INDEX = 2_000_000
K1, B = 1.2, 0.75

_LETTERS = re.compile(r"[^\W_]+")
_PROBES = (RUN - TERM + 1) // STRIDE
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, TERM - 1 - j, 1 << 64) for j in range(TERM)], dtype=np.uint64)


def letters(text: str | None) -> str:
    """Letters and digits only, letter case aside."""
    return "" if not text else "".join(_LETTERS.findall(text.lower()))


def term_hashes(points: np.ndarray, stride: int = 1) -> np.ndarray:
    """64-bit polynomial hashes of the TERM letters from every ``stride``-th place on, mixed so that all bits differ."""
    n = len(points) - TERM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    m = -(-n // stride)
    h = np.zeros(m, dtype=np.uint64)
    for j in range(TERM):
        h += points[j : j + (m - 1) * stride + 1 : stride] * _FACTORS[j]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


class ItemIndex:
    """Inverted index of test items whose terms are TERM letters in a row, by their 64-bit hashes, weighted by BM25.

    The threshold of an item is the least score that any of its RUN-letter runs can have: the sum of the
    weights of the distinct terms in that run. BM25 weights are positive, so a passage that holds a run scores
    at least as much: retrieving everything above the threshold loses nothing (terms with one hash are one term on
    both sides). Posting lists are packed arrays, kept in blocks of BLOCK items with the greatest weight of each block."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        n = len(items)
        hashes = [term_hashes(_points(t)) for t in self.texts]
        lengths = np.array([len(h) for h in hashes], dtype=np.int64)
        mean = max(1.0, lengths.sum() / max(1, n))
        every = np.concatenate([*hashes, np.zeros(0, dtype=np.uint64)])
        owner = np.repeat(np.arange(n, dtype=np.int32), lengths)
        order = np.lexsort((owner, every))
        h, d = every[order], owner[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(h)))
        h, self.docs = h[at], d[at]
        self.terms, first = np.unique(h, return_index=True)
        self.start = np.append(first, len(h)).astype(np.int64)
        df = np.diff(self.start)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths[self.docs] / mean)
        self.weights = (np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        self.most = np.maximum.reduceat(self.weights, self.start[:-1]) if len(h) else self.weights
        bits = max(16, int(16 * max(1, len(self.terms))).bit_length())
        self.shift = np.uint64(64 - min(bits, 26))
        self.seen = np.zeros(1 << min(bits, 26), dtype=bool)
        self.seen[self.terms >> self.shift] = True
        self.threshold = [self._least(k, x) for k, x in enumerate(hashes)]
        self.least = min(self.threshold, default=math.inf)
        self.block_least: dict[int, float] = {}
        for k, x in enumerate(self.threshold):
            self.block_least[k // BLOCK] = min(self.block_least.get(k // BLOCK, math.inf), x)
        self._open: dict[int, tuple[list[int], list[float], dict[int, float]]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the terms with these hashes, -1 for none."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.seen[hashes >> self.shift])
        if len(maybe):
            p = np.searchsorted(self.terms, hashes[maybe])
            p[p == len(self.terms)] = 0
            there = self.terms[p] == hashes[maybe]
            out[maybe[there]] = p[there]
        return out

    def postings(self, term: int) -> tuple[list[int], list[float], dict[int, float]]:
        """(items, weights, greatest weight of each block) of a term; a bounded memory of unpacked ones."""
        got = self._open.get(term)
        if got is None:
            a, b = self.start[term], self.start[term + 1]
            docs, w = self.docs[a:b].tolist(), self.weights[a:b].tolist()
            blocks: dict[int, float] = {}
            for d, x in zip(docs, w):
                blocks[d // BLOCK] = max(blocks.get(d // BLOCK, 0.0), x)
            if len(self._open) >= 20_000:
                self._open.clear()
            got = self._open[term] = (docs, w, blocks)
        return got

    def _least(self, d: int, hashes: np.ndarray) -> float:
        per = RUN - TERM + 1
        if len(hashes) < per:
            return math.inf  # shorter than a run: no passage can hold one
        terms = np.searchsorted(self.terms, hashes)
        weight = {t: float(self.weights[self.start[t] + np.searchsorted(self.docs[self.start[t] : self.start[t + 1]], d)]) for t in set(terms.tolist())}
        held: dict[int, int] = {}
        total, least = 0.0, math.inf
        order = terms.tolist()
        for k, t in enumerate(order):
            held[t] = held.get(t, 0) + 1
            if held[t] == 1:
                total += weight[t]
            if k >= per:
                u = order[k - per]
                held[u] -= 1
                if not held[u]:
                    total -= weight[u]
            if k >= per - 1:
                least = min(least, total)
        return least * (1 - 1e-6)

    def retrieve(self, terms: list[int]) -> list[int]:
        """Items scoring at least their threshold for a passage with these distinct terms: block-max WAND."""
        cursors = [[*self.postings(g), float(self.most[g]), 0] for g in terms]
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0][c[4]])
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c[3]
                if total >= self.least:
                    pivot = k
                    break
            if pivot < 0:
                break
            d = cursors[pivot][0][cursors[pivot][4]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0][cursors[pivot + 1][4]] == d:
                pivot += 1
            block = d // BLOCK
            bound = sum(c[2].get(block, 0.0) for c in cursors[: pivot + 1])
            if bound < self.block_least[block]:
                # nothing up to the end of the block, or up to the next term's item, can reach its threshold
                to = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0][cursors[pivot + 1][4]])
                to = max(to, d + 1)
            else:
                # order of summation is fixed by the posting, not by the passage
                score = 0.0
                for order, w, _, _, at in cursors[: pivot + 1]:
                    p = bisect_left(order, d, at)
                    if p < len(order) and order[p] == d:
                        score += w[p]
                if score >= self.threshold[d]:
                    out.append(d)
                to = d + 1
            kept = []
            for k, c in enumerate(cursors):
                if k <= pivot:
                    c[4] = bisect_left(c[0], to, c[4])
                if c[4] < len(c[0]):
                    kept.append(c)
            cursors = kept
        return out

    def leaked(self, texts: list[str | None]) -> list[list[int]]:
        """For every text the ids of the items with a run of RUN letters and digits in common with it.

        The letters of all texts are hashed together; only texts in which as many probed places in a row are terms of the
        index as every run holds are looked at one by one."""
        own = [letters(t) for t in texts]
        begin = np.cumsum([0, *map(len, own)])
        hit = self.find(term_hashes(_points("".join(own)), STRIDE)) >= 0 if len(self.terms) else np.zeros(0, dtype=bool)
        row = hit
        for k in range(1, _PROBES):  # a run shows at this many probed places in a row
            row = row[:-1] & hit[k:]
        probed = np.flatnonzero(row) * STRIDE
        out: list[list[int]] = [[] for _ in own]
        for i in np.unique(np.searchsorted(begin, probed, side="right") - 1) if len(probed) else []:
            out[i] = self._leaked(own[i])
        return out

    def _leaked(self, t: str) -> list[int]:
        if len(t) < RUN:
            return []
        terms = self.find(term_hashes(_points(t)))
        known = np.flatnonzero(terms >= 0)
        found: set[int] = set()
        for start in range(0, len(t) - RUN + 1, WINDOW - RUN + 1):
            stop = start + WINDOW
            a, b = np.searchsorted(known, [start, stop - TERM + 1])
            if b - a < RUN - TERM + 1:
                continue  # a run is that many terms in a row
            passage = t[start:stop]
            for d in self.retrieve(np.unique(terms[known[a:b]]).tolist()):
                item = self.texts[d]
                if d not in found and any(passage[k : k + RUN] in item for k in range(len(passage) - RUN + 1)):
                    found.add(d)
        return sorted(self.ids[d] for d in found)


def _blocks(items: DataFrame, item_key: str, item_text: str, chars: int):
    """Lists of (id, letters) holding at most ``chars`` letters each (a single longer item stands alone)."""
    rows = items.select(F.col(item_key), F.col(item_text)).dropna().distinct().orderBy(item_key).toLocalIterator()
    block, size = [], 0
    for i, text in rows:
        t = letters(text)
        if len(t) < RUN:
            continue  # leaks nowhere
        if block and size + len(t) > chars:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    if block:
        yield block


def _finder(shared):
    @F.pandas_udf("array<long>")
    def find(s: pd.Series) -> pd.Series:
        return pd.Series(shared.value.leaked(list(s)))

    return find


def find_leaks(
    documents: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, item_text: str, chars_per_index: int = CHARS_PER_INDEX
) -> DataFrame:
    """Rows (doc_id, item_id): documents holding RUN or more letters and digits in a row of an item.

    Every document is cut into overlapping passages; each passage queries the BM25 index of the items, all
    items above their threshold are retrieved by block-max WAND, and the shared run is then verified
    letter by letter. The index is broadcast in blocks of bounded size, so very many items mean more passes (one for
    every ``chars_per_index`` letters of theirs), not a larger broadcast. No shuffle but the final removal of repeated rows.

    Null and empty texts hold nothing; items shorter than RUN letters leak nowhere. Repeated documents and
    items give one row. No items or no documents give no rows.
    """
    spark = documents.sparkSession
    slim = documents.select(F.col(doc_key).alias("doc_id"), F.col(text).alias("_t")).filter(F.col("_t").isNotNull() & F.col("doc_id").isNotNull())
    out = None
    for block in _blocks(items, item_key, item_text, chars_per_index):
        shared = spark.sparkContext.broadcast(ItemIndex(block))
        part = slim.select("doc_id", F.explode(_finder(shared)("_t")).alias("item_id"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return slim.select("doc_id", F.lit(None).cast("long").alias("item_id")).limit(0)
    return out.distinct()

"""Bloom filters folded on the cluster and broadcast: which keys a table certainly does not hold."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Memory of one filter at most. It is broadcast, and every Python worker holds it; more keys make more slices.
FILTER_BYTES = 64 << 20
BITS_PER_KEY = 12
HASHES = 6


def _positions(h1, h2, bits: int):
    """Double hashing: HASHES bit positions from two 64-bit hashes."""
    with np.errstate(over="ignore"):
        return [((h1 + np.uint64(i) * h2) & np.uint64(bits - 1)).astype(np.int64) for i in range(HASHES)]


def key_hashes(*key: Column) -> tuple[Column, Column]:
    return F.xxhash64(*key), F.xxhash64(F.lit(7), *key)


def filter_sizes(n_keys: int, filter_bytes: int = FILTER_BYTES) -> tuple[int, int]:
    """(bits of one filter, slices): BITS_PER_KEY bits a key at least, in as many slices of the keys as keep each
    filter within ``filter_bytes``; the rate of false positives is the same for any number of keys (about 1 in 100 or less)."""
    most = 1 << ((filter_bytes * 8).bit_length() - 1)
    slices = max(1, -(-n_keys * BITS_PER_KEY // most))
    bits = 1 << 13
    while bits < -(-n_keys // slices) * BITS_PER_KEY and bits < most:
        bits <<= 1
    return bits, slices


def slice_of(h1: Column, slices: int) -> Column:
    """The slice of a key; from the upper half of the hash, as positions use the lower bits."""
    return F.pmod(F.shiftrightunsigned(h1, 32), F.lit(slices))


def fold_filter(keys: DataFrame, key: list[str], bits: int, slices: int = 1, number: int = 0) -> np.ndarray:
    """The filter of slice ``number`` of the keys as 64-bit words.

    Every partition folds its keys into words; words are merged by bit_or on the cluster, so the driver receives each
    word once (a result bounded by ``bits``, not by the rows). Keys with a null part are left out."""

    def fold(batches):
        words = np.zeros(bits // 64, dtype=np.uint64)
        for pdf in batches:
            h1 = pdf["h1"].to_numpy(dtype=np.int64).view(np.uint64)
            h2 = pdf["h2"].to_numpy(dtype=np.int64).view(np.uint64) | np.uint64(1)
            for p in _positions(h1, h2, bits):
                np.bitwise_or.at(words, p >> 6, np.uint64(1) << (p & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        for at in range(0, len(used), 100_000):
            part = used[at : at + 100_000]
            yield pd.DataFrame({"w": part.astype(np.int64), "b": words[part].view(np.int64)})

    h1, h2 = key_hashes(*[F.col(k) for k in key])
    hashed = keys.dropna(subset=key).select(h1.alias("h1"), h2.alias("h2"))
    if slices > 1:
        hashed = hashed.filter(slice_of(F.col("h1"), slices) == number)
    parts = hashed.mapInPandas(fold, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[parts["w"].to_numpy(dtype=np.int64)] = parts["b"].to_numpy(dtype=np.int64).view(np.uint64)
    return words


def _probe(shared):
    @F.pandas_udf("boolean")
    def might_hold(h1: pd.Series, h2: pd.Series) -> pd.Series:
        w = shared.value
        a = h1.to_numpy(dtype=np.int64).view(np.uint64)
        b = h2.to_numpy(dtype=np.int64).view(np.uint64) | np.uint64(1)
        hit = np.ones(len(a), dtype=bool)
        for q in _positions(a, b, len(w) * 64):
            hit &= (w[q >> 6] >> (q & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(hit)

    return might_hold


def with_membership(df: DataFrame, on: list[str], keys: DataFrame, key: list[str], n_keys: int, out: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``df`` with ``out``: false where the columns ``on`` are certainly no key of ``keys``, true where they may be.

    The filter is sized by ``n_keys``, an upper bound of the number of keys. Beyond ``filter_bytes`` the keys are dealt to
    slices by hash and each slice has a filter of its own; a row of ``df`` is then probed in the pass of its slice only, one
    pass over ``df`` a slice. Null parts hash like values that no key has."""
    bits, slices = filter_sizes(n_keys, filter_bytes)
    spark = df.sparkSession
    h1, h2 = key_hashes(*[F.col(c) for c in on])
    parts = []
    for s in range(slices):
        shared = spark.sparkContext.broadcast(fold_filter(keys, key, bits, slices, s))
        own = df.filter(slice_of(h1, slices) == s) if slices > 1 else df
        parts.append(own.withColumn(out, _probe(shared)(h1, h2)))
    return reduce(DataFrame.unionByName, parts)

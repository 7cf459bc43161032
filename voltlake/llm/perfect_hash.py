"""Minimal perfect hashing of distinct 64-bit keys, built in buckets side by side.

A bucket's keys are hashed into a bit vector somewhat longer than their number. Keys that have a bit
for themselves are done, the others go on to a shorter vector with another seed, until none is
left. A key's number is the count of bits set before its own, over all buckets in order, so ``n`` keys
get the numbers 0 to n - 1. The function takes some four bits a key. It gives a number to many keys that
were not among those it was built of; the keys in the order of their numbers verify a lookup.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import staged

#: Keys of a bucket, about.
BUCKET_KEYS = 1 << 15
#: Bits of a vector for each key that it gets.
ROOM = 1.5

BUILT = "bucket int, n long, sizes array<long>, bits binary, keys binary"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """One to one for a seed, so two keys never meet under all seeds."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mixed(keys, 0) % np.uint64(n_buckets)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Bits of each level, the packed levels, and the keys in the order of their numbers."""
    sizes, levels, ordered = [], [], []
    left = np.sort(keys)
    while len(left):
        size = -(-int(len(left) * ROOM + 1) // 64) * 64
        place = (mixed(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        own = alone[place]
        ordered.append(left[own][np.argsort(place[own])])
        levels.append(np.packbits(alone, bitorder="little"))
        sizes.append(size)
        left = left[~own]
    bits = np.concatenate(levels) if levels else np.empty(0, np.uint8)
    return sizes, bits, np.concatenate(ordered) if ordered else keys[:0]


class PerfectHash:
    """Numbers of keys; made of the buckets' (bucket, sizes, bits)."""

    def __init__(self, n_buckets: int, built: list[tuple[int, list[int], bytes]]):
        self.n_buckets = n_buckets
        depth = max((len(sizes) for _, sizes, _ in built), default=0)
        self.size = np.zeros((n_buckets, depth), np.int64)
        self.base = np.zeros((n_buckets, depth), np.int64)
        parts, at = [], 0
        for bucket, sizes, bits in sorted(built):
            self.size[bucket, : len(sizes)] = sizes
            self.base[bucket, : len(sizes)] = at + np.cumsum([0, *sizes[:-1]])
            parts.append(np.frombuffer(bits, np.uint64))
            at += sum(sizes)
        self.words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.n = int(self.before[-1])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 for some of the keys that the function was not built of."""
        out = np.full(len(keys), -1, np.int64)
        left, bucket = np.arange(len(keys)), bucket_of(keys, self.n_buckets)
        for level in range(self.size.shape[1]):
            size = self.size[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            place = self.base[bucket[left], level] + (mixed(keys[left], level + 1) % size.astype(np.uint64)).astype(np.int64)
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            own = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[own]] = (self.before[place >> 6] + np.bitwise_count(below))[own]
            left = left[~own]
        return out

    def firsts(self) -> np.ndarray:
        """The number before which each bucket's keys begin, and at the end the number of keys."""
        starts = np.zeros(self.n_buckets + 1, np.int64)
        starts[-1] = self.n
        for bucket in range(self.n_buckets - 1, -1, -1):
            empty = not self.size.shape[1] or self.size[bucket, 0] == 0
            starts[bucket] = starts[bucket + 1] if empty else self.before[self.base[bucket, 0] >> 6]
        return starts


def build_buckets(keys: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, n, sizes, bits, keys of every bucket of the distinct keys in column ``key``; written."""

    def dealt(frames):
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "bucket": bucket_of(frame["key"].to_numpy(), n_buckets)})

    def built(frame: pd.DataFrame) -> pd.DataFrame:
        sizes, bits, ordered = build(frame["key"].to_numpy(np.int64))
        row = (int(frame["bucket"].iloc[0]), len(ordered), sizes, bits.tobytes(), ordered.astype(np.int64).tobytes())
        return pd.DataFrame([row], columns=["bucket", "n", "sizes", "bits", "keys"])

    rows = keys.select("key").mapInPandas(dealt, "key long, bucket int")
    return staged(rows.groupBy("bucket").applyInPandas(built, BUILT), "perfect_hash")


def perfect_hash(buckets: DataFrame, n_buckets: int) -> PerfectHash:
    """The function alone, some four bits a key, without the keys."""
    return PerfectHash(n_buckets, [(r["bucket"], r["sizes"], bytes(r["bits"])) for r in buckets.select("bucket", "sizes", "bits").collect()])


def bucket_count(n_keys: int) -> int:
    return max(1, -(-n_keys // BUCKET_KEYS))


def key_rows(buckets: DataFrame) -> DataFrame:
    """bucket, place, key: the keys in the order of their numbers in the bucket."""

    def run(frames):
        for frame in frames:
            for bucket, keys in zip(frame["bucket"], frame["keys"], strict=True):
                found = np.frombuffer(keys, np.int64)
                yield pd.DataFrame({"bucket": np.int32(bucket), "place": np.arange(len(found)), "key": found})

    return buckets.select(F.col("bucket"), "keys").mapInPandas(run, "bucket int, place long, key long")

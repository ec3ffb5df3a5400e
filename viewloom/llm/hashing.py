"""A minimal perfect hash over a set of distinct keys, built shard by shard on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys a shard holds on average, and bits per key that each level of a shard starts with.
SHARD, GAMMA = 1 << 15, 2


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer over unsigned keys; each seed is another hash function."""
    with np.errstate(over="ignore"):
        value = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys, 0) % np.uint64(shards)).astype(np.int64)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays, one per level: a key's bit is set on the first level where no other remaining key hashes to it."""
    levels: list[np.ndarray] = []
    while len(keys):
        size = GAMMA * len(keys)
        at = (mix(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
        bits = np.bincount(at, minlength=size) == 1
        levels.append(bits)
        keys = keys[~bits[at]]
    return levels


class PerfectHash:
    """Maps each of n keys to its own slot in [0, n): the rank of its bit among all set bits.

    A key outside the set gets some slot too, or n where no level has its bit: whoever looks up must compare the key kept for the slot.
    """

    def __init__(self, shards: list[tuple[int, list[int], bytes]], count: int):
        """``shards`` holds (shard, bits per level, packed bits of all levels) for each of ``count`` shards that has a key."""
        depth = max((len(sizes) for _, sizes, _ in shards), default=0)
        self.shards = count
        self.size = np.zeros((depth, count), np.int64)
        self.start = np.zeros((depth, count), np.int64)
        parts, at = [], 0
        for shard, sizes, packed in sorted(shards):
            total = sum(sizes)
            parts.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=total))
            self.size[: len(sizes), shard] = sizes
            self.start[: len(sizes), shard] = at + np.cumsum([0, *sizes[:-1]])
            at += total
        bits = np.concatenate([*parts, np.zeros(-at % 64, np.uint8)]) if parts else np.zeros(0, np.uint8)
        self.bytes = np.packbits(bits, bitorder="little")
        ones = np.bitwise_count(self.bytes.view(np.uint64)).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), self.n, np.int64)
        left = np.arange(len(keys))
        shard = shard_of(keys, self.shards) if len(keys) else left
        for level in range(len(self.size)):
            size = self.size[level][shard[left]]
            left, size = left[size > 0], size[size > 0]
            at = self.start[level][shard[left]] + (mix(keys[left], level + 1) % size.astype(np.uint64)).astype(np.int64)
            found = (self.bytes[at >> 3] >> (at & 7)) & 1 == 1
            hit = at[found]
            word, bit = hit >> 6, (hit & 63).astype(np.uint64)
            below = self.bytes.view(np.uint64)[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slots[left[found]] = self.before[word] + np.bitwise_count(below)
            left = left[~found]
        return slots


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of equal values in the first column of sorted batches, as (value, slices); a run may span batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for i, j in zip(edges, edges[1:]):
            if i == j:
                continue
            if held and values[i] != key:
                yield key, held
                held = []
            key = values[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield key, held


def perfect_hash(keys: DataFrame, count: int) -> PerfectHash:
    """The hash over the one column of distinct non-negative longs of ``keys``, ``count`` of them.

    Every shard is built in the task that holds it; the driver gets about four bits a key.
    """
    shards = max(1, -(-count // SHARD))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(values, shards)), batch.column(0)], names=["shard", "key"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in runs(batches):
            levels = build_levels(np.concatenate([p.column(1).to_numpy(zero_copy_only=False) for p in parts]))
            packed = np.packbits(np.concatenate(levels)).tobytes()
            columns = [pa.array([shard], pa.int64()), pa.array([[len(x) for x in levels]], pa.list_(pa.int64())), pa.array([packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "sizes", "bits"])

    placed = keys.mapInArrow(place, "shard long, key long").repartition("shard").sortWithinPartitions("shard")
    made = placed.mapInArrow(build, "shard long, sizes array<long>, bits binary").collect()
    return PerfectHash([(r[0], list(r[1]), bytes(r[2])) for r in made], shards)

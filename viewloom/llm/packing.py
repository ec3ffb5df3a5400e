"""Packing token sequences as a cutting-stock problem solved by column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.session import materialize

CAPACITY = 2048
#: Ends every document.
END = 1
#: The rest of a document after its full pieces is cut once, at the largest multiple of this: the histogram has CAPACITY / GRAIN + GRAIN classes at most.
GRAIN = 64
#: A column must improve the linear program by this share of a sequence.
TOLERANCE = 1e-4
#: So many sequences above the total of all lengths the program is good enough: rounding costs about one.
SPARE = 0.5
#: A pattern of the program is used if it wastes at most this share.
SLACK = 1e-3
#: How far prices are drawn towards the ideal ones, and the most columns tried per class.
DRAWN, TURNS = 0.8, 5
_SPECIAL = "<|endoftext|>"


class TokenBytes:
    """The ids of a byte-level BPE vocabulary as little-endian unsigned 32-bit numbers.

    The vocabulary's rank file gives the same ids as its JSON file does in the ``tokenizers`` library (special token included), several times
    faster; the JSON file serves texts that the rank coder gives up on (white space runs of millions of characters).
    """

    def __init__(self, rank_file: str, json_file: str, pattern: str):
        import base64

        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={_SPECIAL: len(ranks)})
        self.json_file = json_file

    def __call__(self, text: str) -> bytes:
        text = text.encode("utf-8", "replace").decode("utf-8")
        try:
            return self.coder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except ValueError:
            from tokenizers import Tokenizer

            return np.array(Tokenizer.from_file(self.json_file).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def cut(n: int, grain: int = GRAIN, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n ids: full ones, then a multiple of the grain, then what is left."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [k for k in (rest // grain * grain, rest % grain) if k]


@dataclass(frozen=True)
class Pattern:
    """A sequence's contents as (length, count), longest first, and how many sequences have it."""

    items: tuple[tuple[int, int], ...]
    times: int


def _knapsack(lengths: np.ndarray, values: np.ndarray, limits: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable bounded choice within the capacity, by dynamic programming over lengths and powers of two of their counts."""
    best = np.zeros(capacity + 1)
    steps = []
    for k, (length, value, limit) in enumerate(zip(lengths.tolist(), values.tolist(), limits.tolist())):
        limit, size = min(limit, capacity // length), 1
        while limit > 0 and value > 0:
            size = min(size, limit)
            weight = size * length
            other = np.full(capacity + 1, -np.inf)
            other[weight:] = best[: capacity + 1 - weight] + size * value
            taken = other > best + 1e-12
            best = np.where(taken, other, best)
            steps.append((k, size, weight, taken))
            limit, size = limit - size, size * 2
    counts, room = np.zeros(len(lengths), np.int64), int(best.argmax())
    total = float(best[room])
    for k, size, weight, taken in reversed(steps):
        if taken[room]:
            counts[k] += size
            room -= weight
    return total, counts


def _relaxed(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often the linear program uses each: revised simplex, columns priced by the knapsack.

    Prices are drawn towards length / capacity, the prices of a program without waste, which keeps them from swinging; where such a
    column would not improve the program the plain prices decide.
    """
    basis = np.diag(np.maximum(1, np.minimum(capacity // lengths, np.maximum(demand, 1)))).astype(float)
    inverse = np.linalg.inv(basis)
    ideal = lengths / capacity
    for turn in range(TURNS * len(lengths)):
        prices = inverse.sum(axis=0)
        if prices @ demand <= ideal @ demand + SPARE:
            break
        _, column = _knapsack(lengths, DRAWN * ideal + (1 - DRAWN) * prices, demand, capacity)
        if prices @ column <= 1 + TOLERANCE:
            worth, column = _knapsack(lengths, prices, demand, capacity)
            if worth <= 1 + TOLERANCE:
                break
        level, step = inverse @ demand, inverse @ column
        ratio = np.where(step > 1e-7, np.maximum(level, 0) / np.where(step > 1e-7, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        if turn % 16 == 15 or abs(step[out]) < 1e-4:
            inverse = np.linalg.inv(basis)
        else:
            pivot = inverse[out] / step[out]
            inverse -= np.outer(step, pivot)
            inverse[out] = pivot
    return np.rint(basis).astype(np.int64), np.linalg.solve(basis, demand)


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece of a length histogram.

    The linear program over patterns is solved by column generation, and the uses of its full patterns are rounded down. What is left
    (a few sequences for each class, and lengths that leave waste) is filled with the fullest choice of the knapsack, as often as it fits, which prefers long pieces.
    Few pieces may fare better without the program, whose uses are then fractions: the shorter of the two plans is returned.
    """
    full = [Pattern(((capacity, 1),), histogram[capacity])] if histogram.get(capacity) else []
    classes = sorted((k for k, n in histogram.items() if n > 0 and k < capacity), reverse=True)
    if not classes:
        return full
    lengths = np.array(classes, np.int64)
    demand = np.array([histogram[k] for k in classes], np.int64)
    columns, uses = _relaxed(lengths, demand, capacity)
    plans = [_filled(lengths, demand, [], capacity), _filled(lengths, demand, zip(columns.T, uses), capacity)]
    return full + min(reversed(plans), key=lambda plan: sum(p.times for p in plan))


def _filled(lengths: np.ndarray, demand: np.ndarray, columns, capacity: int) -> list[Pattern]:
    left, found = demand.copy(), []

    def use(column: np.ndarray, most: int) -> None:
        nonlocal left
        used = column > 0
        times = min(most, int((left[used] // column[used]).min()))
        if times > 0:
            found.append(Pattern(tuple((int(k), int(n)) for k, n in zip(lengths, column) if n), times))
            left = left - column * times

    for column, times in columns:
        if lengths @ column >= (1 - SLACK) * capacity:  # waste is left to the end: there it may still be filled
            use(column, int(times + 1e-6))
    while left.any():
        _, column = _knapsack(lengths, lengths + 0.5 * (lengths / capacity) ** 2, left, capacity)
        use(column, int(demand.max()))
    return found


def pieces(docs: DataFrame, rank_file: str, json_file: str, pattern: str, key: str = "doc_id", text: str = "text", grain: int = GRAIN) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, part, place): the pieces of every document, numbered per task and length.

    A task reads whole texts one by one; null counts as empty. ``place`` counts the pieces of a length in a task ``part``.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = TokenBytes(rank_file, json_file, pattern), TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        places: dict[int, int] = {}
        for batch in batches:
            out: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(coder(body or "") + end)
                n, start = len(ids) // 4, 0
                for length in cut(n, grain):
                    place = places.get(length, 0)
                    places[length] = place + 1
                    out.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, part, place))
                    start += length
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"])

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, place long")


def _slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length rows (first rank, first sequence, pieces per sequence, first offset): where the pieces of that length go, by rank."""
    found: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern in patterns:
        offset = 0
        for length, count in pattern.items:
            found.setdefault(length, []).append((ranks.get(length, 0), sequence, count, offset))
            ranks[length] = ranks.get(length, 0) + count * pattern.times
            offset += length * count
        sequence += pattern.times
    return {k: np.array(v, np.int64) for k, v in found.items()}


def pack(docs: DataFrame, rank_file: str, json_file: str, pattern: str, key: str = "doc_id", text: str = "text", grain: int = GRAIN) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every id of every document in one place of one sequence of at most 2048 ids.

    Documents are cut into full sequences, a multiple of 64 ids and a rest below 64. The histogram of lengths (at most 95 classes at any size) goes to the
    driver, where the cutting-stock problem is solved; the pieces of a length are ranked by task and place, and their rank gives sequence and offset. Ranks are
    prefix sums over counts per task, so no length is gathered. Only one sequence or so is not full, and it is to be padded to 2048 (unless it has a power of two).

    A null text is a document of the end id alone, null and repeated keys are documents of their own, an empty table gives an empty result.
    """
    cuts = materialize(pieces(docs, rank_file, json_file, pattern, key, text, grain), "pieces")
    counts = cuts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(counts.withColumn("before", F.coalesce(before, F.lit(0))), "starts")
    histogram = {r[0]: r[1] for r in starts.groupBy("length").agg(F.sum("n")).collect()}
    slots = _slots(solve(histogram))
    ranked = cuts.join(starts.select("length", "part", "before"), ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("place")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length).tolist():
                at, table = np.flatnonzero(length == k), slots[k]
                first, base, count, start = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1].T
                turn = rank[at] - first
                sequence[at], offset[at] = base + turn // count, start + turn % count * k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

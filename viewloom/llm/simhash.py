"""Near-duplicates by SimHash fingerprints and covering codes as anchor points."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.common import with_columns
from viewloom.llm.components import connected_components
from viewloom.session import materialize

#: Seed of the shingle hash.
SEED = 42
#: First bit and width of the blocks of a fingerprint; each holds 15 bits for the code and free bits above them.
BLOCKS = ((0, 21), (21, 21), (42, 22))
CODE_BITS = 15
#: Shingles hashed at a time: bounds memory for very long texts.
CHUNK = 1 << 16
#: A tile of an anchor holds about this share of all replicas at most, and an anchor below this many rows is not split.
SHARES, UNSPLIT = 1024, 4096
#: Cells of one comparison matrix.
CELLS = 1 << 22

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, size: int = 4) -> int:
    """The SimHash of a text as an unsigned number.

    A-Z become lower case, words are split at ASCII white space, and ``size`` neighbouring words joined by one space are a
    shingle, repeats included. A shorter text is one shingle; without a word (null, empty, blank) the fingerprint is 0.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    n = len(words) - size + 1
    left, right = starts[:n], ends[size - 1 :]
    ones = np.zeros((8, 8), np.int64)
    for k in range(0, n, CHUNK):
        cuts = zip(left[k : k + CHUNK].tolist(), right[k : k + CHUNK].tolist())
        hashes = np.fromiter((xxh64_intdigest(joined[i:j], SEED) for i, j in cuts), np.uint64, min(CHUNK, n - k))
        lanes = hashes.view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
        ones += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits((2 * ones > n).ravel(), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", size: int = 4, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each row as a signed long."""

    def compute(texts: list) -> list[list]:
        return [np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64).tolist()]

    return with_columns(docs, [text], [T.StructField(name, T.LongType())], compute)


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Hamming syndrome of the low 15 bits: the exclusive or of the positions (from 1) of the set bits."""
    found = np.zeros(len(values), np.int64)
    for k in range(CODE_BITS):
        found ^= ((values >> np.uint64(k)) & np.uint64(1)).astype(np.int64) * (k + 1)
    return found


def _masks(width: int) -> list[list[int]]:
    """For each syndrome, what to flip to reach every anchor within distance 2; the nearest anchor comes first.

    The anchors of a block are the words whose low 15 bits are a word of the Hamming code (15, 11), with any
    free bits: every word has exactly one anchor within distance 1.
    """
    free = [1 << k for k in range(CODE_BITS, width)]
    found = [[0, *free, *(a | b for a, b in combinations(free, 2))]]
    for s in range(1, CODE_BITS + 1):
        home = 1 << (s - 1)
        pairs = [1 << (i - 1) | 1 << (j - 1) for i, j in combinations(range(1, CODE_BITS + 1), 2) if i ^ j == s]
        found.append([home, *pairs, *(home | f for f in free)])
    return found


def replicas(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of every copy: one for each anchor within covering radius 1 plus block threshold 1."""
    rows, anchors, homes = [], [], []
    for number, (first, width) in enumerate(BLOCKS):
        block = (values >> np.uint64(first)) & np.uint64((1 << width) - 1)
        syndromes = _syndromes(block)
        for s, masks in enumerate(_masks(width)):
            at = np.flatnonzero(syndromes == s)
            reached = block[at, None].astype(np.int64) ^ np.array(masks, np.int64)
            rows.append(np.repeat(at, len(masks)))
            anchors.append((reached | number << 24).ravel())
            homes.append(np.tile(np.arange(len(masks)) == 0, len(at)))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def _frame(batches: Iterator[pa.RecordBatch], grids: dict[int, int]) -> Iterator[pa.RecordBatch]:
    hot = np.array(sorted(grids), np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, 1 << 14):
            values = batch.column(0).slice(k, 1 << 14).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, anchors, homes = replicas(values)
            tiles = np.zeros(len(rows), np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, anchors), len(hot) - 1)
                side = np.where(hot[at] == anchors, np.array([grids[int(h)] for h in hot])[at], 1)
                # a hot anchor is a grid: home copies take a line of it, and all copies, those at home too, a column
                twin = np.flatnonzero(homes & (side > 1))
                rows, anchors, side = (np.concatenate((x, x[twin])) for x in (rows, anchors, side))
                homes = np.concatenate((homes, np.zeros(len(twin), bool)))
                again = np.repeat(np.arange(len(rows)), side)
                turn = np.arange(len(again)) - np.repeat(np.cumsum(side) - side, side)
                rows, anchors, homes, side = rows[again], anchors[again], homes[again], side[again]
                own = ((values[rows] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % side
                tiles = np.where(homes, own * side + turn, turn * side + own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(tiles.astype(np.int32)), pa.array(homes), pa.array(values[rows].view(np.int64))],
                names=["anchor", "tile", "home", "fingerprint"],
            )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(home, value) of each run of one (anchor, tile) in sorted batches; a run may span batches."""
    held: list[tuple] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, tile, home, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(tile) != 0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            if key != (anchor[i], tile[i]):
                if held:
                    yield tuple(np.concatenate(x) for x in zip(*held))
                held, key = [], (anchor[i], tile[i])
            held.append((home[i:j], value[i:j].view(np.uint64)))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _linked(values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """Members of each component of the values that differ in at most ``distance`` bits."""
    left = np.ones(len(values), bool)
    for seed in range(len(values)):
        if left[seed]:
            left[seed] = False
            members, at = [seed], 0
            while at < len(members):
                near = np.flatnonzero(left & (np.bitwise_count(values ^ values[members[at]]) <= distance))
                left[near] = False
                members.extend(near.tolist())
                at += 1
            if len(members) > 1:
                yield values[members]


def links(values: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all pairs within ``distance`` bits.

    ``values`` has one long column of distinct fingerprints. Two of them that differ in at most four (at most five)
    bits differ in at most one bit of one of three blocks. Each block has a covering code as anchors (radius 1): a
    fingerprint is copied to every anchor within 1 + 1 of its block, at most 30 a block, and compared where the other
    one has its home anchor. A group gives a star for each component in it, never its pairs. An anchor with
    more than a thousandth of all copies is compared as a grid of tiles; there are fewer than a thousand of them.
    """
    if not 0 <= distance < 2 * len(BLOCKS):
        raise ValueError("three blocks with one differing bit each serve distances up to 5")
    schema = "anchor long, tile int, home boolean, fingerprint long"
    counts = values.mapInArrow(lambda batches: _frame(batches, {}), schema).groupBy("anchor").count()
    counts = materialize(counts, "anchors")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    limit = max(UNSPLIT, total // SHARES)
    grids = {r[0]: int(np.ceil((r[1] / limit) ** 0.5)) for r in counts.where(F.col("count") > limit).collect()}
    copies = values.mapInArrow(lambda batches: _frame(batches, grids), schema)
    dealt = copies.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, value in _groups(batches):
            own = value[home]
            if len(value) < 2 or not len(own):
                continue
            step = max(1, CELLS // len(value))
            close, touched = np.zeros(len(value), bool), []
            for k in range(0, len(own), step):
                near = np.bitwise_count(own[k : k + step, None] ^ value) <= distance
                near &= own[k : k + step, None] != value
                close |= near.any(axis=0)
                touched.append(near.any(axis=1))
            if close.any():
                members = np.unique(np.concatenate((value[close], own[np.concatenate(touched)])))
                for found in _linked(members, distance):
                    found = np.sort(found.view(np.int64))
                    a = np.repeat(found[:1], len(found) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(found[1:])], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4) -> DataFrame:
    """One row per document: (key, fingerprint as long, component_id).

    Documents are linked if their fingerprints differ in at most ``distance`` bits; a component is named by its
    least key. Exact copies share a fingerprint, which enters the search once. Rows with a null key are
    rows like any other but never name a component (null if all its keys are); repeated rows stay. An
    empty table gives an empty result, other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = materialize(fingerprints(rows, "text", size).select("doc_id", "fingerprint"), "fingerprints")
    named = _components(marked, distance)
    return marked.join(named, "fingerprint").select(F.col("doc_id").alias(key), "fingerprint", "component_id")


def _components(marked: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, component_id) for every fingerprint of ``marked``."""
    distinct = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    found = connected_components(links(distinct.select("fingerprint"), distance), "a", "b")
    rooted = distinct.join(found, distinct.fingerprint == found.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4) -> DataFrame:
    """The columns of ``docs`` for one row of each component: the one with the least key (nulls last), the first if it is repeated.

    The rows are written once with a row number, so that the choice is a semi join on it and texts are not gathered by group.
    """
    numbered = fingerprints(docs, text, size, "__fingerprint").withColumn("__row", F.monotonically_increasing_id())
    stored = materialize(numbered, "numbered")
    marked = stored.select(F.col("__row"), F.col(f"`{key}`").alias("doc_id"), F.col("__fingerprint").alias("fingerprint"))
    distinct = materialize(marked.select("fingerprint").distinct(), "distinct")
    found = connected_components(links(distinct, distance), "a", "b")
    rooted = marked.join(found, marked.fingerprint == found.node, "left")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    first = rooted.groupBy(F.coalesce("component", "fingerprint").alias("root")).agg(F.min(order).alias("first"))
    chosen = first.select(F.col("first.__row").alias("__row"))
    return stored.join(chosen, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])

"""Alignment of two tokenizers over a corpus: linked id pairs, counted under a minimal perfect hash."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.common import with_columns
from viewloom.llm.hashing import PerfectHash, perfect_hash, runs
from viewloom.llm.packing import TokenBytes
from viewloom.session import materialize

#: Bytes of text and links that one numpy pass takes; a longer text is one pass of its own, its links are cut.
BYTES, LINKS = 1 << 20, 1 << 21
#: Distinct pairs kept before a task writes what it has counted.
HELD = 1 << 20
#: Slots of the count table that a task holds at a time (13 bytes each), and slots of one part of a count vector.
TABLE, PART = 1 << 23, 1 << 12
#: Bits of a B id in a pair's key.
SHIFT = 15
#: Words whose B ids a worker remembers.
WORDS = 1 << 18
#: Spaces and what follows them up to the next space.
_WORD = re.compile(" *[^ ]+| +")
_NONE = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class Files:
    """Paths of the vocabularies: A as ranks, as JSON and its split pattern, B as a piece model."""

    ranks: str
    json: str
    pattern: str
    pieces: str


class Coder:
    """Both tokenizers: ids and the bytes that each id stands for."""

    def __init__(self, files: Files):
        import sentencepiece

        self.files = files
        self.a = TokenBytes(files.ranks, files.json, files.pattern).coder
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.a_bytes = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(x) for x in found], np.int64) for found in (self.a_bytes, self.b_bytes))
        # decimal ids, followed by what comes after them in the group notation: more of the group's side, or its end
        self.notes = [b"%d%s" % (i, end) for found, ends in ((self.a_bytes, (b",", b"|")), (self.b_bytes, (b",", b";"))) for end in ends for i in range(len(found))]

        # no piece goes on behind a space, so words with the spaces before them are encoded one by one, each once
        self.apart = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.known: dict[str, bytes] = {}
        # ids as they are written
        self.kept = "<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4"

    def _b_ids(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """B ids of a space and each text; None where their bytes differ from it, or without text."""
        words = [(_WORD.findall(" " + text) if self.apart else [" " + text]) if text else [] for text in texts]
        new = set(chain.from_iterable(words)).difference(self.known)
        self._learn(list(new))
        found: list = []
        for own in words:
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, own)), np.uint32)
            found.append(None if not own or (ids == _NONE).any() else ids)
        if len(self.known) > WORDS:
            # the first words met are the frequent ones: these stay
            for word in new:
                del self.known[word]
        return found

    def _learn(self, words: list[str]) -> None:
        # the tokenizer puts the first space back; before nothing but spaces it needs a letter to do so
        blank = [w for w in words if self.apart and not w.strip(" ")]
        plain = [w for w in words if not self.apart or w.strip(" ")]
        letter = self.b.encode("x")
        coded = self.b.encode([w[1:] for w in plain], num_threads=1) + [self.b.encode("x" + w)[len(letter) :] for w in blank]
        for word, ids in zip(plain + blank, coded):
            right = b"".join(map(self.b_bytes.__getitem__, ids)) == word.encode()
            self.known[word] = array("I", ids).tobytes() if right else _NONE.tobytes()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _a_ids(self, text: str) -> np.ndarray:
        try:
            return self.a.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            from tokenizers import Tokenizer

            plain = Tokenizer.from_file(self.files.json)
            plain.encode_special_tokens = True
            return np.array(plain.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of every text in both vocabularies; none for a null or empty text, or where either side's bytes are not the space and the text."""
        found: tuple[list, list] = ([], [])
        for text, b in zip(texts, self._b_ids(texts)):
            a = self._a_ids(" " + text) if b is not None else None
            if a is None or b"".join(map(self.a_bytes.__getitem__, a.tolist())) != (" " + text).encode():
                a = b = np.zeros(0, np.uint32)
            found[0].append(a)
            found[1].append(b)
        return found


@cache
def coder(files: Files) -> Coder:
    """One pair of tokenizers for each Python worker."""
    return Coder(files)


class Aligned:
    """Texts cut into groups at the byte offsets where a token of both sides ends."""

    def __init__(self, texts: list[str | None], files: Files):
        self._align(coder(files), *coder(files).encode(texts))

    @classmethod
    def of(cls, a: list[bytes], b: list[bytes], files: Files) -> Aligned:
        """From the ids that :func:`encoded` has written."""
        made, own = cls.__new__(cls), coder(files)
        made._align(own, *([np.frombuffer(x, own.kept) for x in side] for side in (a, b)))
        return made

    def _align(self, own: Coder, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        self.coder = own
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([*side, np.zeros(0, np.uint32)]).astype(np.int64) for side in (a, b))
        end_a, end_b = np.cumsum(self.coder.a_length[self.a]), np.cumsum(self.coder.b_length[self.b])
        ends = np.zeros((int(end_a[-1]) if len(end_a) else 0) + 1, np.int8)
        ends[end_a] += 1
        ends[end_b] += 1
        number = np.cumsum(ends == 2)
        # a token belongs to the group that the first shared end at or behind its own end closes
        self.group_a, self.group_b = number[end_a - 1], number[end_b - 1]
        self.groups = int(number[-1])
        self.doc_a = np.repeat(np.arange(len(a)), self.n_a)
        self.size_a, self.size_b = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        last_a = np.cumsum(self.size_a) - 1
        self.n_groups = np.bincount(self.doc_a[last_a], minlength=len(a)) if self.groups else np.zeros(len(a), np.int64)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, pair key, occurrences) of the distinct linked pairs, a bounded number of links at a time."""
        start_b = np.cumsum(self.size_b) - self.size_b
        partners = self.size_b[self.group_a]
        bounds = np.cumsum(partners)
        first = 0
        while first < len(self.a):
            done = bounds[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(bounds, done + LINKS, "right")))
            count = partners[first:last]
            token = np.repeat(np.arange(first, last), count)
            within = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
            key = self.a[token] << SHIFT | self.b[start_b[self.group_a[token]] + within]
            both, times = np.unique(self.doc_a[token] << 32 | key, return_counts=True)
            yield both >> 32, both & 0xFFFFFFFF, times
            first = last

    def n_links(self) -> np.ndarray:
        return np.bincount(self.doc_a, self.size_b[self.group_a], minlength=len(self.n_a)).astype(np.int64)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``; empty for a text without tokens."""
        width_a, width_b = len(self.coder.a_bytes), len(self.coder.b_bytes)
        last_a, last_b = np.ones(len(self.a), bool), np.ones(len(self.b), bool)
        last_a[:-1], last_b[:-1] = self.group_a[1:] != self.group_a[:-1], self.group_b[1:] != self.group_b[:-1]
        notes = np.zeros(len(self.a) + len(self.b), np.int64)
        notes[np.arange(len(self.a)) + (np.cumsum(self.size_b) - self.size_b)[self.group_a]] = self.a + last_a * width_a
        notes[np.arange(len(self.b)) + np.cumsum(self.size_a)[self.group_b]] = 2 * width_a + self.b + last_b * width_b
        edges = np.cumsum(self.n_a + self.n_b).tolist()
        found = []
        for i, j in zip([0, *edges], edges):
            found.append(hashlib.sha256(b"".join(map(self.coder.notes.__getitem__, notes[i:j].tolist()))[:-1]).hexdigest() if j > i else "")
        return found


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose sizes make about BYTES."""
    first, size = 0, 0
    for i, own in enumerate(sizes):
        size += own
        if size >= BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _aligned(a: list[bytes], b: list[bytes], files: Files) -> Iterator[Aligned]:
    """The texts of a batch, a bounded number of bytes at a time: the ids of both sides take about as many as their text."""
    for i, j in _portions([len(x) + len(y) for x, y in zip(a, b)]):
        yield Aligned.of(a[i:j], b[i:j], files)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), minlength=len(found)).astype(np.int64)


#: Columns of the ids of both sides.
IDS = ["__ids_a", "__ids_b"]


def encoded(docs: DataFrame, files: Files, text: str = "text") -> DataFrame:
    """``docs`` with the ids of every text on both sides, little-endian, 16 bits each where the vocabularies allow it."""

    def run(texts: list) -> list[list]:
        found: list[list] = [[], []]
        own = coder(files)
        for i, j in _portions([len(x or "") for x in texts]):
            for into, side in zip(found, own.encode(texts[i:j])):
                into.extend(ids.astype(own.kept).tobytes() for ids in side)
        return found

    return with_columns(docs, [text], [T.StructField(c, T.BinaryType()) for c in IDS], run)


PARTIAL = "keys binary, docs binary"


def pair_counts(ids: DataFrame, files: Files) -> DataFrame:
    """First pass over the ids: what each task saw, as rows of sorted distinct pair keys and the number of its texts that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        docs: list = []

        def flush() -> pa.RecordBatch:
            found, counts = _summed(keys, docs)
            keys.clear(), docs.clear()
            return pa.RecordBatch.from_arrays([pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (found, counts)], names=["keys", "docs"])

        held = 0
        for batch in batches:
            for aligned in _aligned(batch.column(0).to_pylist(), batch.column(1).to_pylist(), files):
                # a pair counts once for a text, even where the text's links come in several turns
                seen = [doc << 32 | key for doc, key, _ in aligned.links()]
                if seen:
                    found, counts = np.unique((np.unique(np.concatenate(seen)) if len(seen) > 1 else seen[0]) & 0xFFFFFFFF, return_counts=True)
                    keys.append(found)
                    docs.append(counts)
                    held += len(found)
                if held >= HELD:
                    yield flush()
                    held = 0
        if keys:
            yield flush()

    return ids.select(*IDS).mapInArrow(run, PARTIAL)


def _longs(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i8") for x in column.to_pylist()]


def _distinct(partial: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_longs(batch.column(0)))))], names=["key"])

    return partial.select("keys").mapInArrow(run, "key long").distinct()


def _vectors(partial: DataFrame, slots_of, low: int, high: int) -> DataFrame:
    """Dense counts of the slots from ``low`` up to ``high``, summed as a tree: within tasks, over sets of tasks, over all. One row per part of the vector."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = None
        for batch in batches:
            for keys, docs in zip(_longs(batch.column(0)), _longs(batch.column(1))):
                dense = np.zeros(-(-(high - low) // PART) * PART, np.int64) if dense is None else dense
                slots = slots_of.value(keys) - low
                inside = (slots >= 0) & (slots < high - low)
                dense[slots[inside]] += docs[inside]
        if dense is not None:
            parts = dense.reshape(-1, PART)
            used = np.flatnonzero(parts.any(axis=1))
            leaf = int(TaskContext.get().partitionId() ** 0.5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(np.full(len(used), leaf)), pa.array([parts[k].tobytes() for k in used], pa.binary())], names=["part", "leaf", "counts"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, slices in runs(batches):
            total = np.zeros(PART, np.int64)
            for piece in slices:
                for one in _longs(piece.column(1)):
                    total += one
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"])

    schema = "part long, counts binary"
    leaves = partial.mapInArrow(count, "part long, leaf long, counts binary")
    twigs = leaves.repartition("part", "leaf").select("part", "counts").sortWithinPartitions("part").mapInArrow(add, schema)
    return twigs.repartition("part").sortWithinPartitions("part").mapInArrow(add, schema)


def _expanded(vectors: DataFrame, low: int, high: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), _longs(batch.column(1))):
                counts = counts[: max(0, high - low - part * PART)]
                yield pa.RecordBatch.from_arrays([pa.array(low + part * PART + np.arange(len(counts))), pa.array(counts)], names=["slot", "docs"])

    return vectors.mapInArrow(run, "slot long, docs long")


def count_table(partial: DataFrame, table: int = TABLE) -> tuple[PerfectHash, DataFrame]:
    """The hash of all distinct pairs, and (slot, key, docs, best): in how many texts a pair is linked, and whether no pair of its A id is in more."""
    keys = materialize(_distinct(partial), "pairs")
    hashed = perfect_hash(keys, keys.count())
    shared = partial.sparkSession.sparkContext.broadcast(hashed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value(batch.column(0).to_numpy(zero_copy_only=False))), batch.column(0)], names=["slot", "key"])

    counts = [_expanded(_vectors(partial, shared, low, min(low + table, hashed.n)), low, min(low + table, hashed.n)) for low in range(0, max(hashed.n, 1), table)]
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.union(more)
    joined = materialize(keys.mapInArrow(place, "slot long, key long").join(whole, "slot"), "counts")
    token = F.shiftright("key", SHIFT)
    highest = joined.groupBy(token.alias("a")).agg(F.max("docs").alias("highest"))
    best = joined.withColumn("a", token).join(highest, "a").select("slot", "key", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    return hashed, materialize(best, "table")


FIELDS = [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [T.StructField("groups_sha256", T.StringType())]


def align(docs: DataFrame, files: Files, text: str = "text", table: int = TABLE, keep: bool = True) -> DataFrame:
    """``docs`` with the alignment of every text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The texts are encoded once, and their ids written; ``keep=False`` leaves the texts out of the files and of the result. Two passes over
    the ids follow. The first counts, in how many texts each A-B id pair is linked: the distinct pairs get a minimal perfect hash, and
    count vectors indexed by it are summed as a tree. The second aligns every text again and looks its links up; the key kept for a slot is
    compared. The count table is cut into ranges of ``table`` slots, which are worked off one after the other: a task never holds more
    than one range, whatever the number of pairs.

    A null or empty text, or one that either tokenizer does not give back byte for byte, has no tokens: zeros and an empty digest. Rows that repeat
    count each; an empty table gives an empty result. Other columns pass through; one that has the name of a result is replaced.
    """
    coded = encoded(docs, files, text)
    coded = materialize(coded if keep else coded.drop(text), "ids")
    partial = materialize(pair_counts(coded, files), "partial")
    hashed, rows = count_table(partial, table)
    context = docs.sparkSession.sparkContext
    done = None
    for low in range(0, max(hashed.n, 1), table):
        got = rows.where((F.col("slot") >= low) & (F.col("slot") < low + table)).toArrow()
        slot = got["slot"].to_numpy() - low
        keys, docs_of, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64), np.zeros(len(slot), bool)
        keys[slot], docs_of[slot], best[slot] = got["key"].to_numpy(), got["docs"].to_numpy(), got["best"].to_numpy()
        shared = context.broadcast((hashed, low, keys.astype(np.uint32), docs_of, best))
        if done is None:
            done = with_columns(coded, IDS, FIELDS, _looked_up(shared, files))
        else:
            done = with_columns(materialize(done, "ranges"), [*IDS, "n_best", "count_sum"], FIELDS[4:6], _added(shared, files))
    names = [f.name for f in FIELDS]
    return done.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names and (keep or c != text)], *names)


def _sums(aligned: Aligned, shared) -> tuple[np.ndarray, np.ndarray]:
    hashed, low, keys, docs, best = shared.value
    n_best, total = np.zeros(len(aligned.n_a), np.int64), np.zeros(len(aligned.n_a), np.int64)
    for doc, key, times in aligned.links():
        slot = hashed(key) - low
        inside = (slot >= 0) & (slot < len(keys))
        doc, key, times, slot = doc[inside], key[inside], times[inside], slot[inside]
        known = keys[slot] == key
        np.add.at(total, doc[known], docs[slot[known]] * times[known])
        np.add.at(n_best, doc[known], best[slot[known]] * times[known])
    return n_best, total


def _looked_up(shared, files: Files):
    def run(a: list, b: list) -> list[list]:
        found: list[list] = [[] for _ in FIELDS]
        for aligned in _aligned(a, b, files):
            columns = [aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links(), *_sums(aligned, shared)]
            for into, made in zip(found, [*(c.tolist() for c in columns), aligned.digests()]):
                into.extend(made)
        return found

    return run


def _added(shared, files: Files):
    def run(a: list, b: list, n_best: list, count_sum: list) -> list[list]:
        more: list[list] = [[], []]
        for aligned in _aligned(a, b, files):
            for into, made in zip(more, _sums(aligned, shared)):
                into.extend(made.tolist())
        return [[x + y for x, y in zip(old, new)] for old, new in zip((n_best, count_sum), more)]

    return run

"""Near-duplicates by MinHash: an inverted join over signature coordinates, confirmed on the whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.components import connected_components
from viewloom.session import materialize

#: Coordinates of a signature, and how many must agree: a pair of similarity 0.8 has fewer with a chance of about one in a million.
COORDINATES, AGREE = 64, 35
#: Rarest coordinates under which a text is posted: two texts that agree in AGREE coordinates share one of them.
PREFIX = COORDINATES - AGREE + 1
#: Shingles hashed at a time.
CHUNK = 1 << 14
#: Texts and shingles at home in one block of a posting list, texts up to which a list is compared as a whole, and cells of one comparison.
BLOCK, BLOCK_SHINGLES, SMALL, CELLS = 1024, 1 << 19, 8, 1 << 18
#: Partners per text confirmed before posting lists are searched across their blocks.
FIRST = 2
#: Partners that a text then proposes in a block, turn by turn, best first.
TURNS = (8, 128, 1 << 60)
#: Columns of one dense product of shingle counts, and the share of a block's texts from which a shingle has a dense column.
COLUMNS, DENSE = 1024, 1 / 32

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 1 << 63, COORDINATES, np.uint64)


def shingles(text: str | None, size: int = 4) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text: ``size`` neighbouring words with A-Z in lower case.

    Words are split at ASCII white space. A text with fewer words is one shingle; one without words (null, empty, blank) has none.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    n = len(words) - size + 1
    cuts = zip(starts[:n].tolist(), ends[size - 1 :].tolist())
    return np.unique(np.fromiter((xxh64_intdigest(joined[i:j]) for i, j in cuts), np.uint64, n))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash function, 32 bits each."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), CHUNK):
            part = hashes[k : k + CHUNK, None]
            mixed = (part ^ (part >> np.uint64(29))) * _FACTORS + _TERMS
            least = np.minimum(least, ((mixed ^ (mixed >> np.uint64(32))) * _FACTORS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _text_id(text: Column) -> Column:
    """128 bits that stand for a text where its signed row meets it again."""
    return F.concat_ws("-", F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("again"), text)))


def _signed(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, signatures = [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text, size)
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(signature(found).astype("<u4").tobytes() if len(found) else None)
            made = [pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["doc_id", "text_id", "n", "digest", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_id", "text").mapInArrow(run, f"doc_id {kind}, text_id string, n long, digest binary, signature binary")


def _coordinates(classes: DataFrame) -> DataFrame:
    """(class, value): a row for each coordinate of each signature; the value holds the coordinate in its high bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").astype(np.int64)
            values |= np.tile(np.arange(COORDINATES), batch.num_rows) << 32
            again = pa.array(np.repeat(np.arange(batch.num_rows), COORDINATES))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(again), pa.array(values)], names=["class", "value"])

    return classes.select("class", "signature").mapInArrow(run, "class long, value long")


def _posts(classes: DataFrame) -> DataFrame:
    """(class, value, size): each class under the rarest of its coordinate values that it shares with another class.

    A value that no other class has is rarer than any shared one and uses up a place of the prefix. A class with fewer shared values than must
    agree has no partner.
    """
    frequent = _coordinates(classes).groupBy("value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = _coordinates(classes).join(frequent, "value")
    sorted_values = F.sort_array(F.collect_list(F.struct("size", "value")))
    lists = shared.groupBy("class").agg(sorted_values.alias("shared")).where(F.size("shared") >= AGREE)
    prefix = F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.size("shared") - F.lit(COORDINATES - PREFIX)))
    return lists.select("class", F.explode(prefix).alias("post")).select("class", "post.value", "post.size")


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many coordinates agree, for all rows of a with all rows of b; sketches keep 8 bits a coordinate, so this is never too low."""
    total = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip(a.T, b.T):
        total += x[:, None] == y
    return total


class _Rows:
    """Columns of sorted rows (value, block, side, class, label, n, sketch and, for long lists, shingles)."""

    def __init__(self, columns: list[np.ndarray]):
        self.columns = columns
        self.value, self.block, self.side, self.key, self.label, self.n, self.sketch, *self.rest = columns

    @staticmethod
    def of(batch: pa.RecordBatch) -> _Rows:
        plain = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        sketch = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(-1, COORDINATES)
        rest = []
        if batch.num_columns > 7:
            rest = [np.empty(batch.num_rows, object)]
            rest[0][:] = batch.column(7).to_pylist()
        return _Rows([*plain, sketch, *rest])

    def pick(self, at) -> _Rows:
        return _Rows([c[at] for c in self.columns])

    def after(self, before: _Rows | None) -> _Rows:
        return self if before is None else _Rows([np.concatenate(pair) for pair in zip(before.columns, self.columns)])

    def __len__(self) -> int:
        return len(self.value)


def _fits(a_n: np.ndarray, b_n: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a_n, b_n) >= percent * np.maximum(a_n, b_n)


class _Index:
    """The shingles (32 bits each) of the texts at home in a block, by shingle: intersection sizes of visitors with all of them at once.

    Frequent shingles are dense columns, worked off by matrix products; the others are lists of texts. Shingles that share their 32 bits make
    a count too high, never too low.
    """

    def __init__(self, sets: np.ndarray):
        parts = [np.frombuffer(x, "<u4") for x in sets]
        flat = np.concatenate([*parts, np.zeros(0, np.uint32)])
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        order = np.argsort(flat, kind="stable")
        self.texts, self.owner = len(parts), owner[order]
        self.value, self.start, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.column = np.full(len(self.value), -1)
        often = np.flatnonzero(self.count > max(SMALL, DENSE * len(parts)))
        self.column[often] = np.arange(len(often))
        self.dense = np.repeat(self.column, self.count)

    def common(self, sets: np.ndarray) -> np.ndarray:
        parts = [np.frombuffer(x, "<u4") for x in sets]
        flat = np.concatenate(parts)
        guest = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        at = np.minimum(np.searchsorted(self.value, flat), len(self.value) - 1)
        hit = self.value[at] == flat
        at, guest = at[hit], guest[hit]
        column = self.column[at]
        rare = column < 0
        count = self.count[at[rare]]
        entry = np.repeat(self.start[at[rare]], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        cell = np.repeat(guest[rare], count) * self.texts + self.owner[entry]
        total = np.bincount(cell, minlength=len(parts) * self.texts).reshape(len(parts), self.texts).astype(np.float32)
        for first in range(0, int(self.column.max(initial=-1)) + 1, COLUMNS):
            homes, guests = np.zeros((self.texts, COLUMNS), np.float32), np.zeros((len(parts), COLUMNS), np.float32)
            mine, theirs = (self.dense >= first) & (self.dense < first + COLUMNS), (column >= first) & (column < first + COLUMNS)
            np.add.at(homes, (self.owner[mine], self.dense[mine] - first), 1)
            np.add.at(guests, (guest[theirs], column[theirs] - first), 1)
            total += guests @ homes.T
        return total.astype(np.int64)


_MORE = pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32())], names=["a", "b", "agree"])


def _found(a: np.ndarray, b: np.ndarray, agree: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(agree.astype(np.int32))], names=["a", "b", "agree"])


def _proposals(limit: int, percent: int):
    """Pairs of one block of a posting list that agree in enough coordinates and have different labels.

    Rows come sorted: those at home in the block (side 0, or 1 if they look for partners as well), then visitors from other blocks (side 2). A
    looking row proposes the ``limit`` homes that it agrees with best; a row of nulls says that some row had more. Where rows carry their
    shingles, only pairs that are similar enough by them are proposed.
    """

    def look(homes: _Rows, guests: _Rows) -> Iterator[pa.RecordBatch]:
        index = None
        step = max(1, CELLS // max(1, len(homes)))
        for k in range(0, len(guests) if len(homes) else 0, step):
            some = guests.pick(slice(k, k + step))
            agree = _agreeing(some.sketch, homes.sketch)
            agree[(agree < AGREE) | ~_fits(some.n[:, None], homes.n, percent) | (some.label[:, None] == homes.label)] = 0
            near = np.flatnonzero(agree.any(axis=1))
            some, agree = some.pick(near), agree[near]
            if len(some) and some.rest:
                index = index or _Index(homes.rest[0])
                common = index.common(some.rest[0])
                agree[100 * common < percent * (some.n[:, None] + homes.n - common)] = 0
            order = np.argsort(-agree.astype(np.int16), axis=1, kind="stable")[:, :limit]
            best = np.take_along_axis(agree, order, 1)
            i, j = np.nonzero(best)
            if len(i):
                yield _found(some.key[i], homes.key[order[i, j]], best[i, j])
            if ((agree > 0).sum(axis=1) > limit).any():
                yield _MORE

    def few(rows: _Rows, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All pairs of short lists, by their distance in the sorted rows."""
        for lag in range(1, SMALL):
            at = np.flatnonzero(run[lag:] == run[:-lag])
            if not len(at):
                break
            a, b = rows.pick(at), rows.pick(at + lag)
            agree = (a.sketch == b.sketch).sum(axis=1)
            good = (agree >= AGREE) & (a.label != b.label) & _fits(a.n, b.n, percent) & (np.maximum(a.side, b.side) > 0)
            x, y, agree = a.key[good], b.key[good], agree[good]
            if len(x):
                yield _found(np.concatenate((x, y)), np.concatenate((y, x)), np.concatenate((agree, agree)))

    def whole(rows: _Rows, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        sizes = np.diff([0, *edge, len(rows)])
        number = np.repeat(np.arange(len(sizes)), sizes)
        # lists that come with shingles or with visitors are long ones
        long = (sizes > SMALL) | bool(rows.rest)
        long[number[rows.side == 2]] = True
        inner = ~long[number]
        yield from few(rows.pick(inner), number[inner])
        starts = np.cumsum(sizes) - sizes
        for k in np.flatnonzero(long):
            one = rows.pick(slice(int(starts[k]), int(starts[k] + sizes[k])))
            yield from look(one.pick(one.side < 2), one.pick(one.side > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Rows | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Rows.of(batch).after(held)
            edge = np.flatnonzero((np.diff(rows.value) != 0) | (np.diff(rows.block) != 0)) + 1
            last = int(edge[-1]) if len(edge) else 0
            yield from whole(rows.pick(slice(0, last)), edge[:-1])
            held = rows.pick(slice(last, None))
            if len(held) > 2 * BLOCK and (held.side == 2).any():
                # all homes of this block have been read: its visitors need not be kept
                homes = held.pick(held.side < 2)
                yield from look(homes, held.pick(held.side == 2))
                held = homes
        if held is not None:
            yield from whole(held, np.zeros(0, np.int64))

    return run


PAIR = "a long, b long, agree int"


def _propose(members: DataFrame, limit: int, percent: int) -> DataFrame:
    rows = members.select("value", "block", "side", "class", "label", "n", "sketch", *[c for c in members.columns if c == "shingles"])
    dealt = rows.repartition("value", "block").sortWithinPartitions("value", "block", "side", "class")
    return dealt.mapInArrow(_proposals(limit, percent), PAIR)


def _home(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("class", "value"), blocks)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _first_pairs(posts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the best partners of its own blocks: most classes of a group become one here, at a cost in proportion to the rows."""
    members = posts.join(classes.select("class", "n", "sketch"), "class")
    members = members.select("*", _home(F.ceil(F.col("size") / BLOCK)).alias("block"), F.lit(1).alias("side"), F.col("class").alias("label"))
    best = F.slice(F.sort_array(F.collect_set(F.struct("agree", "b")), asc=False), 1, FIRST)
    found = _propose(members, FIRST, percent).where("a is not null").groupBy("a").agg(best.alias("best"))
    return _ordered(found.select("a", F.explode("best").alias("one")).select("a", "one.b"))


def _mixed(posts: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Posting lists that hold several labels, as home and visiting rows: rows of the list's commonest label stay in their block and need not
    meet each other; every other row visits all blocks."""
    named = posts.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    labelled = materialize(named.join(classes.select("class", "n"), "class"), "labelled")
    counted = labelled.groupBy("value", "label").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("shingles"))
    lists = counted.groupBy("value").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("count").alias("texts"), F.sum("shingles").alias("shingles"), F.max_by("label", F.struct("count", "label")).alias("common")
    )
    # a short list is one block; a long one is cut by texts and by shingles
    blocks = F.when(F.col("texts") <= SMALL, 1).otherwise(F.greatest(F.ceil(F.col("texts") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))
    lists = lists.where("labels > 1").select("value", "common", "texts", blocks.cast("long").alias("blocks"))
    rows = labelled.join(lists, "value").withColumn("home", _home(F.col("blocks")))
    minor = F.col("label") != F.col("common")
    visited = F.when(minor, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("home"))
    side = F.when(~minor, 0).when(F.col("block") == F.col("home"), 1).otherwise(2)
    return rows.withColumn("block", F.explode(visited)).select("class", "value", "block", "texts", side.alias("side"))


def _sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(class, set, shingles) for the given classes, from one of the texts of each: 64 bits a shingle, and 32 for the search in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            keys, sets, halves = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != before:  # copies of a text follow each other
                    keys.append(key)
                    whole = shingles(text, size)
                    sets.append(whole.astype("<u8").tobytes())
                    halves.append((whole & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                before = key
            columns = [pa.array(keys, pa.int64()), pa.array(sets, pa.binary()), pa.array(halves, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "set", "shingles"])

    wanted = docs.join(classes.select("class", "text_id"), "text_id").select("class", "text").sortWithinPartitions("class")
    return wanted.mapInArrow(run, "class long, set binary, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(one, "<u8"), np.frombuffer(other, "<u8")
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("left")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("set").alias("right")), "b").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a long, b long").distinct()


def links(docs: DataFrame, classes: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """(class, label): the classes that have a link, with the least class that they reach.

    ``docs`` has (text_id, text), ``classes`` one row per distinct set: (class, text_id, n, signature, sketch). Classes are posted under each of their
    coordinate values that can still matter, the rarest first; lists are cut into blocks. First every class is compared inside its own
    blocks and its best partners are confirmed on whole sets. Where a list then still holds several components, the rows outside its
    commonest one meet all its blocks. In a short list every pair of different components that agrees in enough coordinates is confirmed; in a long
    one the tasks themselves compare the shingles, and only pairs that pass are, best partners first: dissimilar
    pairs of a large group are never rows. Pairs inside a component are never made: they would add nothing.
    """
    posts = materialize(_posts(classes), "posts")
    live = classes.join(posts.select("class").distinct(), "class", "left_semi")
    sets = materialize(_sets(docs, live, size), "sets")
    tested = materialize(_first_pairs(posts, classes, percent), "tested")
    labels = _labels(materialize(_confirmed(tested, sets, percent), "confirmed"))
    rows = materialize(_mixed(posts, classes, labels), "mixed")
    for turn, limit in enumerate(TURNS):
        members = rows.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class")).join(classes.select("class", "n", "sketch"), "class")
        proposed = _propose(members.where(F.col("texts") > SMALL).join(sets.select("class", "shingles"), "class"), limit, percent)
        if not turn:
            proposed = proposed.union(_propose(members.where(F.col("texts") <= SMALL), limit, percent))
        proposed = materialize(proposed, "proposed")
        fresh = materialize(_ordered(proposed.where("a is not null")).join(tested, ["a", "b"], "left_anti"), "fresh")
        tested = tested.union(fresh)
        found = materialize(_confirmed(fresh, sets, percent), "confirmed")
        if not found.isEmpty():
            # the components so far are stars: with the new links between them few rounds are left
            labels = _labels(labels.toDF("a", "b").union(found))
        if proposed.where("a is null").isEmpty():
            break
    return labels


def _labels(found: DataFrame) -> DataFrame:
    return materialize(connected_components(found, "a", "b").toDF("class", "label"), "labels")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: (key, n_shingles, component_id, kept).

    Two documents are linked if their sets of distinct shingles have 100 * intersection >= percent * union; a component is named by its least key, and
    that document is kept. Equal sets enter the search once. A text without words has an empty set and no link: it is its own
    component. A row with a null key never names a component and is not kept (its component is null if all keys in it are); repeated rows stay, a
    repeated least key is kept each time. An empty table gives an empty result; other columns are not looked at.
    Candidates agree in AGREE of COORDINATES hash minima (see there for the chance of missing a link at the threshold itself); every link is confirmed on whole sets.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("text_id", _text_id(F.col("text")))
    marked = materialize(_signed(rows, size).withColumn("row", F.monotonically_increasing_id()), "signed")
    sketch = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda i: F.substring(F.hex("signature"), i * 8 + 1, 2)), ""))
    first = F.min_by(F.struct("text_id", "n", "signature"), F.col("row"))
    grouped = marked.where("n > 0").groupBy("digest").agg(F.min("row").alias("class"), F.min("doc_id").alias("least"), first.alias("one"))
    classes = materialize(grouped.select("digest", "class", "least", "one.*").withColumn("sketch", sketch), "classes")
    labels = links(rows.select("text_id", "text"), classes, size, percent)
    rooted = classes.join(labels, "class", "left").select("digest", "least", F.coalesce("label", "class").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("digest", "component_id"), "named")
    whole = marked.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(False))
    return whole.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))

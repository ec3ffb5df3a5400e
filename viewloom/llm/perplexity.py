"""Quality rules by n-gram perplexity under a modified Kneser-Ney model."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.common import WORD, code_points, slices
from viewloom.session import materialize

#: The model looks at characters, this many at a time. A character takes so many bits, so three fit a long: an n-gram of the highest
#: order is its first character (head) and the other three (tail), a shorter one is a tail alone.
ORDER, BITS = 4, 21
FIRST, LAST = 0x1FFFFF, 0x1FFFFE
#: The model is counted on documents of at least so many words with at most this share of symbols per word.
FEWEST_WORDS, SYMBOL_SHARE = 10, 0.05
#: A band reaches this many quartile distances, and at least so far, to both sides of the median log-perplexity of those documents.
REACH, NARROWEST = 3.0, 0.15
#: Joins the fold and the language in a model that is counted in two folds.
FOLD = "\x00"
#: Characters, and distinct n-grams of the counts, that a task holds before it works them off.
HELD = 1 << 21
#: Entries of the model that every task holds (16 bytes each): the commonest ones. What they do not settle is joined with the model.
COMMON = 1 << 21
#: Bits of the n-grams in one range of hashes of the model.
RANGE_BITS = 22

_SYMBOL = re.compile(r"[#*$%&|<>]")
_WINDOW = 5


# --- base rules ---------------------------------------------------------------------------------------------------------


def base_features(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines with a word, words in five-word windows found twice); all 0 for null."""
    if not text:
        return 0, 0, 0, 0, 0
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = list(zip(*(words[i:] for i in range(_WINDOW))))
    counts = Counter(windows)
    repeated = 0
    if len(counts) < len(windows):
        again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
        marks = np.zeros(len(words) + 1, np.int64)
        at = np.flatnonzero(again)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + _WINDOW, -1)
        repeated = int((np.cumsum(marks) > 0).sum())
    return len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated


def _reference(text: str | None) -> bool:
    if not text:
        return False
    words = sum(1 for _ in WORD.finditer(text))
    return words >= FEWEST_WORDS and len(_SYMBOL.findall(text)) <= SYMBOL_SHARE * words


# --- counting -----------------------------------------------------------------------------------------------------------


def _symbols(text: str) -> Iterator[np.ndarray]:
    """The characters of a text between its marks, in slices that share ORDER - 1 of them."""
    n = ORDER - 1
    pieces = list(slices(text, n))
    for k, piece in enumerate(pieces):
        first, last = [FIRST] * n if k == 0 else [], [LAST] if k == len(pieces) - 1 else []
        yield np.concatenate((np.array(first, np.uint32), code_points(piece), np.array(last, np.uint32)))


def _grams(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(head, tail) of the n-grams of the highest order of all slices, in their order: len - ORDER + 1 of each."""
    joined = np.concatenate(pieces).astype(np.int64)
    inside = np.ones(len(joined) - ORDER + 1, bool)
    for end in np.cumsum([len(p) for p in pieces])[:-1].tolist():
        inside[end - ORDER + 1 : end] = False
    tail = joined[1:-2] << 2 * BITS | joined[2:-1] << BITS | joined[3:]
    return joined[: 1 - ORDER][inside], tail[inside]


def _mix(head: np.ndarray | int, tail: np.ndarray, order: int, salt: int) -> np.ndarray:
    """A 64-bit hash of n-grams of one order and language."""
    x = tail.astype(np.uint64) ^ np.uint64(salt)
    x = (x + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32)) ^ np.asarray(head).astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(language: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(language.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the hashes, and where in it each distinct one begins."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    return order, np.flatnonzero(np.concatenate((np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1])))


def count(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, head, tail, n) over all documents that pass the reference rule; a null language is the language ''."""
    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), F.col(f"`{text}`").alias("text"))
    names = ["lang", "head", "tail", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, ...]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def merge(language: str) -> None:
            head, tail = _grams(waiting.pop(language))
            parts = (_mix(head, tail, ORDER, 0), head, tail, np.ones(len(head), np.int64))
            if language in held:
                parts = tuple(np.concatenate(x) for x in zip(held[language], parts))
            order, starts = _runs(parts[0])
            held[language] = (*(x[order[starts]] for x in parts[:3]), np.add.reduceat(parts[3][order], starts))

        def flush() -> Iterator[pa.RecordBatch]:
            for language, (_, head, tail, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(head), pa.string()), pa.array(head), pa.array(tail), pa.array(n)], names=names)
            held.clear()

        for batch in batches:
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not _reference(body):
                    continue
                for piece in _symbols(body):
                    waiting.setdefault(language, []).append(piece)
                    size += len(piece)
                    if size > HELD:
                        for key in list(waiting):
                            merge(key)
                        size = 0
                        if sum(len(x[0]) for x in held.values()) > HELD:
                            yield from flush()
        for key in list(waiting):
            merge(key)
        yield from flush()

    return rows.mapInArrow(run, "lang string, head long, tail long, n long").groupBy("lang", "head", "tail").agg(F.sum("n").alias("n"))


# --- model --------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Entries:
    """Sorted hashes of entries of the model with their values; ``whole`` if the model has no others."""

    hashes: np.ndarray
    log_p: np.ndarray
    log_w: np.ndarray
    whole: bool

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes, -1 where missing."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def resolve(self, head: np.ndarray, tail: np.ndarray, salt: int) -> np.ndarray:
        """Log-probability of the last character of each n-gram after the others; NaN where entries that are not here may decide."""
        value, left = np.full(len(tail), 0.0), np.arange(len(tail))
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                head, tail = np.zeros(len(tail), np.int64), tail & ((1 << BITS * order) - 1)
            at = self.find(_mix(head, tail, order, salt))
            hit = at >= 0
            value[left[hit]] += self.log_p[at[hit]]
            left, head, tail = left[~hit], head[~hit], tail[~hit]
            if not self.whole:
                value[left] = np.nan
                break
            if order == 1:
                value[left] += self.log_p[self.find(_mix(0, np.zeros(1, np.int64), 0, salt))]
            else:
                context = self.find(_mix(0, head << 2 * BITS | tail >> BITS, order - 1, salt))
                known = context >= 0
                value[left[known]] += self.log_w[context[known]]
        return value


@dataclass(frozen=True)
class Model:
    """``table`` (part, hash, lang, order, head, tail, raw, log_p, log_w): by ranges of hashes, sorted, the n-grams of all orders and languages with the log-probability of each and its log-weight as a context.

    Order 0 of a language is the log-probability of a character that it does not know. ``common`` are the COMMON commonest entries, all if there are no more.
    """

    table: DataFrame
    common: Entries
    folded: bool = False


def _discount(n: Column) -> Column:
    return F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def _discounts(grams: DataFrame) -> DataFrame:
    """(l, d1, d2, d3) of an order: modified Kneser-Ney from the counts of counts, 0.5, 1 and 1.5 where they do not allow it."""
    n1, n2, n3, n4 = (F.sum(F.when(F.col("adjusted") == k, 1).otherwise(0)).alias(f"n{k}") for k in range(1, 5))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    raw = [1 - 2 * y * F.col("n2") / F.col("n1"), 2 - 3 * y * F.col("n3") / F.col("n2"), 3 - 4 * y * F.col("n4") / F.col("n3")]
    counted = grams.groupBy("lang").agg(n1, n2, n3, n4)
    usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    guarded = counted.select(F.col("lang").alias("l"), *[F.when(usable, F.col(f"n{k}")).otherwise(F.lit(1)).alias(f"n{k}") for k in range(1, 5)], usable.alias("usable"))
    usable = F.col("usable")
    fine = [F.when(usable & (d > 0) & (d < k), d).otherwise(F.lit(k / 2)) for k, d in enumerate(raw, 1)]
    return guarded.select("l", *[d.alias(f"d{k}") for k, d in enumerate(fine, 1)])


def _context(order: int) -> Column:
    return F.shiftright("tail", BITS) if order < ORDER else F.shiftleft("head", 2 * BITS).bitwiseOR(F.shiftright("tail", BITS))


def _suffix(order: int) -> Column:
    return F.col("tail").bitwiseAND((1 << BITS * (order - 1)) - 1)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts all reference documents and builds the model.

    The counts of the highest order are exact; a lower order counts the different characters in front (how often, at the start of a
    text). Discounts, context sums and context weights come from all counts. Every n-gram counted enters the model, which grows with the corpus
    and stays on the executors; the driver reads no more than COMMON entries. Every character is one of its own. An empty table gives an empty model.
    """
    grams = materialize(count(docs, text, lang), "grams")
    entries = grams.count()
    grams = grams.select("lang", "head", "tail", F.col("n").alias("raw"), F.col("n").alias("adjusted"))
    priced, sums = {}, {}
    for order in range(ORDER, 0, -1):
        # one row per language, of known size: joining it does not deal the n-grams out by language
        discounts = materialize(_discounts(grams), f"discounts{order}")
        own = grams.join(discounts, F.col("lang") == F.col("l")).withColumn("d", _discount(F.col("adjusted")))
        priced[order] = own.select("lang", "head", "tail", "raw", (F.col("adjusted") - F.col("d")).alias("kept"), _context(order).alias("context"))
        weights = own.groupBy("lang", _context(order).alias("context")).agg(F.sum("adjusted").alias("c"), F.sum("d").alias("mass"))
        sums[order] = materialize(weights.select("lang", "context", "c", (F.col("mass") / F.col("c")).alias("w")), f"contexts{order}")
        if order > 1:
            start = F.shiftright(F.col("s"), BITS * (order - 2)) == FIRST
            lower = grams.select("lang", _suffix(order).alias("s"), "raw", "adjusted").groupBy("lang", "s").agg(F.sum("raw").alias("raw"), F.count(F.lit(1)).alias("kinds"))
            grams = lower.select("lang", F.lit(0).cast("long").alias("head"), F.col("s").alias("tail"), "raw", F.when(start, F.col("raw")).otherwise(F.col("kinds")).alias("adjusted"))
            grams = materialize(grams, f"grams{order - 1}")
    # one row per language: what a character that was never seen gets
    kinds = grams.groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("uniform"))
    unknown = materialize(kinds.join(sums[1], "lang").select("lang", (F.col("w") * F.col("uniform")).alias("below")), "unknown")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("double")
    most = F.lit(2**63 - 1)
    parts = [unknown.select("lang", F.lit(0).alias("order"), zero.alias("head"), zero.alias("tail"), most.alias("raw"), F.col("below").alias("p"), none.alias("w"))]
    lower = unknown
    for order in range(1, ORDER + 1):
        own = priced[order].join(sums[order], ["lang", "context"])
        if order == 1:
            own = own.join(unknown, "lang").withColumn("p", F.col("kept") / F.col("c") + F.col("below"))
        else:
            below = lower.select("lang", F.col("tail").alias("suffix"), F.col("p").alias("below"))
            own = own.withColumn("suffix", _suffix(order)).join(below, ["lang", "suffix"]).withColumn("p", F.col("kept") / F.col("c") + F.col("w") * F.col("below"))
        lower = materialize(own.select("lang", "head", "tail", "raw", "p"), f"probabilities{order}")
        part = lower.withColumn("w", none)
        if order < ORDER:
            # marks before the first character are contexts only
            part = lower.join(sums[order + 1].select("lang", F.col("context").alias("tail"), "w"), ["lang", "tail"], "full")
        parts.append(part.select("lang", F.lit(order).alias("order"), F.coalesce("head", zero).alias("head"), "tail", F.coalesce("raw", most).alias("raw"), "p", "w"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    table = materialize(_sorted(rows, entries), "model")
    whole = table.count() <= COMMON
    common = table if whole else table.orderBy(F.col("raw").desc(), "hash").limit(COMMON)
    held = common.select("hash", "log_p", "log_w").toArrow()
    hashes, log_p, log_w = (held.column(c).to_numpy() for c in ("hash", "log_p", "log_w"))
    order = np.argsort(hashes.view(np.uint64))
    return Model(table, Entries(hashes.view(np.uint64)[order], log_p[order], log_w[order], whole))


def _sorted(rows: DataFrame, entries: int) -> DataFrame:
    """The entries with hash, log_p and log_w, in ranges of hashes, sorted by hash. The number of ranges grows with the model."""
    shift = 64 - max(1, entries.bit_length() - RANGE_BITS + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            salts = np.array([_salt(x) for x in langs.dictionary.to_pylist()], np.uint64)
            order, head, tail = (batch.column(i).to_numpy() for i in range(1, 4))
            hashes = np.zeros(len(tail), np.uint64)
            for k in range(ORDER + 1):
                at = np.flatnonzero(order == k)
                hashes[at] = _mix(head[at], tail[at], k, salts[langs.indices.to_numpy()[at]])
            logs = [np.log(np.maximum(np.where(np.isnan(x), 1.0, x), 1e-12)).astype(np.float32) for x in (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (5, 6))]
            columns = [pa.array((hashes >> np.uint64(shift)).astype(np.int64)), pa.array(hashes.view(np.int64)), *batch.columns[:5], *map(pa.array, logs)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "hash", *batch.schema.names[:5], "log_p", "log_w"])

    return rows.mapInArrow(run, "part long, hash long, lang string, order int, head long, tail long, raw long, log_p float, log_w float").repartition("part").sortWithinPartitions("part", "hash")


def _fold(text: str, lang: str, other: bool) -> Column:
    """The language of a document in its own or in the other fold; copies of a text are in the same fold."""
    own = F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(2))
    return F.concat((1 - own if other else own).cast("string"), F.lit(FOLD), F.coalesce(F.col(f"`{lang}`"), F.lit("")))


def fit_folds(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model counted in two folds by a hash of the text, so that a document is scored by counts without it and its copies."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), _fold(text, lang, False).alias("lang"))
    return replace(fit(rows), folded=True)


# --- scores -------------------------------------------------------------------------------------------------------------


def _portions(texts: Iterator[tuple[int, str | None, str]]) -> Iterator[tuple[str, list[int], list[np.ndarray]]]:
    """(language, place of the document of each slice, slices) of texts that are not empty, HELD characters at a time."""
    waiting: dict[str, tuple[list[int], list[np.ndarray]]] = {}
    size = 0
    for place, text, language in texts:
        for piece in _symbols(text) if text else ():
            places, pieces = waiting.setdefault(language, ([], []))
            places.append(place)
            pieces.append(piece)
            size += len(piece)
            if size > HELD:
                yield from ((key, *value) for key, value in waiting.items())
                waiting, size = {}, 0
    yield from ((key, *value) for key, value in waiting.items())


def _joined(grams: DataFrame, table: DataFrame) -> DataFrame:
    """(lang, head, tail, value) of distinct n-grams: what ``Entries.resolve`` gives, by one join with all entries of the model."""
    keys, p, w = [], [], []
    for order in range(ORDER, -1, -1):
        mask = F.lit((1 << BITS * order) - 1) if order < ORDER else None
        tail = F.col("tail") if mask is None else F.col("tail").bitwiseAND(mask)
        head = F.col("head") if mask is None else F.lit(0).cast("long")
        keys.append(F.struct(F.lit(order).alias("order"), F.lit(False).alias("front"), head.alias("h"), tail.alias("t")))
        if 0 < order < ORDER:
            context = _context(ORDER).bitwiseAND(F.lit((1 << BITS * order) - 1))
            keys.append(F.struct(F.lit(order).alias("order"), F.lit(True).alias("front"), F.lit(0).cast("long").alias("h"), context.alias("t")))
    entries = table.select("lang", "order", F.col("head").alias("h"), F.col("tail").alias("t"), "log_p", "log_w")
    asked = grams.select("lang", "head", "tail", F.inline(F.array(*keys)))
    for order in range(ORDER + 1):
        mine = F.col("order") == order
        p.append(F.max(F.when(mine & ~F.col("front"), F.col("log_p").cast("double"))).alias(f"p{order}"))
        w.append(F.max(F.when(mine & F.col("front"), F.col("log_w").cast("double"))).alias(f"w{order}"))
    found = asked.join(entries, ["lang", "order", "h", "t"]).groupBy("lang", "head", "tail").agg(*p, *w)
    value = F.col("p0")
    for order in range(1, ORDER + 1):
        value = F.coalesce(F.col(f"p{order}"), (F.coalesce(F.col(f"w{order - 1}"), F.lit(0.0)) if order > 1 else F.lit(0.0)) + value)
    return found.select("lang", "head", "tail", value.alias("value"))


def scores(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without its text, with the base features and ``log_perplexity``: the natural log of the perplexity per character, end mark included, of the whole text.

    The common entries of the model lie in every task, of bounded size. N-grams that they do not settle leave the task as rows, each once a document
    with its number, and are joined with the whole model; texts are not moved. Null without text, or where the model does not know the language.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    made = [*names, "log_perplexity", "__row", "__lang", "__total", "__n", "__open"]
    passed = [c for c in docs.columns if c not in {*made, text}]
    language = _fold(text, lang, True) if model.folded else F.coalesce(F.col(f"`{lang}`"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in passed], F.col(f"`{text}`").alias("__text"), language.alias("__lang"))
    common = model.common
    gram = pa.struct([("head", pa.int64()), ("tail", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(len(passed)).to_pylist(), batch.column(len(passed) + 1).to_pylist()
            total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            left: list[list] = [[] for _ in texts]
            known = {x: not common.whole or common.find(_mix(0, np.zeros(1, np.int64), 0, _salt(x)))[0] >= 0 for x in set(langs)}
            for key, places, pieces in _portions((k, t, x) for k, (t, x) in enumerate(zip(texts, langs)) if known[x]):
                head, tail = _grams(pieces)
                order, starts = _runs(_mix(head, tail, ORDER, 0))
                value = np.empty(len(head))
                value[order] = np.repeat(common.resolve(head[order[starts]], tail[order[starts]], _salt(key)), np.diff(np.append(starts, len(head))))
                sizes = np.array([len(p) - ORDER + 1 for p in pieces])
                begin = np.cumsum(sizes) - sizes
                unsettled = np.isnan(value)
                np.add.at(total, places, np.add.reduceat(np.where(unsettled, 0.0, value), begin))
                np.add.at(n, places, sizes)
                if unsettled.any():
                    for place, start, size in zip(places, begin.tolist(), sizes.tolist()):
                        at = np.flatnonzero(unsettled[start : start + size]) + start
                        pairs, times = np.unique(np.stack((head[at], tail[at])), axis=1, return_counts=True)
                        left[place] += [{"head": h, "tail": t, "times": c} for h, t, c in zip(*pairs.tolist(), times.tolist())]
            features = list(zip(*map(base_features, texts))) or [()] * len(names)
            own = [pa.array(x, pa.int64()) for x in features] + [batch.column(len(passed) + 1), pa.array(total), pa.array(n), pa.array(left, pa.list_(gram))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed)], *own], names=[*passed, *names, "__lang", "__total", "__n", "__open"])

    fields = [T.StructField(x, T.LongType()) for x in names] + [T.StructField("__lang", T.StringType()), T.StructField("__total", T.DoubleType()), T.StructField("__n", T.LongType())]
    times = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("head", "tail", "times")]))
    scored = rows.mapInArrow(run, T.StructType([*rows.schema.fields[: len(passed)], *fields, T.StructField("__open", times)]))
    score = F.when(F.col("__n") > 0, -F.col("__total") / F.col("__n"))
    kept = [F.col(f"`{c}`") for c in (*passed, *names)]
    if common.whole:
        return scored.select(*kept, score.alias("log_perplexity"))
    scored = materialize(scored.withColumn("__row", F.monotonically_increasing_id()), "settled")
    unsettled = scored.select("__row", F.col("__lang").alias("lang"), F.inline("__open"))
    values = _joined(unsettled.select("lang", "head", "tail").distinct(), model.table)
    rest = unsettled.join(values, ["lang", "head", "tail"], "left").groupBy("__row").agg(F.sum(F.col("value") * F.col("times")).alias("rest"), F.count("value").alias("found"), F.count(F.lit(1)).alias("all"))
    both = scored.drop("__open").join(rest, "__row", "left").withColumn("__total", F.col("__total") + F.coalesce("rest", F.lit(0.0)))
    whole = F.col("all").isNull() | (F.col("found") == F.col("all"))
    return both.select(*kept, F.when(whole, score).alias("log_perplexity"))


# --- rules --------------------------------------------------------------------------------------------------------------


def judge(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without its text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, log_perplexity, lower, upper and kept.

    Base rules: fewer than 10 words, or more than a fifth of them in repeated five-word windows. The band of a language reaches three quartile
    distances (at least 0.15) to both sides of the median log-perplexity of its documents that may be counted and that pass the base rules; a document outside it is
    not kept. A model of ``fit_folds`` scores each document by the fold without it; a language with documents in one fold only has no score. A language without a scored document has no band and rejects nothing. Null text counts as empty, a null language is
    one of its own, rows with null or repeated keys are judged like others, columns with the names of new ones are replaced.
    """
    made = {"base_failed", "lower", "upper", "kept"}
    scored = scores(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made]), model, text, lang)
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = materialize(scored.withColumn("base_failed", failed), "judged")
    clean = ~F.col("base_failed") & (F.col("n_symbols") <= SYMBOL_SHARE * F.col("n_words")) & F.col("log_perplexity").isNotNull()
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000)
    bands = materialize(scored.where(clean).groupBy(F.col(f"`{lang}`").alias("__lang")).agg(quartiles.alias("q")), "quartiles")
    reach = F.greatest(REACH * (F.col("q")[2] - F.col("q")[0]), F.lit(NARROWEST))
    bands = bands.select("__lang", (F.col("q")[1] - reach).alias("lower"), (F.col("q")[1] + reach).alias("upper"))
    judged = scored.join(bands, F.col(f"`{lang}`").eqNullSafe(F.col("__lang")), "left").drop("__lang")
    inside = F.col("lower").isNull() | F.col("log_perplexity").isNull() | F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return judged.withColumn("kept", ~F.col("base_failed") & inside)

"""Quality classifier: support vectors on n-gram indicators scaled by Naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.common import code_points, gram_buckets, slices, with_columns

#: Character n-grams of these orders are hashed; the last places hold n-grams of "same word as the one before" marks.
ORDERS, BITS = (1, 2, 3), 14
WIDTH, MARKS = 1 << BITS, 16
#: Bound of the labelled rows that the model is fitted on.
SAMPLE = 8000
#: Penalty of the hinge loss, passes over the sample, smoothing of the counts, slope of the score.
COST, PASSES, SMOOTH, SLOPE = 1.0, 30, 1.0, 2.0


def indicators(text: str | None) -> np.ndarray:
    """Which hashed n-grams a whole text has; none for null and empty texts."""
    found = np.zeros(WIDTH, bool)
    if not text:
        return found
    for piece in slices(text, max(ORDERS) - 1):
        points = code_points(piece)
        for order in ORDERS:
            found[gram_buckets(points, order, BITS) % (WIDTH - MARKS)] = True
    words = text.split()
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), np.int64, max(0, len(words) - 1))
    code, first = same, 0
    for order in range(1, 4):
        if len(code):
            found[WIDTH - MARKS + first + np.unique(code)] = True
        first += 1 << order
        code = code[:-1] << 1 | same[order:]
    return found


@dataclass(frozen=True)
class Model:
    """Ratios scale the indicators; ``weights`` belong to indicators scaled and brought to unit length."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt((self.ratios[found] ** 2).sum()))
        return self.bias + (float((self.weights * self.ratios)[found].sum()) / length if length else 0.0)


def _descend(rows: list[np.ndarray], ratios: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared hinge loss; the bias is a component of value 1."""
    scaled = []
    for at in rows:
        x = ratios[at]
        scaled.append(x / max(float(np.linalg.norm(x)), 1e-12))
    weights, bias = np.zeros(len(ratios)), 0.0
    alpha, own = np.zeros(len(rows)), np.array([1.0 + float(x @ x) for x in scaled])
    rng = np.random.default_rng(0)
    for _ in range(PASSES):
        most = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i], scaled[i]
            slope = y[i] * (float(weights[at] @ x) + bias) - 1 + alpha[i] / (2 * cost[i])
            if alpha[i] == 0 and slope >= 0:
                continue
            most = max(most, abs(slope))
            new = max(0.0, alpha[i] - slope / (own[i] + 1 / (2 * cost[i])))
            step, alpha[i] = (new - alpha[i]) * y[i], new
            weights[at] += step * x
            bias += step
        if most < 1e-2:
            break
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows, chosen by a hash of the key among those where ``usable`` holds and the label is 0 or 1.

    The labels chosen are few by that bound and are broadcast; the indicators of their documents come to the driver as bitmaps of fixed size. Both classes weigh
    the same. Without rows of both classes every text scores like the class there is (0.5 without any).
    """
    chosen = labels.where(usable & F.col(f"`{label}`").isin(0, 1)).select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("k"), "k", "y").limit(sample)
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "k").select("k", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(indicators(t)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["k", "y", "bits"])

    key_type = rows.schema["k"].dataType.simpleString()
    # one row per label, whatever number of documents has its key
    found = rows.mapInArrow(run, f"k {key_type}, y int, bits binary").groupBy("k", "y").agg(F.min("bits").alias("bits"))
    got = sorted(found.collect(), key=lambda r: (r["k"], r["y"], bytes(r["bits"])))
    y = np.array([1.0 if r["y"] else -1.0 for r in got])
    if not len(y) or abs(y.sum()) == len(y):
        return Model(np.zeros(WIDTH), np.zeros(WIDTH), float(y[0]) if len(y) else 0.0)
    bits = np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in got], bool)
    good, bad = SMOOTH + bits[y > 0].sum(axis=0), SMOOTH + bits[y < 0].sum(axis=0)
    ratios = np.log(good / good.sum()) - np.log(bad / bad.sum())
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    weights, bias = _descend([np.flatnonzero(b) for b in bits], ratios, y, COST * 0.5 / share)
    return Model(ratios, weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, higher: label 1 is likelier) and predicted (1 from 0.5 on).

    Null and empty texts have no n-gram and get the score of the bias alone. Columns of these names are replaced, all others kept.
    """

    def compute(texts: list) -> list[list]:
        margins = np.array([model.margin(indicators(t)) for t in texts])
        scores = 1 / (1 + np.exp(-SLOPE * np.clip(margins, -100, 100)))
        return [scores.tolist(), (scores >= 0.5).astype(int).tolist()]

    return with_columns(docs, [text], [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], compute)

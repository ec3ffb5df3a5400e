"""Language identification by nearest centroid over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.common import code_points, gram_buckets, slices, with_columns
from viewloom.session import materialize

ORDERS, BITS = (1, 2, 3), 12
WIDTH = 1 << BITS
#: Label of a text without a letter.
UNDETERMINED = "und"
#: Bound of the labelled rows per language that the centroids are fitted on.
PER_LANGUAGE = 1000
#: Centroids per language, rounds of clustering.
CLUSTERS, ROUNDS = 3, 8
#: Rejection: below this share of the least similarity (at the given quantile) seen in fitting, for texts of so many n-grams.
MARGIN, QUANTILE, FEWEST = 0.6, 0.002, 200

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, or a space."""
    if not _LETTERS:
        found = np.full(1 << 16, 32, np.uint32)
        for k in range(1 << 16):
            c = chr(k)
            if c.isalpha():
                low = c.lower()
                found[k] = ord(low) if len(low) == 1 else k
        _LETTERS.append(found)
    return _LETTERS[0]


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text; what is not a letter separates words and counts as one space. All zero without a letter."""
    counts = np.zeros(WIDTH, np.int64)
    if not text:
        return counts
    table = _letters()
    for piece in slices(text, max(ORDERS) - 1):
        points = code_points(piece)
        low = table[np.minimum(points, 0xFFFF)]
        if (points > 0xFFFF).any():
            for k in np.flatnonzero(points > 0xFFFF):
                c = chr(points[k])
                low[k] = ord(c.lower()[0]) if c.isalpha() else 32
        letter = low != 32
        if not letter.any():
            continue
        points = np.concatenate(([np.uint32(32)], low[letter | np.concatenate(([True], letter[:-1]))], [np.uint32(32)]))
        points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
        for order in ORDERS:
            counts += np.bincount(gram_buckets(points, order, BITS), minlength=WIDTH)
    return counts


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = (np.log1p(counts) * idf).astype(np.float32)
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    """Centroids (rows of unit length), the language of each, its least accepted similarity, and the IDF of each bucket."""

    idf: np.ndarray
    languages: tuple[str, ...]
    centroids: np.ndarray
    least: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / max(float(np.linalg.norm(x)), 1e-12)


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the mean and the vectors farthest from all centroids so far."""
    centroids = [_unit(vectors.mean(axis=0))]
    while len(centroids) < min(k, len(vectors)):
        best = (vectors @ np.array(centroids).T).max(axis=1)
        centroids.append(vectors[int(best.argmin())])
    found = np.array(centroids, np.float32)
    for _ in range(ROUNDS):
        nearest = (vectors @ found.T).argmax(axis=1)
        found = np.array([_unit(vectors[nearest == j].mean(axis=0)) if (nearest == j).any() else found[j] for j in range(len(found))], np.float32)
    return found


def fit(docs: DataFrame, labelled: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the rows where ``labelled`` holds and ``lang`` is not null.

    Document frequencies are counted over all these rows. The centroids of a language are clustered in one task from at
    most about ``per_language`` different rows with letters, chosen by a hash of key and text. The driver gets the document frequencies
    and a few centroids per language. Without a labelled row the model has no language.
    """
    rows = docs.where(labelled & F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").alias("lang"), F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), F.lit(1 << 30)).alias("draw"), F.col(f"`{text}`").alias("text")
    )
    # one row per language, of known size: joining it does not deal the texts out by language
    counts = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    share = F.when(F.col("n") <= per_language, F.lit(float(1 << 30))).otherwise(F.lit(float(1 << 30)) * per_language / F.col("n"))
    drawn = rows.join(counts.select(F.col("lang").alias("l"), share.alias("below")), F.col("lang") == F.col("l")).select("lang", "draw", "text", (F.col("draw") < F.col("below")).alias("taken"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, total = np.zeros(WIDTH, np.int64), 0
        names = ["lang", "draw", "bucket", "n", "counts"]
        for batch in batches:
            langs, draws, texts, taken = (batch.column(i).to_pylist() for i in range(4))
            out: list[tuple] = []
            for language, draw, body, keep in zip(langs, draws, texts, taken):
                found = gram_counts(body)
                frequency += found > 0
                total += 1
                if keep and found.any():
                    at = np.flatnonzero(found)
                    out.append((language, draw, None, None, np.stack((at, found[at])).astype(np.int32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=names)
        frequencies = np.append(frequency, total)
        n = len(frequencies)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(frequencies), pa.nulls(n, pa.binary())], names=names
        )

    seen = materialize(drawn.mapInArrow(count, "lang string, draw long, bucket int, n long, counts binary"), "grams")
    frequencies = {r[0]: r[1] for r in seen.where("bucket is not null").groupBy("bucket").agg(F.sum("n")).collect()}
    total = frequencies.pop(WIDTH, 0)
    idf = np.log((1 + total) / (1 + np.array([frequencies.get(k, 0) for k in range(WIDTH)]))) + 1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "counts"])
        counts = np.zeros((len(group), WIDTH), np.int32)
        for row, packed in zip(counts, group["counts"]):
            at, n = np.frombuffer(packed, np.int32).reshape(2, -1)
            row[at] = n
        vectors = _vectors(counts, idf)
        centroids = _cluster(vectors, CLUSTERS)
        best = (vectors @ centroids.T).max(axis=1)[counts.sum(axis=1) >= FEWEST]
        least = MARGIN * float(np.quantile(best, QUANTILE)) if len(best) else 0.0
        return pd.DataFrame({"lang": group["lang"].iloc[0], "least": least, "centroid": [c.astype(np.float32).tobytes() for c in centroids]})

    # repeated rows draw alike: one of them is enough, and the bound holds
    sample = seen.where("counts is not null").select("lang", "draw", "counts").groupBy("lang", "draw").agg(F.min("counts").alias("counts"))
    fitted = sample.groupBy("lang").applyInPandas(cluster, "lang string, least double, centroid binary")
    found = sorted(fitted.collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in found], np.float32).reshape(-1, WIDTH)
    return Model(idf, tuple(r["lang"] for r in found), centroids, np.array([r["least"] for r in found]))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected.

    A text without a letter (or null) is ``und`` with score 0 and rejected. A text of at least 200 n-grams is rejected if it is
    too far from every centroid of its nearest language; shorter ones are too noisy for that. A model without languages says ``und`` and rejects nothing but
    texts without letters. Columns of these names are replaced, all others kept.
    """

    def compute(texts: list) -> list[list]:
        langs, scores, rejected = [], [], []
        for k in range(0, len(texts), 256):
            counts = np.array([gram_counts(t) for t in texts[k : k + 256]])
            totals = counts.sum(axis=1)
            cosines = _vectors(counts, model.idf) @ model.centroids.T if model.languages else np.zeros((len(counts), 0), np.float32)
            for total, row in zip(totals, cosines):
                if not total or not len(row):
                    langs.append(UNDETERMINED), scores.append(0.0), rejected.append(not total)
                    continue
                best = int(row.argmax())
                langs.append(model.languages[best])
                scores.append(float(min(1.0, max(0.0, row[best]))))
                rejected.append(bool(total >= FEWEST and row[best] < model.least[best]))
        return [langs, scores, rejected]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return with_columns(docs, [text], fields, compute)

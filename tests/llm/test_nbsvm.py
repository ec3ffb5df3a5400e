import random

import numpy as np
from pyspark.sql import functions as F

from viewloom.llm import nbsvm
from viewloom.llm.common import held_out

SCHEMA = "doc_id long, text string, predicted string, quality int"
WORDS = "the and of thing that tion ering with from was".split()


def text(rng, good):
    words = [rng.choice(WORDS) for _ in range(rng.randint(3, 60))]
    if not good:
        words = [w + "###" for w in words] if rng.random() < 0.5 else [w for w in words for _ in range(6)]
    return " ".join(words)


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    rows = [(i, rng.random() < 0.8) for i in range(500)]
    docs = spark.createDataFrame([(i, text(rng, good), "old", 9) for i, good in rows], SCHEMA)
    labels = spark.createDataFrame([(i, int(good), 0) for i, good in rows if i % 3] + [(7, None, 0), (None, 1, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    model = nbsvm.fit(docs, labels, ~held_out())
    got = {r.doc_id: r for r in nbsvm.score(docs.withColumn("held", held_out()), model).collect()}
    tested = [(i, good) for i, good in rows if got[i].held]
    assert len(tested) > 100 and sum(got[i].predicted == good for i, good in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in got.values())
    odd = spark.createDataFrame([(1, None, "", 0), (2, "", "", 0), (None, "the and", "", 0), (None, "the and", "", 0), (3, "the thing " * 200_000, "", 0)], SCHEMA)
    scored = sorted(nbsvm.score(odd, model).collect(), key=str)
    assert len(scored) == 5 and len({r.score for r in scored if not r.text}) == 1
    assert nbsvm.score(odd.limit(0), model).count() == 0


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.random((60, 12)) < 0.4
    y = np.where(x[:, 0] | x[:, 1], 1.0, -1.0)
    ratios, cost = rng.normal(size=12), np.ones(60)
    weights, bias = nbsvm._descend([np.flatnonzero(r) for r in x], ratios, y, cost)
    scaled = np.array([ratios * r / max(1e-12, np.linalg.norm(ratios * r)) for r in x])

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - y * (scaled @ w + b)) ** 2).sum()

    best = loss(weights, bias)
    for _ in range(300):
        assert best <= loss(weights + rng.normal(size=12) * 0.05, bias + rng.normal() * 0.05) + 1e-2


def test_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a", "", 0), (2, "b", "", 0)], SCHEMA)
    one = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    assert {r.predicted for r in nbsvm.score(docs, nbsvm.fit(docs, one, F.lit(True))).collect()} == {0}
    assert {r.score for r in nbsvm.score(docs, nbsvm.fit(docs, one.limit(0), F.lit(True))).collect()} == {0.5}

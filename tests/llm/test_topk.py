import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, vector int, rank string"


def slow(rows, k=5):
    usable = [(i, [np.floor(256 * np.float64(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for n, (i, q) in enumerate(usable):
        if i % 50:
            continue
        scores = [(-int(sum(a * b for a, b in zip(q, v))), j) for m, (j, v) in enumerate(usable) if m != n]
        found += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def got(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, **more).collect())


def vectors(n, seed=0, width=16):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=width).astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize("block", [4096, 3])
def test_agrees_with_all_pairs(spark, block):
    rows = vectors(400)
    assert got(spark, rows, block=block) == slow(rows)


def test_copies_ties_and_bad_vectors(spark):
    rows = vectors(120, 1, 6)
    copies = [(i, rows[50][1]) for i in range(1000, 1060)] + [(i, rows[7][1]) for i in range(2000, 2011)]
    odd = [(150, None), (151, [1.0, None, 2.0]), (152, [float("nan")] * 6), (153, [float("inf")] * 6), (None, rows[3][1]), (200, [0.0] * 6), (250, []), (300, [1.0]), (154, [-0.0] * 6)]
    rows = rows + copies + odd
    assert got(spark, rows) == slow(rows)


def test_repeated_rows(spark):
    rows = vectors(60, 2, 4)
    rows += [rows[50], rows[50], rows[3]]
    assert got(spark, rows) == slow(rows)


def test_few_and_no_rows(spark):
    rows = vectors(3, 3)
    assert got(spark, rows) == slow(rows) and len(slow(rows)) == 2
    assert got(spark, []) == [] and got(spark, rows[1:]) == []

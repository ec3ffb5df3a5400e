"""Exact top-k inner products by a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.session import materialize, scratch_path

#: Components become floor(SCALE * x).
SCALE = 256
#: Score lists per vector: the dimensions are split into so many blocks.
LISTS = 2
#: Distinct query vectors worked off at a time: what the driver and each task hold of the queries.
BLOCK = 4096
#: Candidates of one matrix product.
STEP = 512


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))


def _matrix(vectors: list, width: int) -> np.ndarray:
    found = np.zeros((len(vectors), width))
    for row, v in zip(found, vectors):
        row[: len(v)] = v
    return found


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, STEP):
            part = batch.slice(k, STEP)
            yield *(part.column(i).to_numpy(zero_copy_only=False) for i in range(2)), _matrix(part.column(2).to_pylist(), width)


def _bounds(width: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, width, LISTS + 1).astype(int).tolist()
    return list(zip(edges, edges[1:]))


ENTRY = "query long, least long, vector long, score double"


def _frame(query: np.ndarray, least: np.ndarray, vector: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query.astype(np.int64)), pa.array(least), pa.array(vector), pa.array(score)], names=["query", "least", "vector", "score"])


def _local_lists(queries: np.ndarray, k: int):
    """Phase 1 in a task: of every score list of every query the k highest entries, each with its whole score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _bounds(queries.shape[1])
        held: list = [None] * len(blocks)
        for least, vector, matrix in _batches(batches, queries.shape[1]):
            scores = [queries[:, i:j] @ matrix[:, i:j].T for i, j in blocks]
            total = sum(scores)
            for b, one in enumerate(scores):
                rows = [one, total, np.broadcast_to(least, one.shape), np.broadcast_to(vector, one.shape)]
                if held[b] is not None:
                    rows = [np.concatenate(pair, axis=1) for pair in zip(held[b], rows)]
                best = np.argpartition(-rows[0], min(k, rows[0].shape[1]) - 1, axis=1)[:, :k]
                held[b] = [np.take_along_axis(x, best, 1) for x in rows]
        for rows in held:
            if rows is not None and len(queries):
                yield _frame(np.repeat(np.arange(len(queries)), rows[0].shape[1]), rows[2].ravel(), rows[3].ravel(), rows[1].ravel())

    return run


def _first(entries: tuple, k: int) -> tuple:
    """The k best entries of each query: by score, then the least id."""
    query, least, vector, score = entries
    order = np.lexsort((vector, least, -score, query))
    query = query[order]
    start = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
    return tuple(x[order][place < k] for x in entries)


def _sufficient(queries: np.ndarray, cutoff: np.ndarray, k: int):
    """Phases 2 and 3 in a task: entries that reach the uniform share of the cutoff in some list, then their whole scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _bounds(queries.shape[1])
        share = cutoff[:, None] / len(blocks)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for least, vector, matrix in _batches(batches, queries.shape[1]):
            enough = np.zeros((len(queries), len(matrix)), bool)
            for i, j in blocks:
                enough |= queries[:, i:j] @ matrix[:, i:j].T >= share
            query, at = np.nonzero(enough)
            for n in range(0, len(query), 1 << 16):
                q, a = query[n : n + (1 << 16)], at[n : n + (1 << 16)]
                score = np.einsum("ij,ij->i", queries[q], matrix[a])
                high = score >= cutoff[q]
                a = a[high]
                held = tuple(np.concatenate(x) for x in zip(held, (q[high], least[a], vector[a], score[high])))
                if len(held[0]) > max(1 << 18, 4 * k * len(queries)):
                    held = _first(held, k)
        yield _frame(*_first(held, k))

    return run


def _best(entries: DataFrame, k: int) -> DataFrame:
    """The k best entries of each query; Spark limits the groups before and after the exchange."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "least", "vector")
    return entries.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k highest integer inner products with all other rows.

    Components become floor(256 x); scores are exact below 2**53 and stop at the limits of a long. Ties go to the smaller id. The score
    of a pair is the sum of two partial scores, one for each half of the dimensions (a shorter vector counts as filled up with zeros).

    1. Each task gathers the k + 1 highest entries of each list; the (k + 1)-th best whole score among all of them is a safe cutoff.
    2. A pair that reaches the cutoff reaches half of it in one list at least: only such entries are collected.
    3. Their whole scores are resolved, and those at or above the cutoff are ranked.

    Queries go in blocks of about ``block`` distinct vectors, so that what is sent to the tasks does not grow with the data. Equal
    vectors enter once, with their k + 1 smallest ids. Rows with a null id, null vectors and vectors with a null or non-finite component take no
    part. Each of several rows with one id is a query and a candidate. An empty table gives an empty result.
    """
    spark, name = vectors.sparkSession, F.col(f"`{vector}`")
    rows = vectors.where(_usable(name) & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("id"), _integers(name).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row")
    )
    rows = materialize(rows, "vectors")
    few = Window.partitionBy("v").orderBy("id")
    kept = rows.select("v", "id").withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    groups = kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.where("asks").select("v").distinct().withColumn("asked", F.lit(True))
    groups = groups.join(asked, "v", "left").withColumn("least", F.col("ids")[0]).withColumn("vector", F.monotonically_increasing_id())
    groups = materialize(groups, "groups")
    width, wanted = groups.agg(F.max(F.size("v")), F.count("asked")).first()
    parts = max(1, -(-wanted // block))
    part = F.pmod(F.xxhash64("vector"), F.lit(parts))
    candidates = groups.select("least", "vector", "v")
    path = scratch_path(spark, "top")
    for number in range(parts):
        picked = groups.where(F.col("asked") & (part == number)).select("vector", "v").collect()
        queries = _matrix([r["v"] for r in picked], width or 0)
        lists = candidates.mapInArrow(_local_lists(queries, k + 1), ENTRY).distinct()
        last = _best(lists, k + 1).groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("cutoff"))
        cutoff = np.full(len(queries), -np.inf)  # with fewer entries than wanted every pair counts
        for r in last.where(F.col("n") == k + 1).collect():
            cutoff[r["query"]] = r["cutoff"]
        numbers = spark.createDataFrame([(i, r["vector"]) for i, r in enumerate(picked)], "query long, asking long")
        best = _best(candidates.mapInArrow(_sufficient(queries, cutoff, k + 1), ENTRY), k + 1)
        best.join(numbers, "query").select("asking", "vector", "score").write.mode("append").parquet(path)
    found = spark.read.schema("asking long, vector long, score double").parquet(path)
    asking = groups.where("asked").select(F.col("vector").alias("asking"), "v").join(rows.where("asks").select("v", "row", F.col("id").alias("query_id")), "v").drop("v")
    pairs = asking.join(found, "asking").join(groups.select("vector", "ids"), "vector")
    own = F.when(F.col("asking") == F.col("vector"), F.array_position("ids", F.col("query_id"))).otherwise(F.lit(0)).cast("int")
    others = F.when(own > 0, F.concat(F.slice("ids", F.lit(1), own - 1), F.slice("ids", own + 1, F.size("ids")))).otherwise(F.col("ids"))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = pairs.select("row", "query_id", "score", F.explode(others).alias("vec_id")).withColumn("rank", F.row_number().over(order))
    limit = float(2**63 - 1024)
    score = F.greatest(F.least(F.col("score"), F.lit(limit)), F.lit(-limit)).cast("long")
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))

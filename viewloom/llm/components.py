"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.session import materialize, release, written

#: Links that one task writes, and tasks at least: a round of few links does not write a file for every shuffle partition.
LINKS, TASKS = 1 << 16, 16


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is the least node in it.

    Each round hangs the larger neighbours of a node on its least neighbour, then the smaller ones, until the
    links are stars: every node has one link, and none hangs on a node that hangs itself. A round is two aggregations with partial minima and two
    equality joins, so a hub with many links is never gathered: the minima are written first, so that Spark can
    split the links of a hub when it joins them. The rounds grow with the logarithm of the longest path; links that are stars but for a few
    take one or two. Null ends and links of a node to itself are ignored, repeated links count once. Every round is written to
    the checkpoint folder, and the round before it is deleted.
    """
    clean = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    mark = written()
    links = materialize(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    parts = max(TASKS, -(-links.count() // LINKS))
    while not _stars(links):
        links = materialize(_small_star(materialize(_large_star(links, parts).coalesce(parts), "links"), parts).coalesce(parts), "links")
        release(links.sparkSession, mark, keep=1)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select("v", "v").distinct().toDF("node", "component")
    )


def _stars(links: DataFrame) -> bool:
    """Whether every node that hangs on another has one link and nothing hangs on it."""
    ends = links.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def _large_star(links: DataFrame, parts: int) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v"), F.col("u"))).toDF("u", "v")
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(parts), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame, parts: int) -> DataFrame:
    least = materialize(links.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "least")
    hung = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()
